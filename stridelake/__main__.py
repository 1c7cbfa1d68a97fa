"""Command line: ``python -m stridelake <command> ...``.

  pipeline     --raw DIR --countries DIR --out ROOT    batch run, every layer written
  incremental  --raw DIR --countries DIR --out ROOT    streaming tables + recomputed gold
  ask          --lake ROOT --question NAME [--rows N | --out DIR]  run a mart question: print or write all its rows
  questions                                             list the question names
"""

from __future__ import annotations

import argparse
import inspect

from stridelake.plans import questions as Q

QUESTIONS = {
    name: fn
    for name, fn in inspect.getmembers(Q, inspect.isfunction)
    if name[:1] == "q" and name[1:2].isdigit()
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="stridelake")
    sub = parser.add_subparsers(dest="command", required=True)
    for name in ("pipeline", "incremental"):
        p = sub.add_parser(name)
        p.add_argument("--raw", required=True)
        p.add_argument("--countries", required=True)
        p.add_argument("--out", required=True)
    ask = sub.add_parser("ask")
    ask.add_argument("--lake", required=True)
    ask.add_argument("--question", required=True, choices=sorted(QUESTIONS))
    ask.add_argument("--rows", type=int, help="print only so many rows (the rest is counted)")
    ask.add_argument("--out", help="write the answer to this folder as CSV instead of printing it")
    sub.add_parser("questions")
    args = parser.parse_args(argv)

    if args.command == "questions":
        for name in sorted(QUESTIONS):
            print(name)
        return

    from stridelake.session import build_session

    spark = build_session()
    if args.command == "pipeline":
        from stridelake.plans.pipeline import run_pipeline
        from stridelake.schemas import COUNTRY_SCHEMA
        from stridelake.sources import files

        raw = files.read_csv(spark, args.raw)
        countries = files.read_csv(spark, args.countries, COUNTRY_SCHEMA)
        lake = run_pipeline(spark, raw, countries, args.out)
        print("quality gate:", lake.quality)
    elif args.command == "incremental":
        from stridelake.streaming.pipeline import run_incremental

        run_incremental(spark, args.raw, args.countries, args.out)
    else:
        from stridelake.plans.lake import StoredLake

        lake = StoredLake(spark, args.lake)
        fn = QUESTIONS[args.question]
        source = lake.mart_time if "mart_time" in inspect.signature(fn).parameters else lake.mart_distance
        answer = fn(source)
        if args.out:
            answer.write.options(header="true").csv(args.out)
            return
        n = answer.count()
        answer.show(n if args.rows is None else args.rows, truncate=False)
        if args.rows is not None and args.rows < n:
            print(f"{n - args.rows} more rows were left out (--rows)")


if __name__ == "__main__":
    main()
