"""The pipeline's stages, in a row and on odd rows."""

from __future__ import annotations

from collections import Counter

import numpy as np

import corpus_pipeline
from stridelake.llm import packing, quality_rules
from tests.llm import brute
from tests.llm.test_tokens_and_files import _check_packing, encode  # noqa: F401


def test_stages(spark, sf, texts, encode):  # noqa: F811
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf)
        rows = out.collect()
        if name != "packing":
            assert out.columns == columns
        kept[name] = rows
        docs = spark.createDataFrame(rows, out.schema)
    after = lambda name: [(r["doc_id"], r["text"]) for r in kept[name]]
    quality = after("quality_rules")
    assert set(quality) < set(texts)
    judged = {r["doc_id"]: r["kept"] for r in quality_rules.op9_robust_outliers(spark, sf).collect()}
    assert {i for i, _ in quality} == {i for i, k in judged.items() if k}
    for i, text in texts:
        n, _, _, _, repeated = brute.base_statistics(text)
        assert not (judged[i] and (n < 10 or 100 * repeated > 20 * n))
    want = brute.jaccard(quality)
    assert set(after("ngram_jaccard_join")) == {(i, t) for i, t in quality if want[i][1] == i}
    removed = brute.substring(after("ngram_jaccard_join"))
    shortened = {i: t for i, t in after("substring_dedup")}
    assert set(shortened) == {i for i, (n, gone, _) in removed.items() if gone < n or n == 0}
    assert all(len(brute.WORD.findall(t)) == removed[i][0] - removed[i][1] for i, t in shortened.items())
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert set(after("benchmark_decontamination")) == {(i, t) for i, t in after("substring_dedup") if not any(b in t for b in items)}
    pieces = kept["packing"]
    _check_packing(pieces, after("benchmark_decontamination"), encode)
    assert all(p["length"] == len(np.frombuffer(p["ids"], "<u4")) for p in pieces)


def test_packing_of_repeated_ids(spark, encode):  # noqa: F811
    """Rows with one id, or with none, are documents of their own: all their ids are there, in their order."""
    rows = [(1, "a b c " * 900), (1, "d e " * 1_200), (1, "a b c " * 900), (None, "f " * 50), (None, None), (2, "g")]
    pieces = packing.pack(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    of = Counter()
    for p in pieces:
        of[p["doc_id"], p["doc_tokens"]] += p["length"]
    assert of == Counter({k: n * k[1] for k, n in Counter((i, len(encode(t, 1))) for i, t in rows).items()})
    told = Counter(int(x) for p in pieces for x in np.frombuffer(p["ids"], "<u4"))
    assert told == Counter(int(x) for _, t in rows for x in encode(t, 1))


def test_odd_rows(spark, sf, odd, empty):
    for given in (odd, empty):
        docs = given
        for _, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame((out := stage(spark, docs, sf)).collect(), out.schema)
        assert (docs.count() > 0) == (given is odd)
