"""Lost tasks: the silver write survives failed task attempts.

A separate Spark application (``local[4,4]`` allows task retries) writes
bronze, then writes silver while the first attempt of every other task fails
midway.  The retried job must commit each row exactly once, with unique
``result_id`` values (the one non-deterministic column), and equal the silver
of a failure-free run.
"""

from __future__ import annotations

import json
import os
import subprocess
import sys
import textwrap

from tests.conftest import ROOT, SF_SMALL

SCRIPT = textwrap.dedent(
    """
    import json, sys
    sys.path.insert(0, ROOT)
    from pyspark import TaskContext
    from pyspark.sql import SparkSession, functions as F
    from stridelake.operators.lookup import CodeLookup
    from stridelake.plans import silver as silver_plan
    from stridelake.sources import fixture

    spark = (SparkSession.builder.master("local[4,4]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    fixture.raw_results(spark, SF).repartition(6).write.parquet(OUT + "/bronze")
    lookup = CodeLookup.prepare(fixture.countries(spark, SF))

    @F.udf("boolean")
    def survives(row_number):
        ctx = TaskContext.get()
        if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0 and row_number > 50:
            open(f"{OUT}/failed-{ctx.stageId()}-{ctx.partitionId()}", "w").close()
            raise RuntimeError("injected: executor lost")
        return True

    bronze = spark.read.parquet(OUT + "/bronze")
    flaky = bronze.withColumn("__n", F.monotonically_increasing_id() % 1000).filter(survives("__n")).drop("__n")
    silver_plan.silver(flaky, lookup).write.parquet(OUT + "/silver_flaky")
    silver_plan.silver(bronze, lookup).write.parquet(OUT + "/silver_clean")

    a = spark.read.parquet(OUT + "/silver_flaky")
    b = spark.read.parquet(OUT + "/silver_clean")
    print(json.dumps({
        "rows": a.count(),
        "distinct_ids": a.select("result_id").distinct().count(),
        "diff": a.drop("result_id").exceptAll(b.drop("result_id")).count()
                + b.drop("result_id").exceptAll(a.drop("result_id")).count(),
        "clean_rows": b.count(),
    }))
    """
)


def test_silver_write_survives_failed_task_attempts(tmp_path):
    code = f"ROOT = {ROOT!r}\nSF = {SF_SMALL!r}\nOUT = {str(tmp_path)!r}\n" + SCRIPT
    done = subprocess.run(
        [sys.executable, "-c", code], capture_output=True, text=True, timeout=600, env={**os.environ}
    )
    lines = [ln for ln in done.stdout.splitlines() if ln.startswith("{")]
    assert done.returncode == 0 and lines, done.stderr[-3000:]
    result = json.loads(lines[-1])
    assert result["rows"] == result["clean_rows"] > 0
    assert result["distinct_ids"] == result["rows"]
    assert result["diff"] == 0
    failed = [p for p in os.listdir(tmp_path) if p.startswith("failed-")]
    assert len(failed) >= 2, failed  # the injected failures did happen
