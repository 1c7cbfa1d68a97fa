"""The command line end to end: CSV folders -> pipeline -> a mart question."""

from __future__ import annotations

import os
import subprocess
import sys

from stridelake.plans.pipeline import lake_for
from stridelake.session import new_run_dir
from stridelake.sources import files, fixture
from tests.conftest import ROOT, SF_SMALL


def _cli(*args: str) -> subprocess.CompletedProcess:
    env = {**os.environ, "PYTHONPATH": ROOT}
    return subprocess.run(
        [sys.executable, "-m", "stridelake", *args], capture_output=True, text=True, timeout=600, cwd=ROOT, env=env
    )


def test_cli_pipeline_and_ask(spark):
    run = new_run_dir(spark, "test-cli")
    files.write_csv(lake_for(spark, SF_SMALL).raw, f"{run}/raw")
    files.write_csv(fixture.countries(spark, SF_SMALL), f"{run}/countries")

    built = _cli("pipeline", "--raw", f"{run}/raw", "--countries", f"{run}/countries", "--out", f"{run}/lake")
    assert built.returncode == 0, built.stderr[-3000:]
    assert "quality gate:" in built.stdout and "rows_in" in built.stdout

    asked = _cli("ask", "--lake", f"{run}/lake", "--question", "q4b_best_100km_by_gender")
    assert asked.returncode == 0, asked.stderr[-3000:]
    assert "best_time_h" in asked.stdout

    listed = _cli("questions")
    assert listed.returncode == 0 and "q6b_first_women_50km" in listed.stdout
