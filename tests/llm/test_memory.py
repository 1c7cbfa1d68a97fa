"""What a Python worker holds when a step is over: Spark uses it again, and its memory counts beside the JVM's."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import pytest

import corpus_pipeline
from stridelake.llm import packing, tokens

_WORKER = """
import re
from pathlib import Path
import numpy as np
import pyarrow as pa
from stridelake.llm import ngram_join
from stridelake.llm.base import tidy

def held():
    return sum(map(int, re.findall(r"\\nPss_Anon:\\s+(\\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024

def batches():
    rng = np.random.default_rng(0)
    for _ in range(4):
        texts = [" ".join(map(str, rng.integers(0, 1 << 40, 400).tolist())) for _ in range(1500)]
        ids = pa.array(range(1500), pa.int64())
        yield pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], ["__id", "__tk", "text"])

before, most, rows = held(), 0, 0
for out in tidy(ngram_join._sketch)(batches()):
    rows, most = rows + out.num_rows, max(most, held())
del out
print(rows, most - before, held() - before)
"""


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_freed_memory_goes_back():
    rows, most, after = map(float, subprocess.run([sys.executable, "-c", _WORKER], capture_output=True, text=True, check=True, cwd=Path(__file__).parents[2]).stdout.split())
    assert rows == 6000
    assert after < most / 3


def test_arrow_steps_of_the_pipeline_are_tidy(spark, sf, monkeypatch):
    """Every Arrow step of every stage gives back what it freed."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    kind, steps = type(docs), []
    plain = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, func, *a, **b: steps.append(func.__qualname__) or plain(self, func, *a, **b))
    for name, stage in corpus_pipeline.STAGES:
        steps.clear()
        stage(spark, docs, sf)
        assert steps and set(steps) == {"tidy.<locals>.tidied"}, (name, steps)


def test_words_go_when_the_encoding_is_over():
    """The tokenizer stays with its worker; the words it knows do not outlast the encoding, and are learned again."""
    tokenizer, text = tokens.worker_tokenizer(), b"words that are known, then not"
    ids = tokenizer.encode([text])
    assert tokenizer._known
    assert not list(packing._placed({}, 0, 0, 0, packing.WINDOW, packing.UNIT, True)(iter(())))
    assert tokens.worker_tokenizer() is tokenizer and not tokenizer._known and not tokenizer._older
    assert tokenizer.encode([text]) == ids
