from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def texts(spark):
    """(doc_id, text) of the small table."""
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


LONG = " ".join(f"w{i * 7919 % 10007}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty and long texts, ties, repeated rows, columns named like the operators' own."""
    rows = [
        (1, LONG, "en", "a"), (2, LONG, "en", "a"), (2, LONG, "en", "a"), (3, LONG + " tail", None, None), (4, None, "en", "a"), (5, "", "en", "a"),
        (6, " \n\t ", "de", "b"), (7, "one two", "de", "b"), (8, "One TWO", "de", "b"), (None, "one two", "de", "b"), (None, None, None, None),
        (9, "a\u00a0b \u2003 \u00e9", "fr", "c"), (9, "same id, other text", "fr", "c"), (10, LONG[:3000].upper(), "en", "a"),
    ]
    rows = [(i, t, lang, source, len(t or ""), 1, 2, "x", "y", "z", 5) for i, t, lang, source in rows]
    return spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, __id int, h int, digest string, shard string, kept_text string, `a.b` int"
    )


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("1 = 0")
