"""Substring dedup and n-gram join against brute force, on ordinary and on odd tables."""

from __future__ import annotations

import random

import numpy as np
import pytest

from stridelake.llm import base, ngram_join, substring_dedup
from tests.llm import brute


def _shape(df):
    return sorted(map(str, df.collect()))


def test_substring_query(spark, sf, texts):
    got = {r[0]: tuple(r[1:]) for r in substring_dedup.op3_substring_dedup(spark, sf).collect()}
    assert got == brute.substring(texts)


def test_jaccard_query(spark, sf, texts):
    got = {r[0]: tuple(r[1:]) for r in ngram_join.op10_ngram_jaccard_join(spark, sf).collect()}
    assert got == brute.jaccard(texts)


def _made(seed=3):
    rng = random.Random(seed)
    words = [f"v{i}" for i in range(400)]
    passages = [[rng.choice(words) for _ in range(n)] for n in (50, 60, 90, 49)]
    rows = []
    for i in range(60):
        w = [rng.choice(words) for _ in range(rng.randrange(0, 150))]
        for p in rng.sample(passages, rng.randrange(0, 3)):
            at = rng.randrange(0, len(w) + 1)
            w[at:at] = p
        rows.append((i, " ".join(w)))
    first = rows[1][1].split() or ["x"]
    for i in range(60, 100):  # near copies and copies
        w = list(first)
        for _ in range(rng.randrange(0, 4)):
            w[rng.randrange(len(w))] = "changed"
        rows.append((i, "\n".join(w)))
    return rows


def _lines(n, seed=2):
    """Documents of one line, repeated to different lengths, some with a beginning or an end of their own."""
    rng = random.Random(seed)
    line = [f"q{i}" for i in range(23)]
    rows = []
    for i in range(n):
        w = line * rng.randrange(2, 60)
        rows.append((i, " ".join([f"own{i}"] * rng.randrange(0, 3) + w[: rng.randrange(30, len(w))] + [f"end{i}"] * rng.randrange(0, 2))))
    return rows


@pytest.mark.parametrize("hot,piece", [(400_000, 512), (400_000, 64), (1, 512)])
def test_substring_of_repeated_lines(spark, hot, piece, monkeypatch):
    """A minimiser is weighed by its words; its strings end after some windows, hot ones travel as distinct windows."""
    monkeypatch.setattr(substring_dedup, "PIECE", piece)
    rows = _lines(40)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lost = {r["__id"]: (r["n_words"], r["n_removed"]) for r in substring_dedup.repeated_windows(df, hot=hot).collect()}
    assert lost == {i: v[:2] for i, v in brute.substring(rows).items() if v[1]}


def test_distinct_windows():
    words = [w.encode() for w in _lines(1)[0][1].split()] * 3
    for n in (50, 70, len(words)):
        got = substring_dedup.distinct_windows(words[:n], 50)
        want = {}
        for k in range(n - 49):
            want.setdefault(tuple(words[k : k + 50]), []).append(k)
        assert sorted(p for _, p in got) == sorted(want.values()) and len({d for d, _ in got}) == len(want)


@pytest.mark.parametrize("hot", [400_000, 100])
def test_substring_with_hot_minimisers(spark, hot):
    rows = _made()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lost = {r["__id"]: (r["n_words"], r["n_removed"]) for r in substring_dedup.repeated_windows(df, hot=hot).collect()}
    want = {i: v[:2] for i, v in brute.substring(rows).items() if v[1]}
    assert want and lost == want


@pytest.mark.parametrize("limits", [(20_000, 2_000_000), (4, 900)])
def test_jaccard_in_cells(spark, limits, monkeypatch):
    """Heavy lists and blocks are dealt into cells; no link is lost."""
    monkeypatch.setattr(ngram_join, "LIST_LIMIT", limits[0])
    monkeypatch.setattr(ngram_join, "BLOCK_LIMIT", limits[1])
    rows = _made(5)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["__id"]: (r["n_shingles"], r["component"]) for r in ngram_join.jaccard_components(df).collect()}
    want = brute.jaccard(rows)
    assert len({c for _, c in want.values()}) < len(rows) and got == want


def test_a_shingle_of_many_documents_is_split(spark, monkeypatch):
    """No shingle is put last and one is in a third of all prefixes: no list and no cell takes them all, no link is lost."""
    monkeypatch.setattr(ngram_join, "FREQUENT_KEPT", 0)
    monkeypatch.setattr(ngram_join, "LIST_LIMIT", 12)
    rng = random.Random(4)
    rows = [(i, "one two three four five " + " ".join(f"u{rng.randrange(400)}" for _ in range(rng.randrange(2)))) for i in range(120)]
    rows += [(200 + i, " ".join(f"z{rng.randrange(10**6)}" for _ in range(12))) for i in range(240)]
    gathered = []
    plain = ngram_join.cells

    def spy(df, key, member, weight, limit):
        out = plain(df, key, member, weight, limit)
        gathered.append(out.groupBy(key, "__cell_a", "__cell_b").count().agg({"count": "max"}).first()[0])
        return out

    monkeypatch.setattr(ngram_join, "cells", spy)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["__id"]: (r["n_shingles"], r["component"]) for r in ngram_join.jaccard_components(df).collect()}
    assert got == brute.jaccard(rows)
    prefixes = spark.createDataFrame([(1, i) for i in range(5_000)] + [(2 + i % 50, i) for i in range(300)], "token long, rid long")
    lists = ngram_join._all_lists(prefixes, 640)
    assert lists.where("list = xxhash64(CAST(1 AS BIGINT), 'heavy')").count() == 5_000 and gathered[0] <= 24


def test_search_finds_every_link():
    rng = np.random.default_rng(1)
    core = rng.integers(0, 2**63, 200).astype(np.uint64)
    sets = [np.unique(np.r_[rng.choice(core, rng.integers(150, 200), replace=False), rng.integers(0, 2**63, rng.integers(0, 30)).astype(np.uint64)]) for _ in range(40)]
    forest = ngram_join.links_forest(sets)
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in forest:
        n = len(np.intersect1d(sets[i], sets[j]))
        assert 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n)
        parent[find(i)] = find(j)
    for i in range(len(sets)):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                assert find(i) == find(j)


def test_bitmaps_never_hide_a_link():
    rng = np.random.default_rng(2)
    for size in (3, 40, 500, 5000):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        keep = ngram_join.least_overlap(len(a), len(a))
        b = np.unique(np.r_[a[:keep], rng.integers(0, 2**63, len(a) - keep).astype(np.uint64)])
        bits = [ngram_join.bitmap(a), ngram_join.bitmap(b)]
        assert ngram_join._linkable(np.array([len(a), len(b)]), bits, 80, 100) == [(0, 1)]


def test_window_numbers_are_exact():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 2, 500)
    got = substring_dedup.window_numbers(ids, 7)
    seen = {}
    want = [seen.setdefault(tuple(ids[k : k + 7]), len(seen)) for k in range(494)]
    assert len(set(zip(got.tolist(), want))) == len(set(want)) == len(set(got.tolist()))


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40) if i != 20] + [(100, 3), (50, 50)]
    got = {r["node"]: r["root"] for r in base.components(spark.createDataFrame(edges, "u long, v long"), "t").collect()}
    assert got == {**{i: 0 for i in range(21)}, **{i: 21 for i in range(21, 41)}, 100: 0}
    assert base.components(spark.createDataFrame([], "u long, v long"), "t").count() == 0


def test_odd_rows(spark, odd, empty):
    kept = substring_dedup.deduplicate(odd)
    assert kept.columns == odd.columns
    left = {(r["doc_id"], r["text"]) for r in kept.collect()}
    assert (2, None) not in left and not [x for x in left if x[0] == 2]  # an exact copy of a smaller id loses all its words
    assert (3, "tail") in left and (4, None) in left and (5, "") in left and (None, "one two") in left
    single = ngram_join.deduplicate(odd)
    assert single.columns == odd.columns
    ids = sorted((r["doc_id"] if r["doc_id"] is not None else -1) for r in single.collect())
    # 2 is a copy of 1, 3 a near copy; 8 and the null id say what 7 says; texts without words stay
    assert ids == [-1, 1, 4, 5, 6, 7, 9, 9, 10]
    for f in (substring_dedup.deduplicate, ngram_join.deduplicate):
        assert f(empty).collect() == []
    twice = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f")], "doc_id long, text string")
    assert ngram_join.deduplicate(twice).count() == 1
