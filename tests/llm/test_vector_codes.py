"""Vector code compression against a plain Lloyd of full scans."""

from __future__ import annotations

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from stridelake.llm import vector_codes as V


def brute(rows, parts=16, entries=64, rounds=2):
    """(id, vector, label) -> {id: (code, error, label_error)}, digest of the codebooks."""
    kept = [(i, [math.floor(256 * float(x)) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(min(kept)[1])
    edges = [width * p // parts for p in range(parts + 1)]
    cut = {i: [v[a:b] for a, b in zip(edges, edges[1:])] for i, v, _ in kept}
    books = [[cut[i][p] for i in sorted(cut)[:entries]] for p in range(parts)]
    apart = lambda x, e: sum((a - b) ** 2 for a, b in zip(x, e))

    def assign():
        return {i: [min(range(len(books[p])), key=lambda k: (apart(x, books[p][k]), k)) for p, x in enumerate(c)] for i, c in cut.items()}

    for _ in range(rounds):
        codes = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                mine = [cut[i][p] for i in cut if codes[i][p] == k]
                if mine:
                    books[p][k] = [sum(x) // len(mine) for x in zip(*mine)]
    codes = assign()
    errors = {i: sum(apart(x, books[p][codes[i][p]]) for p, x in enumerate(c)) for i, c in cut.items()}
    total = {}
    for i, _, label in kept:
        total[label] = total.get(label, 0) + errors[i]
    digest = hashlib.sha256(",".join(str(y) for book in books for e in book for y in e).encode()).hexdigest()
    return {i: ("".join(f"{k:02x}" for k in codes[i]), errors[i], total[label]) for i, _, label in kept}, digest


def run(spark, tmp_path, rows, kind="vec_id long, embedding array<float>, label int, v string, `a.b` int, codes int"):
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], kind)
    df.repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    return V.op12_active_lloyd_codes(spark, str(tmp_path)).collect()


def test_odd_rows_equal_brute_force(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, rng.uniform(-1, 1)]) for _ in range(32)], rng.choice([None, 0, 1])) for i in range(300)]
    rows[5] = (5, None, 1)
    rows[6] = (6, [None] * 32, 1)
    rows[7] = (7, [math.nan] * 32, 1)
    rows[8] = (8, [math.inf] + [0.0] * 31, None)
    rows[9] = (9, rows[10][1], 0)  # a tie: equal vectors start two entries
    rows = [(i, None if v is None else [x if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    want, digest = brute(rows)
    got = run(spark, tmp_path, rows)
    assert {r["vec_id"]: (r["code"], r["error"], r["label_error"]) for r in got} == want
    assert {r["codebooks_sha256"] for r in got} == {digest} and len(got) == 296
    assert got[0].asDict().keys() == {"vec_id", "code", "error", "label_error", "codebooks_sha256"}


def test_fewer_vectors_than_entries_and_uneven_parts(spark, tmp_path):
    rng = random.Random(4)
    rows = [(i, [float(np.float32(rng.uniform(-1, 1))) for _ in range(19)], None) for i in range(7)]
    want, digest = brute(rows)
    got = run(spark, tmp_path, rows + [(50, [0.5] * 3, 1), (51, [], 1)])  # other lengths are dropped
    assert {r["vec_id"]: (r["code"], r["error"], r["label_error"]) for r in got} == want
    assert {r["codebooks_sha256"] for r in got} == {digest}


def test_repeated_and_null_ids_stay(spark):
    rows = [(1, [0.5, 1.0], 0), (1, [0.5, 1.0], 0), (None, [3.0, 3.0], 1), (2, [0.0, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found, books, _ = V.compress(df, parts=2, entries=3)
    assert found.count() == 4 and len(books) == 3
    assert V.compress(df.where("1 = 0"))[0].count() == 0


def test_empty_table(spark, tmp_path):
    assert run(spark, tmp_path, []) == []


@pytest.mark.parametrize("seed", range(5))
def test_active_entries_equal_full_scans(seed):
    """Small whole numbers, so that ties are frequent."""
    rng = np.random.default_rng(seed)
    rows, before = rng.integers(-3, 4, (500, 4)), rng.integers(-3, 4, (20, 4))
    code, apart = V.nearest(rows, before)
    after = before.copy()
    moved = rng.random(20) < 0.4
    after[moved] += rng.integers(-1, 2, (moved.sum(), 4))
    got = V.reassign(rows, after, moved, code, apart)
    want = V.nearest(rows, after)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_active_entries_do_not_scan_settled_parts(monkeypatch):
    """Only moved entries are compared for parts whose entry stayed."""
    rng = np.random.default_rng(1)
    rows, books = rng.integers(-50, 50, (400, 4)), rng.integers(-50, 50, (16, 4))
    code, apart = V.nearest(rows, books)
    moved = np.zeros(16, bool)
    moved[3] = True
    seen = []
    plain = V.distances
    monkeypatch.setattr(V, "distances", lambda r, e: seen.append((len(r), len(e))) or plain(r, e))
    V.reassign(rows, books, moved, code, apart)
    mine = int((code == 3).sum())
    assert seen == [(mine, 16), (400 - mine, 1)]


def test_large_components_are_exact_or_an_error():
    rows, books = np.array([[2**29 + 1, -(2**29)]]), np.array([[-(2**29), 2**29 + 3]])
    assert V.distances(rows, books)[0, 0] == (2**30 + 1) ** 2 + (2**30 + 3) ** 2
    with pytest.raises(ArithmeticError):
        V.distances(np.array([[2**31]]), books[:, :1])


def test_equals_sql(spark, sf):
    got = {tuple(r) for r in V.op12_active_lloyd_codes(spark, sf).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf}/embeddings.parquet'")
    assert got == set(con.execute(V.ORACLE_SQL).fetchall())
