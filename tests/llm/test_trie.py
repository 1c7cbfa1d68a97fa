"""The prefix trie against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest

from stridelake.llm import prefix_trie as P

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def ordered(rows):
    """(conv, turn, role, text) -> {conv: [(role, text)]}."""
    own = {}
    for c, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        if c is not None:
            own.setdefault(c, []).append((role or "", text or ""))
    return own


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + turns[h:]
    return out


def brute(convs):
    """{conv: [(role, text)]} -> rows of COLUMNS."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for k in members:
        if k:
            children[k[:-1]] = children.get(k[:-1], 0) + 1
    leaves, saved = {}, {}
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] = leaves.get(k[:d], 0) + (k not in children)
            saved[k[:d]] = saved.get(k[:d], 0) + (len(m) - 1) * (len(k[-1][1]) if k else 0)
    ends = lambda k: hashlib.sha256(",".join(str(c) for c in sorted(members[k]) if len(convs[c]) == len(k)).encode()).hexdigest()
    return {(min(m), len(k), min(members[k[:-1]]) if k else None, len(m), children.get(k, 0), leaves[k], saved[k], ends(k)) for k, m in members.items()}


def rows_of(df):
    got = df.select(*COLUMNS).collect()
    assert len(got) == len(set(got))
    return {tuple(r) for r in got}


def test_whole_table_equals_brute_force_and_sql(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = rows_of(P.op11_prefix_trie(spark, sf))
    assert got == brute(rebuilt(ordered(rows)))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    found = con.execute(P.ORACLE_SQL)
    names = [d[0] for d in found.description]
    assert {tuple(dict(zip(names, r))[c] for c in COLUMNS) for r in found.fetchall()} == got


def random_conversations(rng, n, words=3, longest=9):
    """Few texts, so that prefixes, whole sequences and first turns repeat."""
    rows = []
    for c in range(n):
        for turn in range(rng.randint(1, longest)):
            rows.append((c, turn, rng.choice(["user", "assistant"]) if rng.random() < 0.2 else "user", "é" * rng.randint(0, words) if turn else "hello"))
    return rows


@pytest.mark.parametrize("shard", [1, 7, 40, 200_000])
def test_shards_of_any_size_agree(spark, shard):
    rows = random_conversations(random.Random(8), 250)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    assert rows_of(P.prefix_trie(df, shard)) == brute(ordered(rows))


def test_odd_rows(spark, tmp_path):
    """Nulls in every column, ties, repeated rows, negative ids, equal conversations, a base that is a prefix or is missing, clashing names."""
    rows = [(None, 0, "user", "lost"), (-7, None, None, None), (-7, 3, "user", "x")]
    for c in (0, 1, 2, 3, 4, 5, 17, 18, 100, 101, 199, 300, 205, 206):
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(c % 5 + 1)]
    rows += [(3, 1, "user", "tie b"), (3, 1, "user", "tie a"), (3, 1, "assistant", None), (3, None, "user", "early"), (3, None, None, "early"), (4, 0, "user", "t0"), (4, 0, "user", "t0")]
    df = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "conv_id long, turn long, role string, text string, ids string, n int, `a.b` int")
    df.write.parquet(f"{tmp_path}/conversations.parquet")
    got = rows_of(P.op11_prefix_trie(spark, str(tmp_path)))
    assert got == brute(rebuilt(ordered(rows)))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    found = con.execute(P.ORACLE_SQL)
    names = [d[0] for d in found.description]
    assert {tuple(dict(zip(names, r))[c] for c in COLUMNS) for r in found.fetchall()} == got
    assert P.prefix_trie(df.where("1 = 0")).count() == 0


def test_last_turns_have_their_texts(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (2, 0, "user", "hi"), (2, 1, "assistant", "no"), (3, 0, "user", "hi")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {(r["depth"], r["role"], r["text"], r["n_convs"], r["saved_tokens"]) for r in P.prefix_trie(df).collect()}
    assert got == {(0, None, None, 3, 4), (1, "user", "hi", 3, 4), (2, "assistant", "yes", 1, 0), (2, "assistant", "no", 1, 0)}


def test_long_conversation_and_many_equal_ones(spark, monkeypatch):
    """A conversation of a third of all rows, cut into chunks, and a class with very many members."""
    rows = [(900, t, "user", f"w{t % 13}") for t in range(9_000)]
    rows += [(c, t, "user", f"same{t}") for c in range(1_000, 4_000) for t in range(3)] + [(901, t, "user", f"w{t % 13}") for t in range(8_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    monkeypatch.setattr(P, "RUN_BYTES", 4_000)
    assert rows_of(P.prefix_trie(df)) == brute_long(ordered(rows))


def brute_long(convs):
    """`brute` for two long chains: the deeper prefixes of 900 and 901 counted by hand."""
    sizes = [len(t) for _, t in convs[900]]
    below = lambda d: sum(sizes[d - 1 : 8_000]) if 0 < d <= 8_000 else 0
    ends = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    same = list(range(1_000, 4_000))
    own = [len(t) for _, t in convs[1_000]]
    out = {(900, 0, None, 3_002, 2, 2, below(1) + 2_999 * sum(own), ends([]))}
    out |= {(900, d, 900, 2 if d <= 8_000 else 1, int(d < 9_000), 1, below(d), ends([901] if d == 8_000 else [900] if d == 9_000 else [])) for d in range(1, 9_001)}
    return out | {(1_000, d, 900 if d == 1 else 1_000, 3_000, int(d < 3), 1, 2_999 * sum(own[d - 1 :]), ends(same if d == 3 else [])) for d in (1, 2, 3)}


def test_medians_balance_the_tree():
    tree = P.TernarySearchTree()
    for i in P.medians(1_023):
        tree.insert([i], [1])
    depth, deepest = {tree.equal[0]: 1}, 0
    for node in tree.traversal()[1:]:
        deepest = max(deepest, depth[node])
        for side in (tree.low[node], tree.high[node]):
            depth[side] = depth[node] + 1
    assert deepest == 10 and sorted(P.medians(57)) == list(range(57))


def test_tree_holds_only_what_is_shared():
    ids = [np.arange(1_000), np.r_[np.arange(5), 7_000 + np.arange(900)]]
    trie = P.ShardTrie(ids, [np.ones(len(x), np.uint32) for x in ids], [1, 2], [1, 1], ["a", "b"], -1, -1)
    assert len(trie.tree.symbol) == 6 and sum(len(c[0]) for c in trie.rows()) == 6 + 995 + 900
