"""SimHash near-duplicates against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from stridelake.llm import simhash
from tests.llm.brute import WORD


def brute_print(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[k : k + 4]).encode(), 42) for k in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows, within=4):
    """(id, fingerprint) -> component of each row."""
    prints = sorted({p for _, p in rows})
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for b in prints[:i]:
            if (a ^ b).bit_count() <= within:
                parent[find(a)] = find(b)
    least = {}
    for i, p in rows:
        if i is not None:
            least[find(p)] = min(least.get(find(p), i), i)
    return [(i, p, least.get(find(p))) for i, p in rows]


def test_whole_table_equals_brute_force(spark, sf, texts):
    got = {(r["doc_id"], int(r["fingerprint"], 16), r["component_id"]) for r in simhash.op13_simhash_gray_index(spark, sf).collect()}
    assert got == set(brute_components([(i, brute_print(t)) for i, t in texts]))


def near(rng, centre, bits):
    for b in rng.sample(range(64), bits):
        centre ^= 1 << b
    return centre


@pytest.mark.parametrize("within", [0, 2, 4])
def test_index_finds_every_link(within):
    rng = random.Random(within)
    prints = []
    for _ in range(6):
        centre = rng.getrandbits(64)
        prints += [near(rng, centre, rng.randint(0, 7)) for _ in range(60)]
    prints = sorted(set(prints) | {0, 2**64 - 1}, key=lambda p: gray(p))
    index = simhash.GrayIndex(np.array(prints, np.uint64), np.array([0]))
    labels = index.link(within, pairs=500)
    want = brute_components(list(enumerate(prints)), within)
    assert [int(x) for x in labels] == [c for _, _, c in want]


def gray(p):
    rank = 0
    while p:
        rank ^= p
        p >>= 1
    return rank


def test_several_groups_are_searched_apart():
    rng = random.Random(5)
    groups = [sorted({near(rng, 0, 3) for _ in range(n)}, key=gray) for n in (2, 9, 70, 3)]
    starts = np.cumsum([0, *map(len, groups)])[:-1]
    labels = simhash.GrayIndex(np.array(sum(groups, []), np.uint64), starts).link(4)
    at = 0
    for g in groups:
        want = [at + c for _, _, c in brute_components(list(enumerate(g)))]
        assert labels[at : at + len(g)].tolist() == want
        at += len(g)


def test_upper_nodes_take_the_common_bits():
    prints = np.array(sorted([0b1111_0000, 0b1111_0001, 0b1111_0011, 0b1111_0010], key=gray), np.uint64)
    index = simhash.GrayIndex(prints, np.array([0]), fan=2)
    assert len(index.levels) == 3 and int(index.own[2][0]) == 2**64 - 1 - 0b11
    assert all(int(a) & int(b) == 0 for a, b in zip(index.own[0], np.repeat(index.levels[1][1], 2)))


@pytest.mark.parametrize("limit", [100_000, 7])
def test_dense_groups_and_cells(spark, limit, monkeypatch):
    """A chain of near fingerprints, a dense ball and hot equal ones; small cells give the same."""
    rng = random.Random(11)
    centre = rng.getrandbits(64)
    prints = [near(rng, centre, rng.randint(0, 6)) for _ in range(150)] + [rng.getrandbits(64) for _ in range(50)] + [0] * 80
    step = rng.getrandbits(64)
    for _ in range(20):
        prints.append(step)
        step = near(rng, step, 4)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    rows = spark.createDataFrame([(i, 0, p) for i, p in enumerate(signed)], "__id long, __tk long, fp long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *a: rows)
    docs = spark.createDataFrame([], "doc_id long, text string")
    got = {(r["__id"], r["component"]) for r in simhash.simhash_components(docs, cell_limit=limit).collect()}
    assert got == {(i, c) for i, _, c in brute_components(list(enumerate(prints)))}


def test_odd_rows(spark, odd, empty):
    got = sorted(((r["__id"], r["fp"], r["component"]) for r in simhash.simhash_components(odd).collect()), key=str)
    rows = [(r["doc_id"], brute_print(r["text"])) for r in odd.collect()]
    want = [(i, p - 2**64 if p >= 2**63 else p, c) for i, p, c in brute_components(rows)]
    assert got == sorted(want, key=str) and len(got) == odd.count()
    assert simhash.simhash_components(empty).count() == 0
    kept = simhash.deduplicate(odd)
    assert kept.columns == odd.columns and kept.count() == 6  # id 9 is the least of two components
    assert simhash.deduplicate(empty).count() == 0


def test_long_text_is_counted_in_chunks(monkeypatch):
    text = " ".join(f"W{i * 31 % 977}" for i in range(5000))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "_CHUNK", 100)
    assert simhash.fingerprint(text.encode()) == whole == brute_print(text)
