"""SimHash near-duplicates: a hierarchical index over fingerprints in Gray order.

A document's fingerprint has a bit set where over half of its shingles' hashes have
it set (XXH64 with seed 42 of four lower-cased words, repeats included).  Two
documents link when their fingerprints differ in at most ``within`` bits.

1. Equal fingerprints are one row from here on, whatever number of documents has them.
2. The 64 bits are cut into ``within`` + 2 blocks.  Linked fingerprints differ in
   ``within`` blocks at most, so they agree in two: for each two blocks a fingerprint
   travels to the group that has its values there.  No link between different
   fingerprints is lost.  Groups too heavy for one task are dealt into cells in
   which any two members meet.
3. In a group fingerprints are sorted by Gray rank.  Every ``FAN`` neighbours get an
   upper node that holds the bits on which all of them agree (mask and value) and
   leaves its children only the rest, up to one root.  A search goes down from the
   root and adds up the differences to the nodes' patterns: what exceeds ``within``
   is pruned with the whole subtree, and so is a subtree whose members are all in
   the searcher's component already.  Searches run many at a time, in a scattered
   order, so a dense group of n fingerprints costs few times n steps, not n squared.
4. A group emits each member's link to its component's first member; components of
   these links are the result.

Defined results: null text, empty text and text without words: fingerprint zero,
linked like any other; under four words: one shingle, the whole sequence; rows with
a null id or a repeated id each get a row; a component's id is its least non-null
id (null only if all are null); an empty table gives an empty result; only the id
and the text are read, so other columns, whatever their names, do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.base import components, from_row, grouped_batches, materialize, table, text_key, text_slices, whole_row

#: Differing bits of linked fingerprints, words of a shingle, seed of the hash.
WITHIN, WORDS, SEED = 4, 4, 42
#: Children of an upper node.
FAN = 8
#: Members that a cell takes, fingerprints indexed at once, (search, member) pairs looked at once in the worst case.
CELL_LIMIT, AT_ONCE, PAIRS = 100_000, 200_000, 2_000_000
#: Shingles whose bits are counted at once.
_CHUNK = 1 << 16


def fingerprint(text: bytes, width: int = WORDS, seed: int = SEED) -> int:
    """The 64-bit fingerprint of a text (UTF-8)."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= width:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = len(words) - width + 1
    starts, stops = np.r_[0, ends[: n - 1]].tolist(), (ends[width - 1 :] - 1).tolist()
    counts = np.zeros(64, np.int64)
    for a in range(0, n, _CHUNK):
        b = min(n, a + _CHUNK)
        hashes = np.fromiter([digest(joined[s:e], seed) for s, e in zip(starts[a:b], stops[a:b])], np.uint64, b - a)
        counts += np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_slices(batches):
        found = np.array([fingerprint(t or b"") for t in texts], np.uint64)
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(found.view(np.int64))], ["__id", "__tk", "fp"])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """__id, __tk (tells apart rows with one id), fp (the fingerprint as a signed long) of every row."""
    kind = docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(F.col(id_col).alias("__id"), text_key(F.col(text_col)).alias("__tk"), F.col(text_col).alias("text"))
    return keyed.mapInArrow(_fingerprints, f"__id {kind}, __tk long, fp long")


def gray_rank(fp: Column) -> Column:
    """Place of a fingerprint in the order of the Gray code (its prefix parities)."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp


def block_pairs(within: int = WITHIN) -> list[tuple[tuple[int, int], tuple[int, int]]]:
    """Each two of ``within`` + 2 blocks of the 64 bits, as (first bit, width)."""
    edges = [64 * i // (within + 2) for i in range(within + 3)]
    return list(combinations([(a, b - a) for a, b in zip(edges, edges[1:])], 2))


def _grouped(prints: DataFrame, within: int, limit: int) -> DataFrame:
    """(group, cell_a, cell_b, gray, fp): each fingerprint in the groups of its block values; heavy groups in cells."""
    fp, keys = F.col("fp"), []
    for k, ((a, wide), (b, width)) in enumerate(block_pairs(within)):
        high = F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << wide) - 1))
        low = F.shiftrightunsigned(fp, b).bitwiseAND(F.lit((1 << width) - 1))
        keys.append(F.lit(k << 45) + F.shiftleft(high.cast("long"), 22) + low.cast("long"))
    rows = prints.select(fp, F.col("gray"), F.explode(F.array(*keys)).alias("group"))
    heavy = rows.groupBy("group").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit)
    heavy = materialize(heavy.select("group", F.ceil(F.col("n") * 2 / F.lit(limit)).cast("int").alias("m")), "simhash-heavy")
    rows = rows.join(heavy, "group", "left").withColumn("m", F.coalesce("m", F.lit(1)))
    rows = rows.withColumn("own", F.pmod(F.xxhash64("fp"), "m").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    return rows.select("group", F.least("own", "other").alias("cell_a"), F.greatest("own", "other").alias("cell_b"), "gray", "fp")


class GrayIndex:
    """Upper nodes over fingerprints that lie group by group and by Gray rank within a group.

    ``levels`` go from the leaves up to one root a group.  A node has a value and the
    mask of bits in which all its members have it; ``own`` is the part of the mask
    that its parent's mask leaves.
    """

    def __init__(self, prints: np.ndarray, starts: np.ndarray, fan: int = FAN):
        self.prints, self.labels = prints, np.arange(len(prints))
        self.sizes = np.diff(np.r_[starts, len(prints)])
        self.group = np.repeat(np.arange(len(starts)), self.sizes)
        group, every, some = self.group, prints, prints
        self.levels, self.first = [(every, np.full(len(prints), ~np.uint64(0)))], []
        while len(group) > len(starts):
            begins = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            place = np.arange(len(group)) - np.repeat(begins, np.diff(np.r_[begins, len(group)]))
            first = np.flatnonzero(place % fan == 0)
            every, some, group = np.bitwise_and.reduceat(every, first), np.bitwise_or.reduceat(some, first), group[first]
            self.first.append(first)
            self.levels.append((every, every | ~some))
        self.own = []
        for level, (_, mask) in enumerate(self.levels):
            if level < len(self.first):
                width = np.diff(np.r_[self.first[level], len(mask)])
                mask = mask & ~np.repeat(self.levels[level + 1][1], width)
            self.own.append(mask)
        self._spans()

    def _spans(self) -> None:
        """Least and greatest component of each node's members."""
        self.spans = [(self.labels, self.labels)]
        for first in self.first:
            low, high = self.spans[-1]
            self.spans.append((np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)))

    def search(self, queries: np.ndarray, within: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, member) pairs within the distance, members of the query's own component left out."""
        nodes, apart = self.group[queries], np.zeros(len(queries), np.int64)
        for level in range(len(self.levels) - 1, -1, -1):
            value, own = self.levels[level][0][nodes], self.own[level][nodes]
            apart = apart + np.bitwise_count((self.prints[queries] ^ value) & own)
            low, high = self.spans[level]
            mine = self.labels[queries]
            go = (apart <= within) & ((low[nodes] != mine) | (high[nodes] != mine))
            queries, nodes, apart = queries[go], nodes[go], apart[go]
            if level and len(nodes):
                first = self.first[level - 1]
                begin = first[nodes]
                width = np.r_[first, len(self.levels[level - 1][0])][nodes + 1] - begin
                ends = np.cumsum(width)
                queries, apart = np.repeat(queries, width), np.repeat(apart, width)
                nodes = np.arange(ends[-1]) + np.repeat(begin - ends + width, width)
        return queries, nodes

    def merge(self, a: np.ndarray, b: np.ndarray) -> None:
        """Put the members a[i] and b[i] into one component, named by its first member."""
        while True:
            x, y = self.labels[a], self.labels[b]
            differ = x != y
            if not differ.any():
                break
            a, b, x, y = a[differ], b[differ], x[differ], y[differ]
            up = np.arange(len(self.labels))
            np.minimum.at(up, np.maximum(x, y), np.minimum(x, y))
            while (up[up] != up).any():
                up = up[up]
            self.labels = up[self.labels]
        self._spans()

    def link(self, within: int, pairs: int = PAIRS) -> np.ndarray:
        """Components of all links: the first member's place for each member."""
        # Scattered order within a group: the first searches meet all of its clusters.
        scattered = np.lexsort(((self.prints * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(7), self.group))
        turn = np.empty(len(scattered), np.int64)
        turn[scattered] = np.arange(len(scattered)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        waiting = np.argsort(turn, kind="stable")
        while len(waiting):
            low, high = self.spans[-1]
            waiting = waiting[(low != high)[self.group[waiting]]]
            if not len(waiting):
                break
            cost = np.cumsum(self.sizes[self.group[waiting]])
            n = max(1, int(np.searchsorted(cost, pairs, side="right")))
            found = self.search(waiting[:n], within)
            waiting = waiting[n:]
            if len(found[0]):
                self.merge(*found)
        return self.labels


def _links(within: int):
    """Edges from members of groups (rows sorted by group, cell and Gray rank) to the first of their component there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in grouped_batches(batches, ["group", "cell_a", "cell_b"], AT_ONCE):
            keys = [rows[k].to_numpy() for k in ("group", "cell_a", "cell_b")]
            prints = rows["fp"].to_numpy().view(np.uint64)
            starts = np.flatnonzero(np.logical_or.reduce([np.r_[True, k[1:] != k[:-1]] for k in keys]))
            sizes = np.diff(np.r_[starts, len(prints)])
            prints, sizes = prints[np.repeat(sizes > 1, sizes)], sizes[sizes > 1]
            if not len(sizes):
                continue
            labels = GrayIndex(prints, np.cumsum(sizes) - sizes).link(within)
            linked = labels != np.arange(len(labels))
            if linked.any():
                yield pa.RecordBatch.from_arrays([pa.array(prints[linked].view(np.int64)), pa.array(prints[labels[linked]].view(np.int64))], ["u", "v"])

    return run


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", within: int = WITHIN, cell_limit: int = CELL_LIMIT) -> DataFrame:
    """One row for each row: __id, __tk, fp, component (least id), is_first (the row that a deduplication keeps)."""
    rows = materialize(fingerprints(docs, id_col, text_col), "simhash")
    first = F.min(F.struct(F.col("__id").isNull().alias("none"), F.col("__id").alias("id"), F.col("__tk").alias("tk")))
    prints = materialize(rows.groupBy("fp").agg(first.alias("first")).withColumn("gray", gray_rank(F.col("fp"))), "simhash-prints")
    groups = _grouped(prints, within, cell_limit).repartition("group", "cell_a", "cell_b")
    groups = groups.sortWithinPartitions("group", "cell_a", "cell_b", "gray")
    found = components(groups.mapInArrow(_links(within), "u long, v long").distinct(), "simhash-components")

    named = prints.join(found.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    named = materialize(named, "simhash-named")
    least = named.groupBy("root").agg(F.min("first").alias("least"))
    classes = named.join(least, "root").select("fp", "least")
    return rows.join(classes, "fp").select(
        "__id", "__tk", "fp", F.col("least.id").alias("component"), (F.col("least.id").eqNullSafe(F.col("__id")) & (F.col("least.tk") == F.col("__tk"))).alias("is_first")
    )


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`docs` with one row of each component (its least id; repeated equal rows are one)."""
    first = materialize(simhash_components(docs, id_col, text_col, **options).where("is_first").select("__id", "__tk").distinct(), "simhash-first")
    rows = docs.select(whole_row(docs), F.col(id_col).alias("__id"), text_key(F.col(text_col)).alias("__tk"))
    kept = rows.alias("d").join(first.alias("f"), F.expr("d.__id <=> f.__id AND d.__tk <=> f.__tk"), "left_semi")
    return kept.groupBy("__id", "__tk").agg(F.first("__row").alias("__row")).select(*from_row(docs.columns))


def op13_simhash_gray_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every document."""
    found = simhash_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("__id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))
