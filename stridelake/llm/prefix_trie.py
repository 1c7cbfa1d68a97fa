"""Prefix trie of conversations: ternary search trees over turn ids, a tree for each range shard.

A node is a distinct sequence of first turns (role, text); its members are the
conversations that start with it.  For each node the trie gives its members, its
children, the childless nodes below it and what its subtree saves when shared turns
are stored once.

1. Dictionary: distinct turns, sorted by role and text, are numbered in that order.
2. Turns are sorted by conversation and place over range partitions and packed into
   chunks, 8 bytes a turn, before anything is gathered by conversation.
3. Conversations with equal sequences are one class; the digest of its members' ids
   is streamed over sorted runs of ids.
4. The classes are sorted by their sequences and cut into shards of bounded weight.
   In a shard each sequence goes into a ternary search tree as far as a neighbour
   shares it, the median first, then the medians of both halves, which keeps the
   trees balanced.  What only one class has is a chain and never enters the tree.
5. An iterative traversal adds up members, leaves and savings from the bottom.
   Nodes that no other shard has are done.  A node on a border (the prefix that a
   shard's first or last sequence shares with the shard beside it) leaves its shard
   as a part: savings are written as members x length, less the length where the
   node first occurs, so that parts of one node add up.

Defined results: turns are ordered by number (null first), then role, then text;
null roles and texts are empty; repeated rows are turns of their own; rows with a
null conv_id belong to no conversation and are left out; an empty table has no
nodes, not even the root; other columns, whatever their names, are not read.  One
conversation's ids (12 bytes a turn) must fit in a row; its texts need not.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stridelake.llm.base import grouped_batches, materialize, table

#: Turns of a chunk, bytes of ids in a run, turns of a shard (one sequence at least).
CHUNK, RUN_BYTES, SHARD = 4_096, 1 << 20, 200_000
#: Bytes of a sequence (8 a turn) and characters of a text that range partitions are cut by; sorting is by the whole.
CUT_BYTES, CUT_CHARS = 256, 256
NO_ENDS = hashlib.sha256(b"").hexdigest()


# --- sequences of turn ids ------------------------------------------------------


def dictionary(turns: DataFrame) -> DataFrame:
    """Distinct turns of (role, text), numbered in that order: turn_id, digest, role, text, chars."""
    distinct = turns.select("role", "text").distinct()
    cuts = [F.substring("text", 1, CUT_CHARS), F.substring("text", CUT_CHARS + 1, CUT_CHARS)]
    ordered = distinct.repartitionByRange("role", *cuts).sortWithinPartitions("role", "text")
    return materialize(
        ordered.select(F.monotonically_increasing_id().alias("turn_id"), _digest().alias("digest"), "role", "text", F.length("text").alias("chars")), "turn-dictionary"
    )


def _digest():
    return F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by conversation and place: up to CHUNK turns of one conversation packed in a row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        conv = batch.column(0).to_numpy()
        ids, chars = batch.column(1).to_numpy().astype(">u8"), batch.column(2).to_numpy().astype("<u4")
        begins = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]])
        cuts = np.unique(np.concatenate([begins, np.arange(0, len(conv), CHUNK)])).tolist()
        spans = list(zip(cuts, [*cuts[1:], len(conv)]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(conv[cuts]), pa.array([ids[a:b].tobytes() for a, b in spans], pa.binary()), pa.array([chars[a:b].tobytes() for a, b in spans], pa.binary())],
            ["conv", "ids", "chars"],
        )


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks sorted by conversation and place, joined to one row a conversation."""
    for rows in grouped_batches(batches, ["conv"], 4_000):
        conv = rows["conv"].to_numpy()
        ids, chars = rows["ids"].to_pylist(), rows["chars"].to_pylist()
        begins = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]]).tolist()
        spans = list(zip(begins, [*begins[1:], len(conv)]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(conv[begins]), pa.array([b"".join(ids[a:b]) for a, b in spans], pa.binary()), pa.array([b"".join(chars[a:b]) for a, b in spans], pa.binary())],
            ["conv", "ids", "chars"],
        )


def sequences(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(conv, ids: big-endian 8-byte turn ids, chars: little-endian 4-byte lengths) of each conversation, and the dictionary."""
    empty = F.lit("")
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"), "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text")
    )
    names = dictionary(turns)
    # Joined by digest, so texts stay where they are; the hot turns' partitions are split by AQE.
    numbered = turns.select("conv", "turn", _digest().alias("digest")).join(names.select("digest", "turn_id", "chars"), "digest")
    numbered = materialize(numbered.select("conv", "turn", "turn_id", "chars"), "numbered-turns")
    place = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("turn_id")]
    chunks = numbered.repartitionByRange(*place).sortWithinPartitions(*place).select("conv", "turn_id", "chars")
    chunks = chunks.mapInArrow(_chunks, "conv long, ids binary, chars binary").withColumn("at", F.monotonically_increasing_id())
    chunks = materialize(chunks, "turn-chunks").repartition("conv").sortWithinPartitions("conv", "at").select("conv", "ids", "chars")
    return materialize(chunks.mapInArrow(_joined, "conv long, ids binary, chars binary"), "sequences"), names


def with_shared_heads(found: DataFrame) -> DataFrame:
    """Each conversation c after the first h turns of conversation c - c % 100 have replaced its own; h = crc32(c) % 6 (as in SQL, a remainder has the sign of c)."""
    heads = found.where("conv % 100 = 0").select(F.col("conv").alias("base"), F.substring("ids", 1, 40).alias("head_ids"), F.substring("chars", 1, 20).alias("head_chars"))
    h = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(6)).cast("int")
    both = found.withColumns({"base": F.expr("conv - conv % 100"), "h": h}).join(heads, "base", "left")
    rebuilt = lambda c, head, width: F.concat(
        F.coalesce(F.expr(f"substring({head}, 1, {width} * h)"), F.lit(b"")), F.expr(f"substring({c}, {width} * h + 1)")
    ).alias(c)
    return both.select("conv", rebuilt("ids", "head_ids", 8), rebuilt("chars", "head_chars", 4))


# --- classes of equal sequences -------------------------------------------------


def _id_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by class and id: runs of a class's ids as text, bounded in bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        kind, conv = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        out, a = [], 0
        while a < len(kind):
            b, size = a, 0
            while b < len(kind) and kind[b] == kind[a] and size < RUN_BYTES:
                size += 20
                b += 1
            out.append((kind[a], conv[a], b - a, ",".join(map(str, conv[a:b])).encode()))
            a = b
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out), (pa.binary(), pa.int64(), pa.int64(), pa.binary()))], ["class", "conv", "n", "run"])


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs sorted by class and first id: the class's least id, its size, the digest of all its ids."""
    last, state = None, None
    for batch in batches:
        done = []
        for kind, conv, n, run in zip(*(c.to_pylist() for c in batch.columns)):
            if kind != last:
                if state:
                    done.append((state[0], state[1], state[2].hexdigest()))
                last, state = kind, [conv, 0, hashlib.sha256()]
            else:
                state[2].update(b",")
            state[1] += n
            state[2].update(run)
        yield _ends_batch(done)
    if state:
        yield _ends_batch([(state[0], state[1], state[2].hexdigest())])


def _ends_batch(done: list[tuple[int, int, str]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.string()))], ["conv", "n", "ends"])


def classes(found: DataFrame) -> DataFrame:
    """One row for each distinct sequence: ids, chars, conv (its least id), n (conversations), ends (digest of their ids)."""
    found = materialize(found.withColumn("class", F.unhex(F.sha2("ids", 256))), "rebuilt-sequences")
    runs = found.select("class", "conv").repartitionByRange("class", "conv").sortWithinPartitions("class", "conv")
    runs = runs.mapInArrow(_id_runs, "class binary, conv long, n long, run binary").repartition("class").sortWithinPartitions("class", "conv")
    ends = materialize(runs.mapInArrow(_ends, "conv long, n long, ends string"), "class-ends")
    return found.select("conv", "ids", "chars").join(ends, "conv")


# --- shards -----------------------------------------------------------------------


def _pieces(limit: int):
    """Rows sorted by sequence: `piece` goes up whenever the rows so far hold ``limit`` turns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, piece = 0, 0
        for batch in batches:
            pieces = []
            for size in pc.binary_length(batch.column(0)).to_pylist():
                if held and held + size // 8 + 1 > limit:
                    held, piece = 0, piece + 1
                held += size // 8 + 1
                pieces.append(piece)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pieces, pa.int64())], [*batch.schema.names, "piece"])

    return run


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Turns that two sequences share from the start."""
    n = min(len(a), len(b))
    differ = a[:n] != b[:n]
    return int(differ.argmax()) if differ.any() else n


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, turns that its first sequence shares with the last one before it; -1 for the first shard)."""
    for batch in batches:
        shard, first, before = (c.to_pylist() for c in batch.columns)
        shared = [-1 if p is None else common(np.frombuffer(f, ">u8"), np.frombuffer(p, ">u8")) for f, p in zip(first, before)]
        yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), pa.array(shared, pa.int64())], ["shard", "before"])


def shards(found: DataFrame, limit: int) -> DataFrame:
    """The classes in shards of up to ``limit`` turns, with what a shard's border sequences share with the shards beside it."""
    ordered = found.select("ids", "chars", "conv", "n", "ends").repartitionByRange(F.substring("ids", 1, CUT_BYTES)).sortWithinPartitions("ids")
    cut = ordered.mapInArrow(_pieces(limit), "ids binary, chars binary, conv long, n long, ends string, piece long")
    cut = materialize(cut.select("ids", "chars", "conv", "n", "ends", (F.shiftleft(F.spark_partition_id().cast("long"), 40) + F.col("piece")).alias("shard")), "trie-shards")
    order = Window.orderBy("shard")  # a row for each shard, not for each sequence
    edges = cut.groupBy("shard").agg(F.min("ids").alias("first"), F.max("ids").alias("last"))
    edges = edges.select("shard", "first", F.lag("last").over(order).alias("last")).mapInArrow(_borders, "shard long, before long")
    edges = materialize(edges, "trie-borders").withColumn("after", F.lead("before", 1, -1).over(order))
    return cut.join(edges, "shard")


# --- trees ------------------------------------------------------------------------


class TernarySearchTree:
    """Sequences of turn ids; node 0 is the root of no turn.

    `equal` leads to the tree of a node's children, `low` and `high` to its siblings
    with lesser and greater ids.
    """

    def __init__(self):
        self.symbol, self.low, self.equal, self.high, self.up, self.depth, self.chars = (array("q", [x]) for x in (-1, -1, -1, -1, -1, 0, 0))

    def _new(self, symbol: int, chars: int, up: int) -> int:
        for column, value in ((self.symbol, symbol), (self.low, -1), (self.equal, -1), (self.high, -1), (self.up, up), (self.depth, self.depth[up] + 1), (self.chars, chars)):
            column.append(value)
        return len(self.symbol) - 1

    def insert(self, ids: list[int], chars: list[int]) -> int:
        """The node at the end of the sequence."""
        at, symbol, low, equal, high = 0, self.symbol, self.low, self.equal, self.high
        for s, size in zip(ids, chars):
            child = equal[at]
            if child < 0:
                equal[at] = at = self._new(s, size, at)
                continue
            while (found := symbol[child]) != s:
                side = low if s < found else high
                if side[child] < 0:
                    side[child] = child = self._new(s, size, at)
                else:
                    child = side[child]
            at = child
        return at

    def traversal(self) -> array:
        """Nodes, every one after its parent, without recursion."""
        order, stack = array("q"), [0]
        while stack:
            node = stack.pop()
            order.append(node)
            for nxt in (self.high[node], self.low[node], self.equal[node]):
                if nxt >= 0:
                    stack.append(nxt)
        return order


def medians(n: int) -> Iterator[int]:
    """0 to n - 1: the median first, then the medians of both halves, and so on."""
    level = [(0, n)]
    while level:
        below = []
        for a, b in level:
            if a < b:
                m = (a + b) // 2
                yield m
                below += [(a, m), (m + 1, b)]
        level = below


class ShardTrie:
    """The trie of sorted distinct sequences, and what it says of its nodes."""

    def __init__(self, ids: list[np.ndarray], chars: list[np.ndarray], conv: list[int], n: list[int], ends: list[str], before: int, after: int):
        self.ids, self.chars_of, self.conv_of, self.n_of, self.ends_of = ids, chars, conv, n, ends
        self.before, self.after = before, after
        beside = [before, *(common(a, b) for a, b in zip(ids, ids[1:])), after]
        #: Turns of each sequence that another one shares; the rest is a chain of its own.
        self.shared = [max(a, b, 0) for a, b in zip(beside, beside[1:])]
        self.tree = TernarySearchTree()
        self.stop = [0] * len(ids)
        for i in medians(len(ids)):
            d = self.shared[i]
            self.stop[i] = self.tree.insert(ids[i][:d].tolist(), chars[i][:d].tolist())
        self._add_up()

    def _path(self, i: int, depth: int) -> list[int]:
        """Nodes of the first turns of sequence i, the root first, down to `depth`."""
        path, node = [], self.stop[i]
        while node >= 0:
            if self.tree.depth[node] <= depth:
                path.append(node)
            node = self.tree.up[node]
        return path[::-1]

    def _add_up(self) -> None:
        tree, size = self.tree, len(self.tree.symbol)
        self.old = set(self._path(0, self.before))
        self.open = set(self._path(len(self.ids) - 1, self.after))
        self.n, self.children, self.leaves, self.saved = (array("q", bytes(8 * size)) for _ in range(4))
        self.conv = array("q", [2**63 - 1]) * size
        self.ends: dict[int, str] = {}
        chained = set()
        for i, node in enumerate(self.stop):
            self.n[node] += self.n_of[i]
            self.conv[node] = min(self.conv[node], self.conv_of[i])
            if len(self.ids[i]) == self.shared[i]:
                self.ends[node] = self.ends_of[i]
            else:
                chained.add(node)
                self.children[node] += 1
                self.leaves[node] += 1
                self.saved[node] += (self.n_of[i] - 1) * int(self.chars_of[i][self.shared[i] :].sum(dtype=np.int64))
        for node in reversed(tree.traversal()):
            old = node in self.old
            self.saved[node] += (self.n[node] - (not old)) * tree.chars[node]
            if tree.equal[node] < 0 and node not in chained and node not in self.open:
                self.leaves[node] += 1
            up = tree.up[node]
            if up >= 0:
                self.n[up] += self.n[node]
                self.conv[up] = min(self.conv[up], self.conv[node])
                self.children[up] += not old
                self.leaves[up] += self.leaves[node]
                self.saved[up] += self.saved[node]

    def keys(self) -> dict[int, bytes]:
        """Digests of the nodes that other shards have too, equal in all of them."""
        found: dict[int, bytes] = {}
        for path in (self._path(0, self.before), self._path(len(self.ids) - 1, self.after)):
            key = b""
            for node in path:
                key = hashlib.blake2b(key + self.tree.symbol[node].to_bytes(8, "big", signed=True), digest_size=16).digest()
                found[node] = key
        return found

    def rows(self) -> Iterator[tuple]:
        """Columns of the nodes (see NODE): first the tree's, then each chain's."""
        tree, keys = self.tree, self.keys()
        none = lambda node: node not in keys
        nodes = range(len(tree.symbol))
        up = [tree.up[node] for node in nodes]
        yield (
            [keys.get(node) for node in nodes], [keys.get(u) if u >= 0 else None for u in up],
            self.conv.tolist(), [self.conv[u] if u >= 0 and none(u) else None for u in up], tree.depth.tolist(), tree.symbol.tolist(),
            self.n.tolist(), self.children.tolist(), self.leaves.tolist(), self.saved.tolist(), [self.ends.get(node) for node in nodes],
        )
        for i, node in enumerate(self.stop):
            d, length = self.shared[i], len(self.ids[i])
            for a in range(d, length, CHUNK):
                b = min(length, a + CHUNK)
                size = b - a
                if a == d:
                    below = np.cumsum(self.chars_of[i][d:][::-1], dtype=np.int64)[::-1]
                first = a == d
                yield (
                    [None] * size, [keys.get(node) if first else None] + [None] * (size - 1), [self.conv_of[i]] * size,
                    [(self.conv[node] if none(node) else None) if first else self.conv_of[i]] + [self.conv_of[i]] * (size - 1),
                    list(range(a + 1, b + 1)), self.ids[i][a:b].tolist(), [self.n_of[i]] * size,
                    [1] * (size - 1) + [int(b < length)], [1] * size, ((self.n_of[i] - 1) * below[a - d : b - d]).tolist(),
                    [None] * (size - 1) + [self.ends_of[i] if b == length else None],
                )


#: key: set for a part of a node that other shards have too; parent_key: set where the parent is such a node.
NODE = "key binary, parent_key binary, conv_id long, parent_conv_id long, depth long, turn_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"
_TYPES = [{"binary": pa.binary(), "long": pa.int64(), "string": pa.string()}[c.split()[1]] for c in NODE.split(", ")]
_NAMES = [c.split()[0] for c in NODE.split(", ")]


def _tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shards (rows sorted by shard and sequence) to nodes."""
    for rows in grouped_batches(batches, ["shard"]):
        view = lambda name, kind: [np.frombuffer(x, kind) for x in rows[name].to_pylist()]
        trie = ShardTrie(
            [x.astype(np.int64) for x in view("ids", ">u8")], view("chars", "<u4"), rows["conv"].to_pylist(), rows["n"].to_pylist(), rows["ends"].to_pylist(),
            rows["before"][0].as_py(), rows["after"][0].as_py(),
        )
        held: list[list] = [[] for _ in _NAMES]
        for columns in trie.rows():
            for own, more in zip(held, columns):
                own.extend(more)
            if len(held[0]) >= 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(held, _TYPES)], _NAMES)
                held = [[] for _ in _NAMES]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(held, _TYPES)], _NAMES)


def trie_nodes(found: DataFrame, shard_turns: int = SHARD) -> DataFrame:
    """Nodes of the trie of `found` (conv, ids, chars): conv_id (least member), depth, turn_id (of the last turn), parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    dealt = shards(classes(found), shard_turns)
    dealt = dealt.repartition("shard").sortWithinPartitions("shard", "ids")
    nodes = materialize(dealt.mapInArrow(_tries, NODE), "trie-nodes")

    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = nodes.where("key IS NOT NULL").groupBy("key").agg(
        F.min("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.min("turn_id").alias("turn_id"), *sums, F.max("ends").alias("ends")
    )
    merged = materialize(merged, "trie-border-nodes")
    columns = ["conv_id", "depth", "turn_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends"]
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    inner = nodes.where("key IS NULL")
    done = inner.where("parent_key IS NULL").select(*columns)
    below = inner.where("parent_key IS NOT NULL").drop("parent_conv_id").join(parents, "parent_key").select(*columns)
    border = merged.join(parents, "parent_key", "left").select(*columns)
    return done.unionByName(below).unionByName(border).withColumn("ends_sha256", F.coalesce("ends", F.lit(NO_ENDS))).drop("ends")


def prefix_trie(conversations: DataFrame, shard_turns: int = SHARD) -> DataFrame:
    """Nodes of the trie of `conversations` (conv_id, turn, role, text), with role and text of each node's last turn (null for the root)."""
    found, names = sequences(conversations)
    return trie_nodes(found, shard_turns).join(names.select("turn_id", "role", "text"), "turn_id", "left").drop("turn_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node of the rebuilt conversations."""
    found, _ = sequences(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return trie_nodes(with_shared_heads(found)).drop("turn_id")


#: CRC-32 of a conversation's decimal id, a bit at a time.
_CRC = """xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT), list_transform(range(1, length(CAST(conv_id AS VARCHAR)) + 1), lambda i: CAST(ascii(CAST(conv_id AS VARCHAR)[i]) AS BIGINT))),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [CAST(0 AS BIGINT) FOR z IN range(8)]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""

ORACLE_SQL = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), own AS (
  SELECT conv_id, list(sha256(length(role) || ':' || role || text) ORDER BY turn NULLS FIRST, role, text) AS t, list(length(text) ORDER BY turn NULLS FIRST, role, text) AS s FROM turns GROUP BY conv_id
), counted AS (
  SELECT *, {_CRC} % 6 AS h FROM own
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.t[1:c.h], []), c.t[c.h + 1:]) AS t, list_concat(coalesce(b.s[1:c.h], []), c.s[c.h + 1:]) AS s
  FROM counted c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100
), steps AS (
  SELECT conv_id, unnest(range(len(t) + 1)) AS depth, t, s FROM rebuilt
), nodes AS (
  SELECT array_to_string(t[1:depth], ',') AS k, depth, array_to_string(t[1:greatest(depth - 1, 0)], ',') AS up, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(t[1:depth]) AS path,
    coalesce(any_value(s[depth]), 0) AS size, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(t) = depth), '') AS ends
  FROM steps GROUP BY 1, 2, 3
), families AS (
  SELECT up AS k, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2
), full_nodes AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN families f ON n.k = f.k AND n.depth = f.depth
), above AS (
  SELECT unnest(range(depth + 1)) AS d, path, n_children, (n_convs - 1) * size AS saving FROM full_nodes
), sums AS (
  SELECT array_to_string(path[1:d], ',') AS k, d AS depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(saving) AS saved FROM above GROUP BY 1, 2
)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM full_nodes n JOIN sums s ON n.k = s.k AND n.depth = s.depth LEFT JOIN nodes p ON n.up = p.k AND n.depth = p.depth + 1
"""
