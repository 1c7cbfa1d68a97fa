"""N-gram Jaccard join: T-occurrence search (DivideSkip) inside exact candidate blocks.

Two documents link when their sets of 5-word shingles have a Jaccard similarity
of 0.8 or more.  Equal sets are one class; classes that links connect are one
component.  No link between different sets is lost:

1. Every document's set gets a 128-bit digest (its class) and a parity bitmap.
2. Prefix filter: linked sets share a shingle among the first s - ceil(0.8 s) + 1
   of any common order.  Order: by hash, with the corpus's frequent shingles last,
   so that boilerplate forms no long lists.  Lists of one class go, equal lists
   are one.  A shingle in more prefixes than a task should list (told by a share of
   the rows; that only decides the way) is its own list and is never gathered.
3. In a list, two sets can only link if their sizes allow it and their bitmaps
   differ in at most |x| + |y| - 2T bits (each differing shingle flips one bit).
   A list emits a spanning forest of these pairs, never all of them.
4. Components of the forests are the candidate blocks.  Each class's text travels
   once, to its block, where T-occurrence search over inverted lists finds the
   links: short lists are merged, long ones probed by binary search.
5. Components of the links are the result.

Lists and blocks too heavy for one task are dealt into cells (`base.cells`).
Shingles are compared by 64-bit hashes; a false equality has odds below 1e-12 a
pair.  Defined results: no words or null text: size 0, linked with nothing; under
five words: one shingle; rows with equal text and any id are one class; a
component's id is its least non-null id (null only if all are null); an empty table
gives no rows; only id and text are read, and columns whose names clash with the
operator's own pass through `deduplicate`.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.base import WordHashes, cells, components, discard, from_row, grouped_batches, materialize, mix, same_row, shingle_set, table, text_key, text_slices, tidy, whole_row, written, zipped

#: The similarity as a fraction: 100 * intersection >= 80 * union.
NUMERATOR, DENOMINATOR = 80, 100
#: Frequent shingles that are put last: at most so many (an order decides cost, not results).
FREQUENT_KEPT = 1_000_000
#: Members (of a list) and shingles (of a block) that a cell takes.
LIST_LIMIT, BLOCK_LIMIT = 20_000, 2_000_000
#: One class in so many tells which shingles are in more than LIST_LIMIT prefixes.
_SHARE = 16
_SALT = np.uint64(0x5851F42D4C957F2D)


def least_overlap(x, y, num: int = NUMERATOR, den: int = DENOMINATOR):
    """T: the least intersection of linked sets of these sizes."""
    return -((-num * (x + y)) // (num + den))


def prefix_length(size: int, num: int = NUMERATOR, den: int = DENOMINATOR) -> int:
    return size + (num * -size) // den + 1


def bitmap(tokens: np.ndarray) -> np.ndarray:
    """Parity bits of a set: 16/9 of its size, rounded up to a power of two (64 at least).

    Linked sets of size s differ in 2/9 s shingles at most; unrelated ones in half of the bits, four times that.
    """
    bits = 1 << max(6, math.ceil(math.log2(max(1, 16 * len(tokens) / 9))))
    flips = np.bincount((mix(tokens ^ _SALT) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.uint64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    while len(bits) > words:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return bits


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, class, bitmap of each document; with the last row of a slice, the slice's frequent shingles and their counts."""
    hashes = WordHashes()
    for part, texts in text_slices(batches, limit=8 << 20):
        sets = [shingle_set((t or b"").lower().split(), hashes) for t in texts]
        digest = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        maps = [bitmap(s).tobytes() if len(s) else None for s in sets]
        found, counts = np.unique(np.concatenate(sets), return_counts=True)
        often = counts >= max(8, len(sets) // 200)
        frequent: list = [None] * len(sets)
        frequent[-1] = [{"token": int(t), "n": int(n)} for t, n in zip(found[often].view(np.int64), counts[often])]
        yield pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), pa.array(map(len, sets), pa.int64()), pa.array(digest, pa.binary()), pa.array(maps, pa.binary()), pa.array(frequent, pa.list_(pa.struct([("token", pa.int64()), ("n", pa.int64())])))],
            ["__id", "__tk", "n_shingles", "digest", "bits", "frequent"],
        )


def _prefixes(frequent):
    """(shingle, class) for the first shingles of each set; `frequent`: a broadcast of hashes in their order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        known = frequent.value
        place = np.argsort(known, kind="stable")
        ordered = known[place]
        for _, texts in text_slices(batches):
            done, tokens, classes = set(), [], []
            for text in texts:
                s = shingle_set((text or b"").lower().split(), hashes)
                if not len(s):
                    continue
                digest = xxhash.xxh3_128_digest(s.tobytes())
                if digest in done:
                    continue
                done.add(digest)
                if len(ordered):
                    at = np.minimum(np.searchsorted(ordered, s), len(ordered) - 1)
                    late = ordered[at] == s
                    if late.any():
                        s = np.r_[s[~late], known[np.sort(place[at[late]])]]
                first = s[: prefix_length(len(s))]
                tokens.append(first)
                classes.append(np.full(len(first), int.from_bytes(digest[:8], "little", signed=True)))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(classes), pa.int64())], ["token", "rid"])

    return run


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (token, rid): lists of two or more classes, each under a hash of its members, so that equal lists meet."""
    for groups in grouped_batches(batches, ["token"], 20_000):
        token, rid = groups["token"].to_numpy(), groups["rid"].to_numpy()
        new = np.r_[True, token[1:] != token[:-1]]
        fresh = new | np.r_[True, rid[1:] != rid[:-1]]
        token, rid, new = token[fresh], rid[fresh], new[fresh]
        starts = np.flatnonzero(new)
        sizes = np.diff(np.r_[starts, len(token)])
        keys = mix(np.add.reduceat(mix(rid.view(np.uint64) ^ _SALT), starts) + sizes.astype(np.uint64))
        many = np.repeat(sizes > 1, sizes)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(keys, sizes)[many].view(np.int64)), pa.array(rid[many])], ["list", "rid"])


def _forest(num: int, den: int):
    """Edges of a spanning forest of the pairs in a list whose sizes and bitmaps allow a link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs = [], []
        for groups in grouped_batches(batches, ["list", "__cell_a", "__cell_b"], 5_000):
            keys = [groups[k].to_numpy() for k in ("list", "__cell_a", "__cell_b")]
            new = np.logical_or.reduce([np.r_[True, k[1:] != k[:-1]] for k in keys])
            names, sizes, bits = groups["class"].to_pylist(), groups["n_shingles"].to_numpy(), groups["bits"].to_pylist()
            bounds = np.r_[np.flatnonzero(new), len(names)].tolist()
            for a, b in zip(bounds, bounds[1:]):
                for i, j in _linkable(sizes[a:b], [np.frombuffer(x, np.uint64) for x in bits[a:b]], num, den):
                    us.append(names[a + i])
                    vs.append(names[a + j])
            if us:
                yield pa.RecordBatch.from_arrays([pa.array(us, pa.int64()), pa.array(vs, pa.int64())], ["u", "v"])
                us, vs = [], []

    return run


def _linkable(sizes: np.ndarray, bits: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    out, widths = [], sorted({len(b) for b in bits})
    stacked = {}
    for w in widths:  # a set is compared at the smaller of two bitmaps' widths
        wide = [i for i, b in enumerate(bits) if len(b) >= w]
        stacked[w] = np.zeros((len(bits), w), np.uint64)
        stacked[w][wide] = [folded(bits[i], w) for i in wide]
    width = np.array([len(b) for b in bits])
    left = np.arange(len(bits))
    while len(left):
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = left[(sizes[left] * num <= sizes[x] * den) & (sizes[x] * num <= sizes[left] * den)]
            hits = []
            for w in widths:
                y = near[np.minimum(width[near], width[x]) == w]
                if len(y):
                    differ = np.bitwise_count(stacked[w][y] ^ stacked[w][x]).sum(axis=1, dtype=np.int64)
                    hits.append(y[differ <= sizes[x] + sizes[y] - 2 * least_overlap(sizes[x], sizes[y], num, den)])
            if hits and len(found := np.concatenate(hits)):
                out.extend((x, int(y)) for y in found)
                queue.extend(found.tolist())
                left = left[~np.isin(left, found)]
    return out


class InvertedLists:
    """T-occurrence search over the members that are still to be found."""

    def __init__(self, sets: list[np.ndarray], members: np.ndarray):
        tokens = np.concatenate([sets[m] for m in members])
        owner = np.repeat(members, [len(sets[m]) for m in members])
        order = np.lexsort((owner, tokens))
        self.tokens, starts = np.unique(tokens[order], return_index=True)
        self.members = owner[order]
        self.starts = np.r_[starts, len(tokens)]
        self.stride = len(sets)
        # (list, member) as one sorted number: the lists' entries for binary probes
        self.entries = np.repeat(np.arange(len(self.tokens)), np.diff(self.starts)) * self.stride + self.members

    def search(self, query: np.ndarray, least: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(members, overlaps) of wanted members that hold at least ``least`` tokens of the query (DivideSkip).

        The ``long`` longest lists are left out of the merge: a member of T lists is in T - long of the others.
        """
        at = np.minimum(np.searchsorted(self.tokens, query), len(self.tokens) - 1)
        at = at[self.tokens[at] == query]
        if len(at) < least:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        lengths = self.starts[at + 1] - self.starts[at]
        at = at[np.argsort(lengths, kind="stable")]
        longest = int(lengths.max())
        long = min(least - 1, int(least / (0.01 * math.log2(longest + 1) + 1)))
        short, probed = (at[:-long], at[-long:]) if long else (at, at[:0])
        merged = np.concatenate([self.members[self.starts[k] : self.starts[k + 1]] for k in short])
        merged, counts = np.unique(merged, return_counts=True)
        enough = (counts >= least - long) & wanted[merged]
        merged, counts = merged[enough], counts[enough]
        if long and len(merged):
            for a in range(0, len(merged), max(1, 2_000_000 // long)):
                part = slice(a, a + max(1, 2_000_000 // long))
                probes = probed * self.stride + merged[part, None]
                place = np.minimum(np.searchsorted(self.entries, probes), len(self.entries) - 1)
                counts[part] += (self.entries[place] == probes).sum(axis=1)
        enough = counts >= least
        return merged[enough], counts[enough]


def links_forest(sets: list[np.ndarray], num: int = NUMERATOR, den: int = DENOMINATOR) -> list[tuple[int, int]]:
    """A spanning forest of the exact links among the sets; members once found are searched for no more."""
    sizes = np.array([len(s) for s in sets])
    waiting = np.ones(len(sets), bool)
    index, indexed, out = None, 0, []
    for first in range(len(sets)):
        if not waiting[first]:
            continue
        waiting[first] = False
        queue = [first]
        while queue:
            x = queue.pop()
            left = int(waiting.sum())
            if not left:
                return out
            if index is None or left * 2 <= indexed:
                index, indexed = InvertedLists(sets, np.flatnonzero(waiting)), left
            wanted = waiting & (sizes * den >= sizes[x] * num) & (sizes * num <= sizes[x] * den)
            y, overlap = index.search(sets[x], max(1, -((-num * int(sizes[x])) // den)), wanted)
            hit = overlap >= least_overlap(sizes[x], sizes[y], num, den)
            for z in y[hit].tolist():
                out.append((x, z))
                waiting[z] = False
                queue.append(z)
    return out


def _blocks(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, unpack = WordHashes(), zstandard.ZstdDecompressor().decompress
        for groups in grouped_batches(batches, ["root", "__cell_a", "__cell_b"]):
            names = groups["class"].to_pylist()
            sets = [shingle_set(unpack(t).lower().split(), hashes) for t in groups["ztext"].to_pylist()]
            edges = links_forest(sets, num, den)
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array([names[i] for i, _ in edges], pa.int64()), pa.array([names[j] for _, j in edges], pa.int64())], ["u", "v"])

    return run


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = NUMERATOR, den: int = DENOMINATOR) -> DataFrame:
    """One row for each row: __id, __tk, n_shingles, component (least id), is_first (the row that a deduplication keeps)."""
    spark, kind = docs.sparkSession, docs.schema[id_col].dataType.simpleString()
    keyed = docs.select(F.col(id_col).alias("__id"), text_key(F.col(text_col)).alias("__tk"), F.col(text_col).alias("text"))
    sketch = materialize(
        keyed.mapInArrow(tidy(_sketch), f"__id {kind}, __tk long, n_shingles long, digest binary, bits binary, frequent array<struct<token:long,n:long>>"), "sketches"
    )
    often = sketch.where("frequent IS NOT NULL").select(F.inline("frequent")).groupBy("token").agg(F.sum("n").alias("n"))
    often = often.where("n >= 16").orderBy(F.desc("n"), "token").limit(FREQUENT_KEPT).select("token").toArrow()  # bounded: an order for the prefix
    frequent = spark.sparkContext.broadcast(often["token"].to_numpy()[::-1].copy().view(np.uint64))

    prefixes, path = written(keyed.select("text").where("text IS NOT NULL").mapInArrow(tidy(_prefixes(frequent)), "token long, rid long"), "prefixes")
    lists = _all_lists(prefixes, LIST_LIMIT)
    discard(spark, path)
    classes = sketch.where("digest IS NOT NULL").groupBy("digest").agg(
        F.first("n_shingles").alias("n_shingles"), F.first("bits").alias("bits"), F.min(F.struct("__id", "__tk")).alias("shown")
    )
    classes = materialize(classes.withColumns({"rid": _little_endian("digest"), "class": F.monotonically_increasing_id()}), "classes")
    members = cells(lists, "list", "rid", F.lit(1), LIST_LIMIT).join(classes.select("rid", "class", "n_shingles", "bits"), "rid")
    members = members.repartition("list", "__cell_a", "__cell_b").sortWithinPartitions("list", "__cell_a", "__cell_b", "class")
    members = members.select("list", "__cell_a", "__cell_b", "class", "n_shingles", "bits")
    blocks = components(members.mapInArrow(tidy(_forest(num, den)), "u long, v long"), "candidate-components")

    shown = blocks.select(F.col("node").alias("class"), "root").join(classes.select("class", "n_shingles", "shown"), "class")
    shown = cells(shown, "root", "class", F.col("n_shingles"), BLOCK_LIMIT)
    shown = materialize(shown.select("root", "__cell_a", "__cell_b", "class", F.col("shown.__id").alias("__id"), F.col("shown.__tk").alias("__tk")), "blocks")
    # A merge join at every size: the members of blocks grow with the corpus, so does a broadcast of them.
    texts = zipped(keyed.where("text IS NOT NULL")).alias("d").join(shown.hint("merge").alias("s"), same_row("d", "s")).select("root", "__cell_a", "__cell_b", "class", "ztext")
    texts = texts.repartition("root", "__cell_a", "__cell_b").sortWithinPartitions("root", "__cell_a", "__cell_b", "class")
    linked = components(texts.mapInArrow(tidy(_blocks(num, den)), "u long, v long"), "linked-components")

    named = linked.select(F.col("node").alias("class"), "root").join(classes.select("class", "digest"), "class")
    member = sketch.select("__id", "__tk", "n_shingles", "digest").join(named.select("digest", "root"), "digest", "left")
    member = member.withColumn("root", F.when(F.col("root").isNull(), F.col("digest")).otherwise(F.col("root").cast("string").cast("binary")))
    least = member.where("root IS NOT NULL").groupBy("root").agg(F.min("__id").alias("component"), F.min(F.struct(F.col("__id").isNull(), "__id", "__tk")).alias("first"))
    return member.join(least, "root", "left").select(
        "__id", "__tk", "n_shingles", F.when(F.col("root").isNull(), F.col("__id")).otherwise(F.col("component")).alias("component"),
        F.coalesce(F.col("first.__id").eqNullSafe(F.col("__id")) & (F.col("first.__tk") == F.col("__tk")), F.lit(True)).alias("is_first"),
    )


def _all_lists(prefixes: DataFrame, limit: int) -> DataFrame:
    """(list, rid) of the inverted lists of two or more classes; those of heavy shingles go past the gathering."""
    share = max(1, min(_SHARE, limit // 64))
    some = prefixes.where(F.pmod(F.xxhash64("rid"), F.lit(share)) == 0).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    heavy = materialize(some.where(F.col("n") * share > limit).select("token"), "heavy-shingles")
    light = prefixes.join(heavy, "token", "left_anti").repartition("token").sortWithinPartitions("token", "rid").mapInArrow(tidy(_lists), "list long, rid long")
    own = prefixes.join(heavy, "token", "left_semi").select(F.xxhash64("token", F.lit("heavy")).alias("list"), "rid")
    return materialize(light.union(own).dropDuplicates(["list", "rid"]), "lists")


def _little_endian(column: str):
    """The first eight bytes of a binary column as a signed little-endian number."""
    turned = F.concat(*[F.substring(F.hex(column), 2 * i + 1, 2) for i in range(7, -1, -1)])
    return F.conv(turned, 16, -10).cast("long")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`docs` with one row of each component (its least id); rows without words all stay, but equal (id, text) rows are one."""
    found = materialize(jaccard_components(docs, id_col, text_col, **options).where("n_shingles > 0"), "components")
    dropped = found.where("NOT is_first").select("__id", "__tk").distinct()
    rows = docs.select(whole_row(docs), F.col(id_col).alias("__id"), text_key(F.col(text_col)).alias("__tk"))
    rows = rows.alias("d").join(dropped.alias("x"), same_row("d", "x"), "left_anti")
    again = found.where("is_first").groupBy("__id", "__tk").count().where("count > 1")
    if again.take(1):
        twice = rows.alias("d").join(again.alias("x"), same_row("d", "x"), "left_semi").dropDuplicates(["__id", "__tk"])
        rows = rows.alias("d").join(again.alias("x"), same_row("d", "x"), "left_anti").union(twice)
    return rows.select(*from_row(docs.columns))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = jaccard_components(docs)
    return found.select(F.col("__id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


ORACLE_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
),
starts AS (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS k FROM texts WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s FROM starts),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common c JOIN sizes x ON c.a = x.doc_id JOIN sizes y ON c.b = y.doc_id WHERE 100 * c.n >= 80 * (x.n + y.n - c.n)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
least AS (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
FROM texts LEFT JOIN sizes USING (doc_id) LEFT JOIN least USING (doc_id)
"""
