"""Helpers the training-data operators share: scratch tables, word hashing, components.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``; ``bytes.split()`` splits
UTF-8 text in exactly that way, since no multi-byte character holds an ASCII byte.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.session import new_run_dir

#: Odd multipliers, one for each place of a window of words.
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> tuple[DataFrame, str]:
    """Write to a fresh folder below ``spark.checkpoint.dir`` and read back; the folder, for `discard`."""
    path = f"{new_run_dir(df.sparkSession, purpose)}/data"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write to a fresh folder below ``spark.checkpoint.dir`` and read back: lineage is cut, work is not repeated."""
    return written(df, purpose)[0]


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder of `written` that nothing reads any more (a round that the next, written one has replaced)."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release() -> None:
    """Give memory that this process has freed back to the system; its allocators keep it otherwise."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # glibc only
        trim(0)


def tidy(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`run` for mapInArrow that leaves a reused Python worker no larger than it has to be: what a task freed does not lie beside the next one's memory and the JVM's."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release()

    return tidied


def text_key(text: Column) -> Column:
    """Tells apart rows that share an id (or have none): 64 bits, used beside the id only."""
    return F.xxhash64(text)


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, `__row`, so that none clashes with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row")


def from_row(names: list[str], struct: str = "__row") -> list[Column]:
    return [F.col(struct).getField(c).alias(c) for c in names]


def same_row(left: str, right: str) -> Column:
    """Join condition on the row key (`__id`, `__tk`); a null id equals a null id."""
    return F.expr(f"{left}.__id <=> {right}.__id AND {left}.__tk = {right}.__tk")


def zipped(rows: DataFrame) -> DataFrame:
    """`rows` with `text` as zstandard frames (`ztext`, a third less than the shuffle's own compression leaves)."""
    kept = [f for f in rows.schema.fields if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for part, texts in text_slices(batches):
            yield pa.RecordBatch.from_arrays(
                [*(part.column(f.name) for f in kept), pa.array([None if t is None else pack(t) for t in texts], pa.binary())], [*(f.name for f in kept), "ztext"]
            )

    return rows.mapInArrow(tidy(run), T.StructType([*kept, T.StructField("ztext", T.BinaryType())]))


def unzipped_slices(batches: Iterator[pa.RecordBatch], limit: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Slices (one row at least) of rows that `zipped` made, of about ``limit`` bytes of text as it is when unpacked."""
    unpack = zstandard.ZstdDecompressor().decompress
    for part, texts in text_slices(batches, "ztext", limit):
        ends = np.cumsum([1 + (0 if t is None else zstandard.frame_content_size(t)) for t in texts])
        start = 0
        while start < len(texts):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + limit, side="right")))
            yield part.slice(start, stop - start), [None if t is None else unpack(t) for t in texts[start:stop]]
            start = stop


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = 4 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Cut record batches into slices of about ``limit`` bytes of text (one row at least), with the texts as bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        texts = batch.column(batch.schema.get_field_index(column))
        sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = np.cumsum(sizes + 1)
        start = 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
            part = batch.slice(start, stop - start)
            yield part, texts.slice(start, stop - start).cast(pa.binary()).to_pylist()
            start = stop


class WordHashes(dict):
    """Word to 64-bit hash; remembers a bounded number of words."""

    def __init__(self, remember: int = 200_000):
        super().__init__()
        self._remember = remember

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self._remember:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` consecutive word hashes (none if there are fewer words)."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.full(n, width, np.uint64)
    for i in range(width):
        place = _PLACES[i % len(_PLACES)] + np.uint64(2 * (i // len(_PLACES)))
        out = (out ^ (words[i : i + n] * place)) * _MIX1
        out ^= out >> np.uint64(29)
    return mix(out)


def shingle_set(words: list[bytes], hashes: WordHashes, width: int = 5) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles; a shorter text is one shingle, an empty one has none."""
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(window_hashes(hashes.of(words), min(width, len(words))))


def cells(df: DataFrame, key: str, member: str, weight: Column, limit: int) -> DataFrame:
    """Deal groups that are too heavy for one task into cells, so that any two members of a group share a cell.

    Adds `__cell_a`, `__cell_b`.  A group whose weight is within ``limit`` is one
    cell.  A heavier one is cut into parts by a hash of the member; there is a
    cell for each two parts.  Nothing is left out, and no cell grows with the group.
    """
    parts = df.groupBy(key).agg(F.ceil(F.sum(weight) * 2 / F.lit(limit)).cast("int").alias("__m"))
    parts = parts.select(key, F.when(F.col("__m") <= 2, 1).otherwise(F.col("__m")).alias("__m"))
    own = F.pmod(F.xxhash64(F.col(member)), F.col("__m")).cast("int")
    dealt = df.join(parts, key).withColumn("__own", own).withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__m") - 1)))
    return dealt.withColumns(
        {"__cell_a": F.least("__own", "__other"), "__cell_b": F.greatest("__own", "__other")}
    ).drop("__m", "__own", "__other")


def grouped_batches(batches: Iterator[pa.RecordBatch], keys: list[str], at_least: int = 1) -> Iterator[pa.Table]:
    """Whole groups of batches that come sorted by ``keys``: tables of one or more groups, of ``at_least`` rows where there are as many."""
    held: list[pa.RecordBatch] = []
    rows, last = 0, None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        columns = [batch.column(batch.schema.get_field_index(k)) for k in keys]
        change = np.zeros(n, bool)
        for c in columns:
            if n > 1:
                change[1:] |= pc.fill_null(pc.not_equal(c.slice(1), c.slice(0, n - 1)), True).to_numpy(zero_copy_only=False)
        change[0] = last is not None and tuple(c[0].as_py() for c in columns) != last
        last = tuple(c[n - 1].as_py() for c in columns)
        cuts, at = np.flatnonzero(change), 0
        while (k := int(np.searchsorted(cuts, at + max(at_least - rows, 0)))) < len(cuts):
            if cuts[k] > at:
                held.append(batch.slice(at, int(cuts[k]) - at))
            yield pa.Table.from_batches(held)
            held, rows, at = [], 0, int(cuts[k])
        held.append(batch.slice(at))
        rows += n - at
    if held:
        yield pa.Table.from_batches(held)


def components(edges: DataFrame, purpose: str, max_rounds: int = 60) -> DataFrame:
    """Connected components of `edges` (u, v): rows (node, root), root being the smallest node of the component.

    Alternates large-star and small-star steps; each is a map-side combined
    minimum and a join (which AQE splits where a node is hot), so nothing is
    gathered.  Every round is written to the scratch folder, and the one before it
    removed.
    """
    u, v = F.col("u"), F.col("v")
    now, path = written(
        edges.where(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct(), purpose
    )

    def mark(df: DataFrame):
        return df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = mark(now)
    if before[0] == 0:
        return now.select(u.alias("node"), v.alias("root"))
    for _ in range(max_rounds):
        both = now.union(now.select(v.alias("u"), u.alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("__m")).select("u", F.least("u", "__m").alias("__m"))
        large = both.join(least, "u").where(v > u).select(v.alias("u"), F.col("__m").alias("v")).where(u != v).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("__m"))
        small = large.join(least, "u").select(v.alias("u"), F.col("__m").alias("v")).where(u != v).union(
            least.select("u", F.col("__m").alias("v"))
        )
        now, next_path = written(small.distinct(), purpose)
        after = mark(now)
        discard(edges.sparkSession, path)
        path = next_path
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(v.alias("node"), v.alias("root")).distinct()
    return now.select(u.alias("node"), v.alias("root")).union(roots)
