"""Sharding by histogram sort: splitters from counted probes, then one exchange.

Rows are ordered by (hash of a key, row number).  For each shard boundary, every
task counts the exact bytes and rows between candidate keys; the bracket that
holds the boundary is narrowed to the least and greatest key seen in it, and probed
again, until a splitter is within tolerance of its target (or no row lies
between two choices).  Only these counts reach the driver: probes x boundaries
rows a round, whatever the data's size.  Then each row knows its range and the
rows are exchanged once.

To keep tasks even, every shard is made of several ranges (their inner
boundaries have a loose tolerance).  Equal texts are neighbours in the order;
boundaries keep to the edges of such groups where that costs at most a hundredth
of a shard, so only a group too large for that is spread.

Defined results: a null size counts as 0; equal and repeated rows are told apart
by a row number that is written once; an empty table gives no rows; the columns
of the input pass through as they are (its own `shard` and `slot` are replaced).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stridelake.llm.base import from_row, materialize, table, whole_row

#: Bytes of an order key: 8 of the hash, 8 of the row number.
KEY = 16


def _order_key(*parts: Column) -> Column:
    """Longs as one binary value whose byte order is their order."""
    return F.concat(*[F.unhex(F.lpad(F.hex(p.bitwiseXOR(F.lit(-(2**63)))), 16, "0")) for p in parts])


def _counts(probes: np.ndarray):
    """Bytes, rows, least and greatest key between neighbouring probes, of a split."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(probes) + 1
        size, rows = np.zeros(n, np.int64), np.zeros(n, np.int64)
        low: list = [None] * n
        high: list = [None] * n
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.array(batch.column(0).to_pylist(), f"S{KEY}")
            at = np.searchsorted(probes, keys, side="right")
            order = np.lexsort((keys, at))
            at, keys, sizes = at[order], keys[order], batch.column(1).to_numpy()[order]
            starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            stops = np.r_[starts[1:], len(at)]
            total = np.add.reduceat(sizes, starts)
            for k, a, b, t in zip(at[starts].tolist(), starts.tolist(), stops.tolist(), total.tolist()):
                size[k] += t
                rows[k] += b - a
                first, final = bytes(keys[a]).ljust(KEY, b"\0"), bytes(keys[b - 1]).ljust(KEY, b"\0")
                low[k] = first if low[k] is None else min(low[k], first)
                high[k] = final if high[k] is None else max(high[k], final)
        kept = np.flatnonzero(rows)
        if len(kept):
            yield pa.RecordBatch.from_arrays(
                [pa.array(kept), pa.array(size[kept]), pa.array(rows[kept]), pa.array([low[k] for k in kept], pa.binary()), pa.array([high[k] for k in kept], pa.binary())],
                ["bin", "bytes", "rows", "low", "high"],
            )

    return run


def _number(key: bytes) -> int:
    return int.from_bytes(key.ljust(KEY, b"\0"), "big")


_ROW = 64  # bits of the row number
_LAST = 2 ** (8 * KEY) - 1


def _bytes(number: int) -> bytes:
    return number.to_bytes(KEY, "big")


def _probes(low: int, high: int, n: int) -> list[int]:
    """Keys to probe between two keys: starts of groups, or any keys where both are of one group."""
    even = [low + (high - low) * i // (n + 1) for i in range(1, n + 1)]
    if low >> _ROW == high >> _ROW:
        return [low, *even, high, high + 1]
    return [k >> _ROW << _ROW for k in [low, *even, high]] + [((high >> _ROW) + 1) << _ROW]


def splitters(rows: DataFrame, boundaries: int, exact_every: int, tolerance: float, group_tolerance: float, loose: float, probes: int) -> tuple[list[bytes], list[int]]:
    """(splitter of each boundary, rows below it) for rows (__key, __size)."""

    def counted(at: list[int]) -> list:
        sorted_probes = np.array([_bytes(p) for p in at], f"S{KEY}")
        found = rows.mapInArrow(_counts(sorted_probes), "bin long, bytes long, rows long, low binary, high binary")
        found = found.groupBy("bin").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"))
        return sorted(found.collect(), key=lambda r: r["bin"])  # at most len(at) + 1 rows

    whole = counted([])
    if not whole:
        return [_bytes(0)] * boundaries, [0] * boundaries
    total, shards = whole[0]["bytes"], (boundaries + 1) / exact_every
    target = [total * (j + 1) / (boundaries + 1) for j in range(boundaries)]
    exact = [(j + 1) % exact_every == 0 for j in range(boundaries)]
    allowed = [tolerance * total / shards if e else loose * total / (boundaries + 1) for e in exact]
    bracket = {j: (_number(whole[0]["low"]), _number(whole[0]["high"])) for j in range(boundaries)}
    inside: set[int] = set()  # boundaries that must cut a group
    chosen: dict[int, tuple[int, int]] = {}
    while bracket:
        at = sorted({min(p, _LAST) for low, high in bracket.values() for p in _probes(low, high, probes)})
        bins = counted(at)
        below = [(0, 0)]
        for b in bins:
            below.append((below[-1][0] + b["bytes"], below[-1][1] + b["rows"]))
        sums = np.array([b[0] for b in below])
        for j in list(bracket):
            k = min(int(np.searchsorted(sums, target[j], side="right")) - 1, len(bins) - 1)  # the bin where the target lies
            low, high = _number(bins[k]["low"]), _number(bins[k]["high"])
            options = [(abs(below[k][0] - target[j]), low, below[k][1]), (abs(below[k + 1][0] - target[j]), high + 1, below[k + 1][1])]
            miss, key, rows_below = min(options)
            one_group = low >> _ROW == high >> _ROW
            if miss <= allowed[j] or bins[k]["rows"] == 1 or one_group and j not in inside and miss <= group_tolerance * total / shards:
                chosen[j] = (key, rows_below)
                del bracket[j]
            else:
                bracket[j] = (low, high)
                if one_group:
                    inside.add(j)
    return [_bytes(min(chosen[j][0], _LAST)) for j in range(boundaries)], [chosen[j][1] for j in range(boundaries)]


def shard(df: DataFrame, size: Column, group: Column, shards: int = 8, tolerance: float = 1e-4, group_tolerance: float = 0.01, ranges: int = 32, probes: int = 32) -> DataFrame:
    """`df` with `shard` (0 .. shards - 1, bytes near equal) and `slot` (gapless from 0 in each shard).

    ``group``: a hash; rows that share it are neighbours, and a boundary falls inside
    a group only where the group's edges miss equal bytes by more than
    ``group_tolerance`` of a shard.  ``ranges``: tasks that a shard's rows are dealt to.
    """
    rows = df.select(
        whole_row(df), F.coalesce(size, F.lit(0)).cast("long").alias("__size"), _order_key(group, F.monotonically_increasing_id()).alias("__key")
    )
    rows = materialize(rows, "keyed-rows")
    boundaries = shards * ranges - 1
    keys, below = splitters(rows.select("__key", "__size"), boundaries, ranges, tolerance, group_tolerance, 0.1, probes)
    cuts = np.array(keys, f"S{KEY}")
    first = [0, *below]

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, np.array(key.tolist(), f"S{KEY}"), side="right").astype(np.int32))

    rows = rows.withColumn("__range", range_of("__key"))
    begun = F.element_at(F.array(*[F.lit(first[k] - first[k - k % ranges]) for k in range(len(first))]), F.col("__range") + 1)
    place = F.row_number().over(Window.partitionBy("__range").orderBy("__key")) - 1
    return rows.select(
        *from_row([c for c in df.columns if c not in ("shard", "slot")]), F.floor(F.col("__range") / ranges).cast("int").alias("shard"), (begun + place).cast("long").alias("slot")
    )


def op2_histogram_sort_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document."""
    data = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", (F.length(data) + 1).cast("long").alias("size"), F.crc32(data).alias("text_crc32"), F.xxhash64("text").alias("__group")
    )
    out = shard(docs, F.col("size"), F.col("__group"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
