"""Vector code compression: product quantisation by active-entry Lloyd rounds, in whole numbers.

A component x becomes floor(scale * x); a vector is cut into ``parts`` consecutive
parts, and each part position has a codebook of ``entries`` entries, which starts
as that part of the vectors with the least ids.  A round puts every part to its
nearest entry (squared distance; of equally near ones the lower index) and then
moves each entry to its parts' floored mean; an entry without parts stays.

The first round compares every part with every entry.  From then on a row keeps its
entries and their exact distances, and the driver keeps which entries moved (the
active ones).  A part whose entry stayed compares only the moved entries with the
stored distance: every other entry was no nearer before and has not come nearer.  A
part whose entry moved rescans its whole codebook.  On equal distances the lower
index wins in both cases, so the result is that of full scans.

Each round is one pass over the rows, written to the scratch folder, so a lost
executor repeats its tasks of that round only.  A task adds up its parts per entry
and writes one row of sums; what the driver holds is the codebooks and those sums,
entries x dimensions numbers, whatever the number of rows.

Defined results: a null vector or one with a null or non-finite component is
dropped, and so is one whose length differs from that of the vector with the least
id; rows with a null id are coded, but come after all others when entries start;
equal ids go by their vectors; with fewer vectors than ``entries`` the codebooks
have fewer entries; where the length is no multiple of ``parts``, part p ends at
length * (p + 1) // parts; components so large that a distance passes 64 bits are an
error; an empty table gives an empty result.  Other columns, whatever their names,
stay as they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.llm.base import discard, from_row, materialize, table, whole_row, written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Rows whose distances are computed at once.
_AT_ONCE = 8_192


def usable(vector: Column) -> Column:
    """A vector without null, infinite or undefined components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return vector.isNotNull() & fine


def part_edges(dimensions: int, parts: int) -> list[int]:
    return [dimensions * p // parts for p in range(parts + 1)]


def distances(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-numbered rows to entries."""
    most = max((int(np.abs(x).max()) for x in (rows, entries) if x.size), default=0)
    bound = 4 * most * most * rows.shape[1]
    if bound >= 2**63:
        raise ArithmeticError(f"components up to {most} give distances beyond 64 bits")
    if bound < 2**53:  # every intermediate value is a whole number that a double holds
        rows, entries = rows.astype(np.float64), entries.astype(np.float64)
    cross = rows @ entries.T
    return ((rows * rows).sum(axis=1)[:, None] - 2 * cross + (entries * entries).sum(axis=1)).astype(np.int64)


def nearest(rows: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Full scan: (entry, distance), the lower index of equally near entries."""
    apart = distances(rows, entries)
    code = apart.argmin(axis=1)
    return code, apart[np.arange(len(rows)), code]


def reassign(rows: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entries after the entries in ``moved`` moved, from the assignment before."""
    code, apart = code.copy(), apart.copy()
    rescan = moved[code]
    if rescan.any():
        code[rescan], apart[rescan] = nearest(rows[rescan], entries)
    active = np.flatnonzero(moved)
    settled = np.flatnonzero(~rescan)
    if len(active) and len(settled):
        other, there = nearest(rows[settled], entries[active])
        other = active[other]
        better = (there < apart[settled]) | ((there == apart[settled]) & (other < code[settled]))
        code[settled[better]], apart[settled[better]] = other[better], there[better]
    return code, apart


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _round(books: np.ndarray, edges: list[int], moved: np.ndarray | None):
    """One assignment of all rows; with the last row of a task, the sums and counts of its parts per entry.

    ``books``: entries x dimensions; ``moved``: parts x entries, None in the first round.
    """
    parts, spans = len(edges) - 1, list(zip(edges, edges[1:]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(books.shape, np.int64), np.zeros((parts, len(books)), np.int64)
        schema = None
        for whole in batches:
            for at in range(0, whole.num_rows, _AT_ONCE):
                batch = whole.slice(at, _AT_ONCE)
                rows = _matrix(batch.column(1), books.shape[1])
                if moved is None:
                    codes, apart = np.empty((len(rows), parts), np.int64), np.empty((len(rows), parts), np.int64)
                else:
                    codes = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint8).reshape(len(rows), parts).astype(np.int64)
                    apart = _matrix(batch.column(3), parts).copy()
                for p, (a, b) in enumerate(spans):
                    part = rows[:, a:b]
                    if moved is None:
                        codes[:, p], apart[:, p] = nearest(part, books[:, a:b])
                    else:
                        codes[:, p], apart[:, p] = reassign(part, books[:, a:b], moved[p], codes[:, p], apart[:, p])
                    order = np.argsort(codes[:, p], kind="stable")
                    used, first = np.unique(codes[order, p], return_index=True)
                    sums[used, a:b] += np.add.reduceat(part[order], first, axis=0)
                    counts[p, used] += np.diff(np.r_[first, len(order)])
                packed = codes.astype(np.uint8).tobytes()
                out = [
                    batch.column(0), batch.column(1),
                    pa.array([packed[i : i + parts] for i in range(0, len(packed), parts)], pa.binary()),
                    pa.FixedSizeListArray.from_arrays(pa.array(apart.ravel()), parts).cast(pa.list_(pa.int64())),
                    pa.nulls(len(rows), pa.list_(pa.int64())), pa.nulls(len(rows), pa.list_(pa.int64())),
                ]
                done = pa.RecordBatch.from_arrays(out, ["__row", "v", "codes", "apart", "sums", "counts"])
                schema = done.schema
                yield done
        if schema is not None:
            tail = [pa.nulls(1, f.type) for f in schema][:4] + [pa.array([x.ravel().tolist()], pa.list_(pa.int64())) for x in (sums, counts)]
            yield pa.RecordBatch.from_arrays(tail, schema.names)

    return run


def _total(state: DataFrame, column: str, shape: tuple[int, int]) -> np.ndarray:
    """The tasks' sums added up: as many numbers as the codebooks have, so the driver may hold them."""
    found = state.where(F.col(column).isNotNull()).select(F.posexplode(column).alias("at", "x")).groupBy("at").agg(F.sum("x").alias("x"))
    total = np.zeros(shape[0] * shape[1], np.int64)
    for r in found.collect():
        total[r["at"]] = r["x"]
    return total.reshape(shape)


def codebooks_digest(books: np.ndarray, edges: list[int]) -> str:
    """SHA-256 of all entries' components by part, entry, position."""
    text = ",".join(str(x) for a, b in zip(edges, edges[1:]) for x in books[:, a:b].ravel().tolist())
    return hashlib.sha256(text.encode()).hexdigest()


def compress(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE
) -> tuple[DataFrame, np.ndarray, list[int]]:
    """(`__row`: the row without its vector, `codes`: a byte a part, `apart`: squared distances a part), codebooks, part edges."""
    if not 1 <= entries <= 256:
        raise ValueError("a code is one byte: 1 to 256 entries")
    others = vectors.select(*[F.col(f"`{c}`") for c in vectors.columns if c != vector_col])
    vector = F.col(f"`{vector_col}`")
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("v")
    rows = vectors.where(usable(vector)).select(whole_row(others), whole)
    first = rows.orderBy(F.col("__row").getField(id_col).asc_nulls_last(), "v").limit(entries).collect()
    width = len(first[0]["v"]) if first else 0
    starts = [r["v"] for r in first if len(r["v"]) == width]
    books = np.array(starts, np.int64).reshape(len(starts), width)
    edges = part_edges(width, parts)
    kind = T.StructType(
        [T.StructField("__row", rows.schema["__row"].dataType), T.StructField("v", T.ArrayType(T.LongType()))]
        + [T.StructField("codes", T.BinaryType())]
        + [T.StructField(c, T.ArrayType(T.LongType())) for c in ("apart", "sums", "counts")]
    )
    state, moved, before = rows.where(F.size("v") == width), None, None
    for _ in range(rounds if first else 0):
        state, path = written(state.mapInArrow(_round(books, edges, moved), kind), "vector-codes")
        if before:
            discard(vectors.sparkSession, before)  # the round before this one
        before = path
        sums, counts = _total(state, "sums", books.shape), _total(state, "counts", (parts, len(books)))
        state = state.where("codes IS NOT NULL").select("__row", "v", "codes", "apart")
        each = np.repeat(counts, np.diff(edges), axis=0).T  # entries x dimensions
        after = np.where(each > 0, sums // np.maximum(each, 1), books)
        moved = np.array([(after[:, a:b] != books[:, a:b]).any(axis=1) for a, b in zip(edges, edges[1:])])
        books = after
    state = materialize(state.mapInArrow(_round(books, edges, moved), kind), "vector-codes") if first else vectors.sparkSession.createDataFrame([], kind)
    return state.where("codes IS NOT NULL").select("__row", "codes", "apart"), books, edges


def op12_active_lloyd_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every usable vector."""
    found, books, edges = compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    error = F.aggregate("apart", F.lit(0).cast("long"), lambda s, x: s + x).alias("error")
    rows = materialize(found.select(*from_row(["vec_id", "label"]), F.lower(F.hex("codes")).alias("code"), error), "vector-errors")
    labels = rows.groupBy("label").agg(F.sum("error").alias("label_error"))
    both = rows.alias("r").join(labels.alias("l"), F.col("r.label").eqNullSafe(F.col("l.label")))
    return both.select("r.vec_id", "r.code", "r.error", "l.label_error", F.lit(codebooks_digest(books, edges)).alias("codebooks_sha256"))


def _assigned(books: str, name: str) -> str:
    """SQL: the nearest entry of each part, as a CTE `name` (vec_id, part, k, apart)."""
    return f"""{name} AS (
  SELECT vec_id, part, arg_min(k, (apart, k)) AS k, min(apart) AS apart FROM (
    SELECT vec_id, part, k, CAST(list_sum(list_transform(list_zip(x, e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS apart
    FROM pieces JOIN {books} USING (part)
  ) GROUP BY vec_id, part
)"""


def _moved(before: str, assigned: str, name: str) -> str:
    """SQL: the codebooks after a round, as a CTE `name` (part, k, e)."""
    return f"""{name}_means AS (
  SELECT part, k, list(m ORDER BY i) AS e FROM (
    SELECT part, k, i, CAST(sum(y) // count(*) - CASE WHEN sum(y) % count(*) < 0 THEN 1 ELSE 0 END AS BIGINT) AS m
    FROM (SELECT part, k, unnest(x) AS y, unnest(range(len(x))) AS i FROM {assigned} JOIN pieces USING (vec_id, part)) GROUP BY part, k, i
  ) GROUP BY part, k
), {name} AS (
  SELECT part, k, coalesce(m.e, b.e) AS e FROM {before} b LEFT JOIN {name}_means m USING (part, k)
)"""


#: Ids that repeat are not expected by the SQL.
ORACLE_SQL = f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), pieces AS (
  SELECT vec_id, p AS part, v[len(v) * p // {PARTS} + 1 : len(v) * (p + 1) // {PARTS}] AS x FROM kept, range({PARTS}) r(p)
), books0 AS (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS k, x AS e FROM pieces
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {ENTRIES})
), {_assigned("books0", "first")}, {_moved("books0", "first", "books1")}, {_assigned("books1", "second")}, {_moved("books1", "second", "books2")}, {_assigned("books2", "final")},
coded AS (
  SELECT vec_id, string_agg(lpad(lower(to_hex(k)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(apart) AS BIGINT) AS error FROM final GROUP BY vec_id
), flat AS (SELECT part, k, unnest(e) AS y, unnest(range(len(e))) AS i FROM books2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY part, k, i)) FROM flat) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""
