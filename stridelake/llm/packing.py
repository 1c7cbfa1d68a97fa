"""Packing by non-negative least squares over a length histogram.

A document of n tokens gives n // 2048 full windows.  The rest is cut to a
multiple of 16 (its length class, 1 to 127 units) and a crumb of 0 to 15 tokens.
All combinations of up to three classes that fill a window exactly are the
strategies; non-negative least squares finds how often to repeat each so that
their lengths match the corpus's histogram of classes.  The counts are rounded
down to what the histogram holds.  What is left, crumbs included, is packed
greedily, end to end, cut where a window is full; the last open window is cut at
powers of two.  So no window carries padding, and most documents are cut into
few pieces.

The driver sees the histogram (127 numbers) and the slots of the solution (a few
hundred rows), whatever the corpus's size.  Places are ranks: each input split
counts its documents by class, prefix sums over splits make the counts global.

Defined results: null and empty texts are one piece, the end id alone; equal rows
are packed each; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stridelake.llm.base import materialize, table, text_slices, tidy
from stridelake.llm.tokens import forget, worker_tokenizer

WINDOW, UNIT, DEPTH = 2048, 16, 3
END_ID = 1
#: Tasks that place the ids of the splits (each task sends to each of them).
MOST_TASKS = 20_000


def strategies(units: int, depth: int = DEPTH) -> list[tuple[int, ...]]:
    """Ascending combinations of two to ``depth`` classes whose sum is ``units``."""
    out: list[tuple[int, ...]] = []

    def extend(chosen: tuple[int, ...], left: int) -> None:
        if chosen and left >= chosen[-1]:
            out.append((*chosen, left))
        if len(chosen) < depth - 1:
            for k in range(chosen[-1] if chosen else 1, left // 2 + 1):
                if left - k >= k:
                    extend((*chosen, k), left - k)

    extend((), units)
    return sorted({s for s in out if len(s) > 1})


def nnls(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """argmin |a x - b| with x >= 0, by the active-set method of Lawson and Hanson."""
    x, active = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    gram, target = a.T @ a, a.T @ b
    tolerance = 1e-9 * max(1.0, np.abs(target).max())
    for _ in range(3 * a.shape[1]):
        gain = np.where(active, -np.inf, target - gram[:, active] @ x[active])
        j = int(np.argmax(gain))
        if gain[j] <= tolerance:
            break
        active[j] = True
        while True:
            trial = np.zeros_like(x)
            inner = gram[np.ix_(active, active)]
            trial[active] = np.linalg.solve(inner + 1e-10 * np.eye(len(inner)), target[active])
            bad = active & (trial <= 1e-12)
            if not bad.any():
                x = trial
                break
            steps = x[bad] / np.maximum(x[bad] - trial[bad], 1e-300)
            x = x + steps.min() * (trial - x)
            active &= x > 1e-12
            x[~active] = 0
            if not active.any():
                break
    return x


def repeat_counts(histogram: np.ndarray, depth: int = DEPTH) -> list[tuple[tuple[int, ...], int]]:
    """(strategy, repeats) for a histogram over classes 1 .. units - 1 (index 0: class 1); never more than it holds."""
    units = len(histogram) + 1
    every = strategies(units, depth)
    if not every or not histogram.any():
        return []
    usage = np.zeros((len(histogram), len(every)))
    for j, s in enumerate(every):
        for k in s:
            usage[k - 1, j] += 1
    x = nnls(usage, histogram.astype(float))
    left, out = histogram.astype(np.int64).copy(), []
    for j in np.argsort(-x, kind="stable"):
        need = usage[:, j].astype(np.int64)
        n = min(int(np.rint(x[j])), int((left[need > 0] // need[need > 0]).min()))
        if n > 0:
            left -= n * need
            out.append((every[j], n))
    return out


def _encoded(path: str | None, end_id: int, window: int, unit: int, keep_all: bool):
    """Documents of a split, in order, as token ids: class, rank in the split's class, checksums of full windows, the other ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, ranks, at = worker_tokenizer(path), np.zeros(window // unit, np.int64), 0
        if max(tokenizer.size - 1, end_id) > 0xFFFF:
            raise ValueError(f"ids up to {max(tokenizer.size - 1, end_id)} do not fit into the 16 bits that packing keeps of each")
        part, end = TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes()
        for rows, texts in text_slices(batches):
            out = []
            for ids in tokenizer.encode(texts):
                ids += end
                n = len(ids) // 4
                full = n // window
                k = (n - full * window) // unit
                crcs = [zlib.crc32(ids[4 * window * i : 4 * window * (i + 1)]) for i in range(full)]
                kept = 0 if keep_all else full * window
                out.append((part, at, n, k, int(ranks[k]), crcs, kept, np.frombuffer(ids, "<u4")[kept:].astype("<u2").tobytes()))
                ranks[k] += 1
                at += 1
            names = ["part", "at", "n", "class", "rank", "crcs", "kept", "ids"]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), *[pa.array(c, t) for c, t in zip(zip(*out), kinds)]], ["__id", *names]
            )

    return run


def _placed(slots: dict[int, list[tuple[int, int, int, int]]], first_stream: int, stream_tokens: int, first_window: int, window: int, unit: int, with_ids: bool):
    """Pieces of the documents of each split, whose first row, its head, says what the splits before it hold."""
    whole = stream_tokens // window * window
    tail = [1 << b for b in range(window.bit_length(), -1, -1) if (stream_tokens - whole) >> b & 1]
    ends = whole + np.cumsum(tail, dtype=np.int64) if tail else np.empty(0, np.int64)
    begins = np.r_[whole, ends[:-1]] if tail else ends

    def stream_pieces(at: int, length: int):
        while length:
            if at < whole:
                sequence, offset, size = at // window, at % window, window
            else:
                k = int(np.searchsorted(ends, at, side="right"))
                sequence, offset, size = whole // window + k, at - int(begins[k]), tail[k]
            n = min(length, size - offset)
            yield first_stream + sequence, offset, n
            at, length = at + n, length - n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()  # all splits are encoded
        stream = windows = 0
        base: dict[int, int] = {}
        for batch in batches:
            out: list[tuple] = []
            for doc, n, k, rank, crcs, kept, data, before in zip(*(batch.column(i).to_pylist() for i in range(8))):
                if before is not None:  # the head of a split
                    base = {x["class"]: x["n"] for x in before["ranks"]}
                    stream, windows = before["stream"], before["windows"]
                    continue
                ids = np.frombuffer(data, "<u2").astype("<u4")
                cut = lambda a, m: ids[a - kept : a - kept + m].tobytes()
                for i, crc in enumerate(crcs):
                    out.append((doc, i * window, window, crc, n, first_window + windows, 0, cut(i * window, window) if with_ids else None))
                    windows += 1
                start = len(crcs) * window
                place = base[k] + rank
                for low, high, sequence, offset in slots.get(k, ()):
                    if low <= place < high:
                        piece = cut(start, k * unit)
                        out.append((doc, start, k * unit, zlib.crc32(piece), n, sequence + place - low, offset, piece))
                        start += k * unit
                        break
                for sequence, offset, m in stream_pieces(stream, n - start):
                    piece = cut(start, m)
                    out.append((doc, start, m, zlib.crc32(piece), n, sequence, offset, piece))
                    start += m
                    stream += m
            names = ["__id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"][: 8 if with_ids else 7]
            if out:
                columns = list(zip(*out))[: len(names)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], batch.schema.field(0).type), *[pa.array(c, pa.binary() if x == "ids" else pa.int64()) for x, c in zip(names[1:], columns[1:])]], names
                )

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, unit: int = UNIT, depth: int = DEPTH, end_id: int = END_ID, tokenizer: str | None = None, with_ids: bool = True) -> DataFrame:
    """Pieces: the id column, start, length, ids_crc32, doc_tokens, sequence_id, offset and (with_ids) ids, little-endian unsigned 32-bit.

    ``window`` must be a power of two times ``unit``; the tokenizer's ids and the end id must lie below 65,536 (larger ones are an error).
    """
    kind = docs.schema[id_col].dataType.simpleString()
    encoded = materialize(
        docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).mapInArrow(
            tidy(_encoded(tokenizer, end_id, window, unit, with_ids)),
            f"__id {kind}, part int, at long, n long, class int, rank long, crcs array<long>, kept long, ids binary",
        ),
        "encoded",
    )
    counts = encoded.groupBy("part", "class").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("n") % unit).alias("crumbs"), F.sum(F.floor(F.col("n") / window)).alias("windows")
    )
    counts = materialize(counts, "class-counts")
    histogram = np.zeros(window // unit - 1, np.int64)
    for r in counts.where("class > 0").groupBy("class").agg(F.sum("n").alias("n")).collect():  # at most window / unit rows
        histogram[r["class"] - 1] = r["n"]

    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    used, sequences = np.zeros(len(histogram) + 1, np.int64), 0
    for strategy, n in repeat_counts(histogram, depth):
        offset = 0
        for k in strategy:
            slots.setdefault(k, []).append((int(used[k]), int(used[k]) + n, sequences, offset))
            used[k] += n
            offset += k * unit
        sequences += n

    earlier = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranked = counts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
    taken = F.element_at(F.array(*[F.lit(int(u)) for u in used]), F.col("class") + 1)
    loose = F.col("n") - F.greatest(F.lit(0), F.least(F.col("n"), taken - F.col("before")))
    parts = ranked.groupBy("part").agg(
        F.collect_list(F.struct("class", F.col("before").alias("n"))).alias("ranks"),
        F.sum(loose * F.col("class") * unit + F.col("crumbs")).alias("stream"),
        F.sum("windows").alias("windows"),
    )
    parts = materialize(parts, "splits")
    total, splits = parts.agg(F.coalesce(F.sum("stream"), F.lit(0)), F.coalesce(F.max("part"), F.lit(0)) + 1).first()
    upto = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each input split
    before = parts.select("part", *[F.coalesce(F.sum(c).over(upto), F.lit(0)).alias(c) for c in ("stream", "windows")])
    before = before.join(parts.select("part", "ranks"), "part").select("part", F.struct("ranks", "stream", "windows").alias("before"))

    tail = bin(total % window).count("1")
    run = _placed(slots, sequences, int(total), sequences + int(total) // window + tail, window, unit, with_ids)
    # A split is a task's own again, or a few neighbours are: no hash puts many of them into one task.
    rows = encoded.unionByName(before.withColumn("at", F.lit(-1).cast("long")), allowMissingColumns=True)
    tasks = min(int(splits), MOST_TASKS)
    rows = rows.repartitionById(tasks, F.floor(F.col("part") * F.lit(tasks) / F.lit(int(splits))).cast("int"))
    rows = rows.sortWithinPartitions("part", "at").select("__id", "n", "class", "rank", "crcs", "kept", "ids", "before")
    pieces = rows.mapInArrow(
        tidy(run), f"__id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + ", ids binary" * with_ids
    )
    return pieces.withColumnRenamed("__id", id_col)


def op1_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of each piece of every document."""
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
