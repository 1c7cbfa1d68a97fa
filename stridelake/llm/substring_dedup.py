"""Substring deduplication by super-k-mer partitioning.

Consecutive windows of 50 words that share a minimiser (the least hash of the
15-word runs inside the window) form a super-k-mer.  It travels as one packed
string to the bucket of its minimiser, where sorting gives equal windows one
number, exactly.  Text that no other document shares never travels: a window
can only recur in another document if its minimiser does, so minimisers are
counted first (map-side combined, 8 bytes each).

Steps, all distributed:
1. rows (minimiser, id) of every document; minimisers of two or more ids stay;
2. documents with such a minimiser, joined with their list of them (texts
   travel compressed), are cut into super-k-mers, one packed string each;
3. a bucket sorts its windows: the least id that has each window;
4. back to the documents: words covered by a window of a smaller id go.

A minimiser whose super-k-mers hold very many words (``hot``, counted over all
documents) has no bucket: its windows travel under their own digests, a row for each
distinct window of a document with the places where it starts, so that no task
gathers them and a line repeated a thousand times is not a thousand rows.  Packed
strings end after `PIECE` windows (the next one overlaps), so neither a row nor a
bucket grows with a document.

Defined results: null text has no words; null ids are compared with nothing
(such rows neither lose words nor make others lose them); rows with one id never
take words from each other; equal rows get equal results; texts under 50 words
stay whole; very long and repetitive texts are worked on whole; an empty table gives
no rows; columns whose names clash with the operator's own pass through.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.base import WordHashes, from_row, grouped_batches, materialize, same_row, table, text_key, text_slices, tidy, unzipped_slices, whole_row, window_hashes, zipped

WINDOW = 50
MINIMISER = 15
#: Words of a minimiser's super-k-mers that a bucket takes, windows of a packed string.
HOT, PIECE = 400_000, 512
#: Packed strings that a bucket task sorts at once (more only if one bucket has more words' worth of them).
_AT_ONCE = 1_000
#: Windows of a hot super-k-mer from which they are numbered by sorting before they are digested.
_MANY = 64


def super_kmers(words: np.ndarray, window: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(minimiser, first window, windows) of each super-k-mer of a text, given its word hashes."""
    grams = window_hashes(words, width)
    n, span = len(words) - window + 1, window - width + 1
    if n <= 0:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    least, step = grams, 1
    while step * 2 <= span:  # minimum over runs of step, doubled
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    least = np.minimum(least[:n], least[span - step : span - step + n])
    starts = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
    return least[starts], starts, np.diff(np.r_[starts, n])


def _minimisers(window: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for part, texts in text_slices(batches):
            rows, found, words = [], [], []
            for i, text in enumerate(texts):
                minimiser, _, count = super_kmers(hashes.of((text or b"").split()), window, width)
                h, at = np.unique(minimiser, return_inverse=True)
                rows.append(np.full(len(h), i))
                found.append(h)
                words.append(np.bincount(at, count + (window - 1) * -(-count // PIECE), len(h)).astype(np.int64))
            take = pa.array(np.concatenate(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(found).view(np.int64)), part.column(0).take(take), part.column(1).take(take), pa.array(np.concatenate(words))], ["h", "__id", "__tk", "words"]
            )

    return run


def _cut(window: int, width: int, with_strings: bool):
    """Super-k-mers with a listed minimiser: (id, key, digest, first windows, hot), or the strings for the buckets.

    Those of a hot minimiser are cut into single windows, which need no bucket and no string.
    """

    def strings(h: int, words: list[bytes], start: int, n: int) -> Iterator[tuple]:
        for k in range(start, start + n, PIECE):
            packed = b" ".join(words[k : min(k + PIECE, start + n) + window - 1])
            digest = xxhash.xxh3_128_digest(packed)
            yield (h, digest, packed) if with_strings else (digest, [k], False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for part, texts in unzipped_slices(batches):
            rows, out = [], []
            for i, (text, listed) in enumerate(zip(texts, part.column(2).to_pylist())):
                words = text.split()
                hot = {x["h"]: x["hot"] for x in listed}
                minimiser, first, count = super_kmers(hashes.of(words), window, width)
                single: dict[bytes, list[int]] = {}
                for h, start, n in zip(minimiser.view(np.int64).tolist(), first.tolist(), count.tolist()):
                    if h not in hot or hot[h] and with_strings:
                        continue
                    if hot[h]:
                        for digest, places in distinct_windows(words[start : start + n + window - 1], window):
                            single.setdefault(digest, []).extend(start + k for k in places)
                    else:
                        out += strings(h, words, start, n)
                out += [(digest, places, True) for digest, places in single.items()]
                rows += [i] * (len(out) - len(rows))
            take = pa.array(rows, pa.int64())
            kinds = [pa.int64(), pa.binary(), pa.binary()] if with_strings else [pa.binary(), pa.list_(pa.int32()), pa.bool_()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out) if out else ((), (), ()), kinds)]
            ids = [part.column(0).take(take)] if with_strings else [part.column(0).take(take), part.column(1).take(take)]
            yield pa.RecordBatch.from_arrays([*ids, *columns], ["__id", "h", "sk", "packed"] if with_strings else ["__id", "__tk", "sk", "starts", "hot"])

    return run


def window_numbers(ids: np.ndarray, window: int) -> np.ndarray:
    """Equal numbers for equal windows of a sequence of word numbers, by sorting runs of doubled length: exact."""
    run, length, parts, done = ids, 1, [], 0
    while True:
        if window & length:
            parts.append((run, done))
            done += length
        if length * 2 > window:
            break
        pairs = run[:-length].astype(np.int64) << 32 | run[length:].astype(np.int64)
        run = np.unique(pairs, return_inverse=True)[1]
        length *= 2
    n = len(ids) - window + 1
    total, at = parts[0]
    total = total[at : at + n]
    for run, at in parts[1:]:
        total = np.unique(total.astype(np.int64) << 32 | run[at : at + n].astype(np.int64), return_inverse=True)[1]
    return total


def distinct_windows(words: list[bytes], window: int) -> list[tuple[bytes, list[int]]]:
    """(digest, places) of each distinct window of a run of words."""
    n = len(words) - window + 1
    digest = lambda k: xxhash.xxh3_128_digest(b" ".join(words[k : k + window]))
    if n < _MANY:
        return [(digest(k), [k]) for k in range(n)]
    number: dict[bytes, int] = {}
    numbers = window_numbers(np.array([number.setdefault(w, len(number)) for w in words], np.int64), window)
    order = np.argsort(numbers, kind="stable")
    groups = np.split(order, np.flatnonzero(np.diff(numbers[order])) + 1)
    return [(digest(int(g[0])), g.tolist()) for g in groups]


def bucket_minima(strings: list[bytes], ids: np.ndarray, window: int) -> list[np.ndarray]:
    """For each packed string, for each of its windows: the least id whose string has that window."""
    number: dict[bytes, int] = {}
    words, lengths = [], []
    for s in strings:
        w = s.split()
        lengths.append(len(w))
        words.extend([number.setdefault(x, len(number)) for x in w])
    owner = np.repeat(np.arange(len(strings)), lengths)
    windows = window_numbers(np.array(words, np.int64), window)
    whole = owner[: len(windows)] == owner[window - 1 :]  # windows inside one string
    windows, owner = windows[whole], owner[: len(whole)][whole]
    least = np.full(int(windows.max()) + 1 if len(windows) else 0, np.iinfo(np.int64).max)
    np.minimum.at(least, windows, ids[owner])
    return np.split(least[windows], np.cumsum(np.array(lengths) - window + 1)[:-1])


def _bucket(window: int):
    """Of rows sorted by (minimiser, digest): the least id for each window of each distinct string."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in grouped_batches(batches, ["h"], _AT_ONCE):
            sk, ids = groups["sk"].combine_chunks(), groups["__id"].to_numpy()
            new = np.r_[True, pc.not_equal(sk[1:], sk[:-1]).to_numpy(zero_copy_only=False)] if len(sk) > 1 else np.array([True])
            at = np.flatnonzero(new)
            minima = bucket_minima(groups["packed"].take(at).to_pylist(), np.minimum.reduceat(ids, at), window)
            yield pa.RecordBatch.from_arrays([sk.take(at), pa.array(minima, pa.list_(pa.int64()))], ["sk", "minima"])

    return run


def _rest(window: int):
    """Kept words of each document, given (starts, flags) of the windows that a smaller id has: flags of consecutive windows from one start, or one flag of several starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in unzipped_slices(batches):
            out = []
            for text, spans in zip(texts, part.column(2).to_pylist()):
                words = text.split()
                gone = np.zeros(len(words) + 1, np.int32)
                for span in spans:
                    at = np.add.outer(np.flatnonzero(span["taken"]), np.array(span["starts"])).ravel()
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + window, -1)
                gone = np.cumsum(gone[:-1]) > 0
                kept = [w for w, g in zip(words, gone.tolist()) if not g] if gone.any() else words
                edges = np.flatnonzero(np.diff(np.r_[False, gone, False].astype(np.int8))).reshape(-1, 2)
                out.append((len(words), len(words) - len(kept), b" ".join(kept), [{"start": int(a), "stop": int(b)} for a, b in edges]))
            n, removed, kept, spans = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))],
                ["__id", "__tk", "n_words", "n_removed", "kept_text", "removed"],
            )

    return run


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, texts in text_slices(batches):
        words = [(t or b"").split() for t in texts]
        yield pa.RecordBatch.from_arrays(
            [part.column(0), part.column(1), pa.array(map(len, words), pa.int64()), pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words])],
            ["__id", "__tk", "n_words", "sha"],
        )


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, width: int = MINIMISER, hot: int = HOT) -> DataFrame:
    """The documents that lose words: __id, __tk, n_words, n_removed, kept_text, removed (spans of words)."""
    kind = docs.schema[id_col].dataType.simpleString()
    keyed = docs.where(F.col(text_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("__id"), text_key(F.col(text_col)).alias("__tk"), F.col(text_col).alias("text")
    )
    seen = materialize(keyed.mapInArrow(tidy(_minimisers(window, width)), f"h long, __id {kind}, __tk long, words long"), "minimisers")
    shared = seen.groupBy("h").agg(F.min("__id").alias("a"), F.max("__id").alias("b"), F.sum("words").alias("n"))
    shared = shared.where("a < b").select("h", (F.col("n") > hot).alias("hot"))
    listed = seen.join(shared, "h").groupBy("__id", "__tk").agg(F.collect_set(F.struct("h", "hot")).alias("listed"))
    some = zipped(keyed).alias("d").join(listed.alias("l"), same_row("d", "l")).select("d.__id", "d.__tk", "l.listed", "d.ztext")
    some = materialize(some, "documents-with-shared-minimisers")
    if some.groupBy("__id", "__tk").count().where("count > 1").take(1):  # repeated rows
        some = materialize(some.dropDuplicates(["__id", "__tk"]), "distinct-documents")
    strings = some.mapInArrow(tidy(_cut(window, width, True)), f"__id {kind}, h long, sk binary, packed binary")
    dealt = strings.repartition("h").sortWithinPartitions("h", "sk").select("h", "sk", F.col("__id").cast("long").alias("__id"), "packed")
    minima = dealt.mapInArrow(tidy(_bucket(window)), "sk binary, minima array<long>")
    pieces = materialize(some.mapInArrow(tidy(_cut(window, width, False)), f"__id {kind}, __tk long, sk binary, starts array<int>, hot boolean"), "super-k-mers")
    minima = minima.union(pieces.where("hot").groupBy("sk").agg(F.min("__id").cast("long").alias("m")).select("sk", F.array("m")))
    taken = pieces.select("__id", "__tk", "sk", "starts").join(minima, "sk").withColumn("taken", F.transform("minima", lambda m: m < F.col("__id")))
    taken = taken.where(F.exists("taken", lambda x: x)).groupBy("__id", "__tk").agg(F.collect_list(F.struct("starts", "taken")).alias("spans"))
    lost = some.select("__id", "__tk", "ztext").alias("d").join(taken.alias("t"), same_row("d", "t")).select("d.__id", "d.__tk", "t.spans", "d.ztext")
    return lost.mapInArrow(tidy(_rest(window)), f"__id {kind}, __tk long, n_words long, n_removed long, kept_text string, removed array<struct<start:long,stop:long>>")


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`docs` with the repeated words taken out of the text; the other columns as they are.

    A document that loses nothing keeps its text byte for byte; one that loses
    words has the rest joined by one space; one that loses all its words goes.
    """
    lost = materialize(repeated_windows(docs, id_col, text_col, **options), "shortened")
    rows = docs.select(whole_row(docs), F.col(id_col).alias("__id"), text_key(F.col(text_col)).alias("__tk"))
    out = rows.alias("d").join(lost.select("__id", "__tk", "kept_text").alias("k"), same_row("d", "k"), "left").where("kept_text IS NULL OR kept_text <> ''")
    return out.select(
        *[F.coalesce(F.col("kept_text"), c).alias(text_col) if name == text_col else c for name, c in zip(docs.columns, from_row(docs.columns))]
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    lost = materialize(repeated_windows(docs), "shortened")
    lost = lost.select("__id", "__tk", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("new_sha"))
    keyed = docs.select(F.col("doc_id").alias("__id"), text_key(F.col("text")).alias("__tk"), "text")
    every = keyed.mapInArrow(tidy(_digests), "__id long, __tk long, n_words long, sha string")
    return every.alias("d").join(lost.alias("k"), same_row("d", "k"), "left").select(
        F.col("d.__id").alias("doc_id"), "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("new_sha", "sha").alias("kept_sha256"),
    )


ORACLE_SQL = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS k FROM texts WHERE len(w) >= 50),
windows AS (SELECT doc_id, k, array_to_string(w[k:k + 49], ' ') AS s FROM starts),
least AS (SELECT s, min(doc_id) AS f FROM windows GROUP BY s),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(k, k + 49)) AS p FROM windows JOIN least USING (s) WHERE f < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM texts),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS k, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""
