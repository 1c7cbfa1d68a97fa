"""Benchmark decontamination by template windows.

Words are stripped of outer punctuation and lower-cased; numbers, names
(capitalised words inside a sentence) and units (after a number) become typed
placeholders, so a question whose values were exchanged keeps its template.  A
capitalised word that begins a sentence may be a name or not: windows that hold
one have a second template with such words as names, and either may match.
Windows of eight template words of every benchmark item are joined by hash with
those of every document, by their template (which needs four plain words: mere
placeholders say nothing) and by their literal words.

A window that more than `SHARED` different items have (an instruction above every
question) is no evidence: it is neither looked for nor counted, so an item is known
by its own windows, and a document that holds the instruction alone matches none.
Items of equal words are one class, reported once under its least id with their
number.  So a window of a document meets `SHARED` classes at most.

What that leaves out has a way of its own.  More than `SHARED` classes of one template
(a question asked with many values) are one class of templates too: its windows are
shared only if other templates have them, and a leak of it is reported once, under the
least of all its items.  A class all of whose windows are shared is looked for with all
of them, and leaks where the whole of it stands in a document.

Matches are then held together by alignment (item, document, offset between
them).  Literal windows count whatever else matches.  Windows matched by template
alone are checked for slot consistency: within an alignment a value of the item must
stand for one value of the document (two of the item may become equal), and windows
with a value that stands for two are left out.  An item counts as leaked into a
document if the windows that count cover at least half of its own windows, or if
`RUN` consecutive words of it match at one alignment, whatever its length.

The benchmark's windows reach the tasks as a Bloom filter of bounded size, so any
benchmark takes one pass over the documents; what passes it is exchanged and joined
exactly.

Defined results: null or empty texts match nothing; items under five words are
too short to tell and match nothing, items of five to seven words are one window;
an item all of whose windows are shared matches where it stands whole; rows with equal ids are
reported under that id; an empty table of documents or items gives no leaks; of the
tables only ids and texts are read, so other columns, whatever their names, do not
matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm.base import grouped_batches, materialize, mix, table, text_slices, tidy, window_hashes

WIDTH, SHORTEST, PLAIN = 8, 5, 4
COVERAGE = 0.5
#: Consecutive words that are a leak whatever the length of the item (13 words are the usual n-gram of contamination tests).
RUN = 13
#: Different items that may have a window before it is no evidence.
SHARED = 8
#: Bits of the filter for each benchmark window, and of the whole filter at most (128 MB; above 33 million windows more pass it and the join has more to drop).
FILTER_BITS, MOST_BITS = 32, 1 << 30
#: Filter words (64 bits) in a row of its table.
_SEGMENT = 1 << 10

UNITS = frozenset(
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml l s sec min h hr hrs day days week weeks month months year years hour hours minute minutes second seconds"
    " meter meters metre metres kilometer kilometers kilometre kilometres mile miles gram grams kilogram kilograms pound pounds liter liters litre litres"
    " percent % euro euros dollar dollars cent cents usd eur gbp degrees".split()
)
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*%?$")
_NUMBER_UNIT = re.compile(r"[+-]?\d[\d.,]*([^\W\d]+|%)$")
_OUTER = re.compile(r"^[^\w$€£+-]+|[^\w%]+$")
_END = (".", "!", "?", ":", ";")

PLAIN_WORD, NUMBER, MEASURE, UNIT, NAME = range(5)
#: Readings of a window: its words, its template, its template with first words as names.
LITERAL, FIRST, SECOND = range(3)
_PLACEHOLDER = np.array([0, 0x1001, 0x1002, 0x1003, 0x1004], np.uint64)


class Canonical(dict):
    """Word (bytes) to its number, and what is known of each number; begins anew after a bounded number of words."""

    def __init__(self, remember: int = 200_000):
        super().__init__()
        self._remember = remember
        self._forget()

    def _forget(self) -> None:
        self.clear()
        self.plain: list[str] = []
        self._new: list[tuple[int, int, bool, bool, bool]] = []
        self.hash = np.empty(0, np.uint64)
        self.kind, self.title, self.ends, self.empty = np.empty((4, 0), np.int64)

    def __missing__(self, raw: bytes) -> int:
        text = raw.decode()
        ends = text.endswith(_END)
        word = text[:-1] if ends or text[-1:] == "," else text
        if not word.isalpha():  # letters only: nothing to strip, and no number
            word = _OUTER.sub("", text)
        low = word.lower()
        if word.isalpha():
            kind = UNIT if low in UNITS else PLAIN_WORD
        elif _NUMBER.match(word):
            kind = NUMBER
        elif (m := _NUMBER_UNIT.match(word)) and m[1].lower() in UNITS:
            kind = MEASURE
        else:
            kind = UNIT if low in UNITS else PLAIN_WORD
        self._new.append((xxhash.xxh3_64_intdigest(low), kind, word[:1].isupper() and not word.isupper(), ends, not low))
        self.plain.append(low)
        self[raw] = number = len(self)
        return number

    def numbers(self, words: Iterator[bytes], count: int) -> np.ndarray:
        """The words' numbers, good until the next call; `hash`, `kind`, `title`, `ends`, `empty` and `plain` are by number."""
        if len(self) > self._remember:
            self._forget()
        out = np.fromiter(map(self.__getitem__, words), np.int64, count)
        if self._new:
            hashes, *facts = zip(*self._new)
            self.hash = np.r_[self.hash, np.array(hashes, np.uint64)]
            self.kind, self.title, self.ends, self.empty = np.c_[[self.kind, self.title, self.ends, self.empty], np.array(facts, np.int64)]
            self._new = []
        return out


class Templates:
    """The words of some texts, end to end: `row` (which text), `hashes`, `kinds`, `seconds` (kinds with capitalised first
    words as names), `starts` (of each text).  A line's start is a sentence's start."""

    def __init__(self, texts: list[bytes | None], canonical: Canonical):
        rows, lines = [], []
        for i, text in enumerate(texts):
            parts = [line.split() for line in (text or b"").split(b"\n")]
            rows += [i] * len(parts)
            lines += parts
        lengths = np.fromiter(map(len, lines), np.int64, len(lines))
        numbers = canonical.numbers(chain.from_iterable(lines), int(lengths.sum()))
        line = np.repeat(np.arange(len(lines)), lengths)
        told = np.flatnonzero(canonical.empty[numbers] == 0)
        after_end = np.r_[True, canonical.ends[numbers[:-1]] > 0] if len(numbers) else np.empty(0, bool)
        breaks = np.cumsum(after_end | (np.diff(line, prepend=-1) > 0))  # counts up at each place that begins a sentence
        begins = np.diff(breaks[told], prepend=0) > 0
        line, self._numbers, self._plain = line[told], numbers[told], canonical.plain
        kinds = canonical.kind[self._numbers]
        after_number = np.zeros(len(told), bool)
        after_number[1:] = (kinds[:-1] == NUMBER) & (line[1:] == line[:-1])
        kinds[(kinds == UNIT) & ~after_number] = PLAIN_WORD
        self.seconds = np.where((kinds == PLAIN_WORD) & (canonical.title[self._numbers] > 0), NAME, kinds)
        self.kinds = np.where(begins, kinds, self.seconds)
        self.hashes = canonical.hash[self._numbers]
        self.row = np.array(rows, np.int64)[line]
        self.starts = np.searchsorted(self.row, np.arange(len(texts) + 1))

    def windows(self, width: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(reading, kinds, places, hashes) of the windows: of their literal words, of the templates that have placeholders
        and enough plain words, and of the second templates where they differ from the first."""
        n = len(self.row) - width + 1
        if n <= 0:
            return
        whole = self.row[:n] == self.row[width - 1 :]
        places = np.flatnonzero(whole)
        yield LITERAL, np.zeros_like(self.kinds), places, window_hashes(self.hashes, width)[places]

        def within(words: np.ndarray) -> np.ndarray:
            count = np.r_[0, np.cumsum(words)]
            return count[width:] - count[:-width]

        for reading, read, told in ((FIRST, self.kinds, self.kinds != PLAIN_WORD), (SECOND, self.seconds, self.seconds != self.kinds)):
            if told.any():
                plain = read == PLAIN_WORD
                typed = np.flatnonzero(whole & (within(plain) >= PLAIN) & (within(told) > 0))
                yield reading, read, typed, window_hashes(np.where(plain, self.hashes, mix(_PLACEHOLDER)[read]), width)[typed]

    def slots(self, kinds: np.ndarray, at: int, width: int) -> list[str]:
        return [self._plain[self._numbers[i]] for i in range(at, at + width) if kinds[i] != PLAIN_WORD]


_MATCH = pa.list_(pa.string())


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    canonical = Canonical()
    for part, texts in text_slices(batches):
        read, items, out = Templates(texts, canonical), part.column(0).to_pylist(), []
        lengths = np.diff(read.starts)
        kinds_of = [xxhash.xxh3_128_digest(read.hashes[a:b].tobytes() + read.seconds[a:b].tobytes()) for a, b in zip(read.starts, read.starts[1:])]
        typed = np.where(read.seconds == PLAIN_WORD, read.hashes, mix(_PLACEHOLDER)[read.seconds])
        templates = [xxhash.xxh3_128_digest(typed[a:b].tobytes()) for a, b in zip(read.starts, read.starts[1:])]
        for width in range(SHORTEST, WIDTH + 1):
            for reading, kinds, places, found in read.windows(width):
                own = np.minimum(lengths, WIDTH)[read.row[places]] == width
                rows, at = read.row[places[own]], places[own]
                out += [
                    (items[row], kinds_of[row], templates[row], h, width, reading, k - start, n - width + 1, read.slots(kinds, k, width))
                    for row, k, start, n, h in zip(rows.tolist(), at.tolist(), read.starts[rows].tolist(), lengths[rows].tolist(), found[own].view(np.int64).tolist())
                ]
        if out:
            item, *rest = zip(*out)
            kinds_ = [pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), _MATCH]
            yield pa.RecordBatch.from_arrays(
                [pa.array(item, part.schema.field(0).type), *(pa.array(c, t) for c, t in zip(rest, kinds_))], ["item", "class", "template", "window", "width", "reading", "place", "n_windows", "item_slots"]
            )


class Filter:
    """A Bloom filter over window hashes: four bits each, one window in 5,000 passes by chance."""

    def __init__(self, words: np.ndarray):
        self.words, self._mask = words, np.uint64(64 * len(words) - 1)

    @staticmethod
    def size(windows: int) -> int:
        """Words of a filter for so many windows: a power of two, whole segments."""
        bits = max(64 * _SEGMENT, min(MOST_BITS, FILTER_BITS * windows))
        return (1 << (bits - 1).bit_length()) // 64

    @staticmethod
    def bits(hashes: np.ndarray, mask: np.uint64) -> Iterator[np.ndarray]:
        for _ in range(4):
            yield hashes & mask
            hashes = mix(hashes)

    def places(self, found: np.ndarray) -> np.ndarray:
        """Where hashes lie that are in the filter (and a few that are not)."""
        likely, hashes = np.arange(len(found)), found
        for _ in range(4):
            bit = hashes & self._mask
            hit = (self.words[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) > 0
            likely, hashes = likely[hit], mix(hashes[hit])
        return likely


def _filter_bits(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bit in Filter.bits(batch.column(0).to_numpy().view(np.uint64), np.uint64(64 * words - 1)):
                yield pa.RecordBatch.from_arrays([pa.array((bit >> np.uint64(6)).astype(np.int64)), pa.array((np.uint64(1) << (bit & np.uint64(63))).view(np.int64))], ["word", "bits"])

    return run


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Filter words, sorted, to whole segments."""
    for rows in grouped_batches(batches, ["segment"]):
        own = np.zeros(_SEGMENT, np.int64)
        own[rows["word"].to_numpy() % _SEGMENT] = rows["bits"].to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(rows["segment"].to_numpy()[:1]), pa.array([own.tobytes()], pa.binary())], ["segment", "own"])


def window_filter(windows: DataFrame) -> Filter:
    """The filter of a table's `window` column: put together by segments, which alone reach the driver (the filter's own size)."""
    words = Filter.size(windows.count())
    bits = windows.select("window").mapInArrow(tidy(_filter_bits(words)), "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits"))
    bits = bits.select(F.floor(F.col("word") / _SEGMENT).alias("segment"), "word", "bits").repartition("segment").sortWithinPartitions("segment", "word")
    found = np.zeros(words, np.uint64)
    for row in bits.mapInArrow(tidy(_segments), "segment long, own binary").collect():
        at = row["segment"] * _SEGMENT
        found[at : at + _SEGMENT] = np.frombuffer(row["own"], np.uint64)
    return Filter(found)


def _document_windows(sent, widths: list[int]):
    """Windows of the documents that pass the filter; `sent`: a broadcast of it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        canonical, known = Canonical(), sent.value
        for part, texts in text_slices(batches, limit=1 << 20):
            read, out = Templates(texts, canonical), []
            for width in widths:
                for reading, kinds, places, found in read.windows(width):
                    hit = known.places(found)
                    rows, at = read.row[places[hit]], places[hit]
                    out += [
                        (row, h, width, reading, k - start, read.slots(kinds, k, width))
                        for row, k, start, h in zip(rows.tolist(), at.tolist(), read.starts[rows].tolist(), found[hit].view(np.int64).tolist())
                    ]
            if out:
                row, *rest = zip(*out)
                kinds_ = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), _MATCH]
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), *(pa.array(c, t) for c, t in zip(rest, kinds_))], ["__id", "window", "width", "doc_reading", "at", "doc_slots"])

    return run


def _longest_run(places: Column) -> Column:
    """Length of the longest run of consecutive places."""

    def step(s: Column, p: Column) -> Column:
        run = F.when(p == s["last"] + 1, s["run"] + 1).otherwise(F.lit(1).cast("long"))
        return F.struct(p.alias("last"), run.alias("run"), F.greatest(s["best"], run).alias("best"))

    start = F.struct(*[F.lit(v).cast("long").alias(n) for n, v in (("last", -2), ("run", 0), ("best", 0))])
    return F.aggregate(F.array_sort(F.array_distinct(places)), start, step, lambda s: s["best"])


def _clashing(pairs: Column) -> Column:
    """The values a that stand for more than one b; `pairs`: distinct (a, b)."""
    values = F.transform(pairs, lambda p: p["a"])
    distinct = F.array_distinct(values)
    more = F.filter(distinct, lambda v: F.size(F.filter(values, lambda x: x == v)) > 1)
    return F.when(F.size(distinct) < F.size(values), more).otherwise(F.array().cast("array<string>"))


def own_windows(benchmark: DataFrame, item_col: str = "item_id", item_text_col: str = "text", shared: int = SHARED) -> tuple[DataFrame, DataFrame]:
    """(windows of classes that at most ``shared`` others have, with the class's number of them; class, least item, n_items).

    ``whole`` marks the windows of a class that has none of that kind: all it has, to be matched one and all.
    """
    item_type = benchmark.schema[item_col].dataType.simpleString()
    items = benchmark.where(F.col(item_text_col).isNotNull()).select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text"))
    schema = f"item {item_type}, class binary, template binary, window long, width int, reading int, place long, n_windows long, item_slots array<string>"
    found = materialize(items.mapInArrow(tidy(_item_windows), schema), "item-windows")
    # Every item has one literal window at place 0.
    classes = found.where((F.col("reading") == LITERAL) & (F.col("place") == 0)).groupBy("class", "template").agg(F.min("item").alias("item"), F.count(F.lit(1)).alias("n_items"))
    one = found.groupBy("class", "reading", "place").agg(*[F.first(c).alias(c) for c in ("template", "window", "width", "item_slots")])
    # Templates of many classes: the windows of the class with the least item stand for all.
    many = classes.groupBy("template").agg(F.count(F.lit(1)).alias("n_classes"), F.min("item").alias("item"), F.sum("n_items").alias("n_items"), F.min(F.struct("item", "class"))["class"].alias("class"))
    many = materialize(many.where(F.col("n_classes") > shared).withColumn("of", F.concat(F.lit(b"T"), "template")), "item-templates")
    kept = [F.col(c) for c in ("reading", "place", "window", "width", "item_slots")]
    parts = [
        _own(one.select("class", *kept), one, "class", shared),
        _own(one.join(many.select("class", "of"), "class").select(F.col("of").alias("class"), *kept), one, "template", shared),
    ]
    classes = classes.select("class", "item", "n_items").union(many.select(F.col("of").alias("class"), "item", "n_items"))
    return materialize(parts[0].unionByName(parts[1]), "own-windows"), materialize(classes, "item-classes")


def _own(windows: DataFrame, one: DataFrame, holder: str, shared: int) -> DataFrame:
    """The windows that at most ``shared`` different ``holder`` of `one` have; all windows of classes without such (`whole`)."""
    holders = one.select("window", "width", holder).distinct().groupBy("window", "width").agg(F.count(F.lit(1)).alias("holders"))
    told = windows.join(holders, ["window", "width"]).withColumn("own", F.col("holders") <= shared)
    # A place counts if one of its readings is the item's own.
    counted = told.groupBy("class").agg(F.countDistinct(F.when(F.col("own"), F.col("place"))).alias("n_own"), F.countDistinct("place").alias("n_places"))
    out = told.join(counted, "class").withColumn("whole", F.col("n_own") == 0).where(F.col("own") | F.col("whole"))
    return out.withColumn("n_windows", F.when(F.col("whole"), F.col("n_places")).otherwise(F.col("n_own"))).drop("holders", "own", "n_own", "n_places")


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", coverage: float = COVERAGE, run: int = RUN, shared: int = SHARED) -> DataFrame:
    """Leaks: the id, the least id of the item's class, n_items of it, n_windows (its own), n_matched, coverage, kind (exact, or reparameterised), first_word."""
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    items, classes = own_windows(benchmark, item_col, item_text_col, shared)
    widths = sorted(r["width"] for r in items.select("width").distinct().collect())  # 5 to 8
    sent = spark.sparkContext.broadcast(window_filter(items.select("window")))
    rows = docs.where(F.col(text_col).isNotNull()).select(F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("key")).alias("__id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(tidy(_document_windows(sent, widths)), f"__id struct<id:{id_type},key:bigint>, window long, width int, doc_reading int, at long, doc_slots array<string>")
    # Rows of equal text and id give equal windows; one of each is enough.
    matched = materialize(found.join(items, ["window", "width"]).withColumn("offset", F.col("at") - F.col("place")), "matched-windows")
    pairs = F.arrays_zip(F.col("item_slots").alias("a"), F.col("doc_slots").alias("b")).alias("pairs")
    aligned = matched.groupBy("__id", "class", "offset").agg(F.collect_set(F.struct(F.greatest("reading", "doc_reading").alias("reading"), "place", pairs)).alias("windows"), *[F.first(c).alias(c) for c in ("n_windows", "width", "whole")])
    # Second templates only add: their values are held against all others, those of first templates among themselves.
    pairs_of = lambda kept: F.array_distinct(F.flatten(F.filter("windows", kept)["pairs"]))
    aligned = aligned.withColumns({"clash_1": _clashing(pairs_of(lambda w: w["reading"] == FIRST)), "clash_2": _clashing(pairs_of(lambda w: w["reading"] > LITERAL))})
    free = lambda w, clash: ~F.exists(w["pairs"], lambda p: F.array_contains(F.col(clash), p["a"]))
    fits = lambda w: (w["reading"] == LITERAL) | ((w["reading"] == FIRST) & free(w, "clash_1")) | ((w["reading"] == SECOND) & free(w, "clash_2"))
    aligned = aligned.withColumns({"places": F.array_distinct(F.filter("windows", fits)["place"]), "pairs": pairs_of(lambda w: (w["reading"] == FIRST) | fits(w))}).where(F.size("places") > 0)
    told = aligned.select(
        "__id", "class", "n_windows", (F.when(F.col("whole"), F.col("n_windows") + F.col("width") - 1)).alias("needed"), F.explode("places").alias("place"), (_longest_run(F.col("places")) + F.col("width") - 1).alias("run"),
        (F.array_min("places") + F.col("offset")).alias("at"), F.forall("pairs", lambda p: p["a"] == p["b"]).alias("same"),
    )
    # A document may hold an item many times over: places are counted by two aggregates, not gathered.
    whole = [F.max("n_windows").alias("n_windows"), F.min("at").alias("at"), F.max("run").alias("run"), F.max("needed").alias("needed"), F.min("same").alias("same")]
    total = told.groupBy("__id", "class", "place").agg(*whole).groupBy("__id", "class").agg(F.count(F.lit(1)).alias("n_matched"), *whole).withColumnRenamed("at", "first_word")
    share = F.col("n_matched") / F.col("n_windows")
    leaks = F.when(F.col("needed").isNull(), (share >= coverage) | (F.col("run") >= run)).otherwise(F.col("run") >= F.col("needed"))
    return total.where(leaks).join(classes, "class").select(
        F.col("__id.id").alias(id_col), F.col("item").alias(item_col), "n_items", "n_windows", "n_matched", share.alias("coverage"),
        F.when(F.col("same"), "exact").otherwise("reparameterised").alias("kind"), "first_word",
    ).distinct()


def filter_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """`docs` without the rows whose id has a leak."""
    leaked = materialize(contaminated(docs, benchmark, id_col, text_col, **options).select(F.col(id_col).alias("__leaked")).distinct(), "leaked")
    return docs.join(leaked, docs[id_col].eqNullSafe(leaked["__leaked"]), "left_anti")


def op6_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, n_items, n_windows, n_matched, coverage, kind, first_word of every leak."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
