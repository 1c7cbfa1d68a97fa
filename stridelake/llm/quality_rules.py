"""Quality rules: base rules, then robust multivariate outliers.

Each text gives a vector of transformed statistics.  Every language and source has a
minimum-covariance-determinant estimate of its own, over all its documents that pass
the base rules: of all subsets of 75 % of them, the one whose covariance has the
least determinant.  The search takes several starts: medians and deviations,
classical moments, two bounded transforms, the documents on either side of each
median, and the best subsets found from `ELEMENTAL` random handfuls in a sample of up
to `SAMPLE` vectors (small groups whole; a sample only tells where to start).  A C-step
keeps the 75 % of least Mahalanobis distance under a start's estimate and takes their
mean and covariance, which never raises the determinant.  After two steps over all
documents the best starts of a group go on until no step lowers theirs, and the least
determinant wins.

A small group says little, so its estimate is mixed with its language's (the kept
documents of all its sources) as if it had `PRIOR` more documents of that kind, and a
language's with that of all; the weight goes with the group's size, without a switch.
A document goes if its distance under the mixed estimate exceeds the quantile of the
chi-square law that one in `1 / TAIL` documents would exceed, were the statistics normal.

Statistics are rounded to thousandths, so all sums are exact integers and the
result does not depend on partitions.  A C-step of all starts is one aggregate: sums
per group, start and distance bin (map-side combined, so a group with a third of all
rows arrives as some thousand rows), then a running count over the bins finds the
subset; of the bin on its border the fitting part counts.  Estimates stay in a table
of a few rows a group.

Variances have a floor (most texts have no symbols or repeats at all, and a floor
in the statistic's own units keeps a text with a few of them); it is part of the
determinant that is compared, for which C-steps hold as well.

Defined results: null text has no words and fails the base rules; a null language
or source is a value of its own; an empty table gives no rows; equal rows get
equal verdicts; columns whose names clash with the operator's own pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stridelake.llm.base import WordHashes, from_row, materialize, table, text_slices, tidy, whole_row, window_hashes

# Fixed values of the base rules.
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = b"#*$%&|<>"

#: name, floor of the standard deviation (in the statistic's units)
FEATURES = (
    ("x_length", 0.9),  # ln(1 + words)
    ("x_word", 0.25),  # ln of the mean word length
    ("x_symbols", 0.04),  # sqrt of symbols per character of words
    ("x_lines", 0.12),  # sqrt of repeated lines per line with a word
    ("x_repeats", 0.09),  # sqrt of repeated words per word
)
SCALE = 1000
#: The part of a group that an estimate keeps; C-steps of all starts; starts that go on; C-steps at most; least fall of the log determinant.
KEEP_PERCENT, FIRST_STEPS, GO_ON, STEPS, FALL = 75, 2, 3, 60, 1e-6
#: Vectors of a group that starts are tried on, random handfuls there, the best subsets that become starts.
SAMPLE, ELEMENTAL, SAMPLED = 400, 80, 3
#: Documents of its language that a group's estimate is mixed with.
PRIOR = 50
#: Normal documents that the cutoff would reject: far out, since a clean document lost costs more than junk kept.
TAIL = 1e-9
#: Bins of a unit of the logarithm of squared distances.
_BINS = 1000



def chi_square(x: float, degrees: int) -> float:
    """P(a chi-square variable <= x), by the series of the incomplete gamma function."""
    a, x = degrees / 2, x / 2
    term = total = 1 / a
    n = a
    while term > total * 1e-17:
        n += 1
        term *= x / n
        total += term
    return total * math.exp(a * math.log(x) - x - math.lgamma(a)) if x > 0 else 0.0


def chi_square_quantile(p: float, degrees: int) -> float:
    low, high = 0.0, 1_000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, degrees) < p else (low, middle)
    return high


#: A subset of the nearest 75 % has too small a covariance; the factor that makes it right for normal statistics.
CONSISTENCY = KEEP_PERCENT / 100 / chi_square(chi_square_quantile(KEEP_PERCENT / 100, len(FEATURES)), len(FEATURES) + 2)
CUTOFF = math.sqrt(chi_square_quantile(1 - TAIL, len(FEATURES)))

_STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")


def text_statistics(text: bytes, hashes: WordHashes) -> tuple[int, int, int, int, int, int]:
    """Words, code points in them, symbols, lines equal to an earlier one, words in repeated 5-word windows, lines with a word."""
    words = text.split()
    n = len(words)
    joined = np.frombuffer(b"".join(words), np.uint8)
    symbols = sum(text.count(s) for s in (SYMBOLS[i : i + 1] for i in range(len(SYMBOLS))))
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeats = 0
    windows = window_hashes(hashes.of(words), 5)
    if len(windows) > 1:
        order = np.argsort(windows, kind="stable")
        same = windows[order[1:]] == windows[order[:-1]]
        if same.any():
            covered = np.zeros(n + 1, np.int64)
            at = order[np.r_[False, same] | np.r_[same, False]]
            np.add.at(covered, at, 1)
            np.add.at(covered, at + 5, -1)
            repeats = int((np.cumsum(covered[:-1]) > 0).sum())
    return n, int(((joined & 0xC0) != 0x80).sum()), symbols, len(lines) - len(set(lines)), repeats, len(lines)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with their statistics; the columns that come in pass through."""
    hashes = WordHashes()
    for part, texts in text_slices(batches, "__text"):
        found = list(zip(*(text_statistics(t or b"", hashes) for t in texts)))
        kept = [i for i, c in enumerate(part.schema.names) if c != "__text"]
        yield pa.RecordBatch.from_arrays(
            [*(part.column(i) for i in kept), *(pa.array(c, pa.int64()) for c in found)], [*(part.schema.names[i] for i in kept), *_STATS]
        )


def measure(rows: DataFrame) -> DataFrame:
    """`rows` (with `__text`) with the statistics, base_failed and the rounded vector instead of the text."""
    kept = [f for f in rows.schema.fields if f.name != "__text"]
    schema = T.StructType([*kept, *(T.StructField(x, T.LongType()) for x in _STATS)])
    n, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    share = lambda a, b: F.sqrt(F.col(a) / F.greatest(F.col(b), F.lit(1)))
    vector = {
        "x_length": F.log1p(F.col("n_words").cast("double")),
        "x_word": F.log(chars / n),
        "x_symbols": F.sqrt(F.col("n_symbols") / chars),
        "x_lines": share("n_dup_lines", "n_lines"),
        "x_repeats": share("n_repeat_words", "n_words"),
    }
    out = rows.mapInArrow(tidy(_measured), schema).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    )
    return out.withColumns({k: F.round(v * SCALE).cast("long") for k, v in vector.items()})


def _group(df: DataFrame, sizes: DataFrame) -> DataFrame:
    """Adds `__group`, the id of the row's group (null: none of its documents passes the base rules)."""
    return df.alias("d").join(sizes.alias("s"), F.expr("d.__lang <=> s.lang AND d.__source <=> s.source"), "left").select("d.*", F.col("s.group").alias("__group"))


def _distance() -> F.Column:
    """Squared Mahalanobis distance under the joined `mean` and `inverse` (row by row) of the group."""
    d = len(FEATURES)
    diff = [F.col(x) / SCALE - F.element_at("mean", i + 1) for i, (x, _) in enumerate(FEATURES)]
    terms = [diff[i] * diff[j] * F.element_at("inverse", i * d + j + 1) * (1 if i == j else 2) for i in range(d) for j in range(i, d)]
    return sum(terms[1:], terms[0])


_D = len(FEATURES)
_NAMES = [x for x, _ in FEATURES]
_FLOORS = np.diag([f * f for _, f in FEATURES])
_PAIRS = [(i, j) for i in range(_D) for j in range(i, _D)]
#: Unit of the bounded transforms.
_UNIT = 1000

#: Starts: medians and deviations; all documents; tanh of standardised statistics; their directions; then the documents at
#: or above, and at or below, each median.
DIAGONAL, CLASSICAL, TANH, SIGN = range(4)
_HALVES, _TRIED = 4, 4 + 2 * _D


def _moments(n: float, sums, products) -> tuple[np.ndarray, np.ndarray]:
    """Mean and covariance in the statistics' units, from sums in thousandths."""
    mean = np.array([float(x) for x in sums]) / float(n) / SCALE
    cov = np.zeros((_D, _D))
    cov[np.triu_indices(_D)] = [float(x) / float(n) / SCALE**2 for x in products]
    return mean, cov + np.triu(cov, 1).T - np.outer(mean, mean)


def _settled(mean: np.ndarray, cov: np.ndarray) -> tuple[list[float], list[float], float]:
    """Mean, inverse, log determinant; the covariance is corrected and has its floors."""
    whole = cov * CONSISTENCY + _FLOORS
    return mean.tolist(), np.linalg.inv(whole).ravel().tolist(), float(np.linalg.slogdet(whole)[1])


_ESTIMATE = "__group long, start int, n double, sums array<double>, products array<double>, mean array<double>, inverse array<double>, fall double, determinant double"


def _estimates(sums: DataFrame) -> DataFrame:
    """Estimates from sums over subsets; `before`: the log determinant of the step before (null at first)."""

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for group, start, n, s, p, before in zip(*(frame[c] for c in ("__group", "start", "n", "sums", "products", "before"))):
                mean, inverse, determinant = _settled(*_moments(n, s, p))
                fall = np.inf if before is None or np.isnan(before) else before - determinant
                out.append((group, start, n, list(s), list(p), mean, inverse, fall, determinant))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _ESTIMATE.split(", ")])

    return sums.mapInPandas(solve, _ESTIMATE)


def _middles(rows: DataFrame) -> DataFrame:
    """`median` and `mad` (arrays) of each group: exact, from counts of values."""
    values = rows.select("__group", F.posexplode(F.array(*[F.col(x) for x in _NAMES])).alias("axis", "value"))

    def median(counts: DataFrame) -> DataFrame:
        w = Window.partitionBy("__group", "axis")
        upto = F.sum("n").over(w.orderBy("value"))
        placed = counts.withColumns({"upto": upto, "all": F.sum("n").over(w)})
        return placed.where("2 * upto >= all").groupBy("__group", "axis").agg(F.min("value").alias("median"))

    counts = values.groupBy("__group", "axis", "value").agg(F.count(F.lit(1)).alias("n"))
    counts = materialize(counts, "value-counts")
    middle = median(counts)
    away = counts.join(middle, ["__group", "axis"]).groupBy("__group", "axis", F.abs(F.col("value") - F.col("median")).alias("value")).agg(F.sum("n").alias("n"))
    spread = median(away).withColumnRenamed("median", "mad")
    found = middle.join(spread, ["__group", "axis"]).groupBy("__group").agg(F.sort_array(F.collect_list(F.struct("axis", "median", "mad"))).alias("a"))
    return found.select("__group", F.col("a.median").alias("median"), F.col("a.mad").alias("mad"))


def _first(rows: DataFrame) -> DataFrame:
    """The first estimate of every start: one pass over the rows, in which a row stands once in each start that takes it."""
    middles = materialize(_middles(rows), "medians")
    x = [F.col(c) for c in _NAMES]
    away = [x[i] - F.col("median")[i] for i in range(_D)]
    z = [away[i] / (F.col("mad")[i] * 1.4826 + F.lit(FEATURES[i][1] * SCALE)) for i in range(_D)]
    length = F.sqrt(sum((v * v for v in z[1:]), z[0] * z[0]))
    bounded = lambda v: F.round(v * _UNIT).cast("long")

    def taken(start: int, values: list, when=None):
        row = F.struct(F.lit(start).alias("start"), *[v.cast("long").alias(c) for v, c in zip(values, _NAMES)])
        return row if when is None else F.when(when, row)

    parts = [taken(CLASSICAL, x), taken(TANH, [bounded(F.tanh(v)) for v in z]), taken(SIGN, [bounded(F.when(length > 0, v / length).otherwise(0.0)) for v in z])]
    for i in range(_D):
        parts += [taken(_HALVES + 2 * i, x, away[i] >= 0), taken(_HALVES + 2 * i + 1, x, away[i] <= 0)]
    dealt = rows.join(middles, "__group").select("__group", F.explode(F.filter(F.array(*parts), lambda r: r.isNotNull())).alias("r")).select("__group", "r.*")
    sums = dealt.groupBy("__group", "start").agg(F.count(F.lit(1)).alias("n"), *_sums())
    sums = sums.join(middles, "__group").select("__group", "start", F.col("n").cast("double").alias("n"), *_as_arrays(), "median", "mad")

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for group, start, n, s, p, median, mad in zip(*(frame[c] for c in ("__group", "start", "n", "sums", "products", "median", "mad"))):
                middle = np.array(median, float) / SCALE
                wide = np.array(mad, float) * 1.4826 / SCALE + [f for _, f in FEATURES]
                mean, cov = _moments(n, s, p)
                if start in (TANH, SIGN):  # the transforms' shape, in the statistics' units; 2.5: tanh of a normal variable varies by 0.4
                    cov = np.outer(wide, wide) * cov * (2.5 if start == TANH else _D)
                    mean = middle + wide * mean if start == TANH else middle
                out.append((group, start, n, list(s), list(p), *_settled(mean, cov)[:2], np.inf, np.nan))
                if start == CLASSICAL:
                    out.append((group, DIAGONAL, n, list(s), list(p), *_settled(middle, np.diag((wide - [f for _, f in FEATURES]) ** 2))[:2], np.inf, np.nan))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _ESTIMATE.split(", ")])

    return sums.mapInPandas(solve, _ESTIMATE).union(_tried(rows))


def tried_starts(x: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(mean, covariance) of the best subsets of x (units of the statistics) that random handfuls lead to."""
    keep, out = -(-len(x) * KEEP_PERCENT // 100), {}

    def nearest(subset: np.ndarray) -> np.ndarray:
        away = x - x[subset].mean(axis=0)
        inverse = np.linalg.inv(np.cov(x[subset].T, bias=True).reshape(_D, _D) * CONSISTENCY + _FLOORS)
        return np.sort(np.argsort(np.einsum("ij,jk,ik->i", away, inverse, away), kind="stable")[:keep])

    def determinant(subset: np.ndarray) -> float:
        return float(np.linalg.slogdet(np.cov(x[subset].T, bias=True).reshape(_D, _D) * CONSISTENCY + _FLOORS)[1])

    rng = np.random.default_rng(len(x))
    for _ in range(ELEMENTAL):
        subset = rng.choice(len(x), min(len(x), _D + 1), replace=False)
        for _ in range(FIRST_STEPS + 1):
            subset = nearest(subset)
        out[subset.tobytes()] = (determinant(subset), subset)
    settled = {}
    for _, subset in sorted(out.values(), key=lambda v: v[0])[: 4 * SAMPLED]:
        while (after := nearest(subset)).tobytes() != subset.tobytes() and determinant(after) < determinant(subset) - FALL:
            subset = after
        settled[subset.tobytes()] = (determinant(subset), subset)
    best = sorted(settled.values(), key=lambda v: v[0])[:SAMPLED]
    return [(x[subset].mean(axis=0), np.cov(x[subset].T, bias=True).reshape(_D, _D)) for _, subset in best]


def _tried(rows: DataFrame) -> DataFrame:
    """Starts from a sample of each group: the distinct vectors of least hash.  The share that may be among them is known from the group's size, so no group is sorted whole."""
    chance = F.abs(F.xxhash64(*_NAMES) / F.lit(float(2**63)))
    sizes = rows.groupBy("__group").agg(F.count(F.lit(1)).alias("n"))
    some = rows.withColumn("chance", chance).join(sizes, "__group").where(F.col("chance") * F.col("n") <= 4 * SAMPLE)
    first = Window.partitionBy("__group").orderBy("chance", *_NAMES)
    some = some.select("__group", "chance", *_NAMES).distinct().withColumn("k", F.row_number().over(first)).where(F.col("k") <= SAMPLE)
    vectors = some.groupBy("__group").agg(F.sort_array(F.collect_list(F.struct("k", F.array(*_NAMES).alias("x"))))["x"].alias("x"))

    def solve(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for group, x in zip(frame["__group"], frame["x"]):
                for k, (mean, cov) in enumerate(tried_starts(np.array([list(v) for v in x], float) / SCALE)):
                    out.append((group, _TRIED + k, 0.0, [], [], *_settled(mean, cov)[:2], np.inf, np.nan))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in _ESTIMATE.split(", ")])

    return vectors.mapInPandas(solve, _ESTIMATE)


def _sums() -> list:
    return [F.sum(c).alias(c) for c in _NAMES] + [F.sum(F.col(_NAMES[i]) * F.col(_NAMES[j])).alias(f"p{i}_{j}") for i, j in _PAIRS]


def _as_arrays() -> list:
    return [F.array(*[F.col(c).cast("double") for c in names]).alias(a) for a, names in (("sums", _NAMES), ("products", [f"p{i}_{j}" for i, j in _PAIRS]))]


def _step(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """A C-step of every estimate: whole-number sums over the nearest part of its group, and the determinant `before`."""
    near = rows.join(estimates.select("__group", "start", "mean", "inverse"), "__group").withColumn("bin", F.floor(F.log1p(_distance()) * _BINS))
    bins = near.groupBy("__group", "start", "bin").agg(F.count(F.lit(1)).alias("n"), *_sums())
    w = Window.partitionBy("__group", "start")
    before = F.coalesce(F.sum("n").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bins = bins.withColumns({"before": before, "all": F.sum("n").over(w)}).withColumn("wanted", F.ceil(F.col("all") * KEEP_PERCENT / F.lit(100)))
    bins = bins.where(F.col("before") < F.col("wanted")).withColumn("part", F.least(F.lit(1.0), (F.col("wanted") - F.col("before")) / F.col("n")))
    fields = [*_NAMES, *[f"p{i}_{j}" for i, j in _PAIRS]]
    total = bins.groupBy("__group", "start").agg(
        F.max("wanted").cast("double").alias("n"), *[F.sum(F.round(F.col(c) * F.col("part")).cast("decimal(28,0)")).alias(c) for c in fields]
    )
    told = estimates.select("__group", "start", F.col("determinant").alias("before"))
    return total.select("__group", "start", "n", *_as_arrays()).join(told, ["__group", "start"])


def minimum_determinants(rows: DataFrame) -> DataFrame:
    """The best estimate found for each `__group` of rows of vectors."""
    estimates = materialize(_first(rows), "estimates")
    for _ in range(FIRST_STEPS):
        estimates = materialize(_estimates(_step(rows, estimates)), "estimates")
    # Starts that have met count once; the others' order does not depend on partitions.
    distinct = estimates.withColumn("__same", F.round("determinant", 6)).withColumn("__n", F.row_number().over(Window.partitionBy("__group", "__same").orderBy("start")))
    order = Window.partitionBy("__group").orderBy("determinant", "start")
    going = distinct.where("__n = 1").withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= GO_ON).drop("__same", "__n")
    going = materialize(going.withColumn("fall", F.lit(float("inf"))), "estimates")
    done = []
    for _ in range(STEPS):
        after = materialize(_estimates(_step(rows, going)), "estimates")
        done.append(after.where(F.col("fall") <= FALL))
        going = after.where(F.col("fall") > FALL)
        if not going.take(1):
            break
    else:
        done.append(going)
    for more in done[1:]:
        done[0] = done[0].union(more)
    return done[0].withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def _mixed(own: DataFrame, n, sums, products) -> DataFrame:
    """`own` (with n, sums, products) with PRIOR documents of a wider group's kind, given by these columns, mixed in."""
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y * PRIOR / n).alias(a)
    others = [F.col(c) for c in own.columns if c not in ("n", "sums", "products")]
    return own.select(*others, (F.col("n") + PRIOR).alias("n"), add("sums", sums), add("products", products))


def _pooled(best: DataFrame, key: list[str]) -> DataFrame:
    """n, sums and products of the kept documents of all groups with one key; whole numbers, so their order does not matter."""
    whole = lambda c, i: F.sum(F.element_at(c, i + 1).cast("decimal(32,0)")).cast("double")
    return best.groupBy(*key).agg(
        F.sum(F.col("n").cast("decimal(32,0)")).cast("double").alias("n"),
        F.array(*[whole("sums", i) for i in range(_D)]).alias("sums"), F.array(*[whole("products", i) for i in range(len(_PAIRS))]).alias("products"),
    )


def fit(measured: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(group of each language and source, estimate of each group) for measured rows with `__lang`, `__source`."""
    passed = measured.where("NOT base_failed")
    sizes = passed.select(F.col("__lang").alias("lang"), F.col("__source").alias("source")).distinct()
    groups = materialize(sizes.withColumn("group", F.monotonically_increasing_id()), "groups")
    rows = materialize(_group(passed, groups).select("__group", *_NAMES), "vectors")
    best = minimum_determinants(rows).select("__group", "n", "sums", "products")
    best = materialize(best.join(groups.select(F.col("group").alias("__group"), "lang"), "__group"), "best-estimates")
    languages = _pooled(best, ["lang"])
    for every in _pooled(best, []).where("n > 0").collect():  # one row, or none if no document passes
        languages = _mixed(languages, F.lit(every["n"]), *[F.array(*map(F.lit, every[c])) for c in ("sums", "products")])
    wide = languages.select("lang", *[F.col(c).alias(f"__{c}") for c in ("n", "sums", "products")])
    both = best.alias("b").join(wide.alias("w"), F.expr("b.lang <=> w.lang")).select("b.*", "__n", "__sums", "__products")
    mixed = _mixed(both, F.col("__n"), F.col("__sums"), F.col("__products"))
    mixed = mixed.select("__group", F.lit(0).alias("start"), "n", "sums", "products", F.lit(None).cast("double").alias("before"))
    return groups, materialize(_estimates(mixed).select("__group", "mean", "inverse"), "estimates")


def judge(measured: DataFrame, groups: DataFrame, estimates: DataFrame) -> DataFrame:
    """`measured` with `distance` (null without an estimate) and `kept`."""
    scored = _group(measured, groups).join(estimates, "__group", "left").withColumn("distance", F.sqrt(_distance()))
    return scored.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance") <= CUTOFF, F.lit(True))).drop("mean", "inverse", "__group")


def _keyed(docs: DataFrame, text_col: str, lang_col: str, source_col: str, *more) -> DataFrame:
    return docs.select(*more, F.col(lang_col).alias("__lang"), F.col(source_col).alias("__source"), F.col(text_col).alias("__text"))


def filter_documents(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """`docs` without the rejected rows, the columns as they are.

    The estimates come from a narrow table of statistics; the texts are then
    measured again where they are, so no text is exchanged.
    """
    fields = [c for c, _ in FEATURES]
    narrow = materialize(measure(_keyed(docs, text_col, lang_col, source_col)).select("__lang", "__source", "base_failed", *fields), "statistics")
    groups, estimates = fit(narrow)
    whole = _keyed(docs, text_col, lang_col, source_col, whole_row(docs))
    kept = judge(measure(whole), groups, estimates).where("kept")
    return kept.select(*from_row(docs.columns))


def op9_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, the base statistics, base_failed, kept and distance of every document."""
    docs = table(spark, sf_dir, "documents")
    measured = materialize(measure(_keyed(docs, "text", "lang", "source", "doc_id")), "statistics")
    judged = judge(measured, *fit(measured))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance")
