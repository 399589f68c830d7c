"""Quality rules with robust multivariate outliers (DataFrame operations only).

Each text has counts of words, word characters, symbols, duplicate lines and words in repeated
windows. Base rules reject short texts and texts that repeat themselves. The others are
vectors of transformed counts (``VECTOR``); per language and source
a minimum-covariance-determinant estimate gives their centre and covariance,
and a vector whose Mahalanobis distance is beyond ``CUTOFF`` is rejected.

Equal vectors of a group are one row with its number of documents, so a group of any size is
spread over all tasks by vector, and medians come from counts per value. From three starts (medians and
median deviations; mean and covariance of all rows; medians and the covariance of
spatial signs) C-steps are taken: mean and covariance of the ``SUBSET`` share of rows
nearest to the last estimate, until the determinants stop falling; the start with the least
determinant stays. Vectors are whole numbers on a grid of ``1 / GRID``, so sums are exact and any
order of rows gives the same verdicts. Covariances of the nearest rows are widened by
``CONSISTENT``. As in clean prose most counts are zero, and a spread of nothing would reject any
symbol, variances get a floor: what one count (one word for the word length, one repeated window) makes in a text of the
group's median size, measured per group. Estimates are made for (language, source), for the
language and for all rows; a document is held against the first with at least ``ROWS`` rows.

Defined results: a null or empty text has no words and fails the base rules. A null language or
source is a value of its own. Repeated rows are judged each. Extra columns are ignored.
An empty table gives an empty result.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITESPACE, stage, text_or_empty

SYMBOLS = "#*$%&|<>"
SPLIT = r"[\x20\x09-\x0D]+"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
GRID = 1000
ROWS = 100
SUBSET = 0.75
STEPS = 12
CUTOFF = 40.0
MEDIAN = 3.357  # of chi-squared with four degrees of freedom
VECTOR = ("word_length", "symbols", "dup_lines", "repeats")
SIZES = ("n_words", "word_chars", "n_lines")
CONSISTENT = 2.72  # of the nearest 0.75 of a normal coordinate: 1 over their share of its variance; more coordinates need less


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column) -> Column:
    """Words in windows of ``WINDOW`` words that are found twice or more."""
    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda p, k: F.coalesce(F.least(F.lit(WINDOW), F.get(at, k + 1) - p), F.lit(WINDOW)))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    def again(s: Column) -> Column:
        same = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]))
        return _let(F.sort_array(F.transform(same, lambda x: x["i"])), covered)

    def found(h: Column) -> Column:
        numbered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return (F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long"))
                 .otherwise(_let(numbered, again)))

    windows = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
                          lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(F.size(words) < 2, F.lit(0).cast("long")).when(
        F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(_let(windows, found))


def statistics(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, lang, source, the counts and base_failed."""
    text = text_or_empty()
    words = F.filter(F.split(text, SPLIT), lambda w: w != "")
    counted = _let(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), _repeat_words(w).alias("r")))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, WHITESPACE, "") != "")
    lined = _let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n"),
                                           (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d")))
    s = docs.select("doc_id", "lang", "source", counted.alias("c"), lined.alias("l"),
                    F.length(F.translate(text, WHITESPACE, "")).cast("long").alias("word_chars"),
                    (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"))
    n, r = F.col("c.n"), F.col("c.r")
    return s.select("doc_id", "lang", "source", n.alias("n_words"), "word_chars", "n_symbols",
                    F.col("l.d").alias("n_dup_lines"), r.alias("n_repeat_words"), F.col("l.n").alias("n_lines"),
                    ((n < LEAST_WORDS) | (100 * r > MOST_REPEATED * n)).alias("base_failed"))


def vectors(stats: DataFrame) -> DataFrame:
    """``stats`` with ``VECTOR`` as whole numbers of 1 / GRID."""
    words, chars, lines = (F.greatest(F.col(c), F.lit(1)) for c in ("n_words", "word_chars", "n_lines"))
    values = (F.log(chars / words), F.sqrt(F.col("n_symbols") / chars), F.sqrt(F.col("n_dup_lines") / lines),
              F.sqrt(F.col("n_repeat_words") / words))
    return stats.withColumns({name: F.round(v * GRID).cast("long") for name, v in zip(VECTOR, values)})


def _keys() -> list[Column]:
    """The groups that a row belongs to, narrowest first; JSON keeps nulls apart from any value."""
    return [F.to_json(F.struct("lang", "source", F.lit(2).alias("level"))),
            F.to_json(F.struct("lang", F.lit(1).alias("level"))), F.lit('{"level":0}')]


def _distance(table: DataFrame) -> DataFrame:
    """``table`` with d2, the squared distance under the estimate beside each row (m*, l**)."""
    y: list[Column] = []
    for i, name in enumerate(VECTOR):
        left = reduce(lambda a, j: a - F.col(f"l{i}{j}") * y[j], range(i), F.col(name) - F.col(f"m{i}"))
        table = table.withColumn(f"y{i}", left / F.col(f"l{i}{i}"))
        y.append(F.col(f"y{i}"))
    return table.withColumn("d2", sum((c * c for c in y[1:]), y[0] * y[0])).drop(*[f"y{i}" for i in range(len(y))])


def _factor(estimate: DataFrame) -> DataFrame:
    """Cholesky factor l** and log determinant of covariances c** (lower triangle)."""
    for i in range(len(VECTOR)):
        for j in range(i + 1):
            rest = reduce(lambda a, k: a - F.col(f"l{i}{k}") * F.col(f"l{j}{k}"), range(j), F.col(f"c{i}{j}"))
            estimate = estimate.withColumn(f"l{i}{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}{j}"))
    det = sum((F.log(f"l{i}{i}") for i in range(1, len(VECTOR))), F.log("l00"))
    return estimate.withColumn("log_det", det)


P = range(len(VECTOR))
PAIRS = [(i, j) for i in P for j in range(i + 1)]
OWN = ["n", *[f"{x}{i}" for x in "mf" for i in P]]


def _grouped(rows: DataFrame, cols: list[str]) -> DataFrame:
    """Equal ``cols`` of each group as one row: key, cols and the number w of documents."""
    counted = rows.groupBy("lang", "source", *cols).agg(F.count(F.lit(1)).alias("w"))
    return (counted.select(*cols, "w", F.explode(F.array(*_keys())).alias("key"))
                   .groupBy("key", *cols).agg(F.sum("w").alias("w")))


def _percentiles(rows: DataFrame, by: list[str], values: dict[str, Column], share: float) -> DataFrame:
    """The share-percentile of each value per group, from the counts of its distinct values."""
    cells = rows.select(*by, "w", F.explode(F.array(*[
        F.struct(F.lit(name).alias("what"), v.cast("double").alias("v")) for name, v in values.items()])).alias("c"))
    cells = cells.groupBy(*by, "c.what", "c.v").agg(F.sum("w").alias("w"))
    return cells.groupBy(*by).agg(*[
        F.percentile(F.when(F.col("what") == name, F.col("v")), F.lit(share), F.col("w")).alias(name) for name in values])


def _floors(good: DataFrame) -> DataFrame:
    """Per group the variances f* that one count makes in a text of median size."""
    log = {c: F.round(100 * F.log(F.greatest(F.col(c), F.lit(1)))) for c in SIZES}
    middle = _percentiles(_grouped(good.select("lang", "source", *[v.alias(c) for c, v in log.items()]), list(SIZES)),
                          ["key"], {c: F.col(c) for c in SIZES}, 0.5)
    words, chars, lines = (F.exp(F.col(c) / 100) for c in SIZES)
    one = (1 / (words * words), 1 / chars, 1 / lines, 2 * WINDOW / words)
    return middle.select("key", *[(v * GRID * GRID).alias(f"f{i}") for i, v in enumerate(one)])


def _refit(rows: DataFrame, by: list[str]) -> DataFrame:
    """Mean and widened covariance of ``rows`` per group, factored."""
    exact = lambda c: F.sum(c.cast("decimal(20,0)") * F.col("w").cast("decimal(18,0)")).cast("double")
    sums = rows.groupBy(*by).agg(
        F.sum("w").cast("double").alias("h"), *[exact(F.col(VECTOR[i])).alias(f"a{i}") for i in P],
        *[exact(F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(f"b{i}{j}") for i, j in PAIRS])
    sums = sums.withColumns({f"m{i}": F.col(f"a{i}") / F.col("h") for i in P})
    return _factor(sums.withColumns({
        f"c{i}{j}": CONSISTENT * (F.col(f"b{i}{j}") / F.col("h") - F.col(f"m{i}") * F.col(f"m{j}"))
                    + (F.col(f"f{i}") if i == j else 0.0) for i, j in PAIRS}))


def _signs(rows: DataFrame) -> DataFrame:
    """Per group the medians with the covariance of the rows' directions from them, brought to the median deviations."""
    z = [(F.col(v) - F.col(f"m{i}")) / F.col(f"s{i}") for i, v in enumerate(VECTOR)]
    length = F.sqrt(sum((x * x for x in z[1:]), z[0] * z[0]))
    u = [F.when(length > 0, F.round(GRID * x / length)).otherwise(F.lit(0)).cast("long") for x in z]
    rows = rows.withColumns({f"u{i}": x for i, x in enumerate(u)})
    sums = rows.groupBy("key", *OWN, *[f"s{i}" for i in P]).agg(*[
        F.sum(F.col(f"u{i}") * F.col(f"u{j}") * F.col("w").cast("decimal(18,0)")).cast("double").alias(f"b{i}{j}") for i, j in PAIRS])
    return _factor(sums.withColumns({
        f"c{i}{j}": len(VECTOR) * F.col(f"s{i}") * F.col(f"s{j}") * F.col(f"b{i}{j}") / (F.lit(float(GRID * GRID)) * F.col("n"))
                    + (F.col(f"f{i}") if i == j else 0.0) for i, j in PAIRS}))


def _starts(rows: DataFrame, floors: DataFrame) -> DataFrame:
    """Three estimates per group, numbered by start."""
    n = rows.groupBy("key").agg(F.sum("w").alias("n"))
    centre = _percentiles(rows, ["key"], {f"m{i}": F.col(v) for i, v in enumerate(VECTOR)}, 0.5)
    centre = stage(n.join(centre, "key").join(floors, "key"), "op10-medians")
    near = rows.join(centre, "key")
    spread = _percentiles(near, ["key"], {f"s{i}": F.abs(F.col(v) - F.col(f"m{i}")) for i, v in enumerate(VECTOR)}, 0.5)
    spread = centre.join(spread, "key").withColumns({
        f"s{i}": F.sqrt(F.pow(1.4826 * F.col(f"s{i}"), F.lit(2)) + F.col(f"f{i}")) for i in P})
    spread = stage(spread, "op10-spread")
    medians = _factor(spread.withColumns({
        f"c{i}{j}": F.col(f"s{i}") * F.col(f"s{i}") if i == j else F.lit(0.0) for i, j in PAIRS}))
    classic = _refit(near, ["key", "n", *[f"f{i}" for i in P]])
    starts = [medians, classic, _signs(rows.join(spread, "key"))]
    return reduce(DataFrame.union, [e.select("key", F.lit(k).alias("start"), *_estimate()) for k, e in enumerate(starts)])


def _estimate() -> list[str]:
    return [*OWN, *[f"l{i}{j}" for i, j in PAIRS], "log_det"]


def _nearest(rows: DataFrame, estimate: DataFrame, share: float) -> tuple[DataFrame, DataFrame]:
    """Rows with their distance on a logarithmic grid, and per estimate the grid value that holds the share nearest."""
    near = _distance(rows.join(estimate, "key")).withColumn("g", F.round(100 * F.log(F.col("d2") + 1e-4)).cast("long"))
    bound = _percentiles(near, ["key", "start"], {"bound": F.col("g")}, share)
    return near, stage(bound, "op10-bounds")  # as a table its size is known, so rows need no shuffle to meet it


def estimates(stats: DataFrame) -> DataFrame:
    """One row per group: key, n, centre m*, floor f*, Cholesky factor l**, start, log_det and scale."""
    good = stats.where(~F.col("base_failed"))
    rows = stage(_grouped(good, list(VECTOR)), "op10-vectors")
    estimate, before = stage(_starts(rows, _floors(good)), "op10-start"), None
    for _ in range(STEPS):
        near, bound = _nearest(rows, estimate, SUBSET)
        inner = near.join(bound, ["key", "start"]).where(F.col("g") <= F.ceil("bound"))
        fitted = _refit(inner, ["key", "start", "n", *[f"f{i}" for i in P]])
        estimate = stage(fitted.select("key", "start", *_estimate()), "op10-step")
        now = estimate.agg(F.round(F.sum("log_det"), 6)).first()[0]
        if now == before:
            break
        before = now
    best = estimate.groupBy("key").agg(F.min(F.struct(
        F.round("log_det", 6).alias("rounded"), "start", *_estimate())).alias("b")).select("key", "b.start", *[f"b.{c}" for c in _estimate()])
    best = stage(best, "op10-best")
    _, middle = _nearest(rows, best, 0.5)
    scale = F.greatest(F.lit(1.0), F.exp(F.col("bound") / 100) / MEDIAN)
    return stage(best.join(middle, ["key", "start"]).withColumn("scale", scale), "op10-estimates")


def judged(docs: DataFrame) -> DataFrame:
    """One row per document: the counts, base_failed, distance (squared) and kept."""
    stats = stage(vectors(statistics(docs)), "op10-statistics")
    found = estimates(stats)
    cols = [f"m{i}" for i in P] + [f"l{i}{j}" for i, j in PAIRS] + ["scale"]
    enough = found.where((F.col("n") >= ROWS) | (F.col("key") == '{"level":0}')).select("key", F.struct(*cols).alias("e"))
    out, tried = stats, []
    for level, key in enumerate(_keys()):
        own = enough.select(F.col("key").alias(f"k{level}"), F.col("e").alias(f"e{level}"))
        out = out.withColumn(f"k{level}", key).join(own, f"k{level}", "left")
        tried.append(F.col(f"e{level}"))
    out = out.withColumn("e", F.coalesce(*tried)).select(*stats.columns, "e.*")
    far = F.col("d2") / F.col("scale") > CUTOFF
    return _distance(out).withColumn("distance", F.col("d2") / F.col("scale")).withColumn(
        "kept", ~F.col("base_failed") & ~F.coalesce(far, F.lit(False)))
