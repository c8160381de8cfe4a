"""Quality rules: base limits on word statistics, then robust multivariate outliers per language and source.

The statistics of a text become a vector of logarithms. In every group (language
and source) the centre and scatter are minimum-covariance-determinant estimates:
from a start of medians and absolute deviations, the three quarters of the rows
nearest to the current estimate give the next one, a fixed number of times; then
the estimate is made once more from all rows that are no outliers to it. Rows beyond a far quantile of
the Mahalanobis distance are rejected. Sums per group are pre-aggregated, so a
group of any size is no burden, and all of it is SQL functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postings.sources.warehouse import stored

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Groups with fewer rows are pooled by language, and then over languages.
MIN_GROUP = 60
NO_GROUP = "none"
SUBSET = 0.75
STEPS = 3
REWEIGHT_AT = 0.975
#: The chance that a row of a Gaussian group lies beyond the cutoff.
REJECT_CHANCE = 1e-9
#: The statistics and the least standard deviation assumed for each.
FLOORS = {"x_words": 0.5, "x_length": 0.1, "x_symbols": 0.5, "x_lines": 0.7, "x_repeats": 0.5}
BROADCAST_ROWS = 10_000

SPACES = " \t\n\x0b\x0c\r"
_SPACE = r"[\x20\x09-\x0D]+"
_WORD = r"[^\x20\x09-\x0D]"
MARKS = "#*$%&|<>"


def statistics(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words; NULL text counts as empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(_WORD))
    d = docs.withColumns({
        "_words": F.filter(F.split(t, _SPACE), lambda x: x != ""),
        "_lines": lines,
        "word_chars": F.length(F.translate(t, SPACES, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, MARKS, ""))).cast("long"),
    })
    d = d.withColumns({
        "n_words": F.size("_words").cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_windows": F.expr("if(size(_words) > 2, transform(sequence(0, size(_words) - 3), i -> xxhash64(_words[i], _words[i + 1], _words[i + 2])), array())"),
    })
    # Most texts repeat no window; only the others are sorted.
    d = d.withColumn("_sorted", F.expr(
        "if(size(array_distinct(_windows)) < size(_windows), array_sort(transform(_windows, (h, i) -> struct(h, i))), array())"))
    d = d.withColumn("_places", F.expr(
        "array_sort(transform(filter(_sorted, (x, k) -> (k > 0 and _sorted[k - 1].h = x.h) or (k < size(_sorted) - 1 and _sorted[k + 1].h = x.h)), x -> x.i))"))
    covered = F.expr("aggregate(_places, struct(0L as n, -3 as last), (s, p) -> struct(s.n + least(3, p - s.last), p), s -> s.n)")
    return d.withColumn("n_repeat_words", covered).drop("_words", "_lines", "_windows", "_sorted", "_places")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def vector() -> dict[str, Column]:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return {
        "x_words": F.log(words),
        "x_length": F.log(F.greatest(F.col("word_chars"), F.lit(1)) / words),
        "x_symbols": F.log1p(1000 * F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
        "x_lines": F.log1p(F.col("n_dup_lines").cast("double")),
        "x_repeats": F.log1p(100 * F.col("n_repeat_words") / words),
    }


def chi2(x: float, k: int) -> float:
    """The chance that a chi-square variable of k degrees is at most x, by the series of the incomplete gamma function."""
    if x <= 0:
        return 0.0
    a, h = k / 2, x / 2
    term = total = math.exp(a * math.log(h) - h - math.lgamma(a + 1))
    n = a
    while term > total * 1e-17:
        n += 1
        term *= h / n
        total += term
    return min(total, 1.0)


def chi2_beyond(chance: float, k: int) -> float:
    """The value exceeded with the given chance."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - chi2(mid, k) > chance else (low, mid)
    return high


def _grouped(rows: DataFrame) -> DataFrame:
    """``rows`` with a group: language and source, or pooled rows where those are few."""
    one, two = F.to_json(F.struct("lang", "source")), F.to_json(F.struct("lang"))
    d = rows.withColumns({"_one": one, "_two": F.concat(F.lit("pooled "), two)})
    usable = ~base_failed()

    def name(d: DataFrame, key: str, other: Column) -> DataFrame:
        counts = d.where(usable).groupBy(key).agg(F.count("*").alias("_n"))
        return _attach(d, counts, key).withColumn(key, F.when(F.coalesce("_n", F.lit(0)) >= MIN_GROUP, F.col(key)).otherwise(other)).drop("_n")

    for other in (F.col("_two"), F.lit("pooled"), F.lit(NO_GROUP)):
        d = name(d, "_one", other)
    return d.withColumnRenamed("_one", "group").drop("_two")


def _attach(d: DataFrame, small: DataFrame, key: str) -> DataFrame:
    """Left join to one row per group: broadcast when the groups are few, and they are counted for that."""
    small = stored(small)
    few = small.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    return d.join(F.broadcast(small) if few else small, key, "left")


def _distance(names: list[str]) -> Column:
    """Squared Mahalanobis distance by forward substitution with the group's triangular factor."""
    steps: list[Column] = []
    for i, x in enumerate(names):
        rest = F.col(x) - F.col(f"m_{i}")
        for j in range(i):
            rest = rest - F.col(f"l_{i}_{j}") * F.col(f"y_{j}")
        steps.append((rest / F.col(f"l_{i}_{i}")).alias(f"y_{i}"))
    return steps


def with_distance(d: DataFrame, estimates: DataFrame, names: list[str]) -> DataFrame:
    """``d`` with column d2; NULL where the group has no estimate."""
    kept = d.columns
    d = _attach(d, estimates, "group")
    for i, step in enumerate(_distance(names)):
        d = d.withColumn(f"y_{i}", step)
    return d.select(*kept, sum((F.col(f"y_{i}") * F.col(f"y_{i}") for i in range(1, len(names))), F.col("y_0") * F.col("y_0")).alias("d2"))


def _estimates(d: DataFrame, names: list[str], scale: float) -> DataFrame:
    """Centre and triangular factor of the scatter of each group of ``d``; variances have a floor, so the factor exists."""
    sums = {f"s_{i}": F.sum(x) for i, x in enumerate(names)}
    sums |= {f"q_{i}_{j}": F.sum(F.col(names[i]) * F.col(names[j])) for i in range(len(names)) for j in range(i + 1)}
    g = d.groupBy("group").agg(F.count("*").alias("n"), *[c.alias(k) for k, c in sums.items()])
    g = g.withColumns({f"m_{i}": F.col(f"s_{i}") / F.col("n") for i in range(len(names))})
    cov = {}
    for i in range(len(names)):
        for j in range(i + 1):
            c = (F.col(f"q_{i}_{j}") / F.col("n") - F.col(f"m_{i}") * F.col(f"m_{j}")) * scale
            cov[f"c_{i}_{j}"] = F.greatest(c, F.lit(0.0)) + F.lit(FLOORS[names[i]] ** 2) if i == j else c
    g = g.withColumns(cov)
    for i in range(len(names)):
        for j in range(i + 1):
            c = F.col(f"c_{i}_{j}")
            for k in range(j):
                c = c - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
            g = g.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(c, F.lit(1e-6))) if i == j else c / F.col(f"l_{j}_{j}"))
    return g.select("group", *[f"m_{i}" for i in range(len(names))], *[f"l_{i}_{j}" for i in range(len(names)) for j in range(i + 1)])


def _start(d: DataFrame, names: list[str]) -> DataFrame:
    """Medians, and absolute deviations as a diagonal factor."""
    middle = d.groupBy("group").agg(*[F.percentile_approx(x, 0.5, 10_000).alias(f"m_{i}") for i, x in enumerate(names)])
    far = _attach(d, middle, "group").groupBy("group").agg(
        *[F.percentile_approx(F.abs(F.col(x) - F.col(f"m_{i}")), 0.5, 10_000).alias(f"a_{i}") for i, x in enumerate(names)],
        *[F.first(f"m_{i}").alias(f"m_{i}") for i in range(len(names))])
    spread = {f"l_{i}_{i}": F.greatest(1.4826 * F.col(f"a_{i}"), F.lit(FLOORS[x])) for i, x in enumerate(names)}
    spread |= {f"l_{i}_{j}": F.lit(0.0) for i in range(len(names)) for j in range(i)}
    return far.withColumns(spread).drop(*[f"a_{i}" for i in range(len(names))])


def robust_estimates(d: DataFrame, names: list[str], subset: float = SUBSET, steps: int = STEPS) -> DataFrame:
    """Minimum-covariance-determinant estimates per group, reweighted once."""
    k = len(names)
    estimates = _start(d, names)
    consistent = subset / chi2(chi2_beyond(1 - subset, k), k + 2)
    for _ in range(steps):
        near = with_distance(d, estimates, names)
        bounds = near.groupBy("group").agg(F.percentile_approx("d2", subset, 10_000).alias("bound"))
        estimates = _estimates(_attach(near, bounds, "group").where("d2 <= bound"), names, consistent)
    kept = with_distance(d, estimates, names).where(F.col("d2") <= chi2_beyond(1 - REWEIGHT_AT, k))
    return _estimates(kept, names, REWEIGHT_AT / chi2(chi2_beyond(1 - REWEIGHT_AT, k), k + 2))


def judge(docs: DataFrame) -> DataFrame:
    """``docs`` with the base statistics, base_failed, d2 and kept.

    ``docs`` needs text, lang and source; its columns of the names added here are replaced. NULL and empty texts fail the base rules; NULL lang or source are groups of
    their own. Rows that fail the base rules take no part in the estimates. Where even the pooled rows are fewer than
    ``MIN_GROUP``, only the base rules decide. Repeated rows get equal verdicts. The texts are read once: rows with
    their statistics are written, and the verdict reads them back.
    """
    names = list(FLOORS)
    clash = {"n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "d2", "kept", "group", *names}
    d = statistics(docs.select(*[c for c in docs.columns if c not in clash]))
    d = stored(d.withColumns(vector()).withColumn("base_failed", base_failed()))
    few = ["lang", "source", "n_words", "n_repeat_words", *names]
    usable = _grouped(d.select(*few).where(~base_failed()))
    estimates = robust_estimates(stored(usable.select("group", *names)), names)
    named = with_distance(_grouped(d), estimates, names)
    cutoff = chi2_beyond(REJECT_CHANCE, len(names))
    enough = F.col("group") != NO_GROUP
    verdict = ~F.col("base_failed") & (~enough | F.coalesce(F.col("d2") <= cutoff, F.lit(True)))
    return named.withColumn("kept", verdict).drop("group", *names)
