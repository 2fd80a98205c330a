"""Quality rules and robust multivariate outliers, DataFrame functions only.

1. Each text gets its statistics in one pass without a shuffle; repeated three-word windows are found
   by sorting the text's own windows. The base rules judge them.
2. What passes becomes a vector in thousandths of logarithms: word length, and the shares of symbols,
   repeated lines and repeated words (over ``PAD`` more words than there are, so that a single repeated line
   weighs little in a short text).
3. Each (language, source) with at least ``LEAST`` such documents is a cell; smaller ones of a language
   are pooled, and so are smaller languages. Every cell gets a minimum-covariance-determinant
   estimate: from two starts (medians with absolute deviations; mean and covariance) ``STEPS`` concentration
   steps each take the ``SHARE`` of the cell that is nearest by Mahalanobis distance and estimate again; the
   start with the smaller determinant wins, and all within its 97.5 % ellipsoid give the final estimate.
4. Documents beyond the 99.9 % quantile of their cell's final distance are rejected.

A step is one pass over narrow rows. Distances and values are integers when they are counted, so a cell's
histogram has a bounded number of bins whatever its number of rows, which holds sums and products of all its
rows; they are combined in the tasks, and exact, so results do not depend on partitioning.
The smallest scale that counts, ``RESOLUTION``, is added to each variance: where most of a cell's texts are
equal in a statistic, its variance is 0 otherwise.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chanwh.llm.shared import small, text_or_empty, written

#: Fixed by the base rules.
SYMBOLS, SPACE = "#*$%&|<>", " \t\n\x0b\x0c\r"
LEAST_WORDS, MOST_REPEATED = 50, 50
#: Rows of a cell, words added to every text, thousandths that count as one unit of a logarithm's scale.
LEAST, PAD, RESOLUTION = 60, 100, 200
#: Share of a cell in a concentration step, steps, and quantiles of the ellipsoids of reweighting and verdict.
SHARE, STEPS, INSIDE, CUTOFF = 0.75, 6, 0.975, 0.999
#: Bins of a distance for each factor of e.
BINS = 1000
DIM = 4
X = [f"x{i}" for i in range(DIM)]
PAIRS = [(i, j) for i in range(DIM) for j in range(i + 1)]
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def chi_square(x: float, freedom: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(freedom // 2))


def quantile(share: float, freedom: int = DIM) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, freedom) < share else (low, middle)
    return high


def consistency(share: float) -> float:
    """What the covariance of the central ``share`` of a normal distribution is to be multiplied with."""
    return share / chi_square(quantile(share), DIM + 2)


def statistics(docs: DataFrame, keep: list[str], text_col: str) -> DataFrame:
    """The columns ``keep`` and the five statistics of every text; null is an empty text."""
    space = "[\\x20\\x09-\\x0D]+"
    out = docs.select(*keep, text_or_empty(text_col).alias("text"))
    out = out.withColumn("words", F.filter(F.split("text", space), lambda w: w != ""))
    out = out.withColumn("lines", F.filter(F.split("text", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")))
    # the last two windows are shorter, equal to no other
    window = lambda w, i: F.struct(F.concat_ws(" ", w, F.get("words", i + 1), F.get("words", i + 2)).alias("g"), i.alias("i"))
    out = out.withColumn("windows", F.sort_array(F.transform("words", window)))
    again = lambda x, j: (x.g == F.get("windows", j - 1).g) | (x.g == F.get("windows", j + 1).g)
    out = out.withColumn("again", F.filter("windows", again))
    covered = F.array_distinct(F.flatten(F.transform("again", lambda x: F.array(x.i, x.i + 1, x.i + 2))))
    values = {"n_words": F.size("words"), "word_chars": F.length(F.translate("text", SPACE, "")),
              "n_symbols": F.length("text") - F.length(F.translate("text", SYMBOLS, "")),
              "n_dup_lines": F.size("lines") - F.size(F.array_distinct("lines")), "n_repeat_words": F.size(covered)}
    return out.select(*keep, *(c.cast("long").alias(n) for n, c in values.items()))


def vector() -> list[Column]:
    padded = F.col("n_words") + PAD
    logs = [F.ln(F.col("word_chars") / F.col("n_words")), F.ln(1 + 10 * F.col("n_symbols") / padded),
            F.ln(1 + 100 * F.col("n_dup_lines") / padded), F.ln(1 + 10 * F.col("n_repeat_words") / padded)]
    return [F.floor(1000 * c + 0.5).alias(x) for x, c in zip(X, logs)]


def with_cells(rows: DataFrame) -> DataFrame:
    """The cell of each row: struct (lang, source), with null for what is pooled; null if there are too few."""
    groups = written(rows.where("not base_failed").groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n")), "quality-groups")
    pools = groups.where(F.col("n") < LEAST).groupBy("lang").agg(F.sum("n").alias("pool"))
    rest = pools.where(F.col("pool") < LEAST).agg(F.sum("pool").alias("rest")).scalar()
    nothing = F.lit(None).cast("string")
    cell = (F.when(F.col("n") >= LEAST, F.struct("lang", "source"))
            .when(F.col("pool") >= LEAST, F.struct("lang", nothing.alias("source")))
            .when(rest >= LEAST, F.struct(nothing.alias("lang"), nothing.alias("source"))))
    cells = written(groups.join(pools, "lang", "left").select("lang", "source", cell.alias("cell")), "quality-cells")
    return rows.join(small(cells), ["lang", "source"], "left")


def medians(rows: DataFrame, values: list[Column]) -> DataFrame:
    """The lower median of each value in each cell, by counting: columns ``v0``, ``v1``, ..."""
    each = rows.select("cell", F.posexplode(F.array(*values)).alias("k", "v"))
    bins = each.groupBy("cell", "k", "v").agg(F.count(F.lit(1)).alias("n"))
    whole, upto = Window.partitionBy("cell", "k"), Window.partitionBy("cell", "k").orderBy("v")
    bins = bins.withColumns({"upto": F.sum("n").over(upto), "all": F.sum("n").over(whole)})
    return bins.groupBy("cell").agg(*(F.min(F.when((F.col("k") == k) & (2 * F.col("upto") >= F.col("all")), F.col("v"))).alias(f"v{k}") for k in range(len(values))))


def ellipsoid(df: DataFrame, variance: dict[tuple[int, int], Column]) -> DataFrame:
    """Adds the Cholesky factor ``l``i``_``j of the covariance with the resolution, and its determinant."""
    for i, j in PAIRS:
        rest = variance[i, j] + (RESOLUTION**2 if i == j else 0)
        rest = reduce(lambda c, k: c - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}"), range(j), rest)
        df = df.withColumn(f"l{i}_{j}", F.sqrt(rest) if i == j else rest / F.col(f"l{j}_{j}"))
    return df.withColumn("det", reduce(lambda a, b: a * b, (F.col(f"l{i}_{i}") for i in range(DIM))))


ESTIMATE = ["cell", "start", *(f"m{i}" for i in range(DIM)), *(f"l{i}_{j}" for i, j in PAIRS), "det"]


def estimate(moments: DataFrame, share: float) -> DataFrame:
    """Means and ellipsoid from number, sums and sums of products of the central ``share`` of a cell."""
    out = moments.withColumns({f"m{i}": F.col(f"s{i}") / F.col("n") for i in range(DIM)})
    factor = consistency(share) if share < 1 else 1.0
    variance = {(i, j): factor * (F.col(f"p{i}_{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}")) for i, j in PAIRS}
    return ellipsoid(out, variance).select(*ESTIMATE)


def with_distance(rows: DataFrame, estimates: DataFrame, how: str = "inner") -> DataFrame:
    """Adds the squared Mahalanobis distance ``d2`` of each row to the estimates of its cell."""
    out = rows.join(small(estimates), "cell", how)
    for i in range(DIM):
        rest = reduce(lambda c, k: c - F.col(f"l{i}_{k}") * F.col(f"y{k}"), range(i), F.col(X[i]) - F.col(f"m{i}"))
        out = out.withColumn(f"y{i}", rest / F.col(f"l{i}_{i}"))
    return out.withColumn("d2", reduce(lambda a, b: a + b, (F.col(f"y{i}") * F.col(f"y{i}") for i in range(DIM))))


MOMENTS = ["n", *(f"s{i}" for i in range(DIM)), *(f"p{i}_{j}" for i, j in PAIRS)]


def moments(rows: DataFrame, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *(F.sum(x).alias(f"s{i}") for i, x in enumerate(X)),
                                 *(F.sum(F.col(X[i]) * F.col(X[j])).alias(f"p{i}_{j}") for i, j in PAIRS))


def summed(moments_: DataFrame, by: list[str]) -> DataFrame:
    return moments_.groupBy(*by).agg(*(F.sum(c).alias(c) for c in MOMENTS))


def starts(rows: DataFrame) -> DataFrame:
    """The two estimates that concentration starts from."""
    middle = written(medians(rows, [F.col(x) for x in X]), "quality-medians")
    centred = rows.join(small(middle), "cell")
    spread = medians(centred, [F.abs(F.col(x) - F.col(f"v{i}")) for i, x in enumerate(X)])
    spread = spread.select("cell", *(F.col(f"v{i}").alias(f"a{i}") for i in range(DIM))).join(middle, "cell")
    robust = spread.withColumns({"start": F.lit(0)} | {f"m{i}": F.col(f"v{i}").cast("double") for i in range(DIM)})
    variance = {(i, j): F.pow(1.4826 * F.col(f"a{i}"), 2) if i == j else F.lit(0.0) for i, j in PAIRS}
    classical = estimate(moments(rows, ["cell"]).withColumn("start", F.lit(1)), 1)
    return ellipsoid(robust, variance).select(*ESTIMATE).unionByName(classical)


def concentrate(rows: DataFrame, estimates: DataFrame) -> DataFrame:
    """One step: estimates from the nearest ``SHARE`` of each cell, whole bins of distance."""
    near = with_distance(rows, estimates).withColumn("bin", F.floor(BINS * F.ln(1 + F.col("d2"))))
    bins = moments(near, ["cell", "start", "bin"])
    whole, upto = Window.partitionBy("cell", "start"), Window.partitionBy("cell", "start").orderBy("bin")
    bins = bins.withColumns({"upto": F.sum("n").over(upto), "all": F.sum("n").over(whole)})
    central = bins.where(F.col("upto") - F.col("n") < F.ceil(SHARE * F.col("all")))
    return estimate(summed(central, ["cell", "start"]), SHARE)


def robust_estimates(rows: DataFrame) -> DataFrame:
    """The reweighted minimum-covariance-determinant estimate of each cell of ``rows`` (cell, x0, x1, ...)."""
    estimates = written(starts(rows), "quality-start")
    for step in range(STEPS):
        estimates = written(concentrate(rows, estimates), f"quality-step-{step}")
    best = estimates.groupBy("cell").agg(F.min_by(F.struct(*ESTIMATE[1:]), F.struct("det", "start")).alias("e")).select("cell", "e.*")
    inside = with_distance(rows, written(best, "quality-best")).where(F.col("d2") <= quantile(INSIDE))
    return written(estimate(moments(inside, ["cell", "start"]), INSIDE), "quality-estimates")


def judge_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """One row per row of ``docs``: id, the five statistics, ``base_failed``, ``kept``, ``distance`` (squared, null
    where none was taken) and ``cell`` (language and source whose estimate was used).

    Words are runs of characters other than space and U+0009 to U+000D; ``n_repeat_words`` counts words in
    three-word windows that the text has twice or more. Base rules: under 50 words, or more than half of them
    repeated. ``kept`` is true if these pass and the distance is within the cutoff. Null texts are empty,
    null languages and sources count as empty strings; if all pools of a corpus are too small for an
    estimate, the base rules alone decide. Repeated rows are judged alike; no rows: an empty result.
    """
    named = docs.select(F.col(id_col).alias("id"), text_or_empty(lang_col).alias("lang"), text_or_empty(source_col).alias("source"), F.col(text_col).alias("text"))
    rows = statistics(named, ["id", "lang", "source"], "text")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    rows = written(rows.withColumn("base_failed", failed), "quality-statistics")
    passed = F.when(~F.col("base_failed"), F.struct(*vector()))
    rows = written(with_cells(rows).withColumn("v", passed).select("id", *STATISTICS, "base_failed", F.when(~F.col("base_failed"), F.col("cell")).alias("cell"), "v.*"), "quality-rows")
    estimates = robust_estimates(rows.where("cell is not null").select("cell", *X))
    judged = with_distance(rows, estimates, "left")
    kept = ~F.col("base_failed") & (F.coalesce("d2", F.lit(0.0)) <= quantile(CUTOFF))
    return judged.select(F.col("id").alias(id_col), *STATISTICS, "base_failed", kept.alias("kept"), F.col("d2").alias("distance"), "cell")
