"""Descriptive statistics: summaries, histograms, value counts, box statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zerotally import fixed
from zerotally.functions import scalars as S
from zerotally.operators.ranking import exact_quantiles
from zerotally.workspace import materialise

_QUARTILES = {0.25: "q1", 0.5: "median", 0.75: "q3"}


def quartiles(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """q1, median and q3 as columns, one row per group."""
    long = exact_quantiles(df, by, value, list(_QUARTILES))
    named = [F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for p, n in _QUARTILES.items()]
    return long.groupBy(*by).agg(*named)


def describe(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Count, mean, sample sd, min, quartiles and max per group."""
    base = df.groupBy(*by).agg(
        F.count(value).alias("count"),
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).cast("double").alias("min"),
        F.max(value).cast("double").alias("max"),
    )
    return base.join(quartiles(df, by, value), by)


def dispersion(df: DataFrame, by: list[str], y: str = fixed.TARGET) -> DataFrame:
    """Mean, variance and zero share over all rows; mean and variance over non-zero rows."""
    positive = F.when(F.col(y) != 0, F.col(y))
    return df.groupBy(*by).agg(
        F.avg(y).alias("mean"),
        F.var_samp(y).alias("var"),
        F.avg(S.indicator(F.col(y) == 0)).alias("zero_share"),
        F.avg(positive).alias("mean_nonzero"),
        F.var_samp(positive).alias("var_nonzero"),
    )


def histogram(df: DataFrame, by: list[str], value: str, bins: int = fixed.HISTOGRAM_BINS) -> DataFrame:
    """Equal-width bins between each group's extremes, the last one closed.

    One scan finds the extremes, the next counts bins; what tasks hand on is a row per group, and one per group and bin.
    """
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("_v"))
    edges = rows.groupBy(*by).agg(F.min("_v").alias("lo"), F.max("_v").alias("_hi"))
    flat = F.col("_hi") == F.col("lo")
    edges = materialise(edges.select(
        *by,
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.lit(1.0)).otherwise(F.col("_hi") - F.col("lo")).alias("_span")), "edges")
    bin_no = F.least(F.floor((F.col("_v") - F.col("lo")) * bins / F.col("_span")), F.lit(bins - 1))
    filled = rows.join(edges, by).groupBy(*by, bin_no.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = edges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    return (every.join(filled, [*by, "bin"], "left")
            .select(*by, "bin",
                    (F.col("lo") + F.col("bin") * F.col("_span") / bins).alias("left_edge"),
                    F.coalesce("n", F.lit(0)).alias("n")))


def segment_value_counts(df: DataFrame, columns: list[str], segment: str = "segment") -> DataFrame:
    """Level counts side by side for the two segments, zero where a level is absent.

    `df` holds both segments; a column that a segment lacks is NULL there and named in
    `fixed.SEGMENT_DROPS`, and its rows are left out.
    """
    texts = df.select(segment, *[S.category_text(c).alias(c) for c in columns])
    long = texts.unpivot([segment], columns, "Variable", "Level")
    for name, dropped in fixed.SEGMENT_DROPS.items():
        absent = [c for c in dropped if c in columns]
        if absent:
            long = long.where(~((F.col(segment) == fixed.SEGMENTS[name]) & F.col("Variable").isin(absent)))
    return (long.groupBy("Variable", "Level").pivot(segment, list(fixed.SEGMENTS.values())).count()
            .na.fill(0, list(fixed.SEGMENTS.values()))
            .withColumn("Total", F.col("Auto") + F.col("NonAuto")))


def ordered_value_counts(counts: DataFrame) -> DataFrame:
    """Add `position`: by falling total, or by number for the policy count."""
    number = F.when(F.col("Variable") == "household_policy_counts", F.col("Level").try_cast("double"))
    order = Window.partitionBy("Variable").orderBy(
        number.asc_nulls_last(), F.col("Total").desc(), F.col("Level"))
    return counts.withColumn("position", F.row_number().over(order))


def long_values(df: DataFrame, columns: list[str], segment: str = "segment") -> DataFrame:
    """Numeric columns stacked: segment, `Variable`, `value`."""
    doubles = df.select(segment, *[F.col(c).cast("double").alias(c) for c in columns])
    return doubles.unpivot([segment], columns, "Variable", "value")


def log_capped_values(df: DataFrame, segment: str = "segment") -> DataFrame:
    """Natural log of one plus each value capped at its segment's cap, stacked."""
    auto = F.col(segment) == fixed.SEGMENTS["auto"]
    capped = df.select(segment, *[
        S.natural_log_cap(c, F.when(auto, F.lit(t["auto"])).otherwise(F.lit(t["nonauto"]))).alias(c)
        for c, t in fixed.LOG_CAPS.items()])
    return capped.unpivot([segment], list(fixed.LOG_CAPS), "Variable", "value")


def box_statistics(long: DataFrame, by: list[str], value: str = "value") -> DataFrame:
    """Quartiles, whiskers at the last value within 1.5 IQR, and the number of outliers."""
    rows = long.where(F.col(value).isNotNull())
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    fences = materialise(quartiles(rows, by, value).select(
        "*", (F.col("q1") - reach).alias("_lo"), (F.col("q3") + reach).alias("_hi")), "fences")
    inside = F.col(value).between(F.col("_lo"), F.col("_hi"))
    stats = rows.join(fences.select(*by, "_lo", "_hi"), by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
        F.sum(S.indicator(~inside)).alias("outliers"))
    return stats.join(fences.drop("_lo", "_hi"), by)


def prediction_summary(df: DataFrame, by: list[str], pred: str) -> DataFrame:
    """Rows, distinct ids and the range and mean of a prediction; NULL predictions count as rows only.

    Rows are folded per id first, so a segment that holds most rows still spreads.
    """
    per_id = df.groupBy(*by, fixed.ID).agg(
        F.count(F.lit(1)).alias("_n"), F.min(pred).alias("_lo"), F.max(pred).alias("_hi"),
        F.sum(pred).alias("_sum"), F.count(pred).alias("_known"))
    return per_id.groupBy(*by).agg(
        F.sum("_n").alias("n"), F.count(F.lit(1)).alias("ids"),
        F.min("_lo").alias("min_pred"), F.max("_hi").alias("max_pred"),
        (F.sum("_sum") / F.nullif(F.sum("_known"), F.lit(0))).alias("mean_pred"))
