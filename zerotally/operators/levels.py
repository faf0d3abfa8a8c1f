"""Level tables and calibration tables: one scan for all variables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zerotally import fixed
from zerotally.functions.scalars import level_text


def by_level(df: DataFrame, variables: list[str], keep: list[str]) -> DataFrame:
    """One row per input row and variable: `Variable`, `ValVar` and the kept columns."""
    texts = df.select(*[level_text(v).alias(v) for v in variables], *keep)
    return texts.unpivot(keep, variables, "Variable", "ValVar")


def _positive_sums(y: str) -> list[Column]:
    hit = F.col(y) > 0
    return [
        F.sum(F.when(hit, 1).otherwise(0)).alias("ActualCnt"),
        F.count(F.lit(1)).alias("TotalCnt"),
        F.sum(F.when(hit, F.col(y)).otherwise(0)).cast("double").alias("SumGivenPositive"),
    ]


def _mean_given_positive() -> Column:
    return F.when(F.col("ActualCnt") > 0, F.col("SumGivenPositive") / F.col("ActualCnt"))


def level_table(df: DataFrame, variables: list[str], y: str = fixed.TARGET) -> DataFrame:
    """Counts, positives and their sum per variable and level, NULL levels included."""
    sums = by_level(df, variables, [y]).groupBy("Variable", "ValVar").agg(*_positive_sums(y))
    return sums.select(
        "*",
        (F.col("ActualCnt") / F.col("TotalCnt")).alias("Rate"),
        _mean_given_positive().alias("MeanGivenPositive"),
        (F.col("SumGivenPositive") / F.col("TotalCnt")).alias("MarginalMean"),
    )


def rate_calibration(df: DataFrame, variables: list[str], pred: str = "pred",
                     y: str = fixed.TARGET) -> DataFrame:
    """Predicted against actual share of positives, per variable, level and sample."""
    sums = (by_level(df, variables, [y, pred, "Sample"]).groupBy("Variable", "ValVar", "Sample")
            .agg(F.sum(pred).alias("PredCnt"), *_positive_sums(y)))
    return sums.select(
        "*",
        (F.col("ActualCnt") / F.col("TotalCnt")).alias("ActualRate"),
        (F.col("PredCnt") / F.col("TotalCnt")).alias("PredRate"),
        _mean_given_positive().alias("MeanGivenPositive"),
    )


def mean_calibration(df: DataFrame, variables: list[str], pred: str = "pred",
                     y: str = fixed.TARGET) -> DataFrame:
    """Predicted against actual mean, per variable, level and sample, over the rows given.

    Pass positive rows for the conditional mean and all rows for the marginal one.
    """
    return (by_level(df, variables, [y, pred, "Sample"]).groupBy("Variable", "ValVar", "Sample")
            .agg(F.avg(pred).alias("PredMean"), F.avg(y).alias("ActualMean"),
                 F.count(F.lit(1)).alias("TotalCnt")))


def attach_predictions(df: DataFrame, predictions: DataFrame) -> DataFrame:
    """Original-scale rows joined to their predictions by id."""
    return df.join(predictions, fixed.ID)


def ordered_levels(table: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Add `position` within each variable: numeric order if every level is a number, else text."""
    scope = ["Variable", *(extra or [])]
    number = F.col("ValVar").try_cast("double")
    numeric = F.every(F.coalesce(number.isNotNull(), F.lit(False)) | F.col("ValVar").isNull())
    flagged = table.withColumn("_numeric", numeric.over(Window.partitionBy(*scope)))
    order = Window.partitionBy(*scope).orderBy(
        F.when(F.col("_numeric"), number).asc_nulls_last(), F.col("ValVar").asc_nulls_last())
    return flagged.withColumn("position", F.row_number().over(order)).drop("_numeric")
