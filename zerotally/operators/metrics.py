"""Error, rank and discrimination metrics from sums over one pass or one sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zerotally import fixed
from zerotally.operators.ranking import before, range_sorted, tied_products


def rmse(df: DataFrame, y: str, pred: str) -> DataFrame:
    gap = F.col(y) - F.col(pred)
    return df.agg(F.sqrt(F.avg(gap * gap)).alias("rmse"))


def gini(df: DataFrame, y: str, pred: str) -> DataFrame:
    """Gini of the actual counts ordered by falling prediction, ties by id.

    The sum of all running totals equals the sum of y * (n - rank + 1), so a rank is all
    that is needed: local positions plus one offset per partition.
    """
    actual = F.col(y).cast("double")
    ranked = range_sorted(df.select(actual.alias("_y"), F.col(pred).alias("_p"), F.col(fixed.ID).alias("_id")),
                          F.col("_p").desc(), F.col("_id").asc())
    parts = ranked.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_s"),
        F.sum(F.col("_y") * F.col("_pos")).alias("_w"))
    total = before(parts, "_n", "_start").agg(
        F.sum("_n").alias("n"), F.sum("_s").alias("s"),
        F.sum(F.col("_w") + F.col("_start") * F.col("_s")).alias("w"))
    n, s, w = F.col("n"), F.col("s"), F.col("w")
    return total.select(F.when(s != 0, ((n * s - w) / s - (n + 1) / 2) / n).alias("gini"))


def normalized_gini(df: DataFrame, y: str, pred: str, best: DataFrame | None = None) -> DataFrame:
    """Gini of the prediction over the Gini of a perfect ranking, which may be given where several predictions share it."""
    # A perfect ranking orders by the count itself; equal counts contribute the same in any order.
    got = gini(df, y, pred).withColumnRenamed("gini", "_got")
    best = (perfect_gini(df, y) if best is None else best).withColumnRenamed("gini", "_best")
    return (got.select("_got", F.lit(1).alias("_k")).join(best.select("_best", F.lit(1).alias("_k")), "_k")
            .select((F.col("_got") / F.col("_best")).alias("normalized_gini")))


def perfect_gini(df: DataFrame, y: str) -> DataFrame:
    """Gini of counts ordered by themselves. Ranks ahead + 1 .. ahead + c that share one value add up in closed form, so
    equal counts need no order and one exchange of partly tallied counts is enough."""
    y_ = F.col(y).cast("double")
    total = tied_products(df, -y_, F.coalesce(y_, F.lit(0.0)), F.lit(1.0))
    n, s, w = F.col("b"), F.col("a"), F.col("cross") - F.col("a") / 2
    return total.select(F.when(s != 0, ((n * s - w) / s - (n + 1) / 2) / n).alias("gini"))


def log_loss(df: DataFrame, y: str, prob: str, eps: float = 2.220446049250313e-16) -> DataFrame:
    """Mean negative log likelihood of 0/1 outcomes, probabilities clipped away from 0 and 1."""
    p = F.greatest(F.least(F.col(prob), F.lit(1 - eps)), F.lit(eps))
    hit = F.col(y) > 0
    return df.agg(F.avg(F.when(hit, -F.log(p)).otherwise(-F.log1p(-p))).alias("log_loss"))


def roc_auc(df: DataFrame, y: str, score: str) -> DataFrame:
    """Exact area under the ROC curve, ties counting one half; NULL with a single class.

    Positives meet the negatives below them, and half of those that share their score, in one pass over the sorted scores.
    """
    hit = F.when(F.col(y) > 0, 1.0).otherwise(0.0)
    total = tied_products(df, F.col(score), hit, 1.0 - hit)
    pairs = F.col("a") * F.col("b")
    return total.select(F.when(pairs > 0, F.col("cross") / pairs).alias("auc"))


def report(df: DataFrame, label: str, y: str, pred: str, aic: float | None = None, best: DataFrame | None = None) -> DataFrame:
    """One row: label, RMSE, AIC, normalised Gini."""
    one = F.lit(1).alias("_k")
    return (rmse(df, y, pred).select("*", one).join(normalized_gini(df, y, pred, best).select("*", one), "_k")
            .select(F.lit(label).alias("label"), "rmse", F.lit(aic).cast("double").alias("aic"),
                    "normalized_gini"))


def hurdle_report(df: DataFrame, label: str, y: str = fixed.TARGET) -> DataFrame:
    """Rows, ranges of the stage and product predictions, RMSE and normalised Gini."""
    gap = F.col(y) - F.col("y_hat")
    one = F.lit(1).alias("_k")
    ranges = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[f(c).alias(f"{n}_{c}") for c in ("p_positive", "mean_positive", "y_hat")
          for n, f in (("min", F.min), ("max", F.max))],
        F.sqrt(F.avg(gap * gap)).alias("rmse")).select("*", one)
    rank = normalized_gini(df, y, "y_hat").select("*", one)
    return ranges.join(rank, "_k").drop("_k").select(F.lit(label).alias("segment"), "*")
