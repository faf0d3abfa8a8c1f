import math
import random

import pytest
from pyspark.sql import functions as F

from zerotally.operators import metrics


def _gini(rows):
    """Plain running totals over (id, y, p), by falling p, then id."""
    order = sorted(rows, key=lambda r: (-r[2], r[0]))
    n, run, area = len(order), 0.0, 0.0
    for _, y, _ in order:
        run += y
        area += run
    return (area / run - (n + 1) / 2) / n


def _auc(rows):
    pos, neg = [r[2] for r in rows if r[1] > 0], [r[2] for r in rows if r[1] == 0]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(2)
    return [(i, rng.choice([0, 0, 1, 4, 9]), 0.5 if i % 3 == 0 else rng.random()) for i in range(900)]


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_gini_and_auc_with_ties(spark, rows, parts):
    df = spark.createDataFrame(rows, "id long, y int, p double").repartition(parts)
    assert math.isclose(metrics.gini(df, "y", "p").first()[0], _gini(rows), rel_tol=1e-12)
    perfect = _gini([(i, y, y) for i, y, _ in rows])
    assert math.isclose(metrics.perfect_gini(df, "y").first()[0], perfect, rel_tol=1e-12)
    assert math.isclose(metrics.normalized_gini(df, "y", "p").first()[0], _gini(rows) / perfect, rel_tol=1e-12)
    assert math.isclose(metrics.roc_auc(df, "y", "p").first()[0], _auc(rows), rel_tol=1e-12)


def test_rank_metrics_ignore_monotone_changes_and_score_themselves(spark, rows):
    df = spark.createDataFrame(rows, "id long, y int, p double")
    a = metrics.gini(df, "y", "p").first()[0]
    b = metrics.gini(df.withColumn("p", F.exp(F.col("p") * 3)), "y", "p").first()[0]
    assert math.isclose(a, b, rel_tol=1e-12)
    assert math.isclose(metrics.normalized_gini(df, "y", "y").first()[0], 1.0, rel_tol=1e-12)


def test_equal_predictions_and_single_class(spark):
    rows = [(i, i % 3, 0.25) for i in range(50)]
    df = spark.createDataFrame(rows, "id long, y int, p double")
    assert math.isclose(metrics.gini(df, "y", "p").first()[0], _gini(rows), rel_tol=1e-12)
    assert metrics.roc_auc(df, "y", "p").first()[0] == 0.5
    assert metrics.roc_auc(df.where("y > 0"), "y", "p").first()[0] is None


def test_log_loss_is_clipped(spark):
    df = spark.createDataFrame([(1, 1, 0.0), (2, 0, 0.5)], "id long, y int, p double")
    want = (-math.log(2.220446049250313e-16) - math.log(0.5)) / 2
    assert math.isclose(metrics.log_loss(df, "y", "p").first()[0], want, rel_tol=1e-12)
