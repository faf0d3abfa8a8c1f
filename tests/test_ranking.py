import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from zerotally.operators import profiles, ranking
from zerotally.operators.levels import level_table, ordered_levels


def _skewed(spark, n=4000, parts=5):
    """A third of the rows share one key value."""
    rng = random.Random(1)
    rows = [(i, 7 if i % 3 == 0 else rng.randrange(50), rng.randrange(9)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, k int, v int").repartition(parts)


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_row_ids_and_running_sums_do_not_depend_on_partitions(spark, parts):
    rows, df = _skewed(spark, parts=parts)
    order = sorted(rows, key=lambda r: (r[1], r[0]))
    want = {r[0]: i for i, r in enumerate(order)}
    got = ranking.with_row_id(df, ["k", "id"]).select("id", "row_id").collect()
    assert {r["id"]: r["row_id"] for r in got} == want
    run, total = {}, 0
    for r in order:
        total += r[2]
        run[r[0]] = total
    got = ranking.with_running_sum(df, ["k", "id"], "v", "run").select("id", "run").collect()
    assert {r["id"]: r["run"] for r in got} == run


def test_a_hot_key_spreads_over_partitions(spark):
    _, df = _skewed(spark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = (ranking.range_sorted(df, F.col("k").asc(), F.col("id").asc()).groupBy("_part").count().collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 4 and max(r["count"] for r in sizes) < 2000


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    data = {"a": np.r_[np.full(700, 2.5), rng.normal(size=1301)], "b": rng.exponential(size=5), "c": np.array([4.0])}
    rows = [(g, float(v)) for g, vs in data.items() for v in vs] + [("a", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(6)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    got = {(r["g"], r["prob"]): r["quantile"] for r in ranking.exact_quantiles(df, ["g"], "x", probs).collect()}
    for g, vs in data.items():
        for p in probs:
            assert math.isclose(got[g, p], np.quantile(vs, p), rel_tol=1e-12, abs_tol=1e-12)


@pytest.mark.parametrize("n", [1, 4, 5, 11, 999, 23_000])
def test_split_holds_out_the_lowest_keys(spark, n):
    want_n = math.ceil(0.2 * n)
    keys = sorted((hashlib.md5(f"{i}:42".encode()).hexdigest(), i) for i in range(n))
    want = {i for _, i in keys[:want_n]}
    got = ranking.with_sample(spark.range(n)).where("Sample = 'Val'").collect()
    assert {r["id"] for r in got} == want


def test_split_narrows_large_buckets_step_by_step(spark, monkeypatch):
    # one digit per step and tiny buckets, so that several narrowing steps are needed
    monkeypatch.setattr(ranking, "PREFIX_DIGITS", 1)
    monkeypatch.setattr(ranking, "SMALL_BUCKET", 3)
    n = 3000
    keys = sorted(hashlib.md5(f"{i}:7".encode()).hexdigest() for i in range(n))
    for frac in (0.0004, 0.2, 0.5, 1.0):
        assert ranking.holdout_cutoff(spark.range(n), frac, 7) == keys[math.ceil(frac * n) - 1]
    assert ranking.holdout_cutoff(spark.range(0), 0.5, 7) == ""


def test_levels_are_ordered_as_numbers_only_if_all_are(spark):
    rows = [("n", "10"), ("n", "9"), ("n", "-1"), ("t", "10"), ("t", "9"), ("t", "x"), ("n", None)]
    df = ordered_levels(spark.createDataFrame(rows, "Variable string, ValVar string"))
    got = {v: [r["ValVar"] for r in df.where(F.col("Variable") == v).orderBy("position").collect()] for v in "nt"}
    assert got == {"n": ["-1", "9", "10", None], "t": ["10", "9", "x"]}


def test_level_table_keeps_null_levels_and_has_no_mean_without_positives(spark):
    df = spark.createDataFrame([(None, 0), (None, 2), ("a", 0)], "v string, call_counts int")
    got = {r["ValVar"]: r for r in level_table(df, ["v"]).collect()}
    assert (got[None]["ActualCnt"], got[None]["TotalCnt"], got[None]["MeanGivenPositive"]) == (1, 2, 2.0)
    assert got["a"]["MeanGivenPositive"] is None and got["a"]["MarginalMean"] == 0.0


def test_box_statistics_and_histogram(spark):
    values = [1.0, 2.0, 3.0, 4.0, 100.0]
    df = spark.createDataFrame([("s", v) for v in values], "g string, value double")
    box = profiles.box_statistics(df, ["g"]).first()
    assert (box["q1"], box["median"], box["q3"]) == (2.0, 3.0, 4.0)
    assert (box["whisker_low"], box["whisker_high"], box["outliers"]) == (1.0, 4.0, 1)
    bars = {r["bin"]: r["n"] for r in profiles.histogram(df, ["g"], "value", 10).collect()}
    want, _ = np.histogram(values, bins=10)
    assert [bars[i] for i in range(10)] == list(want)


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([("s", 5.0)] * 3, "g string, value double")
    bars = profiles.histogram(df, ["g"], "value", 4).orderBy("bin").collect()
    want, edges = np.histogram([5.0] * 3, bins=4)
    assert [r["n"] for r in bars] == list(want)
    assert [r["left_edge"] for r in bars] == list(edges[:-1])


def test_prediction_summary_leaves_nulls_out_of_the_mean(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, "a", None), (2, "a", 4.0), (3, "b", None)], "id int, g string, p double")
    got = {r["g"]: r for r in profiles.prediction_summary(df, ["g"], "p").collect()}
    assert (got["a"]["n"], got["a"]["ids"], got["a"]["mean_pred"]) == (3, 2, 3.0)
    assert (got["b"]["n"], got["b"]["mean_pred"]) == (1, None)


def test_running_sums_of_doubles_and_nulls(spark):
    rows = [(i, i % 5, None if i < 40 or i % 7 == 0 else i / 4) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, k int, v double").repartition(6)
    run, total = {}, None
    for i, k, v in sorted(rows, key=lambda r: (r[0],)):
        total = total if v is None else (total or 0.0) + v
        run[i] = total
    got = {r["id"]: r["run"] for r in ranking.with_running_sum(df, ["id"], "v", "run").collect()}
    assert got.keys() == run.keys()
    assert all(got[i] == run[i] if run[i] is None else math.isclose(got[i], run[i]) for i in run)


def test_a_running_sum_beyond_64_bits_raises(spark):
    df = spark.createDataFrame([(i, 1 << 62) for i in range(4)], "id long, v long").coalesce(1)
    with pytest.raises(Exception):
        ranking.with_running_sum(df, ["id"], "v", "run").collect()


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("Exchange ", 1)[1].split("(")[0] for line in plan.splitlines() if "Exchange " in line and "Broadcast" not in line]


def test_scans_need_one_exchange_on_the_key(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("v"))
    assert _exchanges(ranking.prefix_scan(df, [F.col("id")], {"run": "v"})) == ["rangepartitioning"]
    moved = _exchanges(ranking.tied_products(df, F.col("v"), F.lit(1), F.lit(1)))
    assert len(moved) == 2 and moved[0].startswith("SinglePartition")  # a row per partition
    assert moved[1] == "rangepartitioning"
    assert _exchanges(ranking.with_running_sum(df, ["id"], "v", "run")).count("rangepartitioning") == 0  # read back, not sorted again


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_tied_products_with_ties_over_partitions_nulls_and_nan(spark, parts):
    rng = random.Random(parts)
    rows = [(i, rng.choice([None, float("nan"), -0.0, 0.0, 1.5, 1.5, 1.5, rng.random()]), rng.randrange(4), rng.randrange(3)) for i in range(800)]
    df = spark.createDataFrame(rows, "id long, k double, a int, b int").repartition(parts)
    order = lambda k: (0, 0.0) if k is None else (2, 0.0) if k != k else (1, k + 0.0)
    want = sum(a * b * (1.0 if order(j) < order(k) else 0.5 if order(j) == order(k) else 0.0) for _, k, a, _ in rows for _, j, _, b in rows)
    for exchange in ("4", "40"):
        spark.conf.set("spark.sql.shuffle.partitions", exchange)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            got = ranking.tied_products(df, F.col("k"), F.col("a"), F.col("b")).first()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        assert (got["a"], got["b"]) == (sum(r[2] for r in rows), sum(r[3] for r in rows))
        assert math.isclose(got["cross"], want, rel_tol=1e-12)
    none = ranking.tied_products(df.where("id < 0"), F.col("k"), F.col("a"), F.col("b")).first()
    assert tuple(none) == (0.0, 0.0, 0.0)


def test_quantiles_narrow_their_brackets(spark, monkeypatch):
    rng = np.random.default_rng(8)
    data = {"smooth": rng.normal(size=20_000), "tied": np.r_[np.full(7000, 3.0), rng.integers(0, 9, 9000)], "few": np.arange(3.0)}
    df = spark.createDataFrame([(g, float(v)) for g, vs in data.items() for v in vs], "g string, x double").repartition(3)
    monkeypatch.setattr(ranking, "SMALL_BRACKET", 50)
    held = []
    inner = ranking._ranked
    monkeypatch.setattr(ranking, "_ranked", lambda rows, wanted, by: (held.append(
        ranking._bracketed(rows, wanted, by).where("_v BETWEEN _lo AND _hi").groupBy(*by, "prob").agg(F.countDistinct("_v").alias("n")).collect()),
        inner(rows, wanted, by))[1])
    probs = [0.0, 0.25, 0.5, 0.999, 1.0]
    got = {(r["g"], r["prob"]): r["quantile"] for r in ranking.exact_quantiles(df, ["g"], "x", probs).collect()}
    for g, vs in data.items():
        for p in probs:
            assert math.isclose(got[g, p], np.quantile(vs, p), rel_tol=1e-12, abs_tol=1e-12)
    assert len(held) == 1 and max(r["n"] for r in held[0]) < 200  # of 20,000 different values


def test_a_bracket_that_misses_is_looked_for_again(spark, monkeypatch):
    df = spark.createDataFrame([("g", float(i)) for i in range(999)], "g string, x double")
    inner, wrong = ranking._narrowed, iter([True])
    def off(*args):
        lo, hi, held = inner(*args)
        return [F.lit(-5.0).alias("_lo"), F.lit(-4.0).alias("_hi"), held] if next(wrong, False) else [lo, hi, held]
    monkeypatch.setattr(ranking, "_narrowed", off)
    assert [r["quantile"] for r in ranking.exact_quantiles(df, ["g"], "x", [0.25]).collect()] == [249.5]


def test_quantiles_of_the_whole_frame(spark):
    df = spark.createDataFrame([(float(i),) for i in range(101)], "x double")
    assert {r["prob"]: r["quantile"] for r in ranking.exact_quantiles(df, [], "x", [0.1, 0.5]).collect()} == {0.1: 10.0, 0.5: 50.0}


def test_histogram_hands_on_bins_and_not_values(spark):
    df = spark.range(50_000).select((F.col("id") % 2).alias("g"), F.rand(1).alias("value"))
    plan = profiles.histogram(df, ["g"], "value", 10)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert "partial_count(1)" in plan and moved and not any("_v#" in line or "value#" in line for line in moved)
