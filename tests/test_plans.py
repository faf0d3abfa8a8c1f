"""The whole chain on the smallest tables: invariants that need no second engine."""

import math
import os

import pytest
from pyspark.sql import functions as F

from zerotally import fixed
from zerotally.operators.newton import NotConverged
from zerotally.plans import hurdle as H
from zerotally.plans.prepare import encode_stage, prepare_all
from zerotally.sources.policies import policies

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables here")


@pytest.fixture(scope="module")
def table(spark):
    return policies(spark, FOLDER)


@pytest.fixture(scope="module")
def prepared(table):
    return prepare_all(table)


@pytest.fixture(scope="module")
def fitted(prepared):
    return H.fit_all(prepared, allow_unconverged=True)


def test_a_stage_without_an_optimum_stops_the_plan(prepared, fitted):
    short = {data.name: model for data, model in fitted if not model.binary.converged}
    assert list(short) == ["auto"]  # too few rows at this size: the fit runs off
    with pytest.raises(NotConverged):
        H.fit_hurdle(prepared[0])
    report = {r["segment"]: r["converged"] for r in H.validation_report(fitted).collect()}
    assert report == {"auto": False, "nonauto": True, "pooled": False}


def test_stage_reports_agree_with_plain_sums(fitted):
    got = {(r["segment"], r["Sample"]): r for r in H.stage_reports(fitted).collect()}
    data, model = fitted[1]
    rows = [r for r in model.score(data.rows, ["id", fixed.TARGET, "Sample"]).collect() if r["Sample"] == "Val"]
    loss = [-math.log(r["p_positive"] if r[fixed.TARGET] > 0 else 1 - r["p_positive"]) for r in rows]
    pos = [r for r in rows if r[fixed.TARGET] > 0]
    r = got["nonauto", "Val"]
    assert math.isclose(r["log_loss"], sum(loss) / len(loss), rel_tol=1e-9)
    assert math.isclose(r["rmse"], math.sqrt(sum((p["mean_positive"] - p[fixed.TARGET]) ** 2 for p in pos) / len(pos)), rel_tol=1e-9)
    assert r["aic"] is None and got["nonauto", "Train"]["aic"] == model.count.aic and 0 < r["auc"] < 1


def test_no_sentinel_is_left_and_no_row_is_lost(table, prepared):
    assert sum(p.rows.count() for p in prepared) == table.count()
    for p in prepared:
        assert p.rows.where(~F.col(fixed.FILLED).isin(fixed.KNOWN_FLAGS) | F.col(fixed.FILLED).isNull()).isEmpty()


def test_both_stages_share_one_split(prepared):
    for p in prepared:
        binary, count = (encode_stage(p, s).rows.select("id", "Sample") for s in ("binary", "count"))
        assert count.join(binary.withColumnRenamed("Sample", "other"), "id").where("Sample != other").isEmpty()


def test_scores_are_products_and_survive_a_round_trip(spark, prepared, fitted, tmp_path):
    data, model = fitted[0]
    model.save(spark, str(tmp_path / "hurdle"))
    again = H.Hurdle.load(spark, str(tmp_path / "hurdle"), data.name)
    a = model.score(data.rows, ["id"]).orderBy("id").collect()
    b = again.score(data.rows, ["id"]).orderBy("id").collect()
    assert a == b
    for r in a:
        assert 0 < r["p_positive"] < 1 and r["mean_positive"] >= 1
        assert math.isclose(r["y_hat"], r["p_positive"] * r["mean_positive"], rel_tol=1e-12)


def test_stage_one_is_calibrated_on_its_training_levels(prepared, fitted):
    data, model = fitted[1]
    table = H.stage_one_calibration(data, model).where("Sample = 'Train'")
    nominal = ["acq_method", "geo_group", "prdct_sbtyp_grp", "product_sbtyp"]
    for r in table.where(F.col("Variable").isin(nominal)).collect():
        assert math.isclose(r["PredCnt"], r["ActualCnt"], rel_tol=1e-6)


def test_calibration_tables_and_report_cover_all_rows(prepared, fitted):
    data, model = fitted[0]
    combined = H.combined_calibration(data, model).groupBy("Variable").agg(F.sum("TotalCnt").alias("n")).collect()
    assert {r["n"] for r in combined} == {data.rows.count()}
    second = H.stage_two_calibration(data, model).where("Variable = 'geo_group'").agg(F.sum("TotalCnt")).first()[0]
    assert second == data.rows.where("call_counts > 0").count()
    report = {r["segment"]: r for r in H.validation_report(fitted).collect()}
    assert report["pooled"]["n"] == report["auto"]["n"] + report["nonauto"]["n"]
    assert report["pooled"]["n"] == sum(math.ceil(0.2 * p.rows.count()) for p in prepared)


def test_unlabelled_rows_are_all_scored(table, fitted):
    out = H.predict_unseen(fitted, table.drop(fixed.TARGET))
    assert out.count() == table.count() == out.select("id").distinct().count()
    assert out.where(F.col(fixed.TARGET).isNull()).isEmpty()


def test_scratch_tables_are_gone_after_a_plan(spark, table, tmp_path):
    from zerotally.workspace import scratch_scope, shared_dir

    folder = shared_dir(spark).removeprefix("file://")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    train, test = (str(tmp_path / n) for n in ("train", "test"))
    table.where("id % 5 <> 4").write.csv(train, header=True)
    table.where("id % 5 = 4").drop(fixed.TARGET).write.csv(test, header=True)
    H.train_from_csv(spark, train, str(tmp_path / "model"), nominal=["acq_method"])
    H.score_csv(spark, test, str(tmp_path / "model"), str(tmp_path / "out"))
    assert set(os.listdir(folder)) == before
    lines = [line for f in sorted(os.listdir(tmp_path / "out")) if f.startswith("part-")
             for line in open(tmp_path / "out" / f).read().splitlines()[1:]]
    ids = [int(line.split(",")[0]) for line in lines]
    assert ids == sorted(ids) and len(ids) == table.where("id % 5 = 4").count()
    with pytest.raises(ZeroDivisionError):
        with scratch_scope(spark):
            prepare_all(table)
            1 / 0
    assert set(os.listdir(folder)) == before


def test_a_policy_table_is_written_once(spark, table, monkeypatch):
    from pyspark.sql import DataFrameWriter

    rows, inner = [], DataFrameWriter.parquet
    def counted(self, path, *args, **kw):
        inner(self, path, *args, **kw)
        rows.append(spark.read.parquet(path).count())
    monkeypatch.setattr(DataFrameWriter, "parquet", counted)
    parts = prepare_all(table)
    n = table.count()
    assert rows.count(n) == 1  # the segments' table
    assert sum(p.rows.count() for p in parts) == n
    # others hold a segment's labelled points, its tiles or the asked ids
    assert all(r == n or r <= max(p.sample("Train").count() for p in parts) for r in rows)


def test_prepared_rows_survive_a_round_trip(spark, prepared, tmp_path):
    from zerotally.plans.prepare import Prepared

    prepared[1].save(spark, str(tmp_path / "p"))
    again = Prepared.load(spark, str(tmp_path / "p"), prepared[1].name)
    columns = prepared[1].rows.columns
    assert sorted(map(tuple, again.rows.select(columns).collect())) == sorted(map(tuple, prepared[1].rows.collect()))


def test_prepared_rows_are_a_written_table(prepared):
    # stages read them several times: no hash of the split, no join of the filled flag is left to do
    plan = prepared[0].rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Relation" in plan and "Join" not in plan and "md5" not in plan and "Union" not in plan


def test_a_segments_filter_comes_before_the_line_items(table):
    from zerotally.operators.segments import segment

    plan = segment(table, "nonauto")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    outer = next(i for i, line in enumerate(plan) if "Join LeftOuter" in line)
    inner = next(i for i, line in enumerate(plan) if "Join Inner" in line)
    assert depth(plan[outer]) < depth(plan[inner]) and "NonAuto" in plan[inner]


def test_dummies_are_read_as_bits_and_sum_alike(prepared):
    from dataclasses import replace

    import numpy as np

    from zerotally.operators import newton as N

    encoded = encode_stage(prepared[1], "baseline")
    design = H.stage_design(encoded)
    dummies = {f.name for f in encoded.encoder.features if f.kind == "dummy"}
    assert dummies and set(design.packed) == dummies
    plain = replace(design, packed={}, found={})
    for a, b in ((design, plain), (design.narrowed(design.features[3:]), plain.narrowed(plain.features[3:])),
                 (design.filtered(F.col(N.Y) > 0), plain.filtered(F.col(N.Y) > 0))):
        one, two = N.survey(a), N.survey(b)
        assert np.allclose(one.gram, two.gram, rtol=1e-12, atol=1e-9) and np.allclose(one.with_y, two.with_y, rtol=1e-12, atol=1e-9)
        start = np.full(len(a.features) + 2, 0.01)
        for got, want in zip(N.evaluate(a, N.FAMILIES["nb"], start), N.evaluate(b, N.FAMILIES["nb"], start)):
            assert np.allclose(got, want, rtol=1e-9, atol=1e-9)


def test_more_dummies_than_one_word_holds(spark):
    from zerotally.operators import newton as N

    rows = [(float(i % 3), *[int(i % (j + 2) == 0) for j in range(130)]) for i in range(400)]
    names = [f"d{j}" for j in range(130)]
    df = spark.createDataFrame(rows, "y double, " + ", ".join(f"{n} tinyint" for n in names))
    design = N.make_design(df, names, "y", dummies=names)
    assert len({word for word, _ in design.packed.values()}) == 3
    assert N.survey(design).gram[0, 1:].tolist() == [float(sum(r[j + 1] for r in rows)) for j in range(130)]


def test_the_survey_of_zeros_needs_no_scan(spark, prepared):
    import numpy as np

    from zerotally.operators import newton as N

    design = H.stage_design(encode_stage(prepared[1], "baseline"))
    flagged = design.replaced(design.rows.withColumn(N.Y, F.when(F.col(N.Y) == 0, 1.0).otherwise(0.0)))
    derived, scanned = N.survey(design).of_zeros(), N.survey(flagged)
    for name in ("n", "sum_y", "bad", "other", "negative", "broken", "zero", "large", "with_y", "at_zero", "at_zero_all", "gram"):
        assert np.allclose(getattr(derived, name), getattr(scanned, name), rtol=1e-12, atol=1e-9), name


def test_the_policy_join_has_a_fixed_number_of_partitions(spark, table):
    from zerotally.operators.segments import segment

    lines = segment(table, "nonauto")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = next(i for i, line in enumerate(lines) if "RepartitionByExpression" in line)
    tasks = spark.conf.get("spark.sql.shuffle.partitions")
    assert lines[at].rstrip().endswith(tasks) or f", {tasks}" in lines[at]
    assert any("NonAuto" in line or "c_mktsegment" in line for line in lines[at + 1:])  # the filter is below
