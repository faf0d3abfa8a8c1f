import glob

import pytest
from pyspark.sql import functions as F

from zerotally import fixed
from zerotally.operators.segments import both_segments, positives, segment, segment_counts, union_samples
from zerotally.sources import csv_files, tables
from zerotally.workspace import shared_dir


def _csv(tmp_path, rows):
    names = [*fixed.POLICY_COLUMNS, fixed.TARGET]
    base = dict.fromkeys(names, "1")
    lines = [",".join(names)]
    for row in rows:
        lines.append(",".join(f'"{v}"' if v == "" else v for v in {**base, **row}.values()))
    path = tmp_path / "policies.csv"
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def test_every_null_token_is_null_and_missing_is_a_level(spark, tmp_path):
    rows = [{"id": str(i), "acq_method": t} for i, t in enumerate([*fixed.NULL_TOKENS, "missing"])]
    df = csv_files.cast_policies(csv_files.read_policies_csv(spark, _csv(tmp_path, rows)), True)
    got = {r["id"]: r["acq_method"] for r in df.select("id", "acq_method").collect()}
    assert len(fixed.NULL_TOKENS) == 19
    assert [got[i] for i in range(20)] == [None] * 19 + ["missing"]


def test_int_columns_take_decimals_wide_ids_and_refuse_text(spark, tmp_path):
    path = _csv(tmp_path, [{"id": "9007199254740993", "trm_len_mo": "12.0", "ann_prm_amt": "9.5"}])
    row = csv_files.cast_policies(csv_files.read_policies_csv(spark, path), True).first()
    assert (row["id"], row["trm_len_mo"], row["ann_prm_amt"]) == (9007199254740993, 12, 9.5)
    bad = csv_files.read_policies_csv(spark, _csv(tmp_path, [{"trm_len_mo": "twelve"}]))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        csv_files.cast_policies(bad, True).collect()


def test_prediction_files_are_in_id_order(spark, tmp_path):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("id"), F.lit(1.5).alias("call_counts"))
    path = str(tmp_path / "out")
    csv_files.write_predictions(df.repartition(7), path)
    ids = []
    for part in sorted(glob.glob(f"{path}/part-*")):
        ids += [int(line.split(",")[0]) for line in open(part).read().splitlines()[1:]]
    assert ids == list(range(5000))


def test_segments_drop_contradictions_and_nulls(spark):
    rows = [(1, "Grp1", 0), (2, "NonAuto", -2), (3, "NonAuto", 1), (4, "Grp1", -2), (5, None, 0), (6, "Grp2", None)]
    df = spark.createDataFrame(rows, "id int, bi_limit_group string, telematics_ind int")
    df = df.withColumns({c: F.lit("x") for c in ("trm_len_mo", "channel", "newest_veh_age")})
    assert [r["id"] for r in segment(df, "auto").collect()] == [1]
    assert [r["id"] for r in segment(df, "nonauto").collect()] == [2]
    assert "channel" not in segment(df, "auto").columns
    assert {r["segment"]: r["n"] for r in segment_counts(df).collect()} == {"Auto": 1, "NonAuto": 1, "Neither": 4}


def test_positives_and_samples(spark):
    df = spark.createDataFrame([(1, 0), (2, 3), (3, None)], "id int, call_counts int")
    assert [r["id"] for r in positives(df).collect()] == [2]
    both = union_samples(df, df.where("id = 1"))
    assert sorted((r["id"], r["Sample"]) for r in both.collect()) == [
        (1, "Train"), (1, "Val"), (2, "Train"), (3, "Train")]


def test_tables_replace_load_list_and_drop(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "id int, t string")
    tables.save_table(df.select("id"), "zt_table")
    tables.save_table(df, "zt_table", add_id=True)
    assert "zt_table" in tables.list_tables(spark)
    loaded = tables.load_table(spark, "zt_table", ["t"])
    assert loaded.columns == ["id", "row_id"]
    assert sorted(map(tuple, loaded.collect())) == [(1, 0), (2, 1), (3, 2)]
    tables.drop_table(spark, "zt_table")
    assert "zt_table" not in tables.list_tables(spark)
    tables.register(df, "zt_view")
    assert spark.sql("SELECT count(*) FROM zt_view").first()[0] == 3
    assert tables.unregister(spark, "zt_view")


def test_scratch_space_follows_the_session(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")


def test_contradictory_markers_are_in_no_segment(spark):
    rows = [(1, "Grp1", 0), (2, "NonAuto", -2), (3, "Grp1", -2), (4, "NonAuto", 1), (5, None, 0), (6, "Grp2", None)]
    df = spark.createDataFrame(rows, "id int, bi_limit_group string, telematics_ind int")
    assert {(r["id"], r["segment"]) for r in both_segments(df).collect()} == {(1, "Auto"), (2, "NonAuto")}
