import math

from pyspark.sql import functions as F

from zerotally.functions import scalars as S


def _one(spark, column, schema="x double", value=None):
    return spark.createDataFrame([(value,)], schema).select(column.alias("v")).first()["v"]


def test_log_cap_is_base_ten_and_null_becomes_the_cap(spark):
    assert _one(spark, S.log_cap("x", 40), value=9.0) == 1.0
    assert _one(spark, S.log_cap("x", 99), value=500.0) == 2.0
    assert _one(spark, S.log_cap("x", 99)) == 2.0
    assert math.isclose(_one(spark, S.natural_log_cap("x", 40), value=9.0), math.log(10))


def test_grid_bin_rounds_half_to_even(spark):
    got = [_one(spark, S.grid_bin("x", 5), value=v) for v in (12.5, 17.5, 12.6, 2.5, 0.0)]
    assert got == [10, 20, 15, 0, 0]
    assert _one(spark, S.grid_bin("x", 5, 40), value=77.0) == 40
    assert _one(spark, S.grid_bin("x", 5, 40)) == 40
    assert _one(spark, S.grid_bin("x", 5)) is None


def test_hinges(spark):
    low, high = S.hinge("x", 2, 4)
    for x, want in ((1, (1, 0)), (2, (2, 0)), (3, (2, 1)), (9, (2, 2))):
        row = spark.createDataFrame([(x,)], "x int").select(low.alias("a"), high.alias("b")).first()
        assert tuple(row) == want
    low, high = S.log_hinge("x", 300, 500)
    row = spark.createDataFrame([(399,)], "x int").select(low.alias("a"), high.alias("b")).first()
    assert math.isclose(row["a"], math.log10(301)) and row["b"] == 2.0


def test_indicator_and_categories_with_null(spark):
    assert _one(spark, S.indicator(F.col("x") == "a"), "x string") == 0
    assert _one(spark, S.category_text("x"), "x int") == "<NA>"
    assert [_one(spark, S.known_flag("x"), "x int", v) for v in (-2, -1, 0, 1, 7, None)] == [
        None, -1, 0, 1, None, None]
