import pytest
import math

from zerotally.operators.encoder import Encoder, fit_encoder, scaling


def _train(spark):
    rows = [(1, "b", 2, 1.0, 5.0), (2, "c", -1, 3.0, 5.0), (3, "a", 10, 8.0, 5.0), (4, None, 2, 8.0, 5.0)]
    return spark.createDataFrame(rows, "id long, t string, n int, x double, flat double")


def test_order_names_and_base_levels(spark):
    enc = fit_encoder(_train(spark), ["t", "n"], ["x", "flat"])
    assert enc.names == ["x", "flat", "t_b", "t_c", "n_2", "n_10"]
    everything = fit_encoder(_train(spark), ["t"], [], drop_first=False)
    assert everything.names == ["n", "x", "flat", "t_a", "t_b", "t_c"]


def test_population_sd_and_constant_column(spark):
    scale = scaling(_train(spark), ["x", "flat"])
    assert math.isclose(scale["x"][1], math.sqrt(sum((v - 5) ** 2 for v in (1, 3, 8, 8)) / 4))
    assert scale["flat"] == (5.0, 1.0)


def test_base_stays_frozen_and_unseen_levels_are_all_zero(spark):
    enc = fit_encoder(_train(spark), ["t"], [])
    new = spark.createDataFrame([(1, "b", 0, 0.0, 0.0), (2, "zz", 0, 0.0, 0.0), (3, None, 0, 0.0, 0.0)],
                                "id long, t string, n int, x double, flat double")
    got = {r["id"]: (r["t_b"], r["t_c"]) for r in enc.apply(new).collect()}
    # no row holds the base level 'a', and 'b' must not take its place
    assert got == {1: (1, 0), 2: (0, 0), 3: (0, 0)}


def test_missing_source_counts_as_zero_before_scaling(spark):
    enc = fit_encoder(_train(spark), ["t"], ["x"])
    mean, sd = scaling(_train(spark), ["x"])["x"]
    row = enc.apply(_train(spark).drop("x", "t")).first()
    assert math.isclose(row["x"], -mean / sd) and row["t_b"] == 0


def test_round_trip(spark, tmp_path):
    enc = fit_encoder(_train(spark), ["t", "n"], ["x"])
    enc.save(spark, str(tmp_path / "enc"))
    assert Encoder.load(spark, str(tmp_path / "enc")) == enc


def test_too_many_levels_name_their_column(spark):
    df = spark.range(50).selectExpr("id", "cast(id as string) as wide", "cast(id % 2 as string) as g")
    with pytest.raises(ValueError, match="wide about"):
        fit_encoder(df, ["wide", "g"], [], max_levels=20)
    assert len(fit_encoder(df, ["wide", "g"], [], max_levels=52).names) == 50


def test_levels_with_dots_reach_the_fit(spark):
    rows = spark.range(90).selectExpr("id", "concat('d.', id % 3) as `g`", "cast((id * 7) % 5 as double) as x", "cast(id % 2 as int) as y")
    enc = fit_encoder(rows.select("id", "x", "g"), ["g"], ["x"])
    assert enc.names == ["x", "g_d.1", "g_d.2"]
    from zerotally.operators.models import fit_logit
    from zerotally.operators.newton import make_design
    encoded = enc.apply(rows, ["id", "y"])
    model = fit_logit(make_design(encoded, enc.names, "y"))
    mean = encoded.select(model.predict().alias("p"), "y").agg({"p": "avg", "y": "avg"}).first()
    assert abs(mean[0] - mean[1]) < 1e-8
