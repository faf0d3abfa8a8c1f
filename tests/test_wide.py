"""Sparse quasi-Newton fits against dense ones and against the totals that an optimum must meet."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from zerotally.operators import models
from zerotally.operators.encoder import fit_encoder
from zerotally.operators.newton import NotConverged, make_design
from zerotally.operators.wide import fit_wide, number_levels


def _rows(spark, n=3000, seed=1):
    rng = np.random.default_rng(seed)
    c, k, x = rng.integers(0, 12, n), rng.integers(0, 5, n), rng.normal(size=n) * 3 + 1
    eta = -0.4 + 0.1 * c - 0.2 * k + 0.15 * x
    hit, y = (rng.random(n) < 1 / (1 + np.exp(-eta))).astype(int), rng.poisson(np.exp(eta / 2))
    return spark.createDataFrame([(i, f"c{a:02d}", f"k{b}", float(v), int(h), int(m)) for i, (a, b, v, h, m) in enumerate(zip(c, k, x, hit, y))],
                                 "id long, c string, k string, x double, hit int, y int")


@pytest.mark.parametrize("family,y,dense", [("logit", "hit", models.fit_logit), ("poisson", "y", models.fit_poisson)])
def test_matches_the_dense_fit(spark, family, y, dense):
    df = _rows(spark)
    wide = fit_wide(df, ["c", "k"], ["x"], y, family)
    enc = fit_encoder(df.select("id", "x", "c", "k"), ["c", "k"], ["x"])
    design = make_design(enc.apply(df, [y]), enc.names, y)
    want = dense(design).part("count")
    got = {f"{r['Variable']}_{r['Level']}": r["coef"] for r in wide.levels.collect()}
    got |= {"const": wide.const, "x": wide.numeric["x"][2]}
    assert got.keys() == want.keys() and all(math.isclose(got[t], want[t], rel_tol=1e-4, abs_tol=1e-5) for t in want)
    scored = wide.predict(df).agg(F.sum("pred").alias("p"), F.sum(y).alias("a")).first()
    assert math.isclose(scored["p"], scored["a"], rel_tol=1e-6)


def test_twenty_thousand_levels_meet_their_totals(spark):
    n = 20_000
    # every level has rows of both kinds, in shares that differ
    df = (spark.range(n * 6).select(F.col("id"), F.concat(F.lit("L"), F.col("id") % n).alias("level"), (F.col("id") % 7).cast("string").alias("other"),
          F.when((F.col("id") / n).cast("int") <= F.col("id") % 5, 1).otherwise(0).alias("hit")))
    model = fit_wide(df, ["level", "other"], [], "hit")
    assert model.levels.count() == n - 1 + 6 and model.converged
    for c in ("level", "other"):
        gap = model.predict(df).groupBy(c).agg(F.abs(F.sum("pred") - F.sum("hit")).alias("d")).agg(F.max("d")).first()[0]
        assert gap < 1e-3


def test_nulls_unseen_levels_and_separation(spark):
    df = _rows(spark, 600).withColumn("c", F.when(F.col("id") % 50 != 0, F.col("c")))
    model = fit_wide(df, ["c"], [], "hit")
    new = spark.createDataFrame([("c00",), (None,), ("never",)], "c string")
    assert len({round(r["pred"], 9) for r in model.predict(new).collect()}) == 1
    apart = df.withColumn("hit", F.when(F.col("c") == "c03", 1).otherwise(F.col("hit")))
    with pytest.raises(NotConverged):
        fit_wide(apart.withColumn("hit", F.when(F.col("c") == "c03", 1).otherwise(0)), ["c"], [], "hit")
    levels, n = number_levels(df, ["c", "k"])
    assert n == 11 + 4 and sorted(r["at"] for r in levels.collect()) == list(range(n))
