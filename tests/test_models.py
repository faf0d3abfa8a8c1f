import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from zerotally.operators import models
from zerotally.operators.likelihood import FAMILIES
from zerotally.operators.newton import BadInput, NotConverged, evaluate, independent_features, make_design, maximise
from zerotally.operators.selection import fit_logits, score_tests, stepwise_logit

BETA, GAMMA, ALPHA, N = (0.9, 0.4, -0.5), (-0.3, 0.6, 0.2), 0.7, 20_000


def _simulated(seed=11, n=N):
    rng = np.random.default_rng(seed)
    x1, x2 = rng.normal(size=n), (rng.random(n) < 0.4).astype(float)
    mu = np.exp(BETA[0] + BETA[1] * x1 + BETA[2] * x2)
    nb = rng.negative_binomial(1 / ALPHA, 1 / (1 + ALPHA * mu))
    poisson = rng.poisson(mu)
    off = rng.random(n) < 1 / (1 + np.exp(-(GAMMA[0] + GAMMA[1] * x1 + GAMMA[2] * x2)))
    return {"x1": x1, "x2": x2, "nb": nb, "poisson": poisson, "zip": np.where(off, 0, poisson),
            "zinb": np.where(off, 0, nb), "hit": off.astype(int)}


@pytest.fixture(scope="module")
def sim(spark):
    import pandas as pd
    return spark.createDataFrame(pd.DataFrame(_simulated())).repartition(5)


def _close(model, part, truth, wide=5.0):
    for c, t in zip([c for c in model.coefficients if c.part == part], truth):
        assert abs(c.coef - t) < wide * c.se, (c, t)


def _design(sim, y, where=None):
    return make_design(sim if where is None else sim.where(where), ["x1", "x2"], y)


def test_poisson_and_logit(sim):
    model = models.fit_poisson(_design(sim, "poisson"))
    _close(model, "count", BETA)
    model = models.fit_logit(_design(sim, "hit"))
    _close(model, "count", GAMMA)
    assert all(math.isclose(c.p, math.erfc(abs(c.coef / c.se) / math.sqrt(2))) for c in model.coefficients)


@pytest.mark.parametrize("family,y,fit", [("poisson", "poisson", models.fit_poisson), ("logit", "hit", models.fit_logit)])
def test_glm_and_newton_agree(sim, family, y, fit):
    design = _design(sim, y)
    glm = fit(design)
    best = maximise(design, family, np.zeros(3))
    assert best.converged
    assert np.allclose([c.coef for c in glm.coefficients], best.params, atol=1e-8)
    assert math.isclose(glm.loglik, best.loglik, rel_tol=1e-10)
    se = np.sqrt(np.diag(np.linalg.inv(-best.hessian)))
    assert np.allclose([c.se for c in glm.coefficients], se, rtol=1e-5)


@pytest.mark.parametrize("y,fit,where", [("nb", models.fit_nb, None), ("nb", models.fit_ztnb, "nb > 0")])
def test_dispersed_models_recover_parameters(sim, y, fit, where):
    model = fit(_design(sim, y, where))
    assert model.converged and model.k == 4
    _close(model, "count", BETA)
    assert abs(model.alpha - ALPHA) < 0.1


def test_inflated_models_recover_parameters(sim):
    model = models.fit_zip(_design(sim, "zip"))
    assert model.converged and model.k == 6
    _close(model, "count", BETA)
    _close(model, "inflate", GAMMA)
    model = models.fit_zinb(_design(sim, "zinb"))
    assert model.converged and model.k == 7
    _close(model, "count", BETA)
    _close(model, "inflate", GAMMA)
    assert abs(model.alpha - ALPHA) < 0.15


def test_weighted_rows_give_the_same_fit(sim):
    rows = sim.select(F.round("x1").alias("x1"), "x2", "zinb", "hit")
    plain, packed = (make_design(rows, ["x1", "x2"], "zinb", compress=c) for c in (False, True))
    a, b = models.fit_zinb(plain), models.fit_zinb(packed)
    assert packed.rows.count() < 2000 and a.n == b.n == N
    assert np.allclose([c.coef for c in a.coefficients], [c.coef for c in b.coefficients], atol=1e-6)
    a, b = (models.fit_logit(make_design(rows, ["x1", "x2"], "hit", compress=c)) for c in (False, True))
    assert np.allclose([(c.coef, c.se) for c in a.coefficients], [(c.coef, c.se) for c in b.coefficients], atol=1e-7)
    assert math.isclose(a.loglik, b.loglik, rel_tol=1e-10)


@pytest.mark.parametrize("parts", [1, 17])
def test_fit_does_not_depend_on_partitions(sim, parts):
    base = models.fit_ztnb(_design(sim, "nb", "nb > 0"))
    other = models.fit_ztnb(make_design(sim.where("nb > 0").repartition(parts), ["x1", "x2"], "nb"))
    assert np.allclose([c.coef for c in base.coefficients], [c.coef for c in other.coefficients], atol=1e-8)


def test_collinear_columns_are_dropped_from_the_right(sim):
    rows = sim.withColumns({"again": F.col("x1") * 2 - F.col("x2"), "flat": F.lit(3.0)})
    design = make_design(rows, ["x1", "x2", "flat", "again"], "hit")
    assert independent_features(design) == ["x1", "x2"]
    model = models.fit_logit(design)
    assert model.dropped == ["flat", "again"] and len(model.coefficients) == 3
    assert models.fit_nb(make_design(rows, ["flat", "x1", "again"], "nb")).dropped == ["flat"]


def test_raw_scale_logit_equals_the_plain_one(sim):
    rows = sim.withColumn("big", F.col("x1") * 1000 + 50)
    design = make_design(rows, ["big", "x2"], "hit")
    a, b = models.fit_logit(design), models.fit_logit_unscaled(design)
    assert np.allclose([(c.coef, c.se) for c in a.coefficients], [(c.coef, c.se) for c in b.coefficients], rtol=1e-6)


def test_constrained_logit_fixes_weak_coefficients_at_zero(sim):
    rows = sim.withColumns({"noise": F.rand(3), "noise2": F.randn(4)})
    design = make_design(rows, ["x1", "noise", "x2", "noise2"], "hit")
    full = models.fit_logit(design)
    held = models.fit_logit_constrained(design, full, 0.001)
    weak = [c.term for c in full.coefficients if c.p > 0.001]
    assert {"noise", "noise2"} <= set(weak)
    assert [c.term for c in held.coefficients] == [c.term for c in full.coefficients]
    assert all((c.coef == 0) == (c.term in weak) for c in held.coefficients)


def test_predictions(spark, sim):
    for name, y, where in (("ztnb", "nb", "nb > 0"), ("zinb", "zinb", None), ("zip", "zip", None)):
        design = _design(sim, y, where)
        model = getattr(models, f"fit_{name}")(design)
        p = {(c.part, c.term): c.coef for c in model.coefficients}
        row = spark.createDataFrame([(0.5, 1.0)], "x1 double, x2 double").select(model.predict().alias("v")).first()
        line = lambda part: p[part, "const"] + 0.5 * p[part, "x1"] + p[part, "x2"]
        mu = math.exp(line("count"))
        want = (mu / (1 - (1 + model.alpha * mu) ** (-1 / model.alpha)) if name == "ztnb"
                else mu / (1 + math.exp(line("inflate"))))
        assert math.isclose(row["v"], want, rel_tol=1e-12)


def test_save_and_load(spark, sim, tmp_path):
    model = models.fit_nb(_design(sim, "nb"))
    model.save(spark, str(tmp_path / "m"))
    assert models.Model.load(spark, str(tmp_path / "m")) == model


def test_stepwise_finds_the_planted_features(sim):
    rows = sim.withColumns({"n1": F.rand(5), "n2": F.randn(6), "copy": F.col("x1") * 3})
    design = make_design(rows, ["n1", "x2", "n2", "x1"], "hit")
    assert sorted(stepwise_logit(design)) == ["x1", "x2"]
    assert sorted(stepwise_logit(design, initial=["n1", "x2"])) == ["x1", "x2"]
    batched = fit_logits(design, [["x1", "x2"], ["n1"]])
    alone = models.fit_logit(design.narrowed(["x1", "x2"]))
    assert all(math.isclose(batched[0][c.term], c.p, rel_tol=1e-4) for c in alone.coefficients[1:])
    doubled = make_design(rows, ["x1", "copy"], "hit")
    assert all(math.isnan(p) for p in fit_logits(doubled, [["x1", "copy"]])[0].values())
    with pytest.raises(ValueError):
        stepwise_logit(design, enter=0.1, leave=0.05)


@pytest.mark.parametrize("name,expr,fits,says", [
    ("x1", "if(n = 3, null, x1)", ["poisson", "nb", "zip", "logit"], "x1: 1 rows NULL"),
    ("x1", "if(n = 3, double('nan'), x1)", ["poisson", "logit"], "x1: 1 rows NULL"),
    ("x2", "if(n < 2, double('inf'), x2)", ["nb"], "x2: 2 rows NULL"),
    ("y", "if(n = 3, null, y)", ["poisson", "zinb", "logit"], "y: 1 rows NULL"),
    ("y", "y + if(n = 3, 0.5, 0)", ["poisson", "nb", "zip", "zinb", "logit"], "y: "),
    ("y", "if(n = 3, -1, y)", ["poisson", "nb", "logit"], "y: "),
    ("y", "y", ["ztnb"], "truncation rules out"),
    ("y", "if(n = 3, 2, y)", ["logit"], "other than 0 and 1"),
])
def test_rows_that_cannot_be_fitted_are_named(spark, name, expr, fits, says):
    rows = spark.range(60).selectExpr("id as n", "cast(id % 7 as double) as x1", "cast(id % 2 as double) as x2", "cast(id % 3 = 0 as double) as y")
    for fit in fits:
        with pytest.raises(BadInput, match=says):
            getattr(models, f"fit_{fit}")(make_design(rows.withColumn(name, F.expr(expr)), ["x1", "x2"], "y"))


def test_a_fit_without_an_optimum_is_an_error_unless_allowed(spark):
    rows = spark.range(80).selectExpr("cast(id % 2 as double) as half", "cast(id % 5 = 0 as double) as level",
                                      "if(id % 5 = 0, 1, cast(id % 3 = 0 as int)) as hit", "if(id % 5 = 0, 0, cast(id % 4 as int)) as calls")
    logit, poisson = make_design(rows, ["half", "level"], "hit"), make_design(rows, ["half", "level"], "calls")
    for fit, design in ((models.fit_logit, logit), (models.fit_poisson, poisson), (models.fit_nb, poisson)):
        with pytest.raises(NotConverged, match="level") as error:
            fit(design)
        assert error.value.model.separated == ["level"]
        kept = fit(design, allow_unconverged=True)
        assert not kept.converged and kept.separated == ["level"]
    with pytest.raises(NotConverged, match="every target is 0"):
        models.fit_logit(make_design(rows.withColumn("hit", F.lit(0)), ["half"], "hit"))


def test_feature_names_with_dots_and_blanks(spark, sim):
    names = ["g_d.1", "a b", "x.y.z"]
    rows = sim.select(F.col("x1").alias(names[0]), F.col("x2").alias(names[1]), F.rand(2).alias(names[2]), "nb", "hit")
    plain = models.fit_logit(_design(sim, "hit"))
    for design in (make_design(rows, names, "hit"), make_design(rows, names, "hit").narrowed(names[:2])):
        model = models.fit_logit(design)
        assert [c.term for c in model.coefficients] == ["const", *design.features]
        mean = rows.select(model.predict().alias("p"), "hit").agg(F.avg("p").alias("p"), F.avg("hit").alias("h")).first()
        assert math.isclose(mean["p"], mean["h"], rel_tol=1e-6)
    assert np.allclose([c.coef for c in model.coefficients], [c.coef for c in plain.coefficients], atol=1e-8)
    assert models.fit_nb(make_design(rows, names, "nb")).converged


def test_many_distinct_and_large_counts_need_no_histogram(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=3000)
    y = rng.poisson(np.exp(13 + 0.3 * x))
    rows = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "x double, y int")
    model = models.fit_poisson(make_design(rows, ["x"], "y"))
    assert np.allclose([c.coef for c in model.coefficients], [13, 0.3], atol=1e-3)


def test_one_scan_serves_all_fits_of_a_design(spark, sim):
    design = _design(sim, "zip")
    models.fit_poisson(design)
    seen = design.found["survey"]
    models.fit_zip(design)
    assert design.found["survey"] is seen
    sub = design.narrowed(["x2"])
    alone = make_design(sim, ["x2"], "zip")
    from zerotally.operators.newton import survey
    a, b = survey(sub), survey(alone)
    assert np.allclose(a.gram, b.gram) and np.allclose(a.with_y, b.with_y) and np.allclose(a.at_zero, b.at_zero)


def test_bounds_hold_in_fit_and_prediction_alike(spark):
    model = models.Model("poisson", [models.Coefficient("count", "const", 0.0, 1, 0, 1), models.Coefficient("count", "x", 1.0, 1, 0, 1)],
                         0.0, 2, 1, 0, True, [])
    rows = spark.createDataFrame([(50.0, 3), (-50.0, 0)], "x double, y int")
    got = [r["p"] for r in rows.select(model.predict().alias("p")).collect()]
    assert np.allclose(got, [math.exp(30), math.exp(-30)])
    value = models.log_likelihood(model, make_design(rows, ["x"], "y"))
    assert math.isclose(value, 3 * 30 - math.exp(30) - math.log(6) - math.exp(-30), rel_tol=1e-12)


def test_score_tests_match_plain_sums(spark):
    rng = np.random.default_rng(31)
    x = rng.normal(size=(600, 4))
    y = (rng.random(600) < 1 / (1 + np.exp(-(0.3 + x[:, 0])))).astype(int)
    rows = spark.createDataFrame([(*map(float, r), int(v)) for r, v in zip(np.column_stack([x, 2 * x[:, 0]]), y)], "a double, b double, c double, e double, twin double, y int")
    design = make_design(rows, ["a", "b", "c", "e", "twin"], "y")
    fit = models.fit_logit(design.narrowed(["a"]))
    params = np.array([c.coef for c in fit.coefficients])
    got = score_tests(design, ["a"], params)
    base = np.column_stack([np.ones(600), x[:, 0]])
    p = 1 / (1 + np.exp(-(base @ params)))
    w = p * (1 - p)
    for j, name in ((1, "b"), (2, "c"), (3, "e")):
        z = x[:, j]
        cross = base.T @ (w * z)
        left = z @ (w * z) - cross @ np.linalg.solve(base.T @ (base * w[:, None]), cross)
        assert math.isclose(got[name], (z @ (y - p)) ** 2 / left, rel_tol=1e-7)
    assert set(got) == {"b", "c", "e", "twin"} and math.isnan(got["twin"])


def test_constrained_errors_come_from_all_coefficients(sim):
    rows = sim.withColumns({"noise": F.rand(3), "noise2": F.randn(4)})
    design = make_design(rows, ["x1", "noise", "x2", "noise2"], "hit")
    full = models.fit_logit(design)
    held = models.fit_logit_constrained(design, full, 0.001)
    at = np.array([c.coef for c in held.coefficients])
    _, grad, hess = evaluate(design, FAMILIES["logit"], at)
    assert np.allclose([c.se for c in held.coefficients], np.sqrt(np.diag(np.linalg.inv(-hess))))
    zero = [i for i, b in enumerate(at) if b == 0]
    assert zero and all(held.coefficients[i].p == 1.0 for i in zero)
    tests = models.multiplier_tests(design, full, held)
    assert set(tests) == {held.coefficients[i].term for i in zero}
    one = zero[0]
    free = [i for i in range(len(at)) if i not in zero]
    left = -hess[np.ix_(zero, zero)] + hess[np.ix_(zero, free)] @ np.linalg.solve(hess[np.ix_(free, free)], hess[np.ix_(free, zero)])
    want = models.two_sided_p(grad[one] / math.sqrt(np.diag(left)[0]))
    assert math.isclose(tests[held.coefficients[one].term][1], want, rel_tol=1e-6)


@pytest.mark.parametrize("family,y", [("zip", "zip"), ("zinb", "zinb")])
def test_expectation_steps_take_over_where_newton_stops(sim, monkeypatch, family, y):
    import zerotally.operators.newton as newton

    design = _design(sim, y)
    fitted = getattr(models, f"fit_{family}")(design)
    want = newton.maximise(design, family, np.array([math.log(c.coef) if c.term == "alpha" else c.coef for c in fitted.coefficients]))
    seen, inner = [], newton.evaluate
    def watched(d, f, p, complete=False):
        out = inner(d, f, p, complete)
        seen.append((complete, out[0]))
        return out
    monkeypatch.setattr(newton, "evaluate", watched)
    far = np.full(len(want.params), 0.0)
    far[0] = 6.0  # nearly all zeros taken as extra ones
    alone = newton._ascend(design, FAMILIES[family], far, newton.EM_STEPS, complete=True)
    assert all(c for c, _ in seen)
    monkeypatch.setattr(newton, "MAX_STEPS", 8)
    found = newton.maximise(design, family, alone.params)
    assert found.converged and math.isclose(found.loglik, want.loglik, rel_tol=1e-9) and np.allclose(found.params, want.params, atol=1e-4)


def test_expectation_steps_never_lower_the_likelihood(sim):
    import zerotally.operators.newton as newton

    design, params, values = _design(sim, "zip"), np.array([4.0, 0.0, 0.0, -2.0, 0.0, 0.0]), []
    for _ in range(12):
        found = newton._ascend(design, FAMILIES["zip"], params, 1, complete=True)
        params = found.params
        values.append(found.loglik)
    assert all(b >= a - 1e-9 * abs(a) for a, b in zip(values, values[1:])) and values[-1] > values[0]


def test_information_of_the_complete_likelihood(spark):
    """The score is the observed one; the information is that of the two parts, each weighted by its share."""
    rng = np.random.default_rng(41)
    x, y = rng.normal(size=200), rng.poisson(1.5, 200) * (rng.random(200) < 0.6)
    design = make_design(spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "x double, y int"), ["x"], "y")
    params = np.array([0.2, -0.3, 0.4, 0.1])
    ll, grad, hess = evaluate(design, FAMILIES["zip"], params, complete=True)
    ll2, grad2, _ = evaluate(design, FAMILIES["zip"], params)
    a = np.column_stack([np.ones(200), x])
    pi, mu = 1 / (1 + np.exp(-(a @ params[:2]))), np.exp(a @ params[2:])
    share = np.where(y == 0, pi / (pi + (1 - pi) * np.exp(-mu)), 0)
    assert ll == ll2 and np.allclose(grad, grad2)
    assert np.allclose(hess[:2, :2], -(a * (pi * (1 - pi))[:, None]).T @ a) and np.allclose(hess[:2, 2:], 0)
    assert np.allclose(hess[2:, 2:], -(a * ((1 - share) * mu)[:, None]).T @ a)


def test_fits_hold_no_copy_of_the_rows_in_memory(spark, sim, monkeypatch):
    """Three fits of a baseline comparison ran side by side, each over a cached copy of all rows."""
    from pyspark.sql import DataFrame
    import zerotally.operators.newton as newton

    held, inner = [], newton.evaluate
    def watched(*args, **kw):
        held.append(spark.sparkContext._jsc.getPersistentRDDs().size())
        return inner(*args, **kw)
    def refused(self, *args, **kw):
        raise AssertionError("rows are cached")
    monkeypatch.setattr(newton, "evaluate", watched)
    monkeypatch.setattr(DataFrame, "persist", refused)
    monkeypatch.setattr(DataFrame, "cache", refused)
    models.zi_warm_start(_design(sim, "zip"))
    assert models.fit_poisson(_design(sim, "zip")).converged
    assert held and not any(held)


@pytest.mark.parametrize("family,y,fit", [("poisson", "poisson", models.fit_poisson), ("logit", "hit", models.fit_logit)])
def test_glm_and_spark_ml_agree(sim, family, y, fit):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GeneralizedLinearRegression

    rows = VectorAssembler(inputCols=["x1", "x2"], outputCol="x").transform(sim)
    want = GeneralizedLinearRegression(family="binomial" if family == "logit" else family, featuresCol="x", labelCol=y, tol=1e-10).fit(rows)
    errors = want.summary.coefficientStandardErrors
    got = fit(_design(sim, y))
    assert got.converged
    assert np.allclose([c.coef for c in got.coefficients], [want.intercept, *want.coefficients], atol=1e-7)
    assert np.allclose([c.se for c in got.coefficients], [errors[-1], *errors[:-1]], rtol=1e-5)


def test_a_logit_without_an_intercept_is_at_its_own_optimum(sim):
    design = _design(sim, "hit")
    full = models.fit_logit(design)
    shifted = models.replace(full, coefficients=[models.replace(c, p=1.0 if c.term == "const" else 0.0) for c in full.coefficients])
    held = models.fit_logit_constrained(design, shifted, 0.5)
    at = np.array([c.coef for c in held.coefficients])
    _, grad, _ = evaluate(design, FAMILIES["logit"], at)
    assert at[0] == 0.0 and abs(grad[0]) > 1 and np.allclose(grad[1:], 0, atol=1e-4)
