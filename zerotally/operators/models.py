"""Fitting, inference, prediction and persistence of the count and binary models."""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zerotally.functions.scalars import sigmoid
from zerotally.operators.likelihood import CLIP, FAMILIES
from zerotally.operators.newton import (MAX_STEPS, WEIGHT, Y, Design, NotConverged, Optimum, Survey, checked, evaluate,
                                        independent_features, maximise, newton_step, separated_features)
from zerotally.workspace import materialise, together

CONST, ALPHA = "const", "alpha"
GLM_STEPS = MAX_STEPS
MAX_GLM_COLUMNS = 4096
_COEF_SCHEMA = "pos int, part string, term string, coef double, se double, z double, p double"
_STAT_SCHEMA = ("family string, loglik double, k int, aic double, n double, steps int, "
                "converged boolean, dropped array<string>, separated array<string>")


@dataclass(frozen=True)
class Coefficient:
    part: str       # 'count', 'inflate' or 'dispersion'
    term: str
    coef: float
    se: float
    z: float
    p: float


@dataclass(frozen=True)
class Model:
    family: str
    coefficients: list[Coefficient]
    loglik: float
    k: int
    n: float
    steps: int
    converged: bool
    dropped: list[str]                                     # collinear with the constant and features before them
    separated: list[str] = field(default_factory=list)     # without a finite optimum

    @property
    def aic(self) -> float:
        return 2 * self.k - 2 * self.loglik

    def part(self, name: str) -> dict[str, float]:
        return {c.term: c.coef for c in self.coefficients if c.part == name}

    @property
    def alpha(self) -> float | None:
        return self.part("dispersion").get(ALPHA)

    def coefficient_frame(self, spark: SparkSession) -> DataFrame:
        rows = [(i, c.part, c.term, c.coef, c.se, c.z, c.p) for i, c in enumerate(self.coefficients)]
        return spark.createDataFrame(rows, _COEF_SCHEMA)

    def statistics_frame(self, spark: SparkSession) -> DataFrame:
        row = (self.family, self.loglik, self.k, self.aic, self.n, self.steps, self.converged, self.dropped,
               self.separated)
        return spark.createDataFrame([row], _STAT_SCHEMA)

    def save(self, spark: SparkSession, path: str) -> None:
        self.coefficient_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/coefficients")
        self.statistics_frame(spark).coalesce(1).write.mode("overwrite").parquet(f"{path}/statistics")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "Model":
        rows = sorted(spark.read.parquet(f"{path}/coefficients").collect(), key=lambda r: r["pos"])
        s = spark.read.parquet(f"{path}/statistics").first()
        return Model(s["family"], [Coefficient(*r[1:]) for r in rows], s["loglik"], s["k"], s["n"],
                     s["steps"], s["converged"], list(s["dropped"]), list(s["separated"]))

    # -- prediction as plain column arithmetic --------------------------------------------

    def linear(self, part: str, columns: dict[str, Column] | None = None) -> Column:
        """Intercept plus coefficient times column, held within the bounds that hold in the fit; `columns` overrides
        names by expressions."""
        columns = columns or {}
        terms = [F.lit(b) if t == CONST else F.lit(b) * columns.get(t, F.col(f"`{t}`"))
                 for t, b in self.part(part).items()]
        return F.greatest(F.least(reduce(lambda a, b: a + b, terms), F.lit(CLIP)), F.lit(-CLIP))

    def predict(self, columns: dict[str, Column] | None = None) -> Column:
        """Expected value: exp(eta), the probability, the truncated mean or (1 - pi) mu."""
        if self.family == "logit":
            return sigmoid(self.linear("count", columns))
        mu = F.exp(self.linear("count", columns))
        if self.family == "ztnb":
            alpha = F.lit(self.alpha)
            return mu / -F.expm1(-F.log1p(alpha * mu) / alpha)
        if FAMILIES[self.family].zeta:
            return mu * sigmoid(-self.linear("inflate", columns))
        return mu


def two_sided_p(z: float) -> float:
    return math.erfc(abs(z) / math.sqrt(2)) if z == z else math.nan


def _coefficient(part: str, term: str, coef: float, variance: float) -> Coefficient:
    se = math.sqrt(variance) if variance > 0 else math.nan
    z = float(coef) / se if se else math.nan
    return Coefficient(part, term, float(coef), se, z, two_sided_p(z))


# -- generalised linear models ----------------------------------------------------------------

def _run_glm(design: Design, family: str, keep: list[str], seen: Survey, intercept: bool) -> tuple[list[Coefficient], Optimum]:
    """Coefficients and optimum of Newton steps, which with the canonical link are those of reweighted least squares.

    They start at the target's mean and read the written design on every step; no copy of its rows is held in memory.
    """
    if len(keep) > MAX_GLM_COLUMNS:
        raise ValueError(f"{len(keep)} columns are more than one Hessian is kept for ({MAX_GLM_COLUMNS}); wide.fit_wide fits them")
    free = slice(0 if intercept else 1, None)
    start = np.zeros(len(keep) + 1)
    if intercept:
        start[0] = _intercept_only(family, seen)[0].coef
    best = maximise(design.narrowed(keep), family, start, free)
    terms = [CONST, *keep][free]
    variance = np.diag(_inverse(-best.hessian[free, free]))
    return [_coefficient("count", t, b, v) for t, b, v in zip(terms, best.params[free], variance)], best


def _intercept_only(family: str, seen: Survey) -> list[Coefficient]:
    n, mean = seen.n, seen.sum_y / seen.n
    if family == "poisson":
        return [_coefficient("count", CONST, math.log(mean), 1 / (n * mean))]
    return [_coefficient("count", CONST, math.log(mean / (1 - mean)), 1 / (n * mean * (1 - mean)))]


def _settled(model: Model, allow: bool) -> Model:
    """The model, or `NotConverged` if it is not at an optimum and that is not allowed."""
    if model.converged or allow:
        return model
    why = f"; without a finite optimum: {', '.join(model.separated)}" if model.separated else ""
    raise NotConverged(f"{model.family} fit stopped after {model.steps} steps without an optimum{why}", model)


def _value_at(model: Model, design: Design):
    """Log likelihood, gradient and Hessian of a Poisson or logit model at its coefficients, the constant first."""
    have = model.part("count")
    keep = [t for t in have if t != CONST]
    params = np.array([have.get(CONST, 0.0), *[have[t] for t in keep]])
    return evaluate(design.narrowed(keep), FAMILIES[model.family], params)


def _fit_glm(design: Design, family: str, keep: list[str], seen: Survey, intercept: bool = True,
             allow: bool = False) -> Model:
    flat = seen.sum_y == 0 or (family == "logit" and seen.sum_y == seen.n)
    if flat:
        raise NotConverged(f"{family} fit: every target is {0 if seen.sum_y == 0 else 1}")
    free = slice(0 if intercept else 1, None)
    if keep:
        coefs, best = _run_glm(design, family, keep, seen, intercept)
        steps, value, grad, hess = best.steps, best.loglik, best.gradient, best.hessian
    elif intercept:
        coefs, steps = _intercept_only(family, seen), 0
        value, grad, hess = evaluate(design.narrowed([]), FAMILIES[family], np.array([coefs[0].coef]))
    else:
        raise ValueError("no coefficient is left to fit")
    apart = separated_features(design.narrowed(keep), family)
    gain = float(grad[free] @ newton_step(grad[free], hess[free, free]))
    done = bool(np.isfinite(value) and steps < GLM_STEPS and gain <= max(1e-6, 1e-9 * abs(value)) and not apart)
    return _settled(Model(family, coefs, float(value), len(coefs), seen.n, steps, done,
                          [f for f in design.features if f not in keep], apart), allow)


def log_likelihood(model: Model, design: Design) -> float:
    """Sum of row log likelihoods of a Poisson or logit model."""
    return float(_value_at(model, design)[0])


def fit_poisson(design: Design, allow_unconverged: bool = False) -> Model:
    seen = checked(design, "poisson")
    return _fit_glm(design, "poisson", independent_features(design), seen, allow=allow_unconverged)


def fit_logit(design: Design, allow_unconverged: bool = False) -> Model:
    seen = checked(design, "logit")
    return _fit_glm(design, "logit", independent_features(design), seen, allow=allow_unconverged)


# -- models Spark ML does not have ------------------------------------------------------------

def _from_optimum(family_name: str, design: Design, best: Optimum, features: list[str], n: float, allow: bool) -> Model:
    family = FAMILIES[family_name]
    names = [CONST, *features]
    labels = [(part, t) for part in (["inflate"] if family.zeta and family.eta else []) + ["count"]
              for t in names]
    params, curvature = best.params.copy(), best.hessian.copy()
    if family.dispersed:
        # at the optimum the Hessian in alpha is the one in log alpha over alpha^2
        params[-1] = math.exp(params[-1])
        curvature[-1, :] /= params[-1]
        curvature[:, -1] /= params[-1]
        labels.append(("dispersion", ALPHA))
    try:
        variance = np.diag(np.linalg.inv(-curvature))
    except np.linalg.LinAlgError:
        variance = np.full(len(params), math.nan)
    coefs = [_coefficient(part, t, b, v) for (part, t), b, v in zip(labels, params, variance)]
    apart = separated_features(design.narrowed(features), family_name)
    return _settled(Model(family_name, coefs, float(best.loglik), len(params), n, best.steps, best.converged and not apart,
                          [f for f in design.features if f not in features], apart), allow)


def _start(model: Model) -> np.ndarray:
    return np.array([c.coef for c in model.coefficients])


def _dispersed_start(seen: Survey, keep: list[str]) -> np.ndarray:
    """Intercept at the log mean, no slopes, alpha 1: a few extra steps replace a Poisson fit."""
    return np.r_[math.log(max(seen.sum_y / seen.n, 1e-8)), np.zeros(len(keep)), 0.0]


def _fit_dispersed(design: Design, family: str, allow: bool) -> Model:
    seen, keep = checked(design, family), independent_features(design)
    best = maximise(design.narrowed(keep), family, _dispersed_start(seen, keep))
    return _from_optimum(family, design, best, keep, seen.n, allow)


def fit_nb(design: Design, allow_unconverged: bool = False) -> Model:
    """Negative binomial, variance mu + alpha mu^2, alpha fitted jointly."""
    return _fit_dispersed(design, "nb", allow_unconverged)


def fit_ztnb(design: Design, allow_unconverged: bool = False) -> Model:
    """Zero-truncated negative binomial; the rows must all have y > 0."""
    return _fit_dispersed(design, "ztnb", allow_unconverged)


def zi_warm_start(design: Design, allow_unconverged: bool = False) -> tuple[Model, Model]:
    """Logit of y == 0 on all rows, Poisson on the positive rows."""
    seen = checked(design, "poisson")
    flagged = design.replaced(design.rows.withColumn(Y, F.when(F.col(Y) == 0, 1.0).otherwise(0.0)))
    if not design.weighted:
        flagged.found["survey"] = seen.of_zeros()  # no scan of its own
    zero_fit, count_fit = together(
        design.rows.sparkSession, lambda: fit_logit(flagged, allow_unconverged),
        lambda: fit_poisson(design.filtered(F.col(Y) > 0), allow_unconverged))
    return zero_fit, count_fit


def _fit_inflated(design: Design, family: str, warm: tuple[Model, Model] | None, allow: bool) -> Model:
    seen, keep = checked(design, family), independent_features(design)
    inflate, count = warm or zi_warm_start(design.narrowed(keep), allow_unconverged=True)  # only where to start
    zeta, eta = inflate.part("count"), count.part("count")
    start = [zeta.get(t, 0.0) for t in (CONST, *keep)] + [eta.get(t, 0.0) for t in (CONST, *keep)]
    if family == "zinb":
        start.append(0.0)   # log alpha, alpha = 1
    best = maximise(design.narrowed(keep), family, np.array(start))
    return _from_optimum(family, design, best, keep, seen.n, allow)


def fit_zip(design: Design, warm: tuple[Model, Model] | None = None, allow_unconverged: bool = False) -> Model:
    """Zero-inflated Poisson, both parts on the same features."""
    return _fit_inflated(design, "zip", warm, allow_unconverged)


def fit_zinb(design: Design, warm: tuple[Model, Model] | None = None, allow_unconverged: bool = False) -> Model:
    """Zero-inflated negative binomial, both parts on the same features."""
    return _fit_inflated(design, "zinb", warm, allow_unconverged)


# -- variants of the logit --------------------------------------------------------------------

def fit_logit_unscaled(design: Design, allow_unconverged: bool = False) -> Model:
    """Logit on raw-scale columns: non-binary ones are divided by their sd for the fit only.

    Scaling a column scales its coefficient and error by the inverse, so mapping both back
    gives the optimum on the original scale.
    """
    seen = checked(design, "logit")
    mean = seen.gram[0, 1:] / seen.n
    var = (np.diag(seen.gram)[1:] - seen.n * mean ** 2) / max(1.0, seen.n - 1)
    sd = {f: 1.0 if not seen.other[i] or var[i] <= 0 else math.sqrt(var[i]) for i, f in enumerate(design.features)}
    columns = [(F.col(c) / sd[f]).alias(c) for f, c in design.columns.items() if f in sd]
    scaled = design.rows.select(*columns, Y, *([WEIGHT] if design.weighted else []))
    fit = fit_logit(design.replaced(materialise(scaled, "scaled")), allow_unconverged)
    back = [replace(c, coef=c.coef / sd.get(c.term, 1.0), se=c.se / sd.get(c.term, 1.0))
            for c in fit.coefficients]
    return replace(fit, coefficients=back)


def fit_logit_constrained(design: Design, fitted: Model, threshold: float, allow_unconverged: bool = False) -> Model:
    """Coefficients whose p-value exceeds the threshold are held at 0, the others refitted.

    Holding a coefficient at 0 is the fit without its column. A weak intercept is held too. Errors come from the information
    of all coefficients at the constrained optimum, those held among them, whose z is 0 and p 1; `multiplier_tests` asks
    whether the data would move them.
    """
    weak = {c.term for c in fitted.coefficients if c.p > threshold}
    keep = [c.term for c in fitted.coefficients if c.term not in weak and c.term != CONST]
    refit = _fit_glm(design, "logit", keep, checked(design, "logit"), CONST not in weak, allow_unconverged)
    terms, params, _, hess = _at_constrained(design, fitted, refit)
    variance = np.diag(_inverse(-hess))
    return replace(refit, coefficients=[_coefficient("count", t, b, v) for t, b, v in zip(terms, params, variance)])


def multiplier_tests(design: Design, fitted: Model, constrained: Model) -> dict[str, tuple[float, float]]:
    """Per held coefficient its Lagrange multiplier and the p-value that it is 0, from the bordered system of the
    information and the constraints."""
    terms, params, grad, hess = _at_constrained(design, fitted, constrained)
    held = [i for i, b in enumerate(params) if b == 0.0]
    n, m = len(terms), len(held)
    bordered = np.zeros((n + m, n + m))
    bordered[:n, :n] = -hess
    bordered[[n + k for k in range(m)], held] = bordered[held, [n + k for k in range(m)]] = 1.0
    # the block that belongs to the multipliers is minus the information that is left in the held coefficients
    left = -np.diag(_inverse(bordered))[n:]
    return {terms[i]: (float(grad[i]), two_sided_p(float(grad[i]) / math.sqrt(v)) if v > 0 else math.nan) for i, v in zip(held, left)}


def _at_constrained(design: Design, fitted: Model, constrained: Model) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Terms, coefficients, score and Hessian of all of the fitted model's terms at the constrained optimum."""
    names = [c.term for c in fitted.coefficients if c.term != CONST]
    have = constrained.part("count")
    params = np.array([have.get(t, 0.0) for t in (CONST, *names)])
    _, grad, hess = evaluate(design.narrowed(names), FAMILIES["logit"], params)
    return [CONST, *names], params, grad, hess


def _inverse(matrix: np.ndarray) -> np.ndarray:
    try:
        return np.linalg.inv(matrix)
    except np.linalg.LinAlgError:
        return np.full(matrix.shape, math.nan)
