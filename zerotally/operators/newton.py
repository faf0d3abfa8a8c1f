"""Distributed Newton steps: one scan per step, sums of gradient and Hessian per task.

Each task folds its Arrow batches into one array of sums; arrays are added up, in a middle step where there are many
tasks. The driver sees (number of parameters)^2 / 2 doubles per step and never a row.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zerotally.operators.likelihood import CLIP, FAMILIES, Family, count_terms, row_terms
from zerotally.workspace import materialise

MAX_STEPS = 100
EM_STEPS = 300
MAX_HALVINGS = 30
#: Task sums that are brought to the driver at once; more are added up in tasks first.
DIRECT_SUMS = 256
Y, WEIGHT, BITS = "_y", "_weight", "_bits"
WORD = 62  # 0/1 features in one whole number


class BadInput(ValueError):
    """The rows cannot be fitted as they are."""


class NotConverged(RuntimeError):
    """A fit did not reach an optimum; `model` is where it stopped."""

    def __init__(self, message: str, model=None):
        super().__init__(message)
        self.model = model


@dataclass(frozen=True)
class Design:
    """Materialised rows: the target `_y`, one column per feature and, where rows stand for several, `_weight`.

    Columns go by position, so that feature names may hold any character.
    """
    rows: DataFrame
    features: list[str]
    columns: dict[str, str]  # of each feature
    y: str
    weighted: bool = False
    packed: dict[str, tuple[str, int]] = field(default_factory=dict)  # of 0/1 features: a column of bits and the place in it
    found: dict = field(default_factory=dict, compare=False, repr=False)  # what scans have shown

    def narrowed(self, features: list[str]) -> "Design":
        have = self.found.get("survey")
        found = {k: v for k, v in self.found.items() if k != "survey"}
        if have is not None:
            found["survey"] = have.narrowed([self.features.index(f) for f in features])
        return Design(self.rows, features, self.columns, self.y, self.weighted, self.packed, found)

    def replaced(self, rows: DataFrame) -> "Design":
        """The same columns over other rows."""
        return Design(rows, self.features, self.columns, self.y, self.weighted, self.packed)

    def filtered(self, condition: Column) -> "Design":
        return self.replaced(self.rows.where(condition))

    def expressions(self) -> dict[str, Column]:
        return {f: F.col(self.columns[f]) for f in self.features}


def make_design(df: DataFrame, features: list[str], y: str, compress: bool = False, dummies: list[str] | None = None) -> Design:
    """Write the design once; with `compress`, equal rows become one row with a weight.

    Compression pays when the features take few distinct combinations, as dummies of a few
    categories do; the sums, and so the fit, stay the same. `dummies` names features that are 0 or 1 in every row; they
    are also written as bits of a few whole numbers, which is what the scans of the fits read.
    """
    columns = {f: f"x{i}" for i, f in enumerate(features)}
    narrow = df.select(*[F.col(f"`{f}`").cast("double").alias(c) for f, c in columns.items()],
                       F.col(f"`{y}`").cast("double").alias(Y))
    packed: dict[str, tuple[str, int]] = {}
    if compress:
        narrow = narrow.groupBy(*columns.values(), Y).agg(F.count(F.lit(1)).cast("double").alias(WEIGHT))
    elif dummies:
        packed = {f: (f"{BITS}{i // WORD}", i % WORD) for i, f in enumerate(dummies)}
        words: dict[str, list[Column]] = {}
        for f, (word, bit) in packed.items():
            words.setdefault(word, []).append(F.when(F.col(columns[f]) != 0, F.lit(1 << bit)).otherwise(F.lit(0)).cast("long"))
        narrow = narrow.select("*", *[reduce(lambda a, b: a.bitwiseOR(b), bits).alias(word) for word, bits in words.items()])
    return Design(materialise(narrow, "design"), features, columns, y, compress, packed)


def _matrix(batch: pa.RecordBatch, places: list[tuple[int, int | None]]) -> np.ndarray:
    """Constant 1 followed by the features, one row per record; a feature's place is its column and its bit, if it has one."""
    out = np.empty((len(places) + 1, batch.num_rows))  # a feature lies in one piece
    out[0] = 1.0
    words: dict[int, np.ndarray] = {}
    for i, (at, bit) in enumerate(places):
        if bit is None:
            out[i + 1] = batch.column(at).to_numpy(zero_copy_only=False)
        else:
            if at not in words:
                words[at] = batch.column(at).to_numpy(zero_copy_only=False)
            out[i + 1] = (words[at] >> bit) & 1
    return out.T


def _added(batches):
    """One row with the sum of all arrays."""
    total = None
    for batch in batches:
        for value in batch.column(0):
            part = value.values.to_numpy()
            total = part if total is None else total + part
    if total is not None:
        yield pa.RecordBatch.from_arrays([pa.array([total])], names=["sums"])


def column_sums(design: Design, fold: Callable[[np.ndarray, np.ndarray, np.ndarray], np.ndarray],
                size: int) -> np.ndarray:
    """Sum of `fold(X, y, weight)` over all batches, as one vector of the given size."""
    weighted, have = design.weighted, set(design.rows.columns)
    packed = {f: p for f, p in design.packed.items() if p[0] in have}
    names = list(dict.fromkeys(packed[f][0] if f in packed else design.columns[f] for f in design.features))
    places = [(names.index(packed[f][0]), packed[f][1]) if f in packed else (names.index(design.columns[f]), None) for f in design.features]
    n = len(names)

    def per_task(batches):
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                w = batch.column(n + 1).to_numpy() if weighted else np.ones(batch.num_rows)
                total += fold(_matrix(batch, places), batch.column(n).to_numpy(zero_copy_only=False), w)
        yield pa.RecordBatch.from_arrays([pa.array([total])], names=["sums"])

    rows = design.rows.select(*names, Y, *([WEIGHT] if weighted else []))
    if "tasks" not in design.found:
        design.found["tasks"] = rows.rdd.getNumPartitions()
    sums, tasks = rows.mapInArrow(per_task, "sums array<double>"), design.found["tasks"]
    while tasks > DIRECT_SUMS:
        tasks = math.isqrt(tasks)
        sums = sums.repartition(tasks).mapInArrow(_added, "sums array<double>")
    return np.sum([np.zeros(size), *[r["sums"] for r in sums.collect()]], axis=0)


def pack(*parts) -> np.ndarray:
    return np.concatenate([np.atleast_1d(p).ravel() for p in parts])


@dataclass(frozen=True)
class Survey:
    """Weighted sums over one scan of a design; features by place."""
    n: float
    sum_y: float
    bad: np.ndarray       # rows that are NULL, NaN or infinite, per feature, the target last
    other: np.ndarray     # rows that are neither 0 nor 1, per feature
    negative: float       # rows with y < 0, y not whole, y = 0, y > 1
    broken: float
    zero: float
    large: float
    with_y: np.ndarray    # sum of x y and of x over y = 0, per feature
    at_zero: np.ndarray
    at_zero_all: float    # weight of the rows with y = 0
    gram: np.ndarray      # of the constant and the features

    def narrowed(self, at: list[int]) -> "Survey":
        g = [0, *(i + 1 for i in at)]
        return Survey(self.n, self.sum_y, self.bad[[*at, -1]], self.other[at], self.negative, self.broken, self.zero,
                      self.large, self.with_y[at], self.at_zero[at], self.at_zero_all, self.gram[np.ix_(g, g)])

    def of_zeros(self) -> "Survey":
        """The survey of the same rows, unweighted and all finite, with the target 1 where it was 0, else 0."""
        return Survey(self.n, self.at_zero_all, self.bad, self.other, 0.0, 0.0, self.n - self.zero, 0.0, self.at_zero,
                      self.gram[0, 1:] - self.at_zero, self.n - self.at_zero_all, self.gram)


def survey(design: Design) -> Survey:
    """What one scan shows of the design; kept with it and with designs narrowed from it."""
    if "survey" in design.found:
        return design.found["survey"]
    p = len(design.features)

    def fold(x, y, w):
        finite = np.isfinite(x)
        bad = [*(~finite[:, 1:]).sum(0), (~np.isfinite(y)).sum()]
        other = ((x[:, 1:] != 0) & (x[:, 1:] != 1)).sum(0)
        x, y = np.where(finite, x, 0.0), np.where(np.isfinite(y), y, 0.0)
        return pack(w.sum(), w @ y, bad, other, (y < 0).sum(), (y != np.floor(y)).sum(), (y == 0).sum(), (y > 1).sum(),
                    (w * y) @ x[:, 1:], (w * (y == 0)) @ x[:, 1:], w @ (y == 0), (x * w[:, None]).T @ x)

    sums = column_sums(design, fold, 8 + 4 * p + (p + 1) ** 2)
    sizes = [1, 1, p + 1, p, 1, 1, 1, 1, p, p, 1, (p + 1) ** 2]
    parts = np.split(sums, np.cumsum(sizes)[:-1])
    one = lambda i: float(parts[i][0])
    made = Survey(one(0), one(1), parts[2], parts[3], one(4), one(5), one(6), one(7), parts[8], parts[9],
                  one(10), parts[11].reshape(p + 1, p + 1))
    design.found["survey"] = made
    return made


def checked(design: Design, family_name: str) -> Survey:
    """The survey, or `BadInput` naming the columns and numbers of rows that the family cannot take."""
    s, family = survey(design), FAMILIES[family_name]
    wrong = [f"{c}: {int(k)} rows NULL or not finite" for c, k in zip([*design.features, design.y], s.bad) if k]
    if family.eta:
        wrong += [f"{design.y}: {int(k)} rows {what}" for what, k in (
            ("below 0", s.negative), ("not whole", s.broken), ("0, which truncation rules out", s.zero * family.truncated)) if k]
    elif s.negative or s.broken or s.large:
        wrong.append(f"{design.y}: rows other than 0 and 1")
    if not s.n:
        wrong.append("no rows")
    if wrong:
        raise BadInput(f"{family_name} fit: " + "; ".join(wrong))
    return s


def separated_features(design: Design, family_name: str) -> list[str]:
    """0/1 features with a side whose target has no spread that the family can fit: no positive count, or no zero where
    a logistic part must explain zeros. Their coefficients have no finite optimum."""
    s, family = survey(design), FAMILIES[family_name]
    ones, out = s.gram[0, 1:], []
    for i, f in enumerate(design.features):
        sides = ((ones[i], s.with_y[i], s.at_zero[i]), (s.n - ones[i], s.sum_y - s.with_y[i], s.at_zero_all - s.at_zero[i]))
        flat = any(n > 0 and ((y == 0 and not family.truncated) or (zero == 0 and family.zeta)) for n, y, zero in sides)
        if not s.other[i] and flat:
            out.append(f)
    return out


def independent_features(design: Design, tolerance: float = 1e-9) -> list[str]:
    """Features left after dropping, from the left, those the constant and earlier ones explain."""
    gram = survey(design).gram
    scale = np.sqrt(np.maximum(np.diag(gram), 1e-300))
    rest = gram / np.outer(scale, scale)
    kept = []
    for j in range(len(gram)):
        left = rest[j, j]
        if left > tolerance:
            if j:
                kept.append(design.features[j - 1])
            rest = rest - np.outer(rest[:, j], rest[j, :]) / left
    return kept


def _completed(family: Family, d: dict[str, np.ndarray], y: np.ndarray, zeta: np.ndarray, eta: np.ndarray, theta: float) -> None:
    """Put the second derivatives of the expected complete likelihood, in which every extra zero is known by its share,
    in place of the observed ones. The first derivatives of both agree."""
    pi = 1 / (1 + np.exp(-np.clip(zeta, -CLIP, CLIP)))
    counted = np.where(y == 0, 1 - (d["z"] + pi), 1.0)  # share of a row that the count part explains
    _, own = row_terms(FAMILIES["nb" if family.dispersed else "poisson"], y, None, eta, theta)
    d["zz"] = -pi * (1 - pi) * (np.abs(zeta) < CLIP)
    for k in ("ee", "et", "tt"):
        if k in d:
            d[k] = counted * own[k]
    for k in ("ze", "zt"):
        if k in d:
            d[k] = np.zeros_like(pi)


def evaluate(design: Design, family: Family, params: np.ndarray, complete: bool = False):
    """Log likelihood, gradient and Hessian at `params` = (gamma, beta, log alpha); with `complete` the Hessian of the
    expected complete likelihood of a zero-inflated model."""
    p = len(design.features) + 1
    parts = [k for k, on in (("z", family.zeta), ("e", family.eta)) if on]
    size = p * len(parts) + family.dispersed
    theta = float(params[-1]) if family.dispersed else 0.0
    coefs = {k: params[i * p:(i + 1) * p] for i, k in enumerate(parts)}

    def fold(x, y, w):
        ll, d = row_terms(family, y, x @ coefs["z"] if "z" in coefs else None,
                          x @ coefs["e"] if "e" in coefs else None, theta)
        if complete:
            _completed(family, d, y, x @ coefs["z"], x @ coefs["e"], theta)
        grad, hess = np.zeros(size), np.zeros((size, size))
        for i, a in enumerate(parts):
            rows = slice(i * p, (i + 1) * p)
            grad[rows] = x.T @ (w * d[a])
            hess[rows, rows] = x.T @ (x * (w * d[a + a])[:, None])
            if i == 0 and len(parts) == 2:
                hess[:p, p:2 * p] = x.T @ (x * (w * d["ze"])[:, None])
            if family.dispersed:
                hess[rows, -1] = x.T @ (w * d[a + "t"])
        value = w @ ll
        if family.dispersed:
            grad[-1], hess[-1, -1] = w @ d["t"], w @ d["tt"]
        if family.eta:
            more, first, second = count_terms(y, w, theta if family.dispersed else None)
            value += more
            if family.dispersed:
                grad[-1] += first
                hess[-1, -1] += second
        return pack(value, grad, hess[np.triu_indices(size)])

    sums = column_sums(design, fold, 1 + size + size * (size + 1) // 2)
    ll, grad = sums[0], sums[1:1 + size].copy()
    hess = np.zeros((size, size))
    hess[np.triu_indices(size)] = sums[1 + size:]
    hess = hess + np.triu(hess, 1).T
    return ll, grad, hess


def newton_step(grad: np.ndarray, hess: np.ndarray) -> np.ndarray:
    """Ascent step with the curvature made positive definite where it is not."""
    scale = 1 / np.sqrt(np.maximum(np.abs(np.diag(hess)), 1e-12))
    value, vector = np.linalg.eigh(-hess * np.outer(scale, scale))
    value = np.maximum(np.abs(value), 1e-8 * max(np.abs(value).max(), 1e-12))
    return scale * (vector @ ((vector.T @ (scale * grad)) / value))


@dataclass(frozen=True)
class Optimum:
    params: np.ndarray
    loglik: float
    gradient: np.ndarray
    hessian: np.ndarray
    steps: int
    converged: bool


def maximise(design: Design, family_name: str, start: np.ndarray, free: slice = slice(None)) -> Optimum:
    """Newton ascent with step halving until the predicted gain is negligible. Where that stops short in a zero-inflated
    model, steps of expectation and maximisation take over, which cannot overshoot, and Newton steps end the fit.
    Parameters that are not `free` stay where they start."""
    family = FAMILIES[family_name]
    found = _ascend(design, family, np.asarray(start, float), MAX_STEPS, free=free)
    if found.converged or not (family.zeta and family.eta):
        return found
    eased = _ascend(design, family, found.params, EM_STEPS, complete=True)
    last = _ascend(design, family, eased.params, MAX_STEPS)
    steps = found.steps + eased.steps + last.steps
    return replace(last if last.converged or last.loglik > eased.loglik else eased, steps=steps, converged=last.converged)


def _ascend(design: Design, family: Family, params: np.ndarray, most: int, complete: bool = False,
            free: slice = slice(None)) -> Optimum:
    """Steps of the (complete) information's inverse times the score; each is halved until the likelihood does not fall."""
    ll, grad, hess = evaluate(design, family, params, complete)
    for taken in range(1, most + 1):
        step = np.zeros_like(grad)
        step[free] = newton_step(grad[free], hess[free, free])
        longest = np.abs(step).max()
        if longest > 5.0:
            step = step * (5.0 / longest)
        gain = float(grad @ step)
        slack = 1e-12 * (1 + abs(ll))
        for _ in range(MAX_HALVINGS):
            new = evaluate(design, family, params + step, complete)
            if np.isfinite(new[0]) and new[0] >= ll - slack:
                break
            step = step / 2
        else:
            return Optimum(params, ll, grad, hess, taken, gain <= 1e-6 * (1 + abs(ll)))
        params, (ll, grad, hess) = params + step, new
        if gain <= max(1e-9, 1e-13 * abs(ll)):
            return Optimum(params, ll, grad, hess, taken, True)
    return Optimum(params, ll, grad, hess, most, False)
