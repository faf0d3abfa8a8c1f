"""Fits on designs of very many dummies: sparse rows and a limited-memory quasi-Newton search.

A row holds the numbers of its levels and its numeric values; nothing of the size of (columns)^2 exists anywhere. Each step is
one scan: tasks fold their rows into a gradient and the diagonal of the information, arrays of which are added up in tasks
before the driver sees one pair of vectors. Levels are numbered by a join, so a vocabulary of any size may stand in it.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zerotally.functions.scalars import sigmoid
from zerotally.operators.encoder import scaling, training_levels
from zerotally.operators.likelihood import CLIP, FAMILIES, row_terms
from zerotally.operators.newton import DIRECT_SUMS, NotConverged, _added
from zerotally.workspace import materialise

MEMORY = 20
MAX_STEPS = 500
MAX_HALVINGS = 40


@dataclass(frozen=True)
class WideModel:
    """A logit or Poisson model: `levels` (Variable, Level, coef), the numeric coefficients on the scaled columns, and the
    constant. The base of a variable is its lowest level in text order, as is any level that the fit did not see."""
    family: str
    levels: DataFrame
    numeric: dict[str, tuple[float, float, float]]  # mean, sd, coefficient
    const: float
    loglik: float
    steps: int
    converged: bool
    separated: int  # levels whose rows all agree, so that their coefficients have no finite optimum

    def predict(self, df: DataFrame, out: str = "pred") -> DataFrame:
        """Add the expected value; one join per nominal column with the coefficients of its levels."""
        eta: Column = F.lit(self.const)
        for c, (mean, sd, coef) in self.numeric.items():
            eta = eta + F.lit(coef) * (F.col(f"`{c}`") - F.lit(mean)) / F.lit(sd)
        columns = df.columns
        for i, (variable,) in enumerate(self.levels.select("Variable").distinct().orderBy("Variable").collect()):
            own = self.levels.where(F.col("Variable") == variable).select(F.col("Level").alias(f"_level{i}"), F.col("coef").alias(f"_coef{i}"))
            df = df.join(own, F.col(f"`{variable}`").cast("string") == F.col(f"_level{i}"), "left")
            eta = eta + F.coalesce(f"_coef{i}", F.lit(0.0))
        eta = F.greatest(F.least(eta, F.lit(CLIP)), F.lit(-CLIP))
        value = sigmoid(eta) if self.family == "logit" else F.exp(eta)
        return df.select(*[F.col(f"`{c}`") for c in columns], value.alias(out))


def number_levels(df: DataFrame, nominal: list[str]) -> tuple[DataFrame, int]:
    """(Variable, Level, at): every level but the base of its variable, numbered from 0, and how many there are."""
    found = materialise(training_levels(df, nominal), "levels")
    lowest = found.groupBy("Variable").agg(F.min("Level").alias("_base"))
    kept = found.join(lowest, "Variable").where(F.col("Level") != F.col("_base")).select("Variable", "Level")
    # places within a variable, then one offset per variable: no window over all levels
    inside = kept.withColumn("_in", F.row_number().over(Window.partitionBy("Variable").orderBy("Level")) - 1)
    sizes = sorted((r["Variable"], r["count"]) for r in kept.groupBy("Variable").count().collect())
    offset, total = F.lit(0), 0
    for variable, n in sizes:
        offset, total = F.when(F.col("Variable") == variable, total).otherwise(offset), total + n
    return materialise(inside.select("Variable", "Level", (F.col("_in") + offset).cast("int").alias("at")), "numbered"), total


def sparse_rows(df: DataFrame, levels: DataFrame, nominal: list[str], scales: dict[str, tuple[float, float]], y: str) -> DataFrame:
    """`y`, the numeric values, the numbers of the row's levels and how many rows agree in all of these."""
    values = [((F.col(f"`{c}`") - F.lit(m)) / F.lit(s)).cast("double") for c, (m, s) in scales.items()]
    rows = df.select(F.col(f"`{y}`").cast("double").alias("y"), F.array(*values).cast("array<double>").alias("x"),
                     *[F.col(f"`{c}`").cast("string").alias(f"_n{i}") for i, c in enumerate(nominal)])
    for i, c in enumerate(nominal):
        own = levels.where(F.col("Variable") == c).select(F.col("Level").alias(f"_l{i}"), F.col("at").alias(f"_at{i}"))
        rows = rows.join(own, F.col(f"_n{i}") == F.col(f"_l{i}"), "left")
    held = F.array_compact(F.array(*[F.col(f"_at{i}") for i in range(len(nominal))])).cast("array<int>")
    return rows.select("y", "x", held.alias("at")).groupBy("y", "x", "at").agg(F.count(F.lit(1)).cast("double").alias("w"))


def _evaluate(rows: DataFrame, tasks: int, family_name: str, params: np.ndarray, m: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Log likelihood without the terms in y alone, its gradient, and the diagonal of the information."""
    family, p = FAMILIES[family_name], len(params)
    kind = "z" if family.zeta else "e"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + 2 * p)
        for batch in batches:
            if not batch.num_rows:
                continue
            y, w = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 3))
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(len(y), m)
            at = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(y)), batch.column(2).value_lengths().to_numpy(zero_copy_only=False))
            eta = params[0] + x @ params[1:1 + m] + np.bincount(row, params[1 + m + at], len(y))
            ll, d = row_terms(family, y, eta if kind == "z" else None, eta if kind == "e" else None, 0.0)
            for start, g in ((1, w * d[kind]), (1 + p, -w * d[kind + kind])):
                total[start] += g.sum()
                total[start + 1:start + 1 + m] += g @ (x if start == 1 else x * x)
                total[start + 1 + m:start + p] += np.bincount(at, g[row], p - 1 - m)
            total[0] += w @ ll
        yield pa.RecordBatch.from_arrays([pa.array([total])], names=["sums"])

    sums, left = rows.mapInArrow(run, "sums array<double>"), tasks
    while left > DIRECT_SUMS:
        left = math.isqrt(left)
        sums = sums.repartition(left).mapInArrow(_added, "sums array<double>")
    total = np.zeros(1 + 2 * p)
    for r in sums.toLocalIterator():
        total += np.array(r["sums"])
    return total[0], total[1:1 + p], total[1 + p:]


def _direction(grad: np.ndarray, diagonal: np.ndarray, pairs: deque) -> np.ndarray:
    """Ascent direction of the two-loop recursion, started from the inverse of the diagonal."""
    q, kept = grad.copy(), []
    for s, t in reversed(pairs):
        rho = 1 / (t @ s)
        alpha = rho * (s @ q)
        q -= alpha * t
        kept.append((rho, alpha, s, t))
    q /= np.maximum(diagonal, 1e-8)
    for rho, alpha, s, t in reversed(kept):
        q += s * (alpha - rho * (t @ q))
    return q


def fit_wide(df: DataFrame, nominal: list[str], numeric: list[str], y: str, family: str = "logit",
             allow_unconverged: bool = False) -> WideModel:
    """Fit `family` ('logit' or 'poisson') on dummies of all levels and the standardised numeric columns.

    NULL levels count as the base. The likelihood rises with every step; the search ends where the gain that the diagonal
    promises is negligible. A level whose rows all agree has no finite optimum, and its fit ends as not converged.
    """
    if family not in ("logit", "poisson"):
        raise ValueError("family is 'logit' or 'poisson'")
    levels, n_levels = number_levels(df, nominal)
    scales, m = scaling(df, numeric), len(numeric)
    rows = materialise(sparse_rows(df, levels, nominal, scales, y), "sparse")
    tasks = rows.rdd.getNumPartitions()
    params, pairs = np.zeros(1 + m + n_levels), deque(maxlen=MEMORY)
    ll, grad, info = _evaluate(rows, tasks, family, params, m)
    done, taken = False, 0
    for taken in range(1, MAX_STEPS + 1):
        step = _direction(grad, info, pairs)
        if step @ grad <= 0:
            pairs.clear()
            step = grad / np.maximum(info, 1e-8)
        step *= min(1.0, 5.0 / max(np.abs(step).max(), 1e-300))
        for _ in range(MAX_HALVINGS):
            new = _evaluate(rows, tasks, family, params + step, m)
            if np.isfinite(new[0]) and new[0] >= ll + 1e-4 * (step @ grad) - 1e-12 * (1 + abs(ll)):
                break
            step = step / 2
        else:
            break
        change = grad - new[1]
        if change @ step > 1e-12 * np.sqrt((change @ change) * (step @ step)):
            pairs.append((step, change))
        params = params + step
        ll, grad, info = new
        if float((grad * grad / np.maximum(info, 1e-8)).sum()) <= max(1e-12, 1e-16 * abs(ll)):
            done = True
            break
    spark, each = df.sparkSession, rows.select(F.explode("at").alias("at"), "w", (F.col("w") * F.col("y")).alias("wy"))
    sums = each.groupBy("at").agg(F.sum("w").alias("w"), F.sum("wy").alias("wy"))
    apart = sums.where((F.col("wy") == 0) | (F.lit(family == "logit") & (F.col("wy") == F.col("w")))).count()
    numbered = spark.createDataFrame([(i, float(b)) for i, b in enumerate(params[1 + m:])], "at int, coef double")
    coefs = materialise(levels.join(numbered, "at").select("Variable", "Level", "coef"), "coefficients")
    model = WideModel(family, coefs, {c: (*scales[c], float(params[1 + i])) for i, c in enumerate(numeric)}, float(params[0]), float(ll), taken, done and not apart, apart)
    if not model.converged and not allow_unconverged:
        why = f"; {apart} levels have no finite optimum" if apart else ""
        raise NotConverged(f"{family} fit on {n_levels} levels stopped after {taken} steps without an optimum{why}", model)
    return model
