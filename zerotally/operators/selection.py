"""Stepwise choice of logit features: candidates screened by score tests in one scan, the best refitted."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

from zerotally import fixed
from zerotally.operators.likelihood import FAMILIES, row_terms
from zerotally.operators.models import two_sided_p
from zerotally.operators.newton import MAX_STEPS, Design, NotConverged, checked, column_sums, newton_step, pack

#: Candidates whose score statistic reaches this share of the best are fitted and compared by their p-values.
NEAR_BEST = 0.8


@dataclass
class _Candidate:
    columns: np.ndarray
    params: np.ndarray
    ll: float = -math.inf
    grad: np.ndarray | None = None
    hess: np.ndarray | None = None
    step: np.ndarray | None = None
    done: bool = False


def _sums(design: Design, trial: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple]:
    """Value, gradient and Hessian of several logits, each on its own columns, in one scan."""
    logit = FAMILIES["logit"]
    sizes = [1 + len(b) + len(b) ** 2 for _, b in trial]

    def fold(x, y, w):
        parts = []
        for columns, b in trial:
            sub = x[:, columns]
            ll, d = row_terms(logit, y, sub @ b, None, 0.0)
            parts += [w @ ll, sub.T @ (w * d["z"]), sub.T @ (sub * (w * d["zz"])[:, None])]
        return pack(*parts)

    flat = column_sums(design, fold, sum(sizes))
    out, at = [], 0
    for (_, b), size in zip(trial, sizes):
        q = len(b)
        part = flat[at:at + size]
        out.append((part[0], part[1:1 + q], part[1 + q:].reshape(q, q)))
        at += size
    return out


def _fitted(design: Design, subsets: list[list[str]], starts: list[dict[str, float]] | None = None) -> list[_Candidate]:
    """The fit of every subset, all in the same scans; `starts` gives coefficients by feature ('' for the constant)."""
    place = {f: i + 1 for i, f in enumerate(design.features)}
    starts = starts or [{}] * len(subsets)
    fits = [_Candidate(np.array([0, *(place[f] for f in s)]), np.array([b.get(f, 0.0) for f in ("", *s)])) for s, b in zip(subsets, starts)]
    for c in fits:
        c.step = np.zeros_like(c.params)
    for _ in range(MAX_STEPS):
        active = [c for c in fits if not c.done]
        if not active:
            break
        for c, (ll, grad, hess) in zip(active, _sums(design, [(c.columns, c.params + c.step) for c in active])):
            if np.isfinite(ll) and ll >= c.ll - 1e-12 * (1 + abs(ll)):
                c.params = c.params + c.step
                c.ll, c.grad, c.hess = ll, grad, hess
                c.step = newton_step(grad, hess)
                c.done = float(grad @ c.step) <= max(1e-10, 1e-14 * abs(ll))
            else:
                c.step = c.step / 2
                c.done = np.abs(c.step).max() < 1e-12
    for c, names in zip(fits, subsets):
        if not c.done:
            raise NotConverged(f"logit on {', '.join(names)} stopped after {MAX_STEPS} steps without an optimum")
    return fits


def _p_values(fit: _Candidate, names: list[str]) -> dict[str, float]:
    scale = 1 / np.sqrt(np.maximum(np.abs(np.diag(fit.hess)), 1e-300))
    if np.linalg.cond(fit.hess * np.outer(scale, scale)) > 1e12:
        return {f: math.nan for f in names}
    se = np.sqrt(np.diag(np.linalg.inv(-fit.hess)))
    return {f: two_sided_p(float(b / s)) for f, b, s in zip(names, fit.params[1:], se[1:])}


def fit_logits(design: Design, subsets: list[list[str]]) -> list[dict[str, float]]:
    """p-values by feature for each subset; NaN where the columns are collinear."""
    return [_p_values(c, s) for c, s in zip(_fitted(design, subsets), subsets)]


def score_tests(design: Design, chosen: list[str], params: np.ndarray) -> dict[str, float]:
    """Score statistic (chi-square, 1 degree of freedom) of adding each other feature to the logit on `chosen` with these
    coefficients, all from one scan; NaN for a feature that the chosen ones explain.

    Sums are those of the chosen columns' information and, per other feature, its score, its own information and that with
    the chosen: as many as candidates times chosen ones, not the square of the candidates.
    """
    place = {f: i + 1 for i, f in enumerate(design.features)}
    inside = np.array([0, *(place[f] for f in chosen)])
    others = [f for f in design.features if f not in chosen]
    outside = np.array([place[f] for f in others], dtype=int)
    q, m = len(inside), len(outside)

    def fold(x, y, w):
        a, z = x[:, inside], x[:, outside]
        _, d = row_terms(FAMILIES["logit"], y, a @ params, None, 0.0)
        v = -w * d["zz"]
        return pack(a.T @ (a * v[:, None]), z.T @ (w * d["z"]), z.T @ (a * v[:, None]), v @ (z * z))

    flat = column_sums(design, fold, q * q + m + m * q + m)
    own, score, cross, self_ = np.split(flat, np.cumsum([q * q, m, m * q]))
    cross = cross.reshape(m, q)
    left = self_ - np.einsum("ij,ij->i", cross, np.linalg.solve(own.reshape(q, q), cross.T).T)
    found = np.where(left > 1e-9 * np.maximum(self_, 1e-300), score ** 2 / np.where(left > 0, left, 1), math.nan)
    return dict(zip(others, found.tolist()))


def stepwise_logit(design: Design, initial: list[str] | None = None, enter: float = fixed.ENTER_P,
                   leave: float = fixed.LEAVE_P) -> list[str]:
    """Add the strongest feature below `enter`, drop the weakest above `leave`, until neither.

    One scan per round screens all candidates by their score tests; only those near the best are fitted, from the
    coefficients so far, and compared by their p-values. The intercept always stays. A chosen set that is collinear, which
    only `initial` can bring in, is an error.
    """
    checked(design, "logit")
    if enter >= leave:
        raise ValueError("enter must be below leave, or the search may not end")
    chosen = list(initial or [])
    fit = _fitted(design, [chosen])[0]
    while True:
        changed = False
        held = dict(zip(["", *chosen], fit.params))
        if any(math.isnan(p) for p in _p_values(fit, chosen).values()):
            raise ValueError(f"collinear features: {', '.join(chosen)}")
        stats = {f: s for f, s in score_tests(design, chosen, fit.params).items() if s == s} if len(chosen) < len(design.features) else {}
        if stats:
            near = [f for f, s in stats.items() if s >= NEAR_BEST * max(stats.values())]
            sets = [[*chosen, f] for f in near]
            tried = _fitted(design, sets, [held] * len(sets))
            scored = [(p, i) for i, (c, s) in enumerate(zip(tried, sets)) if not math.isnan(p := _p_values(c, s)[s[-1]])]
            if scored and min(scored)[0] < enter:
                chosen, fit, changed = sets[min(scored)[1]], tried[min(scored)[1]], True
        if chosen:
            p_values = _p_values(fit, chosen)
            worst = max(chosen, key=lambda f: p_values[f])
            if p_values[worst] > leave:
                held = dict(zip(["", *chosen], fit.params))
                chosen = [f for f in chosen if f != worst]
                fit, changed = _fitted(design, [chosen], [held])[0], True
        if not changed:
            return chosen
