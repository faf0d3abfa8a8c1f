"""Row likelihoods of the count models with first and second derivatives.

Every model is written in two linear predictors: eta for the count mean, zeta for the extra
zeros (or, for the logit, alone). The probability of a zero count is exp(-s), so truncation
and inflation need only s and its derivatives. Terms in y alone are left to `count_terms`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

# linear predictors are held within this in fits, likelihoods and predictions alike; beyond it they are constant
CLIP = 30.0


@dataclass(frozen=True)
class Family:
    name: str
    zeta: bool        # has a logistic part
    eta: bool         # has a count part
    dispersed: bool   # negative binomial, variance mu + alpha mu^2
    truncated: bool = False


FAMILIES = {f.name: f for f in (
    Family("logit", True, False, False),
    Family("poisson", False, True, False),
    Family("nb", False, True, True),
    Family("ztnb", False, True, True, truncated=True),
    Family("zip", True, True, False),
    Family("zinb", True, True, True),
)}


def _series(z: np.ndarray, direct: np.ndarray, *coefs: float) -> np.ndarray:
    """A closed form that cancels near 0, replaced there by its power series."""
    return np.where(z < 1e-4, np.polynomial.polynomial.polyval(z, coefs), direct)


def _zero_exponent(mu: np.ndarray, alpha: float):
    """s = -log P(0) with derivatives in eta and theta = log alpha: s, e, ee, t, tt, et."""
    z = alpha * mu
    d, log = 1 + z, np.log1p(z)
    safe = np.maximum(z, 1e-300)
    first = _series(z, log / safe, 1.0, -1 / 2, 1 / 3)
    with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
        second = _series(z, (log - z / d) / safe**2, 1 / 2, -2 / 3, 3 / 4)
        third = _series(z, (2 * log - 2 * z / d - (z / d) ** 2) / safe**3, 2 / 3, -3 / 2, 12 / 5)
    in_alpha = -mu**2 * second
    return (mu * first, mu / d, mu / d**2, alpha * in_alpha,
            alpha**2 * mu**3 * third + alpha * in_alpha, -z * mu / d**2)


def row_terms(family: Family, y: np.ndarray, zeta: np.ndarray | None, eta: np.ndarray | None,
              theta: float):
    """Log likelihood per row and its derivatives by name ('z', 'e', 't' and pairs)."""
    out: dict[str, np.ndarray] = {}
    if family.zeta:
        free_z = np.abs(zeta) < CLIP
        zeta = np.clip(zeta, -CLIP, CLIP)
        pi = 1 / (1 + np.exp(-zeta))
        soft = np.logaddexp(0, zeta)
    if not family.eta:
        return y * zeta - soft, {"z": free_z * (y - pi), "zz": -(free_z * pi * (1 - pi))}

    free_e = np.abs(eta) < CLIP
    eta = np.clip(eta, -CLIP, CLIP)
    mu = np.exp(eta)
    alpha = math.exp(theta) if family.dispersed else 0.0
    if family.dispersed:
        s, s_e, s_ee, s_t, s_tt, s_et = _zero_exponent(mu, alpha)
        z = alpha * mu
        u, u_e = y * (eta - np.log1p(z)), y / (1 + z)
        u_ee = -y * z / (1 + z) ** 2
        u_t = -y * z / (1 + z)
        u_tt, u_et = -y * z / (1 + z) ** 2, u_ee
    else:
        s, s_e, s_ee = mu, mu, mu
        u, u_e, u_ee = y * eta, y, np.zeros_like(mu)

    ll, l_s, l_ss = u - s, np.full_like(mu, -1.0), np.zeros_like(mu)
    l_zs = None
    if family.truncated:
        # -s - log(1 - exp(-s)) = -log(exp(s) - 1)
        s = np.maximum(s, 1e-300)
        stay = -np.expm1(-s)
        ll, l_s, l_ss = u - s - np.log(stay), -1 / stay, np.exp(-s) / stay**2
    if family.zeta:
        none = y == 0
        w = 1 / (1 + np.exp(-np.clip(zeta + s, -700, 700)))
        ll = np.where(none, np.logaddexp(zeta, -s), ll) - soft
        l_s = np.where(none, w - 1, l_s)
        l_ss = np.where(none, w * (1 - w), l_ss)
        l_zs = np.where(none, w * (1 - w), 0.0)
        out["z"] = np.where(none, w, 0.0) - pi
        out["zz"] = l_zs - pi * (1 - pi)
        out["ze"] = l_zs * s_e
    out["e"] = u_e + l_s * s_e
    out["ee"] = u_ee + l_ss * s_e**2 + l_s * s_ee
    if family.dispersed:
        out["t"] = u_t + l_s * s_t
        out["tt"] = u_tt + l_ss * s_t**2 + l_s * s_tt
        out["et"] = u_et + l_ss * s_e * s_t + l_s * s_et
        if family.zeta:
            out["zt"] = l_zs * s_t
    for key in out:
        if "z" in key:
            out[key] = out[key] * free_z
        if "e" in key:
            out[key] = out[key] * free_e
    return ll, out


#: Sums over j < y are taken term by term up to here; beyond, by the Euler-Maclaurin formula, once per distinct y.
EXACT_TERMS = 1 << 16


def _tail(y: np.ndarray, start: float, integral, term, slope) -> np.ndarray:
    """Sum of term(j) for j = start .. y - 1."""
    return integral(y) - integral(start) - (term(y) - term(start)) / 2 + (slope(y) - slope(start)) / 12


def count_terms(y: np.ndarray, weight: np.ndarray, theta: float | None) -> tuple[float, float, float]:
    """Value and theta-derivatives of the weighted terms in y alone: sum_{j<y} log(1 + alpha j) - log y!.

    y holds whole numbers from 0 on. Rows with y > j are counted for every j, so no gamma function is needed, and a very
    large y costs no more than `EXACT_TERMS`.
    """
    values, place = np.unique(y, return_inverse=True)
    share = np.bincount(place, weight, len(values))
    above = np.append(np.cumsum(share[::-1])[::-1], 0.0)
    total = np.zeros(3)
    j = np.arange(0, min(values[-1], EXACT_TERMS) if len(values) else 0, dtype=float)
    rows = above[np.searchsorted(values, j, side="right")]
    total[0] -= rows @ np.log(j + 1)
    far = values > EXACT_TERMS
    high, held, low = values[far].astype(float), share[far], float(EXACT_TERMS)
    total[0] -= held @ _tail(high, low, lambda t: (t + 1) * np.log(t + 1) - t, lambda t: np.log(t + 1), lambda t: 1 / (t + 1))
    if theta is not None:
        a = math.exp(theta)
        z = a * j
        total += rows @ np.log1p(z), rows @ (z / (1 + z)), rows @ (z / (1 + z) ** 2)
        d = lambda t: 1 + a * t
        total += (held @ _tail(high, low, lambda t: (d(t) * np.log(d(t)) - d(t)) / a, lambda t: np.log(d(t)), lambda t: a / d(t)),
                  held @ _tail(high, low, lambda t: t - np.log(d(t)) / a, lambda t: a * t / d(t), lambda t: a / d(t) ** 2),
                  held @ _tail(high, low, lambda t: (np.log(d(t)) + 1 / d(t)) / a, lambda t: a * t / d(t) ** 2, lambda t: a * (1 - a * t) / d(t) ** 3))
    return tuple(total.tolist())
