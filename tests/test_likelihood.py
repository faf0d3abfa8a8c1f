"""Derivatives and normalisation of the row likelihoods, without Spark."""

import math

import numpy as np
import pytest

from zerotally.operators.likelihood import FAMILIES, count_terms, row_terms

ZETA, ETA, THETA = 0.3, 0.8, -0.4


def _total(name, y, zeta, eta, theta):
    family = FAMILIES[name]
    one = lambda v: np.array([float(v)])
    ll, d = row_terms(family, one(y), one(zeta), one(eta), theta)
    value, first, second = count_terms(one(y), one(1), theta if family.dispersed else None) if family.eta else (0, 0, 0)
    return ll[0] + value, d, first, second


def _derivatives(name, y, zeta, eta, theta):
    _, d, first, second = _total(name, y, zeta, eta, theta)
    d = {k: v[0] for k, v in d.items()}
    if "t" in d:
        d["t"] += first
        d["tt"] += second
    return d


@pytest.mark.parametrize("name", list(FAMILIES))
@pytest.mark.parametrize("y", [0, 1, 2, 17])
@pytest.mark.parametrize("eta", [ETA, -6.0, 3.5])
def test_first_and_second_derivatives(name, y, eta):
    if (name == "ztnb" and y == 0) or (name == "logit" and y > 1):
        pytest.skip("outside the family's range")
    at = {"z": ZETA, "e": eta, "t": THETA}
    have = _derivatives(name, y, at["z"], at["e"], at["t"])
    h = 1e-5

    def moved(key, step):
        p = dict(at, **{key: at[key] + step})
        return p["z"], p["e"], p["t"]

    for key in [k for k in have if len(k) == 1]:
        num = (_total(name, y, *moved(key, h))[0] - _total(name, y, *moved(key, -h))[0]) / (2 * h)
        assert math.isclose(have[key], num, rel_tol=1e-5, abs_tol=1e-7), key
        up, down = _derivatives(name, y, *moved(key, h)), _derivatives(name, y, *moved(key, -h))
        for other in [k for k in have if len(k) == 1]:
            pair = have.get(key + other, have.get(other + key))
            num = (up[other] - down[other]) / (2 * h)
            assert math.isclose(pair, num, rel_tol=1e-5, abs_tol=1e-7), key + other


@pytest.mark.parametrize("name", ["poisson", "nb", "ztnb", "zip", "zinb"])
def test_probabilities_sum_to_one(name):
    first = 1 if name == "ztnb" else 0
    total = sum(math.exp(_total(name, y, ZETA, ETA, THETA)[0]) for y in range(first, 400))
    assert math.isclose(total, 1.0, rel_tol=1e-9)


def test_small_alpha_is_poisson():
    for y in (0, 1, 5):
        nb, d_nb, first, second = _total("nb", y, 0, ETA, math.log(1e-9))
        poisson, d_p, _, _ = _total("poisson", y, 0, ETA, 0.0)
        assert math.isclose(nb, poisson, rel_tol=1e-6)
        assert math.isclose(d_nb["e"][0], d_p["e"][0], rel_tol=1e-6, abs_tol=1e-8)
        assert math.isclose(d_nb["ee"][0], d_p["ee"][0], rel_tol=1e-6)


def test_count_terms_use_weights_and_gaps():
    want = sum(w * (sum(math.log1p(0.5 * j) for j in range(y)) - math.lgamma(y + 1))
               for y, w in ((0, 9), (3, 2.0), (40, 1.5)))
    assert math.isclose(count_terms(np.array([0.0, 3, 40, 3]), np.array([9, 0.5, 1.5, 1.5]), math.log(0.5))[0], want)


def test_terms_of_very_large_targets(monkeypatch):
    import zerotally.operators.likelihood as L

    y, w = np.array([0.0, 3.0, 150.0, 900.0, 4000.0, 4000.0]), np.array([1.0, 2.0, 0.5, 1.0, 1.0, 3.0])
    want = L.count_terms(y, w, math.log(0.3)), L.count_terms(y, w, None)
    monkeypatch.setattr(L, "EXACT_TERMS", 200)
    got = L.count_terms(y, w, math.log(0.3)), L.count_terms(y, w, None)
    assert np.allclose(got[0], want[0], rtol=1e-11) and np.allclose(got[1], want[1], rtol=1e-11)
    value, _, _ = L.count_terms(np.array([1e9]), np.array([1.0]), None)
    assert math.isclose(value, -math.lgamma(1e9 + 1), rel_tol=1e-12)
