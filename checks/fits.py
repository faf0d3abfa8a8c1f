"""Maximum likelihood in DuckDB SQL: Newton steps in a recursive query, so that fits on all features have an oracle.

A step adds up score and information over the rows and solves the linear system by Gauss-Jordan elimination on lists. The
formulas are those of the models' definitions, with every derivative written out.
"""

from __future__ import annotations

import re

from checks import sql
from zerotally import fixed

STEPS = 25


def solved(matrix: str, n: int) -> str:
    """The list-of-rows matrix (n rows) after elimination of its first n columns."""
    pivots = ", ".join(f"[[{k}.0::DOUBLE]]" for k in range(1, n + 1))
    at = "k[1][1]::INTEGER"
    row = f"list_transform(row, lambda v, j: v - row[{at}] * m[{at}][j] / m[{at}][{at}])"
    return (f"list_reduce(list_prepend({matrix}, [{pivots}]), lambda m, k: list_transform(m, lambda row, i: "
            f"CASE WHEN i = {at} THEN list_transform(row, lambda v: v / m[{at}][{at}]) ELSE {row} END))")


def _linear(b: str, columns: list[str], start: int) -> str:
    return "(" + " + ".join(f"{b}[{start + i}] * {c}" for i, c in enumerate(columns, 1)) + ")"


class Fit:
    """SQL of one model: `family` on the columns x0 (constant), x1, ... and y of the rows `source` that meet `where`."""

    def __init__(self, name: str, family: str, source: str, width: int, where: str = "true"):
        self.name, self.family, self.source, self.where = name, family, source, where
        self.columns = [f"x{i}" for i in range(width)]
        self.inflated = family in ("zip", "zinb")
        self.dispersed = family in ("nb", "ztnb", "zinb")
        parts = ["z"] * self.inflated + ["z" if family == "logit" else "e"]
        # (kind, column) of each parameter
        self.params = [(k, c) for k in parts for c in self.columns] + [("t", None)] * self.dispersed
        self.n = len(self.params)

    def terms(self, b: str) -> str:
        """CTE body: per row the derivatives d_z, d_e, d_t and minus the second ones at the parameters b."""
        w, first = len(self.columns), 0
        zeta = _linear(b, self.columns, 0) if self.inflated or self.family == "logit" else "0.0"
        first = w if self.inflated else 0
        eta = _linear(b, self.columns, first) if self.family != "logit" else "0.0"
        a = f"exp({b}[{self.n}])" if self.dispersed else "0.0"
        steps = [f"SELECT *, {zeta} AS zeta, {eta} AS eta, {a} AS a FROM rows_",
                 "SELECT *, 1 / (1 + exp(-zeta)) AS pi, exp(eta) AS mu, a * exp(eta) AS q FROM ({})"]
        if self.family == "logit":
            steps.append("SELECT *, y - pi AS d_z, pi * (1 - pi) AS i_zz, y * zeta - ln(1 + exp(zeta)) AS ll FROM ({})")
            return _nested(steps)
        if self.dispersed:
            js = lambda e: f"coalesce(list_sum(list_transform(range(y::BIGINT), lambda j: {e})), 0)"
            steps += ["SELECT *, ln(1 + q) / a AS s, mu / (1 + q) AS s_e, mu / (1 + q) ** 2 AS s_ee, -q * mu / (1 + q) ** 2 AS s_et FROM ({})",
                      f"SELECT *, s_e - s AS s_t, s_et - (s_e - s) AS s_tt, y / (1 + q) AS u_e, -y * q / (1 + q) ** 2 AS u_ee, "
                      f"-y * q / (1 + q) + {js('a * j / (1 + a * j)')} AS u_t, -y * q / (1 + q) ** 2 + {js('a * j / (1 + a * j) ** 2')} AS u_tt, "
                      f"y * (eta - ln(1 + q)) + {js('ln(1 + a * j)')} - lgamma(y + 1) AS u FROM ({{}})"]
        else:
            steps.append("SELECT *, mu AS s, mu AS s_e, mu AS s_ee, 0.0 AS s_t, 0.0 AS s_tt, 0.0 AS s_et, y AS u_e, 0.0 AS u_ee, 0.0 AS u_t, "
                         "0.0 AS u_tt, y * eta - lgamma(y + 1) AS u FROM ({})")
        if self.family == "ztnb":
            steps.append("SELECT *, -1 / (1 - exp(-s)) AS l_s, exp(-s) / (1 - exp(-s)) ** 2 AS l_ss, 0.0 AS l_zs, 0.0 AS d_z, 0.0 AS l_zz, "
                         "u - s - ln(1 - exp(-s)) AS ll FROM ({})")
        elif self.inflated:
            steps += ["SELECT *, 1 / (1 + exp(-zeta - s)) AS w FROM ({})",
                      "SELECT *, CASE WHEN y = 0 THEN w - 1 ELSE -1 END AS l_s, CASE WHEN y = 0 THEN w * (1 - w) ELSE 0 END AS l_ss, "
                      "CASE WHEN y = 0 THEN w * (1 - w) ELSE 0 END AS l_zs, CASE WHEN y = 0 THEN w ELSE 0 END - pi AS d_z, "
                      "CASE WHEN y = 0 THEN w * (1 - w) ELSE 0 END - pi * (1 - pi) AS l_zz, "
                      "CASE WHEN y = 0 THEN ln(pi + (1 - pi) * exp(-s)) ELSE ln(1 - pi) + u - s END AS ll FROM ({})"]
        else:
            steps.append("SELECT *, -1.0 AS l_s, 0.0 AS l_ss, 0.0 AS l_zs, 0.0 AS d_z, 0.0 AS l_zz, u - s AS ll FROM ({})")
        steps.append("SELECT *, u_e + l_s * s_e AS d_e, u_t + l_s * s_t AS d_t, -l_zz AS i_zz, -l_zs * s_e AS i_ze, -l_zs * s_t AS i_zt, "
                     "-(u_ee + l_ss * s_e ** 2 + l_s * s_ee) AS i_ee, -(u_ee + l_ss * s_e * s_t + l_s * s_et) AS i_et, "
                     "-(u_tt + l_ss * s_t ** 2 + l_s * s_tt) AS i_tt FROM ({})")
        return _nested(steps)

    def system(self) -> tuple[str, str]:
        """Sums of the information matrix (rows with the score behind) and of the log likelihood."""
        product = lambda *cs: " * ".join(c for c in cs if c)
        rows = []
        for i, (k, c) in enumerate(self.params):
            cells = []
            for j, (m, e) in enumerate(self.params):
                (ka, ca), (kb, cb) = ((k, c), (m, e)) if "zet".index(k) <= "zet".index(m) else ((m, e), (k, c))
                cells.append(f"sum({product(f'i_{ka}{kb}', ca, cb)})")
            rows.append(f"[{', '.join(cells)}, sum({product(f'd_{k}', c)})]")
        return f"[{', '.join(rows)}]::DOUBLE[][]", "sum(ll)"

    def start(self) -> str:
        flat = ", ".join(["0.0"] * (len(self.columns) - 1))
        positive = "ln(avg(y) FILTER (WHERE y > 0))"
        mean = {"logit": "ln(avg(y) / (1 - avg(y)))", "poisson": "ln(avg(y))", "nb": "ln(avg(y))", "ztnb": "ln(avg(y))"}
        parts = []
        if self.inflated:
            parts += [f"ln(avg((y = 0)::INTEGER) / (1 - avg((y = 0)::INTEGER))), {flat}", f"{positive}, {flat}"]
        else:
            parts.append(f"{mean[self.family]}, {flat}")
        return f"[{', '.join(parts + ['0.0'] * self.dispersed)}]::DOUBLE[]"

    def ctes(self) -> str:
        """`<name>`: one row with the parameters `b`; `<name>_at`: information (rows with the score) and log likelihood there."""
        name, n = self.name, self.n
        matrix, ll = self.system()
        rows = f"(SELECT * FROM {self.source} WHERE {self.where})"
        step = f"list_transform({solved('h', n)}, lambda r: r[{n + 1}])"
        body = lambda at: self.terms("b").replace("rows_", f"(SELECT r.*, {at}.* FROM {rows} r, {at})")
        return f"""{name}_steps(step, b) AS (
  SELECT 0, {self.start()} FROM {rows}
  UNION ALL
  SELECT step + 1, list_transform(b, lambda v, i: v + d[i] * least(1.0, 1.0 / list_max(list_transform(d, lambda e: abs(e)))))
  FROM (SELECT step, b, {step} AS d FROM (SELECT step, b, {matrix} AS h FROM ({body(f'{name}_steps')}) GROUP BY step, b)) WHERE step < {STEPS}),
{name} AS MATERIALIZED (SELECT b FROM {name}_steps WHERE step = {STEPS}),
{name}_at AS MATERIALIZED (SELECT {matrix} AS h, {ll} AS ll, count(*) AS n FROM ({body(name)}))"""

    def coefficients(self, labels: list[str]) -> str:
        """Select of part, term, coef, se, z, p in order; `labels` are those of the columns."""
        n, parts = self.n, {"z": "inflate", "e": "count", "t": "dispersion"}
        named = [(parts[k] if self.family != "logit" else "count", labels[int(c[1:])] if c else "alpha") for k, c in self.params]
        unit = f"list_transform(h, lambda r, i: list_concat(r[1:{n}], list_transform(range({n}), lambda j: (j + 1 = i)::INTEGER::DOUBLE)))"
        listed = ", ".join(f"({i}, '{part}', '{term}')" for i, (part, term) in enumerate(named, 1))
        scale = "CASE WHEN part = 'dispersion' THEN exp(b[i]) ELSE 1 END"
        return f"""(WITH v AS (SELECT {solved(unit, n)} AS c FROM {self.name}_at),
  t AS (SELECT i, part, term, CASE WHEN part = 'dispersion' THEN exp(b[i]) ELSE b[i] END AS coef, sqrt(c[i][{n} + i]) * {scale} AS se
        FROM (VALUES {listed}) l(i, part, term), {self.name}, v)
  SELECT CAST(i - 1 AS INTEGER) AS pos, part, term, coef, se, coef / se AS z FROM t)"""

    def mean(self) -> str:
        """Expected value of a row with the columns x0, ..., from the one-row table `<name>`."""
        w, b = len(self.columns), f"{self.name}.b"
        if self.family == "logit":
            return f"1 / (1 + exp(-{_linear(b, self.columns, 0)}))"
        mu = f"exp({_linear(b, self.columns, w if self.inflated else 0)})"
        if self.family == "ztnb":
            a = f"exp({b}[{self.n}])"
            return f"{mu} / (1 - (1 + {a} * {mu}) ** (-1 / {a}))"
        return f"{mu} / (1 + exp({_linear(b, self.columns, 0)}))" if self.inflated else mu


def _nested(steps: list[str]) -> str:
    text = steps[0]
    for step in steps[1:]:
        text = step.format(text)
    return text


def features(stage: str, seg: str) -> list[tuple[str, str]]:
    """Name and expression over `v` (view columns, "Sample") of a stage's features, scaled by its training rows."""
    numeric, nominal, out = fixed.NUMERIC[stage, seg], fixed.NOMINAL[seg], []
    raw = list(fixed.POLICY_COLUMNS)  # features come in the order of the raw columns
    place = lambda n: raw.index(re.sub(r"_(le|gt)\d+$", "", n))
    rows = "\"Sample\" = 'Train'" + (" AND call_counts > 0" if stage == "count" else "")
    for n in sorted(sql.view(stage, seg), key=place):
        q = sql.quoted(n)
        if n in numeric:
            over = f"FILTER (WHERE {rows}) OVER ()"
            out.append((n, f"({q} - avg({q}) {over}) / stddev_pop({q}) {over}"))
        elif n not in nominal:
            out.append((n, q))
    for n in nominal:
        out += [(f"{n}_{v}", f"CASE WHEN {n} = '{v}' THEN 1 ELSE 0 END") for v in sql.NOMINAL_LEVELS[n][1:]]
    return out


def design(name: str, stage: str, seg: str) -> tuple[str, list[str]]:
    """CTE `<name>` over `filled` with id, "Sample", call_counts, y and the design's columns, and the columns' terms."""
    listed = features(stage, seg)
    view = ", ".join(f"{e} AS {sql.quoted(n)}" for n, e in sql.view(stage, seg).items())
    y = "(call_counts > 0)::INTEGER::DOUBLE" if stage == "binary" else "call_counts::DOUBLE"
    columns = ", ".join(f"({e})::DOUBLE AS x{i}" for i, (_, e) in enumerate(listed, 1))
    text = f"""{name} AS MATERIALIZED (SELECT id, "Sample", call_counts, {y} AS y, 1.0::DOUBLE AS x0, {columns}
  FROM (SELECT id, "Sample", call_counts, {view} FROM filled))"""
    return text, ["const", *(n for n, _ in listed)]


def imputed(seg: str, *ctes: str) -> str:
    return sql.imputed(seg).replace("WITH ", "WITH RECURSIVE ", 1) + "".join(f", {c}" for c in ctes) + "\n"


def hurdle(seg: str, final: bool = False) -> list[str]:
    """CTEs up to `scored`: the filled rows with p, m and yh of the fitted stages."""
    train = "true" if final else "\"Sample\" = 'Train'"
    first, names = design("xb", "binary", seg)
    second, more = design("xc", "count", seg)
    logit = Fit("fb", "logit", "xb", len(names), train)
    count = Fit("fc", "ztnb", "xc", len(more), f"{train} AND call_counts > 0")
    scored = f"""scored AS MATERIALIZED (SELECT f.*, p, m, p * m AS yh FROM filled f
  JOIN (SELECT id, {logit.mean()} AS p FROM xb, fb) USING (id) JOIN (SELECT id, {count.mean()} AS m FROM xc, fc) USING (id))"""
    return [first, second, logit.ctes(), count.ctes(), scored]
