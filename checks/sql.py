"""DuckDB building blocks: common table expressions the checks are put together from."""

from __future__ import annotations

from zerotally import fixed

POLICIES = """
rolled AS (
  SELECT l_orderkey,
         CAST(coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'R' AND l_linestatus = 'O'), 0) AS INTEGER) AS y,
         CAST(floor(coalesce(sum(l_quantity) FILTER (WHERE l_returnflag = 'A'), 0) / 3) AS INTEGER) AS h,
         CAST(count(*) AS INTEGER) AS n
  FROM lineitem GROUP BY l_orderkey),
flagged AS (
  SELECT o.*, c.*, coalesce(y, 0) AS y, coalesce(h, 0) AS h, coalesce(n, 1) AS n,
         c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') AS auto
  FROM orders o JOIN customer c ON o_custkey = c_custkey LEFT JOIN rolled ON l_orderkey = o_orderkey),
policies AS (
  SELECT o_orderkey AS id,
         h AS "12m_call_history",
         CASE WHEN o_orderpriority[1] = '5' THEN 'missing' ELSE 'method' || o_orderpriority[1] END AS acq_method,
         o_totalprice / 50 AS ann_prm_amt,
         CASE WHEN auto THEN 'Grp' || ((o_orderkey // 81) % 7 + 1) ELSE 'NonAuto' END AS bi_limit_group,
         CASE WHEN auto OR c_nationkey % 3 <> 0 THEN 'Retail' ELSE 'Others' END AS channel,
         CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END AS digital_contact_ind,
         CASE o_orderkey % 3 WHEN 0 THEN 'rural' WHEN 1 THEN 'suburban' ELSE 'urban' END AS geo_group,
         CAST(o_custkey % 2 AS INTEGER) AS has_prior_carrier,
         CAST((o_custkey * 7919) % 150000 AS DOUBLE) AS home_lot_sq_footage,
         CASE WHEN auto THEN CASE WHEN (o_orderkey // 5) % 10 = 0 THEN '3autodwellingumb' ELSE '2autodwelling' END
              ELSE CASE WHEN (o_orderkey // 5) % 4 = 0 THEN '3other' ELSE '1dwelling' END END AS household_group,
         n AS household_policy_counts,
         CASE WHEN auto THEN CAST(o_custkey % 31 AS INTEGER) ELSE -20 END AS newest_veh_age,
         'type' || ((o_orderkey // 9) % 3 + 1) AS pay_type_code,
         CASE WHEN o_orderkey % 97 = 0 THEN -2 WHEN o_orderkey % 311 = 5 THEN -1
              WHEN c_acctbal > 4500 THEN 1 ELSE 0 END AS pol_edeliv_ind,
         CASE (o_orderkey // 3) % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'B' ELSE 'C' END AS prdct_sbtyp_grp,
         'type' || ((o_orderkey // 9) % 3 + 1) AS product_sbtyp,
         CASE WHEN auto THEN CAST((o_orderkey // 27) % 3 - 1 AS INTEGER) ELSE -2 END AS telematics_ind,
         CAST(floor(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-09-01') / 4) AS INTEGER) AS tenure_at_snapshot,
         CASE WHEN auto OR c_nationkey % 5 = 0 THEN 6 ELSE 12 END AS trm_len_mo,
         y AS call_counts
  FROM flagged)"""

SEGMENT = {
    "auto": """
s AS (SELECT * EXCLUDE (trm_len_mo, channel) FROM policies
      WHERE bi_limit_group <> 'NonAuto' AND telematics_ind <> -2)""",
    "nonauto": """
s AS (SELECT * EXCLUDE (bi_limit_group, newest_veh_age, telematics_ind) FROM policies
      WHERE bi_limit_group = 'NonAuto' AND telematics_ind = -2)""",
}

SPLIT = """
sp AS (SELECT * EXCLUDE (rk, total),
              CASE WHEN rk <= ceil(0.2::DOUBLE * total) THEN 'Val' ELSE 'Train' END AS "Sample"
       FROM (SELECT *, row_number() OVER (ORDER BY md5(id || ':42'), id) AS rk, count(*) OVER () AS total FROM s))"""

_NUM = ['"12m_call_history"', "ann_prm_amt", "household_policy_counts", "tenure_at_snapshot"]
_SCALED = ", ".join(f"({c} - m{i}) / s{i} AS f{i}" for i, c in enumerate(_NUM))
_FLAGS = ("digital_contact_ind AS f4, has_prior_carrier AS f5, "
          "CAST(geo_group = 'rural' AS INTEGER) AS f6, CAST(geo_group = 'suburban' AS INTEGER) AS f7, "
          "CAST(geo_group = 'urban' AS INTEGER) AS f8")
SCALES = (
    "lab AS (SELECT * FROM sp WHERE \"Sample\" = 'Train' AND pol_edeliv_ind IN (0, 1, -1)),\n"
    "sc AS (SELECT " + ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(_NUM))
    + " FROM lab)")


def neighbours(source: str = "sp") -> str:
    """The five nearest training rows of the source's rows without a known flag."""
    return f"""
{SCALES},
refs AS (SELECT id, pol_edeliv_ind AS label, {_SCALED}, {_FLAGS} FROM lab, sc),
asked AS (SELECT id, {_SCALED}, {_FLAGS} FROM {source}, sc WHERE pol_edeliv_ind NOT IN (0, 1, -1)),
nb AS (SELECT q.id, r.id AS nid, r.label,
              {' + '.join(f'(q.f{i} - r.f{i}) * (q.f{i} - r.f{i})' for i in range(9))} AS d2,
              row_number() OVER (PARTITION BY q.id ORDER BY d2, r.id) AS place
       FROM asked q, refs r QUALIFY place <= 5)"""


def imputing(source: str = "sp") -> str:
    """The source's rows with the flag filled by the neighbours' vote."""
    return f"""
{neighbours(source)},
votes AS (SELECT id, label, count(*) AS votes FROM nb GROUP BY id, label),
imp AS (SELECT id, label AS imputed FROM votes
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY votes DESC, label) = 1),
filled AS (SELECT {source}.* EXCLUDE (pol_edeliv_ind),
                  CASE WHEN pol_edeliv_ind = -2 THEN imputed ELSE pol_edeliv_ind END AS pol_edeliv_ind_filled
           FROM {source} LEFT JOIN imp USING (id))"""


NEIGHBOURS, IMPUTED = neighbours(), imputing()


def training(seg: str) -> str:
    """The segment's rows but for every fifth id."""
    return SEGMENT[seg].rstrip()[:-1] + " AND id % 5 <> 4)"


def unseen(seg: str) -> str:
    """The segment's rows of every fifth id, as `un`."""
    return SEGMENT[seg].replace("s AS", "un AS", 1).rstrip()[:-1] + " AND id % 5 = 4)"


def with_(*parts: str) -> str:
    return "WITH " + ",".join([POLICIES, *parts]) + "\n"


def raw(seg: str) -> str:
    return with_(SEGMENT[seg])


def split(seg: str) -> str:
    return with_(SEGMENT[seg], SPLIT)


def imputed(seg: str) -> str:
    return with_(SEGMENT[seg], SPLIT, IMPUTED)


def quoted(name: str) -> str:
    return f'"{name}"'


def two_sided(z: str) -> str:
    """Two-sided normal p-value; erf(x) by its series of positive terms, 2 / sqrt(pi) exp(-x^2) sum 2^n x^(2n+1) / (2n+1)!!."""
    x = f"(abs({z}) / sqrt(2))"
    term = f"exp(-({x} ** 2) + 2 * n * ln(2) + (2 * n + 1) * ln({x}) + lgamma(n + 1) - lgamma(2 * n + 2))"
    return f"CASE WHEN abs({z}) > 10 THEN 0.0::DOUBLE ELSE greatest(0, 1 - 2 / sqrt(pi()) * list_sum(list_transform(range(400), lambda n: {term}))) END"


def view(stage: str, seg: str, filled: str = "pol_edeliv_ind_filled") -> dict[str, str]:
    """Feature name to DuckDB expression; LOG is base 10 there."""
    log_tenure = {"tenure_at_snapshot": "log(1 + least(tenure_at_snapshot, 500))"}
    common = {
        "12m_call_history": f'log(1 + least("12m_call_history", {40 if seg == "auto" else 30}))',
        "acq_method": "acq_method",
        "ann_prm_amt": "log(1 + least(ann_prm_amt, 7200))",
        "digital_contact_ind": "digital_contact_ind",
        "geo_group": "geo_group",
        "has_prior_carrier": "has_prior_carrier",
        "home_lot_sq_footage": "home_lot_sq_footage",
        "pol_edeliv_ind": filled,
        "prdct_sbtyp_grp": "prdct_sbtyp_grp",
        "product_sbtyp": "product_sbtyp",
    }
    hpc = "household_policy_counts"
    if seg == "auto":
        more = {"bi_limit_group": "bi_limit_group", "newest_veh_age": "newest_veh_age",
                "telematics_ind": "telematics_ind", **log_tenure}
        if stage == "baseline":
            more["household_group"] = "CASE WHEN household_group = '2autodwelling' THEN 1 ELSE 0 END"
            more[hpc] = f"least({hpc}, 4)"
        else:
            more[f"{hpc}_le2"] = f"least({hpc}, 2)"
            more[f"{hpc}_gt2"] = f"greatest(least({hpc}, 4) - 2, 0)"
    else:
        more = {"channel": "CASE WHEN channel = 'Retail' THEN 1 ELSE 0 END",
                "trm_len_mo": "CASE WHEN trm_len_mo = 12 THEN 1 ELSE 0 END",
                "household_group": "CASE WHEN household_group = '1dwelling' THEN 1 ELSE 0 END"}
        if stage == "count":
            more[f"{hpc}_le3"] = f"least({hpc}, 3)"
            more[f"{hpc}_gt3"] = f"greatest(least({hpc}, 5) - 3, 0)"
            more["tenure_at_snapshot_le300"] = "log(1 + least(tenure_at_snapshot, 300))"
            more["tenure_at_snapshot_gt300"] = "log(1 + greatest(least(tenure_at_snapshot, 500) - 300, 0))"
        else:
            more[hpc] = f"least({hpc}, 5)"
            more.update(log_tenure)
    return {**common, **more}


LOGGED = ["12m_call_history", "ann_prm_amt", "tenure_at_snapshot", "tenure_at_snapshot_le300",
          "tenure_at_snapshot_gt300"]


def view_select(stage: str, seg: str, target: bool = True, filled: str = "pol_edeliv_ind_filled") -> str:
    items = [f"round({e}, 9) AS {quoted(n)}" if n in LOGGED else f"{e} AS {quoted(n)}"
             for n, e in view(stage, seg, filled).items()]
    if target and stage == "binary":
        items.append("CASE WHEN call_counts > 0 THEN 1 ELSE 0 END AS nonzero_call")
    elif target:
        items.append("call_counts")
    return "SELECT id, " + ", ".join(items)


def levels(seg: str, filled: str = "pol_edeliv_ind_filled") -> dict[str, str]:
    """Level-table variable to DuckDB expression."""
    cap, top = (40, 4) if seg == "auto" else (30, 5)
    binned = {
        "binned_12m_call_history": f'least(("12m_call_history" / 5)::INT * 5, {cap})',
        "binned_ann_prm_amt": "least((ann_prm_amt / 900)::INT * 900, 7200)",
        "binned_home_lot_sq_footage": "(home_lot_sq_footage / 10000)::INT * 10000",
        "capped_household_policy_counts": f"least(household_policy_counts, {top})",
        "binned_tenure_at_snapshot": "least((tenure_at_snapshot / 100)::INT * 100, 500)",
        "pol_edeliv_ind_filled": filled,
    }
    return {v: binned.get(v, v) for v in fixed.LEVEL_VARIABLES[seg]}


def stacked(variables: dict[str, str], source: str, keep: str) -> str:
    """UNION ALL of one select per variable: "Variable", "ValVar" and the kept columns."""
    return "\nUNION ALL ".join(
        f"SELECT '{v}' AS \"Variable\", CAST({e} AS VARCHAR) AS \"ValVar\", {keep} FROM {source}"
        for v, e in variables.items())


# Levels of the nominal columns in the policy table, lowest first.
NOMINAL_LEVELS = {
    "acq_method": ["method1", "method2", "method3", "method4", "missing"],
    "bi_limit_group": ["Grp1", "Grp2", "Grp3", "Grp4", "Grp5", "Grp6", "Grp7"],
    "geo_group": ["rural", "suburban", "urban"],
    "pol_edeliv_ind": ["-1", "0", "1"],
    "prdct_sbtyp_grp": ["A", "B", "C"],
    "product_sbtyp": ["type1", "type2", "type3"],
    "telematics_ind": ["-1", "0", "1"],
}


def encoded_select(stage: str, seg: str) -> str:
    """Select list over a CTE `v` (view columns and "Sample"): scaled numerics, then dummies."""
    numeric, nominal = fixed.NUMERIC[stage, seg], fixed.NOMINAL[seg]
    items = []
    for n in view(stage, seg):
        q = quoted(n)
        if n in numeric:
            over = "FILTER (WHERE \"Sample\" = 'Train') OVER ()"
            items.append(f"round(({q} - avg({q}) {over}) / stddev_pop({q}) {over}, 6) + 0 AS {q}")
        elif n not in nominal:
            items.append(q)
    for n in nominal:
        items += [f"CASE WHEN {n} = '{v}' THEN 1 ELSE 0 END AS \"{n}_{v}\"" for v in NOMINAL_LEVELS[n][1:]]
    return "SELECT id, \"Sample\", " + ", ".join(items)
