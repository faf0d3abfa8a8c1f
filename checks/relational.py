"""Sources, projections, joins, aggregates, ranks and unions."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import sql
from checks.registry import query, r, rounded
from zerotally import fixed
from zerotally.functions import scalars as S
from zerotally.operators import levels, profiles, ranking
from zerotally.operators import segments as seg_ops
from zerotally.operators.imputation import fill_from
from zerotally.operators.segments import segment
from zerotally.operators.views import feature_view, level_view
from zerotally.plans.prepare import prepare
from zerotally.sources import csv_files, tables
from zerotally.sources.policies import policies
from zerotally.workspace import materialise, scratch_path

SEGS = ("auto", "nonauto")


def raw_filled(spark, d, seg):
    """A segment whose flag counts as filled, for operators that come after imputation."""
    return segment(policies(spark, d), seg).withColumnRenamed(fixed.IMPUTED, fixed.FILLED)


def pseudo(df):
    """A made-up prediction, the same in SQL: 1.5 times the capped history plus 1."""
    return df.withColumn("pred", F.least("12m_call_history", F.lit(40)) * 1.5 + 1)


PSEUDO = 'least("12m_call_history", 40) * 1.5::DOUBLE + 1'
ALL = sql.with_()
_BOTH = ALL + """, m AS (SELECT CASE WHEN bi_limit_group <> 'NonAuto' THEN 'Auto' ELSE 'NonAuto' END AS segment, * FROM policies
    WHERE (bi_limit_group <> 'NonAuto' AND telematics_ind <> -2) OR (bi_limit_group = 'NonAuto' AND telematics_ind = -2))
"""


# -- sources and sinks ------------------------------------------------------------------------

CSV_SQL = ALL + """SELECT * REPLACE (
    CASE WHEN household_policy_counts = 1 THEN NULL ELSE household_policy_counts END AS household_policy_counts,
    CASE WHEN newest_veh_age = -20 THEN NULL ELSE newest_veh_age END AS newest_veh_age,
    CASE WHEN channel = 'Others' THEN NULL ELSE channel END AS channel,
    CASE WHEN has_prior_carrier = 0 THEN NULL ELSE has_prior_carrier END AS has_prior_carrier,
    round(ann_prm_amt, 6) AS ann_prm_amt) FROM policies"""


def _written_csv(spark, d):
    """The policy table as CSV, some values replaced by different NULL tokens."""
    marked = policies(spark, d).withColumns({
        "household_policy_counts": F.when(F.col("household_policy_counts") == 1, "#N/A").otherwise(
            F.col("household_policy_counts").cast("string")),
        "newest_veh_age": F.when(F.col("newest_veh_age") == -20, "nan").otherwise(
            F.concat(F.col("newest_veh_age").cast("string"), F.lit(".0"))),
        "channel": F.when(F.col("channel") == "Others", "<NA>").otherwise(F.col("channel")),
        "has_prior_carrier": F.when(F.col("has_prior_carrier") == 0, "").otherwise(
            F.col("has_prior_carrier").cast("string")),
    })
    path = scratch_path(spark, "csv")
    marked.write.csv(path, header=True)
    return csv_files.read_policies_csv(spark, path)


@query("s01_csv_null_tokens", ALL + """SELECT
    count(*) FILTER (WHERE household_policy_counts = 1) AS null_counts,
    count(*) FILTER (WHERE newest_veh_age = -20) AS null_ages,
    count(*) FILTER (WHERE channel = 'Others') AS null_channels,
    count(*) FILTER (WHERE has_prior_carrier = 0) AS null_carriers,
    count(*) FILTER (WHERE acq_method = 'missing') AS literal_missing, count(*) AS n FROM policies""")
def s01(spark, d):
    read = _written_csv(spark, d)
    absent = lambda c, name: F.count(F.when(F.col(c).isNull(), 1)).alias(name)
    return read.agg(absent("household_policy_counts", "null_counts"), absent("newest_veh_age", "null_ages"),
                    absent("channel", "null_channels"), absent("has_prior_carrier", "null_carriers"),
                    F.count(F.when(F.col("acq_method") == "missing", 1)).alias("literal_missing"),
                    F.count(F.lit(1)).alias("n"))


@query("s02_typed_projection", CSV_SQL)
def s02(spark, d):
    return rounded(csv_files.cast_policies(_written_csv(spark, d), has_target=True), 6, "ann_prm_amt")


@query("s03_create_or_replace_table", ALL + "SELECT * REPLACE (round(ann_prm_amt, 6) AS ann_prm_amt) FROM policies")
def s03(spark, d):
    name, path = f"policies_{uuid.uuid4().hex}", scratch_path(spark, "table")
    df = policies(spark, d)
    tables.save_table(df.select(fixed.ID), name, path=path)
    tables.save_table(df, name, path=path)
    return rounded(tables.load_table(spark, name), 6, "ann_prm_amt")


@query("s04_row_id", ALL + """SELECT id, row_number() OVER (ORDER BY tenure_at_snapshot, id) - 1 AS "Id_" FROM policies""")
def s04(spark, d):
    numbered = ranking.with_row_id(policies(spark, d).select(fixed.ID, "tenure_at_snapshot"),
                                   ["tenure_at_snapshot", fixed.ID], "Id_")
    return numbered.select(fixed.ID, "Id_")


@query("s05_load_excluding_columns", ALL + """SELECT * EXCLUDE (call_counts, ann_prm_amt, home_lot_sq_footage) FROM policies""")
def s05(spark, d):
    name = f"policies_{uuid.uuid4().hex}"
    tables.save_table(policies(spark, d), name, path=scratch_path(spark, "table"))
    return tables.load_table(spark, name, [fixed.TARGET, "ann_prm_amt", "home_lot_sq_footage"])


@query("s06_frame_in_sql", ALL + "SELECT channel, count(*) AS n, CAST(sum(call_counts) AS BIGINT) AS calls FROM policies GROUP BY channel")
def s06(spark, d):
    name = f"policies_{uuid.uuid4().hex}"
    tables.register(policies(spark, d), name)
    out = spark.sql(f"SELECT channel, count(*) AS n, sum(call_counts) AS calls FROM {name} GROUP BY channel")
    tables.unregister(spark, name)
    return out


@query("s07_list_and_drop", ALL + "SELECT 'listed' AS what, count(*) AS n FROM policies UNION ALL SELECT 'dropped', 0")
def s07(spark, d):
    name = scratch_path(spark, "t").rsplit("/", 1)[1].replace("-", "_")
    tables.save_table(policies(spark, d), name, path=scratch_path(spark, "listed"))
    n = tables.load_table(spark, name).count() if name in tables.list_tables(spark) else -1
    tables.drop_table(spark, name)
    gone = 0 if name not in tables.list_tables(spark) else 1
    return spark.createDataFrame([("listed", n), ("dropped", gone)], "what string, n long")


@query("s08_prediction_csv", ALL + f"SELECT id, round({PSEUDO}, 6) AS call_counts FROM policies")
def s08(spark, d):
    path = scratch_path(spark, "predictions")
    csv_files.write_predictions(pseudo(policies(spark, d)).select(fixed.ID, F.col("pred").alias(fixed.TARGET)), path)
    return csv_files.read_predictions(spark, path).select(fixed.ID, r(fixed.TARGET).alias(fixed.TARGET))


# -- filters and projections ------------------------------------------------------------------

for _seg, _n in zip(SEGS, ("p01_auto_segment", "p02_nonauto_segment")):
    @query(_n, sql.raw(_seg) + "SELECT * REPLACE (round(ann_prm_amt, 6) AS ann_prm_amt) FROM s")
    def _(spark, d, seg=_seg):
        return rounded(segment(policies(spark, d), seg), 6, "ann_prm_amt")


@query("p01_segment_row_counts", ALL + """SELECT CASE WHEN bi_limit_group <> 'NonAuto' AND telematics_ind <> -2 THEN 'Auto'
    WHEN bi_limit_group = 'NonAuto' AND telematics_ind = -2 THEN 'NonAuto' ELSE 'Neither' END AS segment,
    count(*) AS n FROM policies GROUP BY 1""")
def p01_counts(spark, d):
    return seg_ops.segment_counts(policies(spark, d))


@query("p03_positive_rows", ALL + "SELECT id, call_counts FROM policies WHERE call_counts > 0")
def p03(spark, d):
    return seg_ops.positives(policies(spark, d)).select(fixed.ID, fixed.TARGET)


@query("p04_labelled_and_unlabelled", ALL + """SELECT 'labelled' AS part, id FROM policies WHERE pol_edeliv_ind IN (0, 1, -1)
    UNION ALL SELECT 'unlabelled', id FROM policies WHERE pol_edeliv_ind NOT IN (0, 1, -1)""")
def p04(spark, d):
    df = policies(spark, d)
    parts = [f(df).select(F.lit(f.__name__).alias("part"), fixed.ID) for f in (seg_ops.labelled, seg_ops.unlabelled)]
    return parts[0].unionByName(parts[1])


@query("p05_sentinel_recode", ALL + """SELECT id, CASE WHEN pol_edeliv_ind IN (0, 1, -1) THEN pol_edeliv_ind END AS flag FROM policies""")
def p05(spark, d):
    return policies(spark, d).select(fixed.ID, S.known_flag().alias("flag"))


@query("p06_log_cap", ALL + """SELECT id, round(log(1 + least("12m_call_history", 40)), 9) AS history,
    round(log(1 + least(ann_prm_amt, 7200)), 9) AS premium, round(log(1 + least(tenure_at_snapshot, 500)), 9) AS tenure FROM policies""")
def p06(spark, d):
    return policies(spark, d).select(
        fixed.ID, r(S.log_cap("12m_call_history", 40), 9).alias("history"),
        r(S.log_cap("ann_prm_amt", fixed.PREMIUM_CAP), 9).alias("premium"),
        r(S.log_cap("tenure_at_snapshot", fixed.TENURE_CAP), 9).alias("tenure"))


@query("p07_hinge", ALL + """SELECT id, least(household_policy_counts, 2) AS low2, greatest(least(household_policy_counts, 4) - 2, 0) AS high2,
    least(household_policy_counts, 3) AS low3, greatest(least(household_policy_counts, 5) - 3, 0) AS high3 FROM policies""")
def p07(spark, d):
    a, b = S.hinge("household_policy_counts", 2, 4)
    c, e = S.hinge("household_policy_counts", 3, 5)
    return policies(spark, d).select(fixed.ID, a.alias("low2"), b.alias("high2"), c.alias("low3"), e.alias("high3"))


@query("p08_log_hinge", ALL + """SELECT id, round(log(1 + least(tenure_at_snapshot, 300)), 9) AS low,
    round(log(1 + greatest(least(tenure_at_snapshot, 500) - 300, 0)), 9) AS high FROM policies""")
def p08(spark, d):
    low, high = S.log_hinge("tenure_at_snapshot", fixed.TENURE_KNOT, fixed.TENURE_CAP)
    return policies(spark, d).select(fixed.ID, r(low, 9).alias("low"), r(high, 9).alias("high"))


@query("p09_plain_cap", ALL + "SELECT id, least(household_policy_counts, 4) AS cap4, least(household_policy_counts, 5) AS cap5 FROM policies")
def p09(spark, d):
    return policies(spark, d).select(fixed.ID, S.cap("household_policy_counts", 4).alias("cap4"),
                                     S.cap("household_policy_counts", 5).alias("cap5"))


@query("p10_equality_indicator", ALL + """SELECT id, CASE WHEN channel = 'Retail' THEN 1 ELSE 0 END AS retail,
    CASE WHEN household_group = '1dwelling' THEN 1 ELSE 0 END AS dwelling,
    CASE WHEN household_group = '2autodwelling' THEN 1 ELSE 0 END AS auto_dwelling,
    CASE WHEN trm_len_mo = 12 THEN 1 ELSE 0 END AS long_term FROM policies""")
def p10(spark, d):
    return policies(spark, d).select(
        fixed.ID, S.indicator(F.col("channel") == fixed.RETAIL).alias("retail"),
        S.indicator(F.col("household_group") == fixed.HOUSEHOLD_FLAG["nonauto"]).alias("dwelling"),
        S.indicator(F.col("household_group") == fixed.HOUSEHOLD_FLAG["auto"]).alias("auto_dwelling"),
        S.indicator(F.col("trm_len_mo") == fixed.LONG_TERM).alias("long_term"))


@query("p11_nonzero_target", ALL + "SELECT id, CASE WHEN call_counts > 0 THEN 1 ELSE 0 END AS nonzero_call FROM policies")
def p11(spark, d):
    return policies(spark, d).select(fixed.ID, S.nonzero().alias(fixed.NONZERO))


@query("p12_grid_bins", ALL + """SELECT id, least(("12m_call_history" / 5)::INT * 5, 40) AS history, least((ann_prm_amt / 900)::INT * 900, 7200) AS premium,
    (home_lot_sq_footage / 10000)::INT * 10000 AS lot, least((tenure_at_snapshot / 100)::INT * 100, 500) AS tenure FROM policies""")
def p12(spark, d):
    return policies(spark, d).select(
        fixed.ID, S.grid_bin("12m_call_history", fixed.HISTORY_BIN, 40).alias("history"),
        S.grid_bin("ann_prm_amt", fixed.PREMIUM_BIN, fixed.PREMIUM_CAP).alias("premium"),
        S.grid_bin("home_lot_sq_footage", fixed.LOT_BIN).alias("lot"),
        S.grid_bin("tenure_at_snapshot", fixed.TENURE_BIN, fixed.TENURE_CAP).alias("tenure"))


@query("p13_level_text", ALL + """SELECT id, CAST(telematics_ind AS VARCHAR) AS telematics, CAST(tenure_at_snapshot AS VARCHAR) AS tenure FROM policies""")
def p13(spark, d):
    return policies(spark, d).select(fixed.ID, S.level_text("telematics_ind").alias("telematics"),
                                     S.level_text("tenure_at_snapshot").alias("tenure"))


@query("p14_category_text", ALL + """SELECT id, coalesce(CAST(CASE WHEN pol_edeliv_ind IN (0, 1, -1) THEN pol_edeliv_ind END AS VARCHAR), '<NA>') AS category FROM policies""")
def p14(spark, d):
    return policies(spark, d).select(fixed.ID, S.category_text(S.known_flag()).alias("category"))


_LOG_LONG = """, l AS (SELECT segment, '12m_call_history' AS "Variable",
      ln(1 + least("12m_call_history", CASE segment WHEN 'Auto' THEN 40 ELSE 30 END)) AS value FROM m
    UNION ALL SELECT segment, 'ann_prm_amt', ln(1 + least(ann_prm_amt, 7200)) FROM m
    UNION ALL SELECT segment, 'tenure_at_snapshot', ln(1 + least(tenure_at_snapshot, 500)) FROM m)
"""


@query("p15_log_capped_long", _BOTH + _LOG_LONG + """
    SELECT segment, "Variable", round(value, 6) AS value, count(*) AS n FROM l GROUP BY ALL""")
def p15(spark, d):
    long = profiles.log_capped_values(both_segments(spark, d))
    return long.groupBy("segment", "Variable", r("value").alias("value")).agg(F.count(F.lit(1)).alias("n"))


def both_segments(spark, d):
    """All columns of both segments with a segment label; filled flag as it stands."""
    return seg_ops.both_segments(policies(spark, d)).withColumnRenamed(fixed.IMPUTED, fixed.FILLED)


_VIEWS = [("p17", "baseline", "auto"), ("p18", "baseline", "nonauto"), ("p19", "binary", "auto"),
          ("p20", "count", "auto"), ("p21", "binary", "nonauto"), ("p22", "count", "nonauto")]
for _id, _stage, _seg in _VIEWS:
    _only = " WHERE call_counts > 0" if _stage == "count" else ""

    @query(f"{_id}_{_stage}_view_{_seg}", sql.raw(_seg) + sql.view_select(_stage, _seg, filled="pol_edeliv_ind") + " FROM s" + _only)
    def _(spark, d, stage=_stage, seg=_seg):
        rows = raw_filled(spark, d, seg)
        rows = seg_ops.positives(rows) if stage == "count" else rows
        return rounded(feature_view(rows, stage, seg), 9, *sql.LOGGED)


@query("p19_unlabelled_view_auto", sql.raw("auto") + sql.view_select("binary", "auto", False, "pol_edeliv_ind") + " FROM s")
def p19_unlabelled(spark, d):
    rows = raw_filled(spark, d, "auto").drop(fixed.TARGET)
    return rounded(feature_view(rows, "binary", "auto", has_target=False), 9, *sql.LOGGED)


for _seg in SEGS:
    @query(f"p23_level_view_{_seg}", sql.raw(_seg) + "SELECT id, " + ", ".join(
        f"{e} AS {v}" for v, e in sql.levels(_seg, "pol_edeliv_ind").items()) + ", call_counts FROM s")
    def _(spark, d, seg=_seg):
        return level_view(raw_filled(spark, d, seg), seg, [fixed.TARGET])


# -- joins ------------------------------------------------------------------------------------

@query("j01_fill_from_imputed", ALL + """, i AS (SELECT id, CAST(household_policy_counts % 2 AS INTEGER) AS imputed FROM policies)
    SELECT p.id, CASE WHEN pol_edeliv_ind = -2 THEN imputed ELSE pol_edeliv_ind END AS pol_edeliv_ind_filled FROM policies p LEFT JOIN i ON p.id = i.id""")
def j01(spark, d):
    df = policies(spark, d)
    imputed = df.select(fixed.ID, (F.col("household_policy_counts") % 2).cast("int").alias("imputed"))
    return fill_from(df.select(fixed.ID, fixed.IMPUTED), imputed)


@query("j02_attach_predictions", ALL + f"SELECT id, household_group, round({PSEUDO}, 6) AS pred FROM policies")
def j02(spark, d):
    df = policies(spark, d)
    joined = levels.attach_predictions(df.select(fixed.ID, "household_group"), pseudo(df).select(fixed.ID, "pred"))
    return rounded(joined, 6, "pred")


@query("j03_stage_alignment", ALL + f"""SELECT id, round(1.0 / (1 + household_policy_counts) * ({PSEUDO}), 6) AS y_hat FROM policies""")
def j03(spark, d):
    df = policies(spark, d)
    first = df.select(fixed.ID, (1.0 / (1 + F.col("household_policy_counts"))).alias("p"))
    second = pseudo(df).select(fixed.ID, F.col("pred").alias("mean"))
    return first.join(second, fixed.ID).select(fixed.ID, r(F.col("p") * F.col("mean")).alias("y_hat"))


# -- aggregates -------------------------------------------------------------------------------

_LEVEL_SUMS = """SUM(CASE WHEN call_counts > 0 THEN 1 ELSE 0 END)::BIGINT AS "ActualCnt", COUNT(*) AS "TotalCnt",
    SUM(CASE WHEN call_counts > 0 THEN call_counts ELSE 0 END)::DOUBLE AS "SumGivenPositive" """
_LEVEL_RATES = """round("ActualCnt" / "TotalCnt", 9) AS {rate},
    round(CASE WHEN "ActualCnt" > 0 THEN "SumGivenPositive" / "ActualCnt" END, 9) AS "MeanGivenPositive" """

for _seg in SEGS:
    @query(f"a01_level_table_{_seg}", sql.imputed(_seg) + ", l AS (" + sql.stacked(sql.levels(_seg), "filled", "call_counts") + f"""),
    g AS (SELECT "Variable", "ValVar", {_LEVEL_SUMS} FROM l GROUP BY 1, 2)
    SELECT *, {_LEVEL_RATES.format(rate='"Rate"')}, round("SumGivenPositive" / "TotalCnt", 9) AS "MarginalMean" FROM g""")
    def _(spark, d, seg=_seg):
        rows = level_view(prepare(policies(spark, d), seg).rows, seg, [fixed.TARGET])
        table = levels.level_table(rows, fixed.LEVEL_VARIABLES[seg])
        return rounded(table, 9, "Rate", "MeanGivenPositive", "MarginalMean")

    @query(f"a02_level_rates_{_seg}", sql.raw(_seg) + ", l AS (" + sql.stacked(sql.levels(_seg, "pol_edeliv_ind"), "s", "call_counts") + f"""),
    g AS (SELECT "Variable", "ValVar", {_LEVEL_SUMS} FROM l GROUP BY 1, 2)
    SELECT "Variable", "ValVar", {_LEVEL_RATES.format(rate='"Rate"')}, round("SumGivenPositive" / "TotalCnt", 9) AS "MarginalMean" FROM g""")
    def _(spark, d, seg=_seg):
        rows = level_view(raw_filled(spark, d, seg), seg, [fixed.TARGET])
        table = levels.level_table(rows, fixed.LEVEL_VARIABLES[seg])
        return rounded(table, 9, "Rate", "MeanGivenPositive", "MarginalMean").select(
            "Variable", "ValVar", "Rate", "MeanGivenPositive", "MarginalMean")

    @query(f"a03_rate_calibration_{_seg}", sql.split(_seg) + ", l AS (" + sql.stacked(
        sql.levels(_seg, "pol_edeliv_ind"), "sp", f'"Sample", call_counts, ({PSEUDO}) / 100 AS pred') + f"""),
    g AS (SELECT "Variable", "ValVar", "Sample", SUM(pred) AS "PredCnt", {_LEVEL_SUMS} FROM l GROUP BY 1, 2, 3)
    SELECT * REPLACE (round("PredCnt", 6) AS "PredCnt"), {_LEVEL_RATES.format(rate='"ActualRate"')}, round("PredCnt" / "TotalCnt", 8) AS "PredRate" FROM g""")
    def _(spark, d, seg=_seg):
        rows = ranking.with_sample(materialise(raw_filled(spark, d, seg), "segment"))
        rows = pseudo(rows).withColumn("pred", F.col("pred") / 100)
        table = levels.rate_calibration(level_view(rows, seg, [fixed.TARGET, "Sample", "pred"]), fixed.LEVEL_VARIABLES[seg])
        return rounded(rounded(rounded(table, 6, "PredCnt"), 8, "PredRate"), 9, "ActualRate", "MeanGivenPositive")

    for _id, _what, _where in (("a04", "conditional", " WHERE call_counts > 0"), ("a05", "combined", "")):
        @query(f"{_id}_{_what}_calibration_{_seg}", sql.split(_seg) + ", l AS (" + sql.stacked(
            sql.levels(_seg, "pol_edeliv_ind"), "sp" + _where, f'"Sample", call_counts, {PSEUDO} AS pred') + """)
    SELECT "Variable", "ValVar", "Sample", round(AVG(pred), 9) AS "PredMean", round(AVG(call_counts), 9) AS "ActualMean", COUNT(*) AS "TotalCnt"
    FROM l GROUP BY 1, 2, 3""")
        def _(spark, d, seg=_seg, positive=bool(_where)):
            rows = pseudo(ranking.with_sample(materialise(raw_filled(spark, d, seg), "segment")))
            rows = seg_ops.positives(rows) if positive else rows
            table = levels.mean_calibration(level_view(rows, seg, [fixed.TARGET, "Sample", "pred"]), fixed.LEVEL_VARIABLES[seg])
            return rounded(table, 9, "PredMean", "ActualMean")

def _quart(v):
    return f"round(quantile_cont({v}, 0.25), 6) AS q1, round(quantile_cont({v}, 0.5), 6) AS median, round(quantile_cont({v}, 0.75), 6) AS q3"


@query("a06_describe", _BOTH + f"""SELECT segment, count(call_counts) AS count, round(avg(call_counts), 6) AS mean, round(stddev_samp(call_counts), 6) AS std,
    min(call_counts)::DOUBLE AS min, max(call_counts)::DOUBLE AS max, {_quart('call_counts')} FROM m GROUP BY segment""")
def a06(spark, d):
    return rounded(profiles.describe(both_segments(spark, d), ["segment"], fixed.TARGET), 6, "mean", "std", "q1", "median", "q3")


@query("a06_describe_premium", _BOTH + f"""SELECT segment, count(ann_prm_amt) AS count, round(avg(ann_prm_amt), 6) AS mean, round(stddev_samp(ann_prm_amt), 6) AS std,
    round(min(ann_prm_amt), 6) AS min, round(max(ann_prm_amt), 6) AS max, {_quart('ann_prm_amt')} FROM m GROUP BY segment""")
def a06_premium(spark, d):
    table = profiles.describe(both_segments(spark, d), ["segment"], "ann_prm_amt")
    return rounded(table, 6, "mean", "std", "min", "max", "q1", "median", "q3")


@query("a07_dispersion", _BOTH + """SELECT segment, round(avg(call_counts), 6) AS mean, round(var_samp(call_counts), 6) AS var,
    round(avg(CASE WHEN call_counts = 0 THEN 1 ELSE 0 END), 6) AS zero_share,
    round(avg(call_counts) FILTER (WHERE call_counts <> 0), 6) AS mean_nonzero, round(var_samp(call_counts) FILTER (WHERE call_counts <> 0), 6) AS var_nonzero
    FROM m GROUP BY segment""")
def a07(spark, d):
    return rounded(profiles.dispersion(both_segments(spark, d), ["segment"]), 6, "mean", "var", "zero_share", "mean_nonzero", "var_nonzero")


_HIST = """, e AS (SELECT segment, min(call_counts)::DOUBLE AS lo, max(call_counts)::DOUBLE - min(call_counts) AS span FROM v GROUP BY segment),
    c AS (SELECT segment, CAST(least(floor((call_counts - lo) * 30 / span), 29) AS INTEGER) AS bin, count(*) AS n FROM v JOIN e USING (segment) GROUP BY 1, 2)
    SELECT e.segment, CAST(b.bin AS INTEGER) AS bin, round(lo + b.bin * span / 30, 6) AS left_edge, coalesce(n, 0) AS n
    FROM e CROSS JOIN (SELECT unnest(range(30)) AS bin) b LEFT JOIN c ON c.segment = e.segment AND c.bin = b.bin"""


@query("a08_histogram", _BOTH + ", v AS (SELECT * FROM m)" + _HIST)
def a08(spark, d):
    return rounded(profiles.histogram(both_segments(spark, d), ["segment"], fixed.TARGET), 6, "left_edge")


@query("a08_histogram_nonzero", _BOTH + ", v AS (SELECT * FROM m WHERE call_counts <> 0)" + _HIST)
def a08_nonzero(spark, d):
    rows = both_segments(spark, d).where(F.col(fixed.TARGET) != 0)
    return rounded(profiles.histogram(rows, ["segment"], fixed.TARGET), 6, "left_edge")


def _bar_sql():
    only = {"bi_limit_group": " WHERE segment = 'Auto'", "telematics_ind": " WHERE segment = 'Auto'",
            "channel": " WHERE segment = 'NonAuto'", "trm_len_mo": " WHERE segment = 'NonAuto'"}
    expr = lambda c: "pol_edeliv_ind" if c == fixed.FILLED else c
    stacks = "\nUNION ALL ".join(
        f"SELECT segment, '{c}' AS \"Variable\", coalesce(CAST({expr(c)} AS VARCHAR), '<NA>') AS \"Level\" FROM m{only.get(c, '')}"
        for c in fixed.BAR_COLUMNS)
    return _BOTH + f""", l AS ({stacks}), t AS (SELECT "Variable", "Level", count(*) FILTER (WHERE segment = 'Auto') AS "Auto",
    count(*) FILTER (WHERE segment = 'NonAuto') AS "NonAuto", count(*) AS "Total" FROM l GROUP BY 1, 2)
    SELECT *, CAST(row_number() OVER (PARTITION BY "Variable" ORDER BY CASE WHEN "Variable" = 'household_policy_counts' THEN CAST("Level" AS DOUBLE) END NULLS LAST,
    "Total" DESC, "Level") AS INTEGER) AS position FROM t"""


@query("a09_segment_value_counts", _bar_sql())
def a09(spark, d):
    return profiles.ordered_value_counts(profiles.segment_value_counts(both_segments(spark, d), fixed.BAR_COLUMNS))


@query("a09_capped_policy_counts", _BOTH + """SELECT segment, least(household_policy_counts, CASE segment WHEN 'Auto' THEN 4 ELSE 5 END) AS level, count(*) AS n FROM m GROUP BY 1, 2""")
def a09_capped(spark, d):
    top = F.when(F.col("segment") == "Auto", fixed.POLICY_COUNT_CAP["auto"]).otherwise(fixed.POLICY_COUNT_CAP["nonauto"])
    return both_segments(spark, d).groupBy("segment", S.cap("household_policy_counts", top).alias("level")).agg(F.count(F.lit(1)).alias("n"))


_BOX = """, q AS (SELECT segment, "Variable", quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median, quantile_cont(value, 0.75) AS q3
    FROM l GROUP BY 1, 2)
    SELECT segment, "Variable", count(*) AS n, round(min(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_low,
    round(max(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
    CAST(count(*) FILTER (WHERE NOT value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS BIGINT) AS outliers,
    round(any_value(q1), 6) AS q1, round(any_value(median), 6) AS median, round(any_value(q3), 6) AS q3
    FROM l JOIN q USING (segment, "Variable") GROUP BY 1, 2"""
_BOX_ROUND = ("whisker_low", "whisker_high", "q1", "median", "q3")


@query("a10_box_statistics", _BOTH + ", l AS (" + "\nUNION ALL ".join(
    f"SELECT segment, '{c}' AS \"Variable\", CAST({sql.quoted(c)} AS DOUBLE) AS value FROM m" for c in fixed.BOX_COLUMNS) + ")" + _BOX)
def a10(spark, d):
    long = profiles.long_values(both_segments(spark, d), fixed.BOX_COLUMNS)
    return rounded(profiles.box_statistics(long, ["segment", "Variable"]), 6, *_BOX_ROUND)


@query("a10_box_statistics_log_capped", _BOTH + _LOG_LONG + _BOX)
def a10_log(spark, d):
    long = profiles.log_capped_values(both_segments(spark, d))
    return rounded(profiles.box_statistics(long, ["segment", "Variable"]), 6, *_BOX_ROUND)


@query("a11_prediction_summary", _BOTH + f"""SELECT segment, count(*) AS n, count(DISTINCT id) AS ids, round(min({PSEUDO}), 6) AS min_pred,
    round(max({PSEUDO}), 6) AS max_pred, round(avg({PSEUDO}), 6) AS mean_pred FROM m GROUP BY segment""")
def a11(spark, d):
    table = profiles.prediction_summary(pseudo(both_segments(spark, d)), ["segment"], "pred")
    return rounded(table, 6, "min_pred", "max_pred", "mean_pred")


# -- ranks, split -----------------------------------------------------------------------------

@query("r01_running_sum", ALL + """SELECT id, CAST(sum(call_counts) OVER (ORDER BY "12m_call_history", id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM policies""")
def r01(spark, d):
    df = policies(spark, d).select(fixed.ID, "12m_call_history", fixed.TARGET)
    return ranking.with_running_sum(df, ["12m_call_history", fixed.ID], fixed.TARGET, "running").select(fixed.ID, "running")


@query("r02_ordered_levels", sql.raw("auto") + ", l AS (" + sql.stacked(sql.levels("auto", "pol_edeliv_ind"), "s", "1 AS one") + """),
    g AS (SELECT DISTINCT "Variable", "ValVar" FROM l),
    f AS (SELECT *, bool_and(TRY_CAST("ValVar" AS DOUBLE) IS NOT NULL) OVER (PARTITION BY "Variable") AS numeric FROM g)
    SELECT "Variable", "ValVar", CAST(row_number() OVER (PARTITION BY "Variable" ORDER BY
      CASE WHEN numeric THEN TRY_CAST("ValVar" AS DOUBLE) END NULLS LAST, "ValVar") AS INTEGER) AS position FROM f""")
def r02(spark, d):
    rows = level_view(raw_filled(spark, d, "auto"), "auto", [fixed.TARGET])
    table = levels.level_table(rows, fixed.LEVEL_VARIABLES["auto"]).select("Variable", "ValVar")
    return levels.ordered_levels(table)


for _seg in SEGS:
    @query(f"r03_holdout_split_{_seg}", sql.split(_seg) + 'SELECT id, "Sample" FROM sp')
    def _(spark, d, seg=_seg):
        return ranking.with_sample(materialise(segment(policies(spark, d), seg).select(fixed.ID), "segment"))


# -- unions -----------------------------------------------------------------------------------

@query("u01_train_and_val", sql.split("auto") + "SELECT id, call_counts FROM sp")
def u01(spark, d):
    rows = ranking.with_sample(materialise(segment(policies(spark, d), "auto"), "segment"))
    part = lambda s: rows.where(F.col("Sample") == s).select(fixed.ID, fixed.TARGET)
    return part("Train").unionByName(part("Val"))


@query("u02_union_with_sample", sql.split("nonauto") + 'SELECT id, call_counts, "Sample" FROM sp')
def u02(spark, d):
    rows = ranking.with_sample(materialise(segment(policies(spark, d), "nonauto"), "segment"))
    part = lambda s: rows.where(F.col("Sample") == s).select(fixed.ID, fixed.TARGET)
    return seg_ops.union_samples(part("Train"), part("Val"))


@query("u03_union_of_segments", ALL + f"SELECT id, round({PSEUDO}, 6) AS call_counts FROM policies")
def u03(spark, d):
    df = materialise(pseudo(policies(spark, d)), "scored")
    part = lambda s: segment(df, s).select(fixed.ID, r("pred").alias(fixed.TARGET))
    return part("auto").unionByName(part("nonauto"))
