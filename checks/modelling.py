"""Encoders, imputation, model fits and metrics.

A model on an intercept and the dummies of one category fits that category's group means,
whatever the dispersion, so a fit can be checked against a plain GROUP BY ("saturated").
A Poisson or logit fit on any dummies matches totals per level on its training rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import fits, sql
from checks.registry import query, r, rounded
from checks.relational import ALL, PSEUDO, SEGS, pseudo, raw_filled
from zerotally import fixed
from zerotally.operators import imputation, metrics, models
from zerotally.operators.encoder import Encoder, fit_encoder, scaling, training_levels
from zerotally.operators.levels import by_level
from zerotally.operators.newton import make_design
from zerotally.operators.ranking import with_sample
from zerotally.operators.segments import labelled, positives, segment
from zerotally.operators.selection import stepwise_logit
from zerotally.operators.views import feature_view
from zerotally.operators.wide import fit_wide
from zerotally.plans import hurdle as H
from zerotally.plans.prepare import Prepared, encode_stage, prepare, prepare_all
from zerotally.sources import csv_files
from zerotally.sources.policies import policies
from zerotally.workspace import materialise, scratch_path, together

GROUP = "acq_method"


def split_segment(spark, d, seg):
    return with_sample(materialise(segment(policies(spark, d), seg), "segment"))


# -- encoders ---------------------------------------------------------------------------------

@query("f01_training_levels", sql.split("auto") + ", l AS (" + sql.stacked(
    {n: ("pol_edeliv_ind" if n == "pol_edeliv_ind" else n) for n in fixed.NOMINAL["auto"]},
    "sp WHERE \"Sample\" = 'Train'", "1 AS one") + """)
    SELECT "Variable", "ValVar" AS "Level", count(*) AS n FROM l GROUP BY 1, 2""")
def f01(spark, d):
    rows = split_segment(spark, d, "auto").where(F.col("Sample") == "Train")
    return training_levels(rows, fixed.NOMINAL["auto"])


@query("f02_one_hot", sql.split("auto") + "SELECT id, " + ", ".join(
    f"CASE WHEN {n} = '{v}' THEN 1 ELSE 0 END AS \"{n}_{v}\""
    for n in ("acq_method", "bi_limit_group", "telematics_ind") for v in sql.NOMINAL_LEVELS[n][1:]) + " FROM sp")
def f02(spark, d):
    rows = split_segment(spark, d, "auto")
    nominal = ["acq_method", "bi_limit_group", "telematics_ind"]
    enc = fit_encoder(rows.where(F.col("Sample") == "Train").select(fixed.ID, *nominal), nominal, [])
    return ints(enc.apply(rows))


def ints(df: DataFrame) -> DataFrame:
    """Byte-wide dummies widened to int."""
    return df.select(*[F.col(f"`{n}`").cast("int").alias(n) if t == "tinyint" else F.col(f"`{n}`")
                       for n, t in df.dtypes])


@query("f03_standardise", sql.split("nonauto") + "SELECT id, " + ", ".join(
    f"round(({q} - avg({q}) FILTER (WHERE \"Sample\" = 'Train') OVER ()) / stddev_pop({q}) FILTER (WHERE \"Sample\" = 'Train') OVER (), 6) + 0 AS {q}"
    for q in map(sql.quoted, fixed.KNN_NUMERIC)) + " FROM sp")
def f03(spark, d):
    rows = split_segment(spark, d, "nonauto")
    narrow = rows.select(fixed.ID, *fixed.KNN_NUMERIC)
    enc = fit_encoder(rows.where(F.col("Sample") == "Train").select(*narrow.columns), [], fixed.KNN_NUMERIC)
    return rounded(enc.apply(narrow), 6, *fixed.KNN_NUMERIC)


for _stage in ("baseline", "binary", "count"):
    for _seg in SEGS:
        _only = " WHERE call_counts > 0" if _stage == "count" else ""
        _y = "nonzero_call" if _stage == "binary" else "call_counts"

        @query(f"f04_encoded_{_stage}_{_seg}", sql.imputed(_seg) + ", v AS (SELECT id, \"Sample\", " + ", ".join(
            f"{e} AS {sql.quoted(n)}" for n, e in sql.view(_stage, _seg).items())
            + ", CASE WHEN call_counts > 0 THEN 1 ELSE 0 END AS nonzero_call, call_counts FROM filled" + _only + ")\n"
            + sql.encoded_select(_stage, _seg) + f", {_y} FROM v")
        def _(spark, d, stage=_stage, seg=_seg):
            enc = encode_stage(prepare(policies(spark, d), seg), stage)
            return rounded(ints(enc.rows), 6, *fixed.NUMERIC[stage, seg])


@query("f05_geo_dummies", ALL + """SELECT id, CAST(geo_group = 'rural' AS INTEGER) AS geo_rural, CAST(geo_group = 'suburban' AS INTEGER) AS geo_suburban,
    CAST(geo_group = 'urban' AS INTEGER) AS geo_urban FROM policies""")
def f05(spark, d):
    return policies(spark, d).select(fixed.ID, *imputation.geo_dummies())


@query("s09_encoder_round_trip", sql.split("nonauto") + "SELECT id, " + ", ".join(
    f"CASE WHEN {n} = '{v}' THEN 1 ELSE 0 END AS \"{n}_{v}\"" for n in ("acq_method", "geo_group")
    for v in sql.NOMINAL_LEVELS[n][1:]) + " FROM sp")
def s09(spark, d):
    rows = split_segment(spark, d, "nonauto")
    nominal = ["acq_method", "geo_group"]
    path = scratch_path(spark, "encoder")
    fit_encoder(rows.select(fixed.ID, *nominal), nominal, []).save(spark, path)
    return ints(Encoder.load(spark, path).apply(rows))


# -- imputation -------------------------------------------------------------------------------

@query("i01_knn_features", sql.split("auto") + "," + sql.SCALES + """
    SELECT id, CASE WHEN pol_edeliv_ind IN (0, 1, -1) THEN pol_edeliv_ind END AS label, """ + ", ".join(
    f"round(({c} - m{i}) / s{i}, 6) + 0 AS {c}" for i, c in enumerate(map(sql.quoted, fixed.KNN_NUMERIC))) + """,
    digital_contact_ind, has_prior_carrier, CAST(geo_group = 'rural' AS INTEGER) AS geo_rural,
    CAST(geo_group = 'suburban' AS INTEGER) AS geo_suburban, CAST(geo_group = 'urban' AS INTEGER) AS geo_urban FROM sp, sc""")
def i01(spark, d):
    rows = split_segment(spark, d, "auto")
    scales = scaling(labelled(rows.where(F.col("Sample") == "Train")), fixed.KNN_NUMERIC)
    return rounded(imputation.knn_features(rows, scales), 6, *fixed.KNN_NUMERIC)


@query("i02_impute_training_rows", sql.imputed("auto") + "SELECT id, pol_edeliv_ind_filled FROM filled WHERE \"Sample\" = 'Train'")
def i02(spark, d):
    rows = split_segment(spark, d, "auto")
    filled, _ = imputation.fit_impute(rows.where(F.col("Sample") == "Train"))
    return filled.select(fixed.ID, fixed.FILLED)


for _seg in SEGS:
    @query(f"j04_nearest_neighbours_{_seg}", sql.split(_seg) + "," + sql.NEIGHBOURS + """
    SELECT id, nid, label, round(d2, 6) AS d2, CAST(place AS INTEGER) AS place FROM nb""")
    def _(spark, d, seg=_seg):
        rows = split_segment(spark, d, seg)
        imputer = imputation.fit_imputer(rows.where(F.col("Sample") == "Train"))
        return rounded(imputer.neighbours(rows), 6, "d2")

    @query(f"i03_majority_label_{_seg}", sql.imputed(_seg) + "SELECT id, imputed FROM imp")
    def _(spark, d, seg=_seg):
        rows = split_segment(spark, d, seg)
        imputer = imputation.fit_imputer(rows.where(F.col("Sample") == "Train"))
        return imputer.predict(rows)

    # the rows asked about are not those that were fitted
    @query(f"i04_impute_unseen_after_reload_{_seg}", sql.with_(sql.training(_seg), sql.SPLIT, sql.unseen(_seg), sql.imputing("un"))
           + "SELECT id, pol_edeliv_ind_filled FROM filled")
    def _(spark, d, seg=_seg):
        rows, path = policies(spark, d), scratch_path(spark, "prepared")
        prepare(rows.where("id % 5 <> 4"), seg).save(spark, path)
        again = Prepared.load(spark, path, seg)
        return again.impute(rows.where("id % 5 = 4").drop(fixed.TARGET)).select(fixed.ID, fixed.FILLED)

    @query(f"i04_impute_with_frozen_imputer_{_seg}", sql.imputed(_seg) + "SELECT id, pol_edeliv_ind_filled FROM filled")
    def _(spark, d, seg=_seg):
        table = materialise(policies(spark, d), "policies")
        return prepare(table, seg).impute(table.drop(fixed.TARGET)).select(fixed.ID, fixed.FILLED)


# -- saturated fits ---------------------------------------------------------------------------

def saturated(spark, d, seg, binary=False, positive=False):
    """Rows, encoder and compressed design on the dummies of one category."""
    rows = segment(policies(spark, d), seg)
    rows = positives(rows) if positive else rows
    y = F.when(F.col(fixed.TARGET) > 0, 1).otherwise(0) if binary else F.col(fixed.TARGET)
    rows = rows.select(fixed.ID, GROUP, y.alias("y"))
    enc = fit_encoder(rows, [GROUP], [], exclude=["y"])
    return rows, enc, make_design(enc.apply(rows, ["y"]), enc.names, "y", compress=True)


def by_group(rows, enc, model):
    """Predicted mean per level; the model's features come straight from the level."""
    scored = rows.withColumn("pred", model.predict({f.name: f.column() for f in enc.features}))
    return scored.groupBy(F.col(GROUP).alias("level")).agg(
        F.count(F.lit(1)).alias("n"), r(F.avg("pred"), 5).alias("predicted"))


def _means(seg, value="call_counts", where=""):
    return sql.raw(seg) + f"SELECT acq_method AS level, count(*) AS n, round(avg({value}), 5) AS predicted FROM s {where} GROUP BY 1"


_FITS = [
    ("m01_poisson", models.fit_poisson, {}, "call_counts", ""),
    ("m02_negative_binomial", models.fit_nb, {}, "call_counts", ""),
    ("m03_zero_truncated_nb", models.fit_ztnb, {"positive": True}, "call_counts", "WHERE call_counts > 0"),
    ("m05_zero_inflated_poisson", models.fit_zip, {}, "call_counts", ""),
    ("m06_zero_inflated_nb", models.fit_zinb, {}, "call_counts", ""),
    ("m07_logit", models.fit_logit, {"binary": True}, "CASE WHEN call_counts > 0 THEN 1 ELSE 0 END", ""),
]
for _name, _fit, _kind, _value, _where in _FITS:
    for _seg in SEGS:
        @query(f"{_name}_{_seg}", _means(_seg, _value, _where))
        def _(spark, d, fit=_fit, kind=_kind, seg=_seg):
            rows, enc, design = saturated(spark, d, seg, **kind)
            return by_group(rows, enc, fit(design))


@query("m04_warm_start", sql.raw("auto") + """SELECT 'zero' AS part, acq_method AS level, count(*) AS n, round(avg(CASE WHEN call_counts = 0 THEN 1 ELSE 0 END), 5) AS predicted FROM s GROUP BY 2
    UNION ALL SELECT 'positive', acq_method, count(*), round(avg(call_counts) FILTER (WHERE call_counts > 0), 5) FROM s GROUP BY 2""")
def m04(spark, d):
    rows, enc, design = saturated(spark, d, "auto")
    zero, positive = models.zi_warm_start(design)
    part = lambda name, m: by_group(rows, enc, m).select(F.lit(name).alias("part"), "*")
    return part("zero", zero).unionByName(part("positive", positive))


@query("m08_unscaled_logit", sql.raw("nonauto") + """SELECT count(*) AS n, round(avg(y), 6) AS mean_pred, round(avg(y * ann_prm_amt) / avg(ann_prm_amt), 6) AS premium_weighted,
    round(avg(y * tenure_at_snapshot) / avg(tenure_at_snapshot), 6) AS tenure_weighted FROM (SELECT *, CASE WHEN call_counts > 0 THEN 1 ELSE 0 END AS y FROM s)""")
def m08(spark, d):
    rows = segment(policies(spark, d), "nonauto")
    features = ["ann_prm_amt", "tenure_at_snapshot", "has_prior_carrier"]
    target = rows.select(*features, F.when(F.col(fixed.TARGET) > 0, 1).otherwise(0).alias("y"))
    design = make_design(target, features, "y")
    model = models.fit_logit_unscaled(design)
    column = design.expressions()
    scored = design.rows.withColumn("pred", model.predict(column))
    weighted = lambda c: F.avg(F.col("pred") * column[c]) / F.avg(column[c])
    return scored.agg(F.count(F.lit(1)).alias("n"), r(F.avg("pred")).alias("mean_pred"),
                      r(weighted("ann_prm_amt")).alias("premium_weighted"),
                      r(weighted("tenure_at_snapshot")).alias("tenure_weighted"))


# a p-value above 0.2 is a |z| below this
_WEAK_Z = 1.2815515655446004


@query("m09_constrained_logit", ALL + f""", y AS (SELECT *, CASE WHEN call_counts > 0 THEN 1.0::DOUBLE ELSE 0 END AS hit FROM policies),
    g AS (SELECT acq_method AS level, count(*) AS n, avg(hit) AS p FROM y GROUP BY 1),
    b AS (SELECT n AS n0, p AS p0 FROM g WHERE level = 'method1'),
    z AS (SELECT level, level <> 'method1' AND abs(ln(p / (1 - p)) - ln(p0 / (1 - p0)))
                 / sqrt(1 / (n * p * (1 - p)) + 1 / (n0 * p0 * (1 - p0))) < {_WEAK_Z} AS weak FROM g, b),
    m AS (SELECT CASE WHEN weak THEN 'method1' ELSE y.acq_method END AS merged, y.* FROM y JOIN z ON z.level = y.acq_method),
    pm AS (SELECT merged, avg(hit) AS p FROM m GROUP BY 1)
    SELECT acq_method AS level, count(*) AS n, round(any_value(p), 5) AS predicted FROM m JOIN pm USING (merged) GROUP BY 1""")
def m09(spark, d):
    rows = policies(spark, d).select(fixed.ID, GROUP, F.when(F.col(fixed.TARGET) > 0, 1).otherwise(0).alias("y"))
    enc = fit_encoder(rows, [GROUP], [], exclude=["y"])
    design = make_design(enc.apply(rows, ["y"]), enc.names, "y", compress=True)
    return by_group(rows, enc, models.fit_logit_constrained(design, models.fit_logit(design), 0.2))


@query("m09_constrained_inference", ALL + f""", y AS (SELECT *, CASE WHEN call_counts > 0 THEN 1.0::DOUBLE ELSE 0 END AS hit FROM policies),
    g AS (SELECT acq_method AS level, count(*) AS n, avg(hit) AS p FROM y GROUP BY 1),
    b AS (SELECT n AS n0, p AS p0 FROM g WHERE level = 'method1'),
    z AS (SELECT level, n, p, level <> 'method1' AND abs(ln(p / (1 - p)) - ln(p0 / (1 - p0)))
                 / sqrt(1 / (n * p * (1 - p)) + 1 / (n0 * p0 * (1 - p0))) < {_WEAK_Z} AS weak FROM g, b),
    m AS (SELECT sum(n * p) / sum(n) AS pm FROM z WHERE weak OR level = 'method1'),
    c AS (SELECT level, weak, n, CASE WHEN weak OR level = 'method1' THEN pm ELSE p END AS q, pm FROM z, m),
    v AS (SELECT *, 1 / (n * q * (1 - q)) AS v, ln(q / (1 - q)) - ln(pm / (1 - pm)) AS b FROM c), v0 AS (SELECT v AS base FROM v WHERE level = 'method1')
    SELECT CASE WHEN level = 'method1' THEN 'const' ELSE 'acq_method_' || level END AS term, round(CASE WHEN level = 'method1' THEN ln(pm / (1 - pm)) ELSE b END, 5) + 0 AS coef,
        round(sqrt(CASE WHEN level = 'method1' THEN base ELSE v + base END), 5) AS se, weak AS held FROM v, v0""")
def m09_inference(spark, d):
    rows = policies(spark, d).select(fixed.ID, GROUP, F.when(F.col(fixed.TARGET) > 0, 1).otherwise(0).alias("y"))
    enc = fit_encoder(rows, [GROUP], [], exclude=["y"])
    design = make_design(enc.apply(rows, ["y"]), enc.names, "y", compress=True)
    held = models.fit_logit_constrained(design, models.fit_logit(design), 0.2)
    table = held.coefficient_frame(spark).withColumn("held", F.col("coef") == 0)
    return table.select("term", (r("coef", 5) + 0).alias("coef"), r("se", 5).alias("se"), "held")


_WIDE = {"lot": "CAST(floor(home_lot_sq_footage / 1000) AS INTEGER)", "months": "CAST(floor(tenure_at_snapshot / 4) AS INTEGER)", "calls": '"12m_call_history"'}

for _family, _hit in (("logit", "CASE WHEN call_counts > 0 THEN 1 ELSE 0 END"), ("poisson", "call_counts")):
    # several hundred dummies, fitted without a square of their number; every level's total must be met
    @query(f"m07_wide_{_family}_level_totals", ALL + ", w AS (SELECT " + ", ".join(f"CAST({e} AS VARCHAR) AS {n}" for n, e in _WIDE.items()) + f""", {_hit} AS y FROM policies),
    l AS ({sql.stacked({n: n for n in _WIDE if n != "calls"}, "w", "y")})
    SELECT "Variable", "ValVar", count(*) AS n, round(sum(y), 2) + 0.0::DOUBLE AS predicted FROM l GROUP BY 1, 2""")
    def _(spark, d, family=_family):
        rows = policies(spark, d).select(F.floor(F.col("home_lot_sq_footage") / 1000).cast("int").cast("string").alias("lot"),
                                         F.floor(F.col("tenure_at_snapshot") / 4).cast("int").cast("string").alias("months"), F.col("12m_call_history").cast("double").alias("calls"),
                                         (F.when(F.col(fixed.TARGET) > 0, 1).otherwise(0) if family == "logit" else F.col(fixed.TARGET)).alias("y"))
        rows = materialise(rows, "wide")
        scored = fit_wide(rows, ["lot", "months"], ["calls"], "y", family, allow_unconverged=True).predict(rows)
        return by_level(scored, ["lot", "months"], ["pred"]).groupBy("Variable", "ValVar").agg(
            F.count(F.lit(1)).alias("n"), r(F.sum("pred"), 2).alias("predicted"))


@query("m12_coefficient_table", sql.raw("nonauto") + """, g AS (SELECT acq_method AS level, count(*) AS n, avg(CASE WHEN call_counts > 0 THEN 1 ELSE 0 END) AS p FROM s GROUP BY 1),
    v AS (SELECT level, ln(p / (1 - p)) AS b, 1 / (n * p * (1 - p)) AS v FROM g), b AS (SELECT b AS b0, v AS v0 FROM v WHERE level = 'method1'),
    c AS (SELECT CASE WHEN level = 'method1' THEN 'const' ELSE 'acq_method_' || level END AS term, CASE WHEN level = 'method1' THEN b ELSE b - b0 END AS coef,
    CASE WHEN level = 'method1' THEN sqrt(v) ELSE sqrt(v + v0) END AS se FROM v, b)
    SELECT term, round(coef, 5) AS coef, round(se, 5) AS se, round(coef / se, 4) AS z FROM c""")
def m12(spark, d):
    _, _, design = saturated(spark, d, "nonauto", binary=True)
    table = models.fit_logit(design).coefficient_frame(spark)
    return table.select("term", r("coef", 5).alias("coef"), r("se", 5).alias("se"), r("z", 4).alias("z"))


@query("m13_loglik_and_aic", sql.raw("auto") + """, f AS (SELECT call_counts AS y, avg(call_counts) OVER (PARTITION BY acq_method) AS mu FROM s),
    t AS (SELECT sum(y * ln(mu) - mu - lgamma(y + 1)) AS ll, count(*)::DOUBLE AS n FROM f)
    SELECT 'poisson' AS family, n, CAST(5 AS INTEGER) AS k, round(ll, 3) AS loglik, round(2 * 5 - 2 * ll, 3) AS aic FROM t""")
def m13(spark, d):
    _, _, design = saturated(spark, d, "auto")
    table = models.fit_poisson(design).statistics_frame(spark)
    return table.select("family", "n", "k", r("loglik", 3).alias("loglik"), r("aic", 3).alias("aic"))


@query("m11_predict_with_fixed_coefficients", ALL + """, x AS (SELECT id, 0.5 + 0.02 * least("12m_call_history", 40) - 0.1 * has_prior_carrier AS eta, -0.3 + 0.05 * household_policy_counts AS zeta FROM policies)
    SELECT id, round(exp(eta), 6) AS poisson, round(1 / (1 + exp(-eta)), 6) AS logit, round(exp(eta) / (1 - pow(1 + 0.7 * exp(eta), -1 / 0.7)), 6) AS ztnb,
    round((1 - 1 / (1 + exp(-zeta))) * exp(eta), 6) AS zinb FROM x""")
def m11(spark, d):
    c = lambda part, term, b: models.Coefficient(part, term, b, 0.0, 0.0, 0.0)
    eta = [c("count", "const", 0.5), c("count", "history", 0.02), c("count", "has_prior_carrier", -0.1)]
    zeta = [c("inflate", "const", -0.3), c("inflate", "household_policy_counts", 0.05)]
    alpha = [c("dispersion", "alpha", 0.7)]
    parts = {"poisson": eta, "logit": eta, "ztnb": eta + alpha, "zinb": zeta + eta + alpha}
    rows = policies(spark, d).withColumn("history", F.least("12m_call_history", F.lit(40)))
    return rows.select(fixed.ID, *[
        r(models.Model(f, cs, 0.0, 0, 0.0, 0, True, []).predict()).alias(f) for f, cs in parts.items()])


@query("s10_model_round_trip", _means("auto"))
def s10(spark, d):
    rows, enc, design = saturated(spark, d, "auto")
    path = scratch_path(spark, "model")
    models.fit_poisson(design).save(spark, path)
    return by_group(rows, enc, models.Model.load(spark, path))


# -- the hurdle on one category, then on all features -----------------------------------------

_TRAIN_MEANS = ", t AS (SELECT acq_method, avg(call_counts) AS mean FROM sp WHERE \"Sample\" = 'Train' GROUP BY 1)"
for _seg in SEGS:
    @query(f"m14_hurdle_product_{_seg}", sql.split(_seg) + _TRAIN_MEANS + """
    SELECT acq_method AS level, count(*) AS n, round(any_value(mean), 5) AS predicted FROM sp JOIN t USING (acq_method) WHERE "Sample" = 'Val' GROUP BY 1""")
    def _(spark, d, seg=_seg):
        data = prepare(policies(spark, d), seg)
        scored = H.fit_hurdle(data, nominal=[GROUP]).score(data.sample("Val"), [fixed.ID, GROUP])
        return scored.groupBy(F.col(GROUP).alias("level")).agg(
            F.count(F.lit(1)).alias("n"), r(F.avg("y_hat"), 5).alias("predicted"))


@query("m15_final_refit", _means("nonauto"))
def m15(spark, d):
    data = prepare(policies(spark, d), "nonauto")
    scored = H.fit_hurdle(data, final=True, nominal=[GROUP]).score(data.rows, [fixed.ID, GROUP])
    return scored.groupBy(F.col(GROUP).alias("level")).agg(
        F.count(F.lit(1)).alias("n"), r(F.avg("y_hat"), 5).alias("predicted"))


@query("m16_score_unlabelled_rows", ALL + """SELECT id, round(avg(call_counts) OVER (PARTITION BY bi_limit_group = 'NonAuto', acq_method), 4) AS call_counts FROM policies""")
def m16(spark, d):
    train = materialise(policies(spark, d), "policies")
    fitted = H.fit_all(prepare_all(train), final=True, nominal=[GROUP])
    return rounded(H.predict_unseen(fitted, train.drop(fixed.TARGET)), 4, fixed.TARGET)


@query("m16_csv_to_scores", ALL + """, t AS (SELECT bi_limit_group = 'NonAuto' AS other, acq_method, avg(call_counts) AS mean FROM policies WHERE id % 5 <> 4 GROUP BY 1, 2)
    SELECT id, round(mean, 4) AS call_counts FROM policies p JOIN t ON t.other = (p.bi_limit_group = 'NonAuto') AND t.acq_method = p.acq_method WHERE id % 5 = 4""")
def m16_csv(spark, d):
    rows, path = materialise(policies(spark, d), "policies"), scratch_path(spark, "csv")
    rows.where("id % 5 <> 4").write.csv(f"{path}/train", header=True)
    rows.where("id % 5 = 4").drop(fixed.TARGET).write.csv(f"{path}/test", header=True)
    H.train_from_csv(spark, f"{path}/train", f"{path}/model", nominal=[GROUP])
    H.score_csv(spark, f"{path}/test", f"{path}/model", f"{path}/scores")
    return rounded(csv_files.read_predictions(spark, f"{path}/scores"), 4, fixed.TARGET)


@query("m16_score_unlabelled_rows_all_features", "WITH " + ", ".join(
    f"{seg}_all AS ({fits.imputed(seg, *fits.hurdle(seg, final=True))} SELECT id, yh FROM scored)" for seg in SEGS)
    + "\nSELECT id, round(yh, 3) AS call_counts FROM (SELECT * FROM auto_all UNION ALL SELECT * FROM nonauto_all)")
def m16_full(spark, d):
    train = materialise(policies(spark, d), "policies")
    scores = H.predict_unseen(H.fit_all(prepare_all(train), final=True), train.drop(fixed.TARGET))
    return rounded(scores, 3, fixed.TARGET)


def _gini_sql(source, y, p, out):
    return f"""{out} AS (SELECT ((sum(cum) / sum(y)) - (count(*) + 1) / 2.0) / count(*) AS g FROM
    (SELECT y, sum(y) OVER (ORDER BY p DESC, id ROWS UNBOUNDED PRECEDING) AS cum FROM (SELECT id, {y} AS y, {p} AS p FROM {source})))"""


@query("m17_baseline_comparison", sql.split("auto") + _TRAIN_MEANS + """, f AS (SELECT * FROM sp JOIN t USING (acq_method)),
    """ + ",\n".join(_gini_sql(f"f WHERE \"Sample\" = '{s}'", "call_counts", "mean" if k == "p" else "call_counts", f"{s}_{k}") for s in ("Train", "Val") for k in "py") + """
    SELECT m || ' ' || lower(s) AS label, round(rmse, 4) AS rmse, round(gini, 4) AS normalized_gini, true AS converged FROM (SELECT 'Train' AS s, (SELECT g FROM Train_p) / (SELECT g FROM Train_y) AS gini
    UNION ALL SELECT 'Val', (SELECT g FROM Val_p) / (SELECT g FROM Val_y))
    JOIN (SELECT "Sample" AS s, sqrt(avg((call_counts - mean) * (call_counts - mean))) AS rmse FROM f GROUP BY 1) USING (s)
    CROSS JOIN (SELECT unnest(['Poisson', 'ZIP', 'ZINB']) AS m)""")
def m17(spark, d):
    data = prepare(policies(spark, d), "auto")
    encoded, fitted = H.baseline_models(data, nominal=[GROUP])
    table = H.baseline_comparison(encoded, fitted).drop("aic", "steps")
    return rounded(table, 4, "rmse", "normalized_gini")


_IN_TRAIN = "\"Sample\" = 'Train'"
for _seg in SEGS:
    _text, _names = fits.design("xx", "baseline", _seg)
    _models = {"Poisson": fits.Fit("f1", "poisson", "xx", len(_names), _IN_TRAIN), "ZIP": fits.Fit("f2", "zip", "xx", len(_names), _IN_TRAIN),
               "ZINB": fits.Fit("f3", "zinb", "xx", len(_names), _IN_TRAIN)}

    @query(f"m17_baseline_comparison_all_features_{_seg}", fits.imputed(
        _seg, _text, *[m.ctes() for m in _models.values()],
        "preds AS MATERIALIZED (SELECT id, \"Sample\" AS s, y, " + ", ".join(f"{m.mean()} AS {m.name}_p" for m in _models.values()) + " FROM xx, f1, f2, f3)",
        *[_gini_sql(f"preds WHERE s = '{s}'", "y", f"{m.name}_p", f"{m.name}_{s}") for m in _models.values() for s in ("Train", "Val")],
        *[_gini_sql(f"preds WHERE s = '{s}'", "y", "y", f"best_{s}") for s in ("Train", "Val")]) + "\nUNION ALL ".join(
        f"SELECT '{label} {s.lower()}' AS label, round((SELECT sqrt(avg((y - {m.name}_p) ** 2)) FROM preds WHERE s = '{s}'), 6) AS rmse, "
        f"round(2 * {m.n} - 2 * (SELECT ll FROM {m.name}_at), 3) AS aic, round((SELECT g FROM {m.name}_{s}) / (SELECT g FROM best_{s}), 5) AS normalized_gini, "
        "true AS converged" for label, m in _models.items() for s in ("Train", "Val")))
    def _(spark, d, seg=_seg):
        table = H.baseline_comparison(*H.baseline_models(prepare(policies(spark, d), seg))).drop("steps")
        return rounded(rounded(rounded(table, 6, "rmse"), 3, "aic"), 5, "normalized_gini")

    # canonical links reproduce every training level's total, whatever the other features
    for _id, _stage, _fit, _y in (("m01", "baseline", models.fit_poisson, "call_counts"),
                                  ("m07", "binary", models.fit_logit, "CASE WHEN call_counts > 0 THEN 1 ELSE 0 END")):
        @query(f"{_id}_{_stage}_level_totals_{_seg}", sql.imputed(_seg) + ", l AS (" + sql.stacked(
            {n: ("pol_edeliv_ind_filled" if n == "pol_edeliv_ind" else n) for n in fixed.NOMINAL[_seg]},
            "filled WHERE \"Sample\" = 'Train'", f"{_y} AS y") + """)
    SELECT "Variable", "ValVar", count(*) AS n, CAST(sum(y) AS DOUBLE) AS actual, round(sum(y), 3) + 0.0::DOUBLE AS predicted FROM l GROUP BY 1, 2""")
        def _(spark, d, stage=_stage, seg=_seg, fit=_fit):
            data = prepare(policies(spark, d), seg)
            encoded = encode_stage(data, stage)
            model = fit(H.stage_design(encoded))
            view = feature_view(data.sample("Train"), stage, seg)
            scored = view.withColumn("pred", model.predict({f.name: f.column() for f in encoded.encoder.features}))
            return by_level(scored, fixed.NOMINAL[seg], ["pred", encoded.target]).groupBy("Variable", "ValVar").agg(
                F.count(F.lit(1)).alias("n"), F.sum(encoded.target).cast("double").alias("actual"),
                r(F.sum("pred"), 3).alias("predicted"))

    for _id, _name, _stage, _family, _fit in (
            ("m03", "truncated", "count", "ztnb", models.fit_ztnb), ("m01", "poisson", "baseline", "poisson", models.fit_poisson),
            ("m02", "negative_binomial", "baseline", "nb", models.fit_nb), ("m05", "inflated_poisson", "baseline", "zip", models.fit_zip),
            ("m06", "inflated_negative_binomial", "baseline", "zinb", models.fit_zinb), ("m07", "logit", "binary", "logit", models.fit_logit)):
        _text, _names = fits.design("xx", _stage, _seg)
        _sql_fit = fits.Fit("ff", _family, "xx", len(_names), _IN_TRAIN + (" AND call_counts > 0" if _stage == "count" else ""))

        @query(f"{_id}_{_name}_coefficients_{_seg}", fits.imputed(_seg, _text, _sql_fit.ctes())
               + f"SELECT pos, part, term, round(coef, 5) AS coef, round(se, 5) AS se, round(z, 4) AS z, round({sql.two_sided('z')}, 5) AS p FROM {_sql_fit.coefficients(_names)}")
        def _(spark, d, seg=_seg, stage=_stage, fit=_fit):
            encoded = encode_stage(prepare(policies(spark, d), seg), stage)
            table = fit(H.stage_design(encoded)).coefficient_frame(spark)
            return rounded(rounded(table, 5, "coef", "se", "p"), 4, "z")

    _designs = {stage: fits.design(f"x_{stage}", stage, _seg) for stage in ("baseline", "binary", "count")}
    _kinds = {"logit": "binary", "nb": "baseline", "poisson": "baseline", "zinb": "baseline", "zip": "baseline", "ztnb": "count"}
    _each = {family: fits.Fit(f"f_{family}", family, f"x_{stage}", len(_designs[stage][1]), _IN_TRAIN + (" AND call_counts > 0" if stage == "count" else ""))
             for family, stage in _kinds.items()}

    @query(f"m13_loglik_and_aic_all_features_{_seg}", fits.imputed(_seg, *[text for text, _ in _designs.values()], *[f.ctes() for f in _each.values()])
           + " UNION ALL ".join(f"SELECT '{name}' AS family, n::DOUBLE AS n, {f.n}::INTEGER AS k, round(ll, 4) AS loglik, round(2 * {f.n} - 2 * ll, 4) AS aic, true AS converged FROM {f.name}_at"
                                for name, f in _each.items()))
    def _(spark, d, seg=_seg):
        data = prepare(policies(spark, d), seg)
        def base():
            encoded, baseline = H.baseline_models(data)
            return [*baseline.values(), models.fit_nb(H.stage_design(encoded))]

        found = sum(together(spark, base, lambda: [models.fit_logit(H.stage_design(encode_stage(data, "binary")))],
                             lambda: [models.fit_ztnb(H.stage_design(encode_stage(data, "count")))]), [])
        table = reduce(DataFrame.unionByName, [m.statistics_frame(spark) for m in found])
        return rounded(table.select("family", "n", "k", "loglik", "aic", "converged"), 4, "loglik", "aic")

    for _id, _name, _pred, _calibrate in (("a03", "rate", "p", H.stage_one_calibration),
                                          ("a04", "conditional", "m", H.stage_two_calibration),
                                          ("a05", "combined", "yh", H.combined_calibration)):
        _stacked = "l AS (" + sql.stacked(sql.levels(_seg), "scored" + (" WHERE call_counts > 0" if _id == "a04" else ""), f'"Sample", call_counts, {_pred} AS pred') + ")"
        _table = ("""g AS (SELECT "Variable", "ValVar", "Sample", sum(pred) AS "PredCnt", sum((call_counts > 0)::INTEGER)::BIGINT AS "ActualCnt", count(*) AS "TotalCnt",
            sum(call_counts)::DOUBLE AS "SumGivenPositive", sum((call_counts > 0)::INTEGER) / count(*) AS "ActualRate", sum(pred) / count(*) AS "PredRate",
            avg(call_counts) FILTER (WHERE call_counts > 0) AS "MeanGivenPositive" FROM l GROUP BY 1, 2, 3)""" if _id == "a03" else
            'g AS (SELECT "Variable", "ValVar", "Sample", avg(pred) AS "PredMean", avg(call_counts) AS "ActualMean", count(*) AS "TotalCnt" FROM l GROUP BY 1, 2, 3)')
        _figures = {"PredCnt": 4, "ActualRate": 9, "PredRate": 6, "MeanGivenPositive": 9} if _id == "a03" else {"PredMean": 5, "ActualMean": 9}

        @query(f"{_id}_{_name}_calibration_fitted_{_seg}", fits.imputed(_seg, *fits.hurdle(_seg), _stacked, _table, """
            o AS (SELECT *, bool_and("ValVar" IS NULL OR TRY_CAST("ValVar" AS DOUBLE) IS NOT NULL) OVER (PARTITION BY "Variable", "Sample") AS numbers FROM g)""")
            + "SELECT * EXCLUDE (numbers) REPLACE (" + ", ".join(f'round("{c}", {k}) AS "{c}"' for c, k in _figures.items()) + """), CAST(row_number() OVER (PARTITION BY "Variable", "Sample"
            ORDER BY CASE WHEN numbers THEN TRY_CAST("ValVar" AS DOUBLE) END NULLS LAST, "ValVar" NULLS LAST) AS INTEGER) AS position FROM o""")
        def _(spark, d, seg=_seg, calibrate=_calibrate, figures=_figures):
            data = prepare(policies(spark, d), seg)
            table = calibrate(data, H.fit_hurdle(data))
            for c, k in figures.items():
                table = rounded(table, k, c)
            return table


# With one category the stages are the category's share of positive rows and its mean of these, so SQL can say
# what the fitted calibrations and reports must be.
_ONE = """, t AS (SELECT acq_method, avg(CASE WHEN call_counts > 0 THEN 1.0 ELSE 0 END) AS p, avg(call_counts) FILTER (WHERE call_counts > 0) AS m
    FROM {rows} WHERE "Sample" = 'Train' GROUP BY 1), f AS (SELECT r.*, p, m, p * m AS yh FROM {rows} r JOIN t USING (acq_method))"""


def one_category(spark, d, seg):
    data = prepare(policies(spark, d), seg)
    return data, H.fit_hurdle(data, nominal=[GROUP])


for _seg in SEGS:
    @query(f"a03_rate_calibration_one_category_{_seg}", sql.imputed(_seg) + _ONE.format(rows="filled") + ", l AS (" + sql.stacked(
        sql.levels(_seg), "f", '"Sample", call_counts, p AS pred') + """)
    SELECT "Variable", "ValVar", "Sample", round(sum(pred), 4) AS "PredCnt", count(*) FILTER (WHERE call_counts > 0) AS "ActualCnt", count(*) AS "TotalCnt" FROM l GROUP BY 1, 2, 3""")
    def _(spark, d, seg=_seg):
        table = H.stage_one_calibration(*one_category(spark, d, seg))
        return rounded(table.select("Variable", "ValVar", "Sample", "PredCnt", "ActualCnt", "TotalCnt"), 4, "PredCnt")

    for _id, _what, _pred, _where, _calibrate in (("a04", "conditional", "m", " WHERE call_counts > 0", H.stage_two_calibration),
                                                  ("a05", "combined", "yh", "", H.combined_calibration)):
        @query(f"{_id}_{_what}_calibration_one_category_{_seg}", sql.imputed(_seg) + _ONE.format(rows="filled") + ", l AS (" + sql.stacked(
            sql.levels(_seg), "f" + _where, f'"Sample", call_counts, {_pred} AS pred') + """)
    SELECT "Variable", "ValVar", "Sample", round(avg(pred), 4) AS "PredMean", round(avg(call_counts), 6) AS "ActualMean", count(*) AS "TotalCnt" FROM l GROUP BY 1, 2, 3""")
        def _(spark, d, seg=_seg, calibrate=_calibrate):
            return rounded(rounded(calibrate(*one_category(spark, d, seg)).drop("position"), 4, "PredMean"), 6, "ActualMean")

    @query(f"e04_stage_reports_one_category_{_seg}", sql.split(_seg) + _ONE.format(rows="sp") + f""",
    g AS (SELECT "Sample", p, count(*) FILTER (WHERE call_counts > 0) AS pos, count(*) FILTER (WHERE call_counts = 0) AS neg FROM f GROUP BY 1, 2),
    b AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY "Sample" ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g),
    u AS (SELECT "Sample", sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)) AS auc FROM b GROUP BY 1)
    SELECT '{_seg}' AS segment, "Sample", round(avg(CASE WHEN call_counts > 0 THEN -ln(p) ELSE -ln(1 - p) END), 6) AS log_loss, round(any_value(auc), 6) AS auc,
        round(sqrt(avg((call_counts - m) * (call_counts - m)) FILTER (WHERE call_counts > 0)), 4) AS rmse FROM f JOIN u USING ("Sample") GROUP BY 2""")
    def _(spark, d, seg=_seg):
        table = H.stage_reports([one_category(spark, d, seg)]).drop("aic", "normalized_gini")
        return rounded(rounded(table, 6, "log_loss", "auc"), 4, "rmse")


@query("e07_hurdle_validation_one_category", sql.split("nonauto") + _ONE.format(rows="sp") + """
    SELECT 'nonauto' AS segment, count(*) AS n, round(min(p), 6) AS min_p_positive, round(max(p), 6) AS max_p_positive, round(min(m), 4) AS min_mean_positive,
        round(max(m), 4) AS max_mean_positive, round(sqrt(avg((call_counts - yh) * (call_counts - yh))), 4) AS rmse, true AS converged
    FROM f WHERE "Sample" = 'Val'""")
def e07_one(spark, d):
    table = H.validation_report([one_category(spark, d, "nonauto")]).where("segment = 'nonauto'")
    table = table.select("segment", "n", "min_p_positive", "max_p_positive", "min_mean_positive", "max_mean_positive", "rmse", "converged")
    return rounded(rounded(table, 6, "min_p_positive", "max_p_positive"), 4, "min_mean_positive", "max_mean_positive", "rmse")


@query("m10_stepwise_logit")
def m10(spark, d):
    encoded = encode_stage(prepare(policies(spark, d), "nonauto"), "binary")
    chosen = stepwise_logit(H.stage_design(encoded))
    return spark.createDataFrame(list(enumerate(chosen)), "position int, feature string")


# A target made from three features and hashed noise: the search must find these and no others.
_PLANTED = ["has_prior_carrier", "geo_group_urban", "prdct_sbtyp_grp_C"]
_CHANCE = "0.35 + 0.25 * has_prior_carrier - 0.2 * (CASE WHEN geo_group = 'urban' THEN 1 ELSE 0 END) + 0.15 * (CASE WHEN prdct_sbtyp_grp = 'C' THEN 1 ELSE 0 END)"
_planted_fit = fits.Fit("ff", "logit", "xx", 1 + len(_PLANTED))


@query("m10_stepwise_planted_signal", sql.raw("nonauto").replace("WITH ", "WITH RECURSIVE ", 1) + f""", xx AS MATERIALIZED (
    SELECT (('0x' || substr(md5(id || ':noise'), 1, 6))::INTEGER / 16777216.0 < {_CHANCE})::INTEGER::DOUBLE AS y, 1.0::DOUBLE AS x0, has_prior_carrier::DOUBLE AS x1,
    (geo_group = 'urban')::INTEGER::DOUBLE AS x2, (prdct_sbtyp_grp = 'C')::INTEGER::DOUBLE AS x3 FROM s), {_planted_fit.ctes()}
    SELECT term AS feature FROM {_planted_fit.coefficients(["const", *_PLANTED])} WHERE term <> 'const' AND {sql.two_sided('z')} < 0.01""")
def m10_planted(spark, d):
    rows = raw_filled(spark, d, "nonauto")
    noise = F.conv(F.substring(F.md5(F.concat(F.col(fixed.ID).cast("string"), F.lit(":noise"))), 1, 6), 16, 10).cast("double") / 16777216
    rows = rows.withColumn("hit", F.when(noise < F.expr(_CHANCE).cast("double"), 1).otherwise(0))
    nominal = ["acq_method", "geo_group", "prdct_sbtyp_grp", "product_sbtyp"]
    numeric = ["12m_call_history", "ann_prm_amt", "household_policy_counts", "tenure_at_snapshot"]
    view = rows.select(fixed.ID, *numeric, *nominal, "digital_contact_ind", "has_prior_carrier", "hit")
    enc = fit_encoder(view, nominal, numeric, exclude=["hit"])
    chosen = stepwise_logit(make_design(enc.apply(view, ["hit"]), enc.names, "hit"))
    return spark.createDataFrame([(f,) for f in chosen], "feature string")


# -- metrics ----------------------------------------------------------------------------------

_BASE = f"f AS (SELECT id, call_counts AS y, {PSEUDO} AS p FROM policies)"
_NG = ",".join((_gini_sql("f", "y", "p", "gp"), _gini_sql("f", "y", "y", "gy")))


def scored(spark, d):
    return materialise(pseudo(policies(spark, d)).select(
        fixed.ID, F.col(fixed.TARGET).alias("y"), F.col("pred").alias("p")), "scored")


@query("e01_rmse", ALL + f", {_BASE} SELECT round(sqrt(avg((y - p) * (y - p))), 6) AS rmse FROM f")
def e01(spark, d):
    return rounded(metrics.rmse(scored(spark, d), "y", "p"), 6, "rmse")


@query("e02_gini", ALL + f", {_BASE}, {_gini_sql('f', 'y', 'p', 'gp')} SELECT round(g, 9) AS gini FROM gp")
def e02(spark, d):
    return rounded(metrics.gini(scored(spark, d), "y", "p"), 9, "gini")


@query("e03_normalized_gini", ALL + f", {_BASE}, {_NG} SELECT round((SELECT g FROM gp) / (SELECT g FROM gy), 9) AS normalized_gini")
def e03(spark, d):
    return rounded(metrics.normalized_gini(scored(spark, d), "y", "p"), 9, "normalized_gini")


@query("e04_log_loss", ALL + f", {_BASE}, c AS (SELECT y, p / 100 AS q FROM f) SELECT round(avg(CASE WHEN y > 0 THEN -ln(q) ELSE -ln(1 - q) END), 9) AS log_loss FROM c")
def e04(spark, d):
    return rounded(metrics.log_loss(scored(spark, d).withColumn("q", F.col("p") / 100), "y", "q"), 9, "log_loss")


@query("e05_roc_auc", ALL + f""", {_BASE}, g AS (SELECT p, count(*) FILTER (WHERE y > 0) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM f GROUP BY p),
    b AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)
    SELECT round(sum(pos * (below + neg / 2)) / (sum(pos) * sum(neg)), 9) AS auc FROM b""")
def e05(spark, d):
    return rounded(metrics.roc_auc(scored(spark, d), "y", "p"), 9, "auc")


@query("e06_model_report", ALL + f", {_BASE}, {_NG} SELECT 'pseudo' AS label, round((SELECT sqrt(avg((y - p) * (y - p))) FROM f), 6) AS rmse, 12.5::DOUBLE AS aic, round((SELECT g FROM gp) / (SELECT g FROM gy), 6) AS normalized_gini")
def e06(spark, d):
    return rounded(metrics.report(scored(spark, d), "pseudo", "y", "p", 12.5), 6, "rmse", "normalized_gini")


def _report_sql(name, source, digits=6):
    return (_gini_sql(source, "call_counts", "y_hat", f"{name}_p") + ",\n" + _gini_sql(source, "call_counts", "call_counts", f"{name}_y") + ",\n"
            + f"{name}_r AS (SELECT '{name}' AS segment, count(*) AS n, " + ", ".join(
                f"round({f}({c}), {digits}) AS {f}_{c}" for c in ("p_positive", "mean_positive", "y_hat") for f in ("min", "max"))
            + f", round(sqrt(avg((call_counts - y_hat) * (call_counts - y_hat))), {digits}) AS rmse, round((SELECT g FROM {name}_p) / (SELECT g FROM {name}_y), {digits}) AS normalized_gini FROM {source})")


_STAGES = """, f AS (SELECT *, 1 / (1.0::DOUBLE + household_policy_counts) AS p_positive, """ + PSEUDO + """ AS mean_positive, 1 / (1.0::DOUBLE + household_policy_counts) * (""" + PSEUDO + """) AS y_hat FROM policies)
"""


@query("e07_segment_report", ALL + _STAGES + ", " + ",\n".join([
    _report_sql("auto", "f WHERE bi_limit_group <> 'NonAuto'"), _report_sql("nonauto", "f WHERE bi_limit_group = 'NonAuto'"),
    _report_sql("pooled", "f")]) + "\nSELECT * FROM auto_r UNION ALL SELECT * FROM nonauto_r UNION ALL SELECT * FROM pooled_r")
def e07(spark, d):
    rows = pseudo(policies(spark, d)).withColumn("p_positive", 1 / (1.0 + F.col("household_policy_counts")))
    rows = materialise(rows.withColumn("mean_positive", F.col("pred")).withColumn("y_hat", F.col("p_positive") * F.col("pred")))
    parts = [metrics.hurdle_report(segment(rows, s), s) for s in SEGS] + [metrics.hurdle_report(rows, "pooled")]
    table = reduce(DataFrame.unionByName, parts)
    return rounded(table, 6, *[c for c in table.columns if c not in ("segment", "n")])


@query("e07_hurdle_validation_report", "WITH " + ", ".join(
    f"""{seg}_val AS ({fits.imputed(seg, *fits.hurdle(seg))} SELECT id, call_counts, p AS p_positive, m AS mean_positive, yh AS y_hat FROM scored WHERE "Sample" = 'Val')"""
    for seg in SEGS) + ", pooled_val AS (SELECT * FROM auto_val UNION ALL SELECT * FROM nonauto_val),\n" + ",\n".join(
    _report_sql(s, f"{s}_val", 5) for s in (*SEGS, "pooled")) + "\n" + " UNION ALL ".join(f"SELECT *, true AS converged FROM {s}_r" for s in (*SEGS, "pooled")))
def e07_fitted(spark, d):
    table = H.validation_report(H.fit_all(prepare_all(policies(spark, d)))).drop("steps")
    return rounded(table, 5, *[c for c in table.columns if c not in ("segment", "n", "converged")])
