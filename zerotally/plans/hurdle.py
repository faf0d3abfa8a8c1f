"""The two-stage hurdle model and the baseline models: fit, score, calibrate, report."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zerotally import fixed
from zerotally.operators.encoder import Encoder
from zerotally.operators.imputation import Imputer
from zerotally.operators.levels import mean_calibration, ordered_levels, rate_calibration
from zerotally.operators.metrics import hurdle_report, log_loss, perfect_gini, report, roc_auc
from zerotally.operators.models import (Model, fit_logit, fit_poisson, fit_zinb, fit_zip, fit_ztnb,
                                        zi_warm_start)
from zerotally.operators.newton import Design, checked, make_design
from zerotally.operators.segments import positives, segment_tables
from zerotally.operators.views import level_view, view_columns
from zerotally.plans.prepare import Encoded, Prepared, encode_stage, imputed, prepare_all
from zerotally.sources.csv_files import cast_policies, read_policies_csv, write_predictions
from zerotally.workspace import materialise, scratch_scope, together


def stage_design(encoded: Encoded, which: str | None = "Train") -> Design:
    """Design of one sample, or of both for the final refit; dummies alone are compressed."""
    dummies = [f.name for f in encoded.encoder.features if f.kind == "dummy"]
    return make_design(encoded.sample(which), encoded.encoder.names, encoded.target,
                       compress=len(dummies) == len(encoded.encoder.names), dummies=dummies)


@dataclass(frozen=True)
class Hurdle:
    """P(Y > 0) from a logit, E[Y | Y > 0] from a zero-truncated negative binomial."""
    segment: str
    binary_encoder: Encoder
    binary: Model
    count_encoder: Encoder
    count: Model

    def score(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """Add `p_positive`, `mean_positive` and `y_hat` to imputed rows, in one projection.

        Each stage works from its own feature view, side by side on the same row, so no
        join lines the stages up.
        """
        views = {"_b": view_columns("binary", self.segment), "_c": view_columns("count", self.segment)}
        held = df.select(*keep, *[
            F.struct(*[c.alias(n) for n, c in cols.items()]).alias(name) for name, cols in views.items()])
        features = lambda enc, prefix: {f.name: f.column(prefix) for f in enc.features}
        return (held
                .withColumn("p_positive", self.binary.predict(features(self.binary_encoder, "_b.")))
                .withColumn("mean_positive", self.count.predict(features(self.count_encoder, "_c.")))
                .withColumn("y_hat", F.col("p_positive") * F.col("mean_positive"))
                .drop(*views))

    def save(self, spark: SparkSession, path: str) -> None:
        self.binary_encoder.save(spark, f"{path}/binary_encoder")
        self.binary.save(spark, f"{path}/binary")
        self.count_encoder.save(spark, f"{path}/count_encoder")
        self.count.save(spark, f"{path}/count")

    @staticmethod
    def load(spark: SparkSession, path: str, segment: str) -> "Hurdle":
        return Hurdle(segment, Encoder.load(spark, f"{path}/binary_encoder"),
                      Model.load(spark, f"{path}/binary"),
                      Encoder.load(spark, f"{path}/count_encoder"), Model.load(spark, f"{path}/count"))


def fit_hurdle(data: Prepared, final: bool = False, nominal: list[str] | None = None,
               numeric: list[str] | None = None, allow_unconverged: bool = False) -> Hurdle:
    """Fit both stages on the training rows, or with `final` on training and validation.

    The encoders always come from the training rows. A stage without an optimum is an error unless that is allowed.
    """
    which = None if final else "Train"

    def stage(name, fit):
        encoded = encode_stage(data, name, nominal, numeric)
        return encoded.encoder, fit(stage_design(encoded, which), allow_unconverged=allow_unconverged)

    first, second = together(data.rows.sparkSession, lambda: stage("binary", fit_logit),
                             lambda: stage("count", fit_ztnb))
    return Hurdle(data.name, *first, *second)


def fit_all(prepared: list[Prepared], final: bool = False, nominal: list[str] | None = None,
            numeric: list[str] | None = None, allow_unconverged: bool = False) -> list[tuple[Prepared, Hurdle]]:
    """Every segment with its fitted hurdle, the fits running side by side."""
    spark = prepared[0].rows.sparkSession
    fitted = together(spark, *[lambda p=p: fit_hurdle(p, final, nominal, numeric, allow_unconverged) for p in prepared])
    return list(zip(prepared, fitted))


def level_predictions(data: Prepared, model: Hurdle, pred: str) -> DataFrame:
    """Levels, target, sample and one prediction per row."""
    scored = model.score(data.rows, data.rows.columns).withColumn("pred", F.col(pred))
    return level_view(scored, data.name, [fixed.TARGET, "Sample", "pred"])


def stage_one_calibration(data: Prepared, model: Hurdle) -> DataFrame:
    """As the other two, with `position`: the place of the level within its variable and sample, by number if all are."""
    return ordered_levels(rate_calibration(level_predictions(data, model, "p_positive"), fixed.LEVEL_VARIABLES[data.name]), ["Sample"])


def stage_two_calibration(data: Prepared, model: Hurdle) -> DataFrame:
    rows = positives(level_predictions(data, model, "mean_positive"))
    return ordered_levels(mean_calibration(rows, fixed.LEVEL_VARIABLES[data.name]), ["Sample"])


def combined_calibration(data: Prepared, model: Hurdle) -> DataFrame:
    return ordered_levels(mean_calibration(level_predictions(data, model, "y_hat"), fixed.LEVEL_VARIABLES[data.name]), ["Sample"])


def validation_report(fitted: list[tuple[Prepared, Hurdle]]) -> DataFrame:
    """One row per segment and one for all segments pooled, on the held-out rows; with whether both stages' fits reached an
    optimum and the most steps that one took."""
    spark = fitted[0][0].rows.sparkSession
    frames = together(spark, *[
        lambda d=d, m=m: materialise(m.score(d.sample("Val"), [fixed.ID, fixed.TARGET]), "scored")
        for d, m in fitted])
    scored = list(zip([d.name for d, _ in fitted], frames))
    fits = [[m.binary, m.count] for _, m in fitted]
    state = lambda df, some: df.withColumns({"converged": F.lit(all(f.converged for f in some)), "steps": F.lit(max(f.steps for f in some))})
    parts = [state(hurdle_report(df, name), some) for (name, df), some in zip(scored, fits)]
    pooled = reduce(DataFrame.unionByName, [df for _, df in scored])
    return reduce(DataFrame.unionByName, [*parts, state(hurdle_report(pooled, "pooled"), sum(fits, []))])


def stage_reports(fitted: list[tuple[Prepared, Hurdle]]) -> DataFrame:
    """Each stage on its own rows, per segment and sample: log loss and AUC of P(Y > 0); RMSE, AIC (training rows) and
    normalised Gini of E[Y | Y > 0] on the positive rows."""
    out = []
    for data, model in fitted:
        rows = materialise(model.score(data.rows, [fixed.ID, fixed.TARGET, "Sample"]), "scored")
        for sample in ("Train", "Val"):
            own = rows.where(F.col("Sample") == sample)
            first, second = own, positives(own)
            one = F.lit(1).alias("_k")
            row = (log_loss(first, fixed.TARGET, "p_positive").select("*", one)
                   .join(roc_auc(first, fixed.TARGET, "p_positive").select("*", one), "_k")
                   .join(report(second, sample, fixed.TARGET, "mean_positive", model.count.aic if sample == "Train" else None)
                         .drop("label").select("*", one), "_k"))
            out.append(row.select(F.lit(data.name).alias("segment"), F.lit(sample).alias("Sample"), "log_loss", "auc",
                                  "rmse", "aic", "normalized_gini"))
    return reduce(DataFrame.unionByName, out)


@dataclass(frozen=True)
class Scorer:
    """What a segment's raw rows need to be scored: the frozen imputer and the fitted hurdle."""
    segment: str
    imputer: Imputer
    model: Hurdle

    def score(self, table: DataFrame) -> DataFrame:
        """`id, call_counts` of the rows of a written segment table."""
        return (self.model.score(imputed(table, self.imputer), [fixed.ID])
                .select(fixed.ID, F.col("y_hat").alias(fixed.TARGET)))

    def save(self, spark: SparkSession, path: str) -> None:
        self.imputer.save(spark, f"{path}/imputer")
        self.model.save(spark, f"{path}/hurdle")

    @staticmethod
    def load(spark: SparkSession, path: str, segment: str) -> "Scorer":
        return Scorer(segment, Imputer.load(spark, f"{path}/imputer"), Hurdle.load(spark, f"{path}/hurdle", segment))


def scorers(fitted: list[tuple[Prepared, Hurdle]]) -> list[Scorer]:
    return [Scorer(data.name, data.imputer, model) for data, model in fitted]


def score_unseen(parts: list[Scorer], unseen: DataFrame) -> DataFrame:
    """`id, call_counts` for every row of an unlabelled policy table that fits a segment; the table is written once."""
    tables = segment_tables(unseen)
    scored = together(unseen.sparkSession, *[lambda p=p: p.score(tables[p.segment]) for p in parts])
    return reduce(DataFrame.unionByName, scored)


def predict_unseen(fitted: list[tuple[Prepared, Hurdle]], unseen: DataFrame) -> DataFrame:
    """`id, call_counts` for every row of an unlabelled policy table that fits a segment."""
    return score_unseen(scorers(fitted), unseen)


def train_from_csv(spark: SparkSession, train_csv: str, model_path: str, nominal: list[str] | None = None,
                   numeric: list[str] | None = None, allow_unconverged: bool = False) -> None:
    """Fit both segments' hurdles on all rows of a labelled policy file and save what scoring needs, per segment."""
    with scratch_scope(spark):
        train = cast_policies(read_policies_csv(spark, train_csv), has_target=True)
        parts = scorers(fit_all(prepare_all(train), True, nominal, numeric, allow_unconverged))
        together(spark, *[lambda p=p: p.save(spark, f"{model_path}/{p.segment}") for p in parts])


def score_csv(spark: SparkSession, test_csv: str, model_path: str, out_csv: str) -> None:
    """Score an unlabelled policy file with saved models, in any session, and write `id,call_counts` in id order."""
    with scratch_scope(spark):
        parts = [Scorer.load(spark, f"{model_path}/{s}", s) for s in fixed.SEGMENTS]
        unseen = cast_policies(read_policies_csv(spark, test_csv), has_target=False)
        write_predictions(score_unseen(parts, unseen), out_csv)


def baseline_models(data: Prepared, nominal: list[str] | None = None, numeric: list[str] | None = None,
                    allow_unconverged: bool = False) -> tuple[Encoded, dict[str, Model]]:
    """Poisson, zero-inflated Poisson and zero-inflated negative binomial on the same design, surveyed once."""
    encoded = encode_stage(data, "baseline", nominal, numeric)
    design = stage_design(encoded)
    spark = data.rows.sparkSession
    checked(design, "poisson")
    warm, poisson = together(spark, lambda: zi_warm_start(design, allow_unconverged=True),  # only where to start
                             lambda: fit_poisson(design, allow_unconverged))
    zip_, zinb = together(spark, lambda: fit_zip(design, warm, allow_unconverged),
                          lambda: fit_zinb(design, warm, allow_unconverged))
    return encoded, {"Poisson": poisson, "ZIP": zip_, "ZINB": zinb}


def baseline_comparison(encoded: Encoded, models: dict[str, Model]) -> DataFrame:
    """RMSE, AIC and normalised Gini of every baseline on training and validation rows, with the state of its fit."""
    scored = materialise(encoded.rows.select(
        fixed.ID, "Sample", encoded.target, *[m.predict().alias(name) for name, m in models.items()]), "scored")
    samples = {s: scored.where(F.col("Sample") == s) for s in ("Train", "Val")}
    # one perfect ranking per sample serves all models
    best = dict(zip(samples, together(scored.sparkSession, *[lambda df=df: materialise(perfect_gini(df, encoded.target), "best")
                                                             for df in samples.values()])))
    rows = [report(df, f"{name} {s.lower()}", encoded.target, name, m.aic, best[s])
            .withColumns({"converged": F.lit(m.converged), "steps": F.lit(m.steps)})
            for name, m in models.items() for s, df in samples.items()]
    return reduce(DataFrame.unionByName, rows)
