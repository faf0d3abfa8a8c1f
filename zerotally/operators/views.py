"""Feature views: one declarative column list per model stage and segment."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zerotally import fixed
from zerotally.functions import scalars as S


def _shared(seg: str) -> dict[str, Column]:
    """Columns every stage treats alike."""
    return {
        "12m_call_history": S.log_cap("12m_call_history", fixed.HISTORY_CAP[seg]),
        "acq_method": F.col("acq_method"),
        "ann_prm_amt": S.log_cap("ann_prm_amt", fixed.PREMIUM_CAP),
        "digital_contact_ind": F.col("digital_contact_ind"),
        "geo_group": F.col("geo_group"),
        "has_prior_carrier": F.col("has_prior_carrier"),
        "home_lot_sq_footage": F.col("home_lot_sq_footage"),
        "pol_edeliv_ind": F.col(fixed.FILLED),
        "prdct_sbtyp_grp": F.col("prdct_sbtyp_grp"),
        "product_sbtyp": F.col("product_sbtyp"),
    }


def _policy_counts(seg: str, split: bool) -> dict[str, Column]:
    name, top = "household_policy_counts", fixed.POLICY_COUNT_CAP[seg]
    if not split:
        return {name: S.cap(name, top)}
    knot = fixed.POLICY_COUNT_KNOT[seg]
    low, high = S.hinge(name, knot, top)
    return {f"{name}_le{knot}": low, f"{name}_gt{knot}": high}


def _tenure(split: bool) -> dict[str, Column]:
    name, knot = "tenure_at_snapshot", fixed.TENURE_KNOT
    if not split:
        return {name: S.log_cap(name, fixed.TENURE_CAP)}
    low, high = S.log_hinge(name, knot, fixed.TENURE_CAP)
    return {f"{name}_le{knot}": low, f"{name}_gt{knot}": high}


def _only_in(seg: str) -> dict[str, Column]:
    if seg == "auto":
        return {c: F.col(c) for c in ("bi_limit_group", "newest_veh_age", "telematics_ind")}
    return {
        "channel": S.indicator(F.col("channel") == fixed.RETAIL),
        "trm_len_mo": S.indicator(F.col("trm_len_mo") == fixed.LONG_TERM),
    }


def view_columns(stage: str, seg: str) -> dict[str, Column]:
    """Feature name to expression, for one stage and segment."""
    split_counts = stage == "count" or (stage == "binary" and seg == "auto")
    household = {}
    if seg == "nonauto" or stage == "baseline":
        household = {"household_group": S.indicator(F.col("household_group") == fixed.HOUSEHOLD_FLAG[seg])}
    columns = {**_shared(seg), **household, **_policy_counts(seg, split_counts),
               **_tenure(stage == "count" and seg == "nonauto"), **_only_in(seg)}
    # the order of the raw columns; both halves of a hinge stay together
    raw = list(fixed.POLICY_COLUMNS)
    return dict(sorted(columns.items(), key=lambda kv: raw.index(re.sub(r"_(le|gt)\d+$", "", kv[0]))))


def feature_view(df: DataFrame, stage: str, seg: str, has_target: bool = True,
                 keep: list[str] | None = None) -> DataFrame:
    """Id, features and, when asked for, the stage's target. Never drops rows."""
    target = []
    if has_target:
        target = [S.nonzero().alias(fixed.NONZERO)] if stage == "binary" else [F.col(fixed.TARGET)]
    features = [c.alias(name) for name, c in view_columns(stage, seg).items()]
    return df.select(fixed.ID, *features, *target, *(keep or []))


def level_view(df: DataFrame, seg: str, keep: list[str] | None = None) -> DataFrame:
    """Binned and raw levels per row, for level and calibration tables."""
    derived = {
        "binned_12m_call_history": S.grid_bin("12m_call_history", fixed.HISTORY_BIN,
                                              fixed.HISTORY_CAP[seg]),
        "binned_ann_prm_amt": S.grid_bin("ann_prm_amt", fixed.PREMIUM_BIN, fixed.PREMIUM_CAP),
        "binned_home_lot_sq_footage": S.grid_bin("home_lot_sq_footage", fixed.LOT_BIN),
        "capped_household_policy_counts": S.cap("household_policy_counts", fixed.POLICY_COUNT_CAP[seg]),
        "binned_tenure_at_snapshot": S.grid_bin("tenure_at_snapshot", fixed.TENURE_BIN,
                                                fixed.TENURE_CAP),
    }
    variables = [derived.get(v, F.col(v)).alias(v) for v in fixed.LEVEL_VARIABLES[seg]]
    return df.select(fixed.ID, *variables, *(keep or []))
