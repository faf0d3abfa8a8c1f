"""Caps, logs, hinges, grids and recodes as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zerotally import fixed


def _col(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def cap(x, top) -> Column:
    """LEAST skips NULL, so a NULL input comes out as the cap itself."""
    return F.least(_col(x), F.lit(top))


def log_cap(x, top) -> Column:
    """Base-10 log of one plus the capped value."""
    return F.log10(F.lit(1) + cap(x, top))


def natural_log_cap(x, top) -> Column:
    return F.log1p(cap(x, top))


def hinge(x, knot, top) -> tuple[Column, Column]:
    """The part of x up to the knot and the part between knot and cap."""
    return cap(x, knot), F.greatest(cap(x, top) - F.lit(knot), F.lit(0))


def log_hinge(x, knot, top) -> tuple[Column, Column]:
    low, high = hinge(x, knot, top)
    return F.log10(F.lit(1) + low), F.log10(F.lit(1) + high)


def indicator(condition: Column) -> Column:
    """1 where the condition holds, 0 elsewhere, NULL included."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def nonzero(y=fixed.TARGET) -> Column:
    return indicator(_col(y) > 0)


def grid_bin(x, width, top=None) -> Column:
    """Nearest multiple of the width, halves to even, optionally capped."""
    snapped = F.rint(_col(x) / F.lit(width)).cast("int") * F.lit(width)
    return snapped if top is None else F.least(snapped, F.lit(top))


def level_text(x) -> Column:
    return _col(x).cast("string")


def category_text(x) -> Column:
    """Level text with NULL shown as its own category."""
    return F.coalesce(level_text(x), F.lit("<NA>"))


def known_flag(x=fixed.IMPUTED) -> Column:
    """The value where it is one of the known codes, else NULL."""
    return F.when(_col(x).isin(fixed.KNOWN_FLAGS), _col(x)).cast("int")


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
