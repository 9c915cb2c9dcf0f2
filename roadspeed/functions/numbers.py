"""Column expressions on doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_INF = float("inf")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c: Column | str) -> Column:
    """NaN becomes NULL, so that averages skip it."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def is_finite(c: Column | str) -> Column:
    """True for a number that is neither NULL, NaN nor infinite; never NULL."""
    c = _col(c)
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(_INF))


def finite_or_zero(c: Column | str) -> Column:
    c = _col(c)
    return F.when(is_finite(c), c).otherwise(F.lit(0.0))


def z_score(c: Column | str, mu: Column | str, sd: Column | str) -> Column:
    return (_col(c) - _col(mu)) / _col(sd)
