"""Per-link standardisation."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspeed.functions import is_finite, nan_to_null, z_score
from roadspeed.operators.split import within

Moments = tuple[datetime | int, datetime | int]


def fit_scaler(
    df: DataFrame, cols: Iterable[str], fit_range: Moments, key: str = "linkid", ts: str = "datetime"
) -> DataFrame:
    """One row per link seen in the range (ends included): ``<col>_mu`` and ``<col>_sd``.

    Population deviation. A mean that is no finite number becomes 0, a deviation that is none or
    zero becomes 1.
    """
    parts = []
    for c in cols:
        value = nan_to_null(F.col(c))
        mu, sd = F.avg(value), F.stddev_pop(value)
        parts.append(F.when(is_finite(mu), mu).otherwise(0.0).alias(f"{c}_mu"))
        parts.append(F.when(is_finite(sd) & (sd != 0), sd).otherwise(1.0).alias(f"{c}_sd"))
    return df.filter(within(ts, fit_range)).groupBy(key).agg(*parts)


def standardise(df: DataFrame, scaler: DataFrame, cols: Iterable[str], key: str = "linkid") -> DataFrame:
    """z-scores in place of the columns; links without a scaler row are left out.

    No broadcast is forced: the scaler grows with the links, so Spark decides by its size.
    """
    scores = {c: z_score(c, f"{c}_mu", f"{c}_sd") for c in cols}
    return df.join(scaler, key).withColumns(scores).select(df.columns)
