"""Date parts and stamps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: part name -> expression; weeks start on Monday (0) and are numbered by ISO 8601
DATE_PARTS = {
    "year": F.year,
    "month": F.month,
    "day": F.day,
    "hour": F.hour,
    "dayofweek": F.weekday,
    "dayofyear": F.dayofyear,
    "weekofyear": F.weekofyear,
}


def add_date_features(
    df: DataFrame, time: str, parts: Sequence[str] = ("month", "dayofweek", "hour")
) -> DataFrame:
    unknown = [p for p in parts if p not in DATE_PARTS]
    if unknown:
        raise ValueError(f"unknown date parts: {unknown}")
    return df.withColumns({p: DATE_PARTS[p](F.col(time)).cast("int") for p in parts})


def time_difference(later: Column, earlier: Column) -> Column:
    """Duration between two zone-less timestamps, as a day-time interval."""
    return later - earlier


def utc_stamp(t: Column) -> Column:
    """Compact stamp for run names, for a zone-less timestamp that holds UTC."""
    return F.date_format(t, "yyyyMMdd'T'HHmmss'UTC'")
