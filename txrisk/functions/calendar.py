"""Date and time expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_SECONDS = 86400


def epoch_seconds(ts: Column | str) -> Column:
    """Whole seconds since 1970; works for zoned and zone-less timestamps."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return col.cast("timestamp").cast("bigint")


def date_stamp(ts: Column | str) -> Column:
    """``yyyy_MM_dd`` of the event itself, used to name daily forecasts."""
    return F.date_format(ts, "yyyy_MM_dd")


def time_features(df: DataFrame, ts: str = "tx_datetime") -> DataFrame:
    """Add day_of_week (1 = Sunday), ISO week_of_year, is_weekend, hour and is_day."""
    dow, hour = F.dayofweek(ts), F.hour(ts)
    return df.withColumns(
        {
            "day_of_week": dow,
            "week_of_year": F.weekofyear(ts),
            "is_weekend": F.when(dow.isin(1, 7), 1).otherwise(0),
            "hour": hour,
            "is_day": F.when(hour <= 6, 0).otherwise(1),
        }
    )
