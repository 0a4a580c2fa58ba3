"""Data-quality profiles; each one is a single pass over the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The columns whose ranges tell whether a file is sound.
PROFILED_COLUMNS = [
    "tranaction_id",
    "customer_id",
    "terminal_id",
    "tx_time_days",
    "tx_fraud",
    "tx_fraud_scenario",
]


def profile_duplicates(df: DataFrame, by: str | None = None) -> DataFrame:
    """Rows, distinct rows and surplus copies, in total or per value of ``by``.

    Rows are compared on all columns but ``by``.
    """
    groups = [by] if by else []
    per_row = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    return per_row.groupBy(*groups).agg(
        F.sum("__copies").alias("n_rows"),
        F.count(F.lit(1)).alias("n_distinct"),
        F.sum(F.col("__copies") - 1).alias("n_duplicates"),
    )


def _long_format(wide: DataFrame, keys: list[str], columns: list[str], stats: list[str]) -> DataFrame:
    """One row per profiled column out of columns named ``stat@column``."""
    entries = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"`{s}@{c}`").alias(s) for s in stats])
        for c in columns
    ]
    return wide.select(*keys, F.inline(F.array(*entries)))


def profile_numeric(
    df: DataFrame, columns: list[str] = PROFILED_COLUMNS, by: str | None = None
) -> DataFrame:
    """count, mean, sample stddev, min and max of each column, one row per column.

    A text column is profiled by the numbers it parses to.
    """
    keys = [by] if by else []
    stats: dict[str, Column] = {}
    for c in columns:
        x = F.col(c).try_cast("double")
        stats |= {
            f"count@{c}": F.count(c),
            f"mean@{c}": F.avg(x),
            f"stddev@{c}": F.stddev_samp(x),
            f"min@{c}": F.min(x),
            f"max@{c}": F.max(x),
        }
    wide = df.groupBy(*keys).agg(*[v.alias(n) for n, v in stats.items()])
    return _long_format(wide, keys, columns, ["count", "mean", "stddev", "min", "max"])


def profile_missing(df: DataFrame, by: str | None = None) -> DataFrame:
    """Nulls and NaNs per column; only floating-point columns can hold a NaN."""
    keys = [by] if by else []
    columns = [c for c in df.columns if c not in keys]
    stats: dict[str, Column] = {}
    for c in columns:
        floating = df.schema[c].dataType.typeName() in ("double", "float")
        stats[f"n_null@{c}"] = F.count_if(F.col(c).isNull())
        stats[f"n_nan@{c}"] = F.count_if(F.isnan(c)) if floating else F.lit(0).cast("bigint")
    wide = df.groupBy(*keys).agg(*[v.alias(n) for n, v in stats.items()])
    return _long_format(wide, keys, columns, ["n_null", "n_nan"])
