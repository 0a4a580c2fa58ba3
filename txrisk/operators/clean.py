"""From raw text rows to typed, complete, distinct, non-negative rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.schema import CLEAN_TYPES, NON_NEGATIVE_COLUMNS

INTEGRAL = {"int", "bigint"}


def _coerced(df: DataFrame, name: str, to: str) -> Column:
    if df.schema[name].dataType.typeName() == "string" and to in INTEGRAL:
        # "178.0" stands for 178 in text fields; try_cast alone would reject it.
        whole = rf"regexp_replace(trim(`{name}`), r'(?<=\d)\.\d*$', '')"
        return F.expr(f"coalesce(try_cast(`{name}` as {to}), try_cast({whole} as {to}))")
    return F.expr(f"try_cast(`{name}` as {to})")


def coerce_types(df: DataFrame, types: dict[str, str] = CLEAN_TYPES) -> DataFrame:
    """Cast the known columns; a value that does not parse becomes null."""
    return df.withColumns({c: _coerced(df, c, t) for c, t in types.items() if c in df.columns})


def drop_nulls(df: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN in ``required`` (default: in any column)."""
    return df.dropna(subset=required)


def drop_duplicates(df: DataFrame) -> DataFrame:
    """Keep one of each group of fully equal rows."""
    return df.dropDuplicates()


def clamp_negative(df: DataFrame, columns: list[str] = NON_NEGATIVE_COLUMNS) -> DataFrame:
    """Replace negative values by 0; null stays null."""
    return df.withColumns(
        {c: F.when(F.col(c) < 0, F.lit(0).cast(df.schema[c].dataType)).otherwise(F.col(c)) for c in columns}
    )


def drop_negative(df: DataFrame, columns: list[str] = NON_NEGATIVE_COLUMNS) -> DataFrame:
    """Drop rows that ``clamp_negative`` would change."""
    for c in columns:
        df = df.where(F.col(c) >= 0)
    return df


def clean(
    df: DataFrame,
    required: list[str] | None = None,
    invalid_keys: str = "clamp",
) -> DataFrame:
    """Cast, drop incomplete rows, drop exact duplicates, then treat negatives.

    The order is part of the result: rows that only become equal by clamping
    are all kept. ``required=REQUIRED_COLUMNS`` keeps unlabelled rows, which
    live scoring needs.
    """
    treat = {"clamp": clamp_negative, "drop": drop_negative}[invalid_keys]
    return (
        df.transform(coerce_types)
        .transform(drop_nulls, required)
        .transform(drop_duplicates)
        .transform(treat)
    )
