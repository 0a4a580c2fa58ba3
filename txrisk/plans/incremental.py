"""The clean job for new files only: late rows change stored days, and just those are written again.

Beside the days of the feature table, under a name that readers of the table skip, stands one narrow copy of
every distinct row as it was before clamping: the identity of a row, and all that windows need.

    <table>/tx_date=.../                  features, one folder per day, as ``clean_job`` writes them
    <table>/_rows/tx_date=.../job=.../    the rows, one folder per day and the job that brought them
    <table>/_pending/                     the days that a job has set out to write

A job notes its days before it adds rows, and removes the note when the days are written. A job that finds a
note of another that was lost writes these days first; they follow from the rows alone. So a lost job may be run
again, and files may be given twice.
"""

from __future__ import annotations

import datetime as dt
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.operators.clean import clamp_negative, coerce_types, drop_duplicates, drop_negative, drop_nulls
from txrisk.operators.features import build_features
from txrisk.schema import CLEAN_TYPES, RAW_COLUMNS, WINDOW_DAYS
from txrisk.session import work_dir
from txrisk.sources.raw import read_raw
from txrisk.sources.tables import read_if_exists, write_clean

ROWS, PENDING = "_rows", "_pending"
ROW_SCHEMA = ", ".join(f"{c} {t}" for c, t in CLEAN_TYPES.items())
BACK = max(WINDOW_DAYS)


def update_clean(
    raw: DataFrame, table_path: str, required: list[str] | None = None, invalid_keys: str = "clamp"
) -> list[dt.date]:
    """Add raw rows to the feature table at ``table_path``; returns the days that were written.

    However rows are split over calls, and in whatever order they come, the table is that of one job over all of them.
    Exact duplicates of stored rows change nothing. ``required`` and ``invalid_keys`` are those of ``clean``
    and must be the same in all calls. One call at a time may write a table.
    """
    spark = raw.sparkSession
    treat = {"clamp": clamp_negative, "drop": drop_negative}[invalid_keys]
    finish_pending(spark, table_path, treat)
    # A row without a time belongs to no day and no window.
    typed = drop_duplicates(drop_nulls(coerce_types(raw.select(*RAW_COLUMNS)), required)).where("tx_datetime is not null")
    fresh = _kept(_unknown(typed, table_path), "fresh")
    days = changed_days(fresh, table_path)
    if days:
        _note(spark, table_path, days)
        _add_rows(fresh, table_path)
        finish_pending(spark, table_path, treat)
    return days


def update_job(spark: SparkSession, raw_path: str | list[str], table_path: str, glob: str = "*.txt", **options) -> DataFrame:
    """``update_clean`` for new raw text files; returns the table."""
    update_clean(read_raw(spark, raw_path, glob), table_path, **options)
    return spark.read.parquet(table_path)


def stored_rows(spark: SparkSession, table_path: str) -> DataFrame | None:
    """The distinct rows of a table as they came, with ``tx_date`` and the ``job`` that brought them."""
    return read_if_exists(spark, f"{table_path}/{ROWS}", f"{ROW_SCHEMA}, tx_date DATE, job STRING")


def _kept(df: DataFrame, name: str) -> DataFrame:
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _day() -> Column:
    return F.to_date("tx_datetime")


def _on(days: list[dt.date]) -> Column:
    """Rows of some days; as text, because not every year can be handed over as a date."""
    return F.col("tx_date").isin([F.lit(d.isoformat()).cast("date") for d in days])


def _days_of(df: DataFrame, day: Column) -> list[dt.date]:
    """Distinct days, which the driver may hold: a table has one folder for each."""
    return sorted(r[0] for r in df.select(day.alias("day")).distinct().collect())


def _unknown(typed: DataFrame, table_path: str) -> DataFrame:
    """Rows that are not stored yet; of the stored ones only those of the same days are read."""
    stored = stored_rows(typed.sparkSession, table_path)
    if stored is None:
        return typed
    there = stored.where(_on(_days_of(typed, _day())))
    same = [typed[c].eqNullSafe(there[c]) for c in RAW_COLUMNS]
    return typed.join(there, reduce(Column.__and__, same), "left_anti")


def changed_days(fresh: DataFrame, table_path: str) -> list[dt.date]:
    """Days of new rows, and the stored days on which a window of one of their keys may reach back to them."""
    days = _days_of(fresh, _day())
    stored = stored_rows(fresh.sparkSession, table_path)
    if not days or stored is None:
        return days
    later = sorted({d + dt.timedelta(days=n) for d in days for n in range(1, BACK + 1) if d < dt.date(9999, 1, 1)} - set(days))
    reach = F.explode(F.sequence(F.lit(0), F.lit(BACK)))
    found = set(days)
    candidates = stored.where(_on(later))
    for key in ("customer_id", "terminal_id"):
        # As windows see it: negative ids are clamped to one key.
        value = F.greatest(F.col(key), F.lit(0))
        mine = fresh.select(value.alias("key"), _day().alias("of")).distinct().select("key", "of", reach.alias("n"))
        mine = mine.select("key", F.date_add("of", F.col("n")).alias("day")).distinct()
        touched = candidates.select(value.alias("k"), "tx_date").distinct().join(
            mine, F.col("k").eqNullSafe(F.col("key")) & (F.col("tx_date") == F.col("day")), "left_semi"
        )
        found |= set(_days_of(touched, F.col("tx_date")))
    return sorted(found)


def _note(spark: SparkSession, table_path: str, days: list[dt.date]) -> None:
    spark.createDataFrame([(d,) for d in days], "day DATE").coalesce(1).write.mode("overwrite").parquet(f"{table_path}/{PENDING}")


def _add_rows(fresh: DataFrame, table_path: str) -> None:
    dated = fresh.withColumns({"tx_date": _day(), "job": F.lit(uuid.uuid4().hex)})
    dated.hint("rebalance", F.col("tx_date")).write.mode("append").partitionBy("tx_date", "job").parquet(f"{table_path}/{ROWS}")


def finish_pending(spark: SparkSession, table_path: str, treat=clamp_negative) -> list[dt.date]:
    """Write the days noted by a job, this one or one that was lost; returns them."""
    noted = read_if_exists(spark, f"{table_path}/{PENDING}", "day DATE")
    days = [] if noted is None else _days_of(noted, F.col("day"))
    stored = stored_rows(spark, table_path)
    if days and stored is not None:
        near = sorted({d - dt.timedelta(days=n) for d in days for n in range(BACK + 1) if d > dt.date(1, 3, 1)} | set(days))
        rows = treat(stored.where(_on(near)))
        # What is asked for, and what its windows reach back to.
        asked = _on(days)
        current = rows.where(asked).select(*RAW_COLUMNS)
        history = rows.where(~asked).select(*RAW_COLUMNS)
        write_clean(build_features(current, history), table_path)
    if days:
        _note(spark, table_path, [])
    return days
