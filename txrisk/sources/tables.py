"""Dated Parquet tables: clean rows, snapshots and forecasts."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions.calendar import date_stamp
from txrisk.schema import FORECAST_TEXT


def write_clean(df: DataFrame, path: str) -> None:
    """Write rows partitioned by event date, replacing the partitions they touch.

    ``rebalance`` gathers a date into few files and lets AQE cut a large date
    into several.
    """
    dated = df.withColumn("tx_date", F.to_date("tx_datetime"))
    (
        dated.hint("rebalance", F.col("tx_date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("tx_date")
        .parquet(path)
    )


def read_snapshots(spark: SparkSession, path: str, dates: list | None = None) -> DataFrame:
    """Rows of the given dates (default: all); other dates are not read."""
    df = spark.read.parquet(path)
    if dates is None:
        return df
    return df.where(F.col("tx_date").isin([F.lit(d).cast("date") for d in dates]))


def snapshot_dates(spark: SparkSession, path: str) -> DataFrame:
    """The dates a clean table holds, as one ``tx_date`` column."""
    return spark.read.parquet(path).select("tx_date").distinct()


def choose_snapshots(dates: DataFrame, k: int, seed: int, column: str = "tx_date") -> DataFrame:
    """``k`` dates without replacement; the same seed picks the same dates anywhere."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.col(column).cast("string")))
    return dates.select(column).orderBy(order).limit(k)


def append_forecasts(scores: DataFrame, path: str, batch_id: int) -> None:
    """Add forecast rows to the table of daily forecasts; repeating a batch is safe.

    ``scores`` has the columns of ``decode_scores``. The day is that of the event.
    """
    stamp = date_stamp(F.col("tx_datetime").try_cast("timestamp"))
    dated = scores.withColumns(
        {"forecast_date": stamp, "batch_id": F.lit(batch_id).cast("bigint")}
    )
    (
        dated.hint("rebalance", F.col("forecast_date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("forecast_date", "batch_id")
        .parquet(path)
    )


def read_forecasts(spark: SparkSession, path: str, date: str | None = None) -> DataFrame:
    """Forecast rows, of one day (``yyyy_MM_dd``) or of all."""
    df = spark.read.parquet(path)
    return df if date is None else df.where(F.col("forecast_date") == date)


def read_forecast_text(spark: SparkSession, path: str) -> DataFrame:
    """A forecast text file with a header; columns are taken by position."""
    df = spark.read.schema(FORECAST_TEXT).option("header", True).option("escape", '"').csv(path)
    return df.select(
        F.col("tx_id").alias("tranaction_id"),
        F.col("datetime").alias("tx_datetime"),
        "prediction",
        F.from_json("probability", "array<double>").alias("probability"),
    )


def read_if_exists(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A Parquet table, or None where nothing has been written yet."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
