"""The driver's tables seen as transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.schema import RAW_COLUMNS

# 2024-01-01 00:00:00 UTC, the first day of the events table.
EVENTS_START = 1704067200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as typed transactions."""
    ts = F.col("ts").cast("timestamp")
    seconds = ts.cast("bigint") - F.lit(EVENTS_START)
    fraud = F.when(F.col("event_type") == "error", 1).otherwise(0)
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("tranaction_id"),
        ts.alias("tx_datetime"),
        F.col("user_id").cast("int").alias("customer_id"),
        F.get_json_object("props", "$.k").cast("int").alias("terminal_id"),
        F.col("value").alias("tx_amount"),
        seconds.alias("tx_time_seconds"),
        F.floor(seconds / 86400).alias("tx_time_days"),
        fraud.alias("tx_fraud"),
        (fraud * (1 + F.col("event_id") % 3)).cast("int").alias("tx_fraud_scenario"),
    )


def dirty_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as raw text rows with negative, unparsable, missing and repeated values."""
    tid = F.col("tranaction_id")
    text = {c: F.col(c).cast("string") for c in RAW_COLUMNS}
    text["tx_datetime"] = F.date_format("tx_datetime", "yyyy-MM-dd HH:mm:ss")
    text["customer_id"] = (
        F.when(tid % 41 == 0, -F.col("customer_id") - 1).otherwise(F.col("customer_id")).cast("string")
    )
    text["terminal_id"] = (
        F.when(tid % 43 == 0, F.lit("Err"))
        .when(tid % 37 == 0, F.lit(None))
        .otherwise(F.col("terminal_id").cast("string"))
    )
    rows = transactions(spark, sf_dir)
    # A second copy of some rows, made in the same pass over the table.
    copies = F.when(tid % 50 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("__copy", F.explode(copies)).select(
        *[text[c].alias(c) for c in RAW_COLUMNS],
        F.concat(F.date_format("tx_datetime", "yyyy-MM-dd"), F.lit(".txt")).alias("source_file"),
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dirty_raw`` without the file name: the nine raw columns only."""
    return dirty_raw(spark, sf_dir).select(*RAW_COLUMNS)


def lineitem_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as transactions: larger, all at midnight, so full of ties."""
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_partkey").alias("customer_id"),
        F.col("l_suppkey").alias("terminal_id"),
        F.col("l_shipdate").cast("timestamp").alias("tx_datetime"),
        F.col("l_extendedprice").alias("tx_amount"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("tx_fraud"),
    )
