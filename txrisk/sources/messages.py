"""Transactions and scores as keyed JSON messages."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions.scores import probability_text
from txrisk.operators.clean import coerce_types
from txrisk.schema import RAW_COLUMNS, RAW_STRING, REQUIRED_COLUMNS
from txrisk.sources.raw import file_headers, number_lines

BROKEN = "__broken"
SCORE_COLUMNS = ["tranaction_id", "tx_datetime", "prediction", "probability"]


def to_messages(df: DataFrame, key: Column | None = None, also: Sequence[str] = ()) -> DataFrame:
    """Rows as (key, value) with every field as text; null fields are left out. Columns ``also`` stay beside them."""
    fields = [F.col(c).cast("string").alias(c) for c in RAW_COLUMNS if c in df.columns]
    name = F.concat(F.lit("tx_"), F.col("tranaction_id").cast("string")) if key is None else key
    return df.select(name.alias("key"), F.to_json(F.struct(*fields)).alias("value"), *also)


def file_messages(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Raw text files as messages keyed ``tx_<line number>@<file>``; see ``line_messages``."""
    return line_messages(number_lines(spark, path), limit)


def line_messages(lines: DataFrame, limit: int | None = None) -> DataFrame:
    """Numbered lines of whole files as messages; keys are unique over all files.

    Each file's own header line names its fields, in any order; without one they are in the order of the raw
    layout. Fields of other names, and missing ones, are left out. With ``limit`` only the lines before
    that number are sent, which is how a short load test is cut.
    """
    headers = file_headers(lines)
    lines = lines.where(~F.col("value").startswith("#"))
    if limit is not None:
        lines = lines.where(F.col("line") < limit)
    # One row per file on the right; the rows of a large file need no shuffle where that is broadcast, and are split where not.
    rows = lines.join(headers, F.col("file") == F.col("__of"), "left")
    names = F.coalesce("names", F.array(*[F.lit(c) for c in RAW_COLUMNS]))
    rows = rows.select("file", "line", F.split("value", ",").alias("parts"), names.alias("names"))
    at = {c: F.array_position("names", c).cast("int") - 1 for c in RAW_COLUMNS}
    fields = [F.when(i >= 0, F.get("parts", i)).alias(c) for c, i in at.items()]
    return rows.select(
        F.concat(F.lit("tx_"), F.col("line").cast("string"), F.lit("@"), "file").alias("key"),
        F.to_json(F.struct(*fields)).alias("value"),
    )


def decode_messages(messages: DataFrame) -> DataFrame:
    """Messages as raw text rows plus key, value and the reject ``reason``.

    ``reason`` is null for a usable message, else not_json or missing_field (one
    of the seven required fields is absent). Labels are optional. The messages' ``timestamp``, where they have one, is kept.
    """
    schema = f"{RAW_STRING}, {BROKEN} STRING"
    parsed = F.from_json("value", schema, {"columnNameOfCorruptRecord": BROKEN})
    # inline keeps the parsed row together: plain field access would let the
    # optimizer repeat the parsing for every field and filter.
    when = [c for c in ("timestamp",) if c in messages.columns]
    row = messages.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), *when
    ).select("key", "value", *when, F.inline(F.array(parsed)))
    is_object = F.coalesce(F.col(BROKEN).isNull() & F.ltrim("value").startswith("{"), F.lit(False))
    reason = F.when(~is_object, "not_json").when(_any_null(REQUIRED_COLUMNS), "missing_field")
    return row.withColumn("reason", reason).drop(BROKEN)


def _any_null(columns: list[str]) -> Column:
    return reduce(Column.__or__, [F.col(c).isNull() for c in columns])


def check_messages(messages: DataFrame) -> DataFrame:
    """Decoded, typed rows with ``reason`` null where the message is usable.

    Adds the reason unparsable: a required field is there but does not fit its type.
    """
    typed = coerce_types(decode_messages(messages))
    lost = F.when(_any_null(REQUIRED_COLUMNS), "unparsable")
    return typed.withColumn("reason", F.coalesce(F.col("reason"), lost))


def valid_rows(checked: DataFrame) -> DataFrame:
    """Typed rows of the usable messages, with their key."""
    return checked.where(F.col("reason").isNull()).select("key", *RAW_COLUMNS)


def rejected_rows(checked: DataFrame) -> DataFrame:
    """The other messages as they came, with the reason."""
    return checked.where(F.col("reason").isNotNull()).select("key", "value", "reason")


def split_invalid(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected messages)."""
    checked = check_messages(messages)
    return valid_rows(checked), rejected_rows(checked)


def score_fields(scored: DataFrame) -> DataFrame:
    """The four published columns, time and probability as text."""
    return scored.select(
        *[c for c in ("key",) if c in scored.columns],
        "tranaction_id",
        F.date_format("tx_datetime", "yyyy-MM-dd HH:mm:ss").alias("tx_datetime"),
        F.col("prediction").cast("double").alias("prediction"),
        probability_text(scored).alias("probability"),
    )


def encode_scores(scored: DataFrame) -> DataFrame:
    """Scored rows as (key, value) messages, one JSON object per row."""
    fields = score_fields(scored)
    return fields.select("key", F.to_json(F.struct(*SCORE_COLUMNS)).alias("value"))


def decode_scores(messages: DataFrame) -> DataFrame:
    """Messages of ``encode_scores`` as forecast rows."""
    kinds = "tranaction_id LONG, tx_datetime STRING, prediction DOUBLE, probability STRING"
    out = messages.select(
        F.col("key").cast("string").alias("key"),
        F.from_json(F.col("value").cast("string"), kinds).alias("s"),
    ).select("key", "s.*")
    return out.withColumn("probability", F.from_json("probability", "array<double>"))


def encode_column_maps(scored: DataFrame) -> DataFrame:
    """Scored rows as the older payload ``{column: {row number: value}}``, one row each."""
    fields = score_fields(scored)
    maps = [F.create_map(F.lit("0"), F.col(c)).alias(c) for c in SCORE_COLUMNS]
    return fields.select("key", F.to_json(F.struct(*maps)).alias("value"))


def decode_column_maps(messages: DataFrame) -> DataFrame:
    """The older payload as forecast rows; a payload may hold several rows."""
    kinds = (
        "tranaction_id MAP<STRING,LONG>, tx_datetime MAP<STRING,STRING>, "
        "prediction MAP<STRING,DOUBLE>, probability MAP<STRING,STRING>"
    )
    maps = messages.select(
        F.col("key").cast("string").alias("key"),
        F.from_json(F.col("value").cast("string"), kinds).alias("s"),
    ).select("key", "s.*")
    rows = maps.withColumn("row", F.explode(F.map_keys("prediction")))
    picked = {c: F.try_element_at(c, F.col("row")) for c in SCORE_COLUMNS}
    picked["probability"] = F.from_json(picked["probability"], "array<double>")
    return rows.select("key", *[v.alias(c) for c, v in picked.items()])

