"""Scoring a message stream, with or without the history of its keys."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txrisk.functions.calendar import time_features
from txrisk.functions.scores import probability_array
from txrisk.operators.clean import clamp_negative
from txrisk.operators.features import build_features, single_row_features
from txrisk.sources.messages import (
    check_messages,
    decode_scores,
    encode_scores,
    rejected_rows,
    valid_rows,
)
from txrisk.sources.tables import append_forecasts
from txrisk.streaming.history import recent_history, store_history, without_known, write_batch
from txrisk.streaming.keyed import distinct_within

MESSAGE = "key STRING, value STRING, timestamp TIMESTAMP"


def read_tx_stream(
    spark: SparkSession,
    path: str | None = None,
    topic: str | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """(key, value, timestamp) messages from a Kafka topic or a folder of Parquet files.

    Connection settings and read limits (``maxOffsetsPerTrigger``,
    ``maxFilesPerTrigger``) go in ``options``.
    """
    if topic is not None:
        source = spark.readStream.format("kafka").option("subscribe", topic)
        stream = source.options(**(options or {})).load()
    else:
        stream = spark.readStream.schema(MESSAGE).options(**(options or {})).parquet(path)
    return stream.select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "timestamp"
    )


def score_batch(
    messages: DataFrame,
    batch_id: int,
    model: PipelineModel | None,
    features: str,
    history_path: str | None,
    scores_path: str | None,
    features_path: str | None,
    quarantine_path: str | None,
    drop_known: bool = True,
) -> None:
    """Everything one micro-batch does: validate, clean, derive, score, write.

    Without ``drop_known`` rows are not compared with those of earlier batches: the stream has dropped redeliveries.
    """
    checked, out = check_messages(messages), None
    with_history = features == "history"
    if quarantine_path:
        checked = checked.persist(StorageLevel.MEMORY_AND_DISK)
    distinct = rows = None
    try:
        rows = clamp_negative(valid_rows(checked).dropDuplicates())
        if with_history:
            # Read for its days, the features, the totals and the stored rows.
            distinct = rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
            past = recent_history(rows, history_path, batch_id)
            if drop_known and "history" in past:
                rows = without_known(rows, past["history"]).persist(StorageLevel.MEMORY_AND_DISK)
            out = build_features(rows, **past)
        else:
            out = single_row_features(rows).transform(time_features)
        if model is not None:
            out = model.transform(out)
            out = out.withColumn("probability", probability_array(out)).drop(
                "features", "scaledFeatures", "rawPrediction"
            )
        if features_path and scores_path:
            out = out.persist(StorageLevel.MEMORY_AND_DISK)
        if features_path:
            write_batch(out, features_path, batch_id)
        if scores_path:
            _write_messages(encode_scores(out), scores_path, batch_id)
        if with_history:
            store_history(rows, history_path, batch_id)
        if quarantine_path:
            write_batch(rejected_rows(checked), quarantine_path, batch_id)
    finally:
        for kept in (out, rows, distinct):
            if kept is not None:
                kept.unpersist()
        if quarantine_path:
            checked.unpersist()


def _write_messages(messages: DataFrame, path: str, batch_id: int) -> None:
    write_batch(messages.withColumn("timestamp", F.current_timestamp()), path, batch_id)


def score_stream(
    stream: DataFrame,
    checkpoint: str,
    model: PipelineModel | None = None,
    features: str = "history",
    history_path: str | None = None,
    scores_path: str | None = None,
    features_path: str | None = None,
    quarantine_path: str | None = None,
    trigger: dict | None = None,
    redelivered_within: str | None = None,
) -> StreamingQuery:
    """Score messages as they arrive and write score messages.

    ``features="stateless"`` lets a row know only itself. ``"history"`` adds the
    rows stored under ``history_path`` by earlier batches, so that a row's
    features are those of the batch job over all rows up to its own batch. As there, a
    row whose values all came before counts, and is scored, once; with ``redelivered_within`` (``"1 day"``) instead
    a message whose key and value both came within that time, which reads state of that time only and no stored row.
    ``trigger`` defaults to working off what is there and stopping.
    """
    if features not in ("history", "stateless"):
        raise ValueError(f"unknown features {features!r}")
    if features == "history" and history_path is None:
        raise ValueError("history features need a history_path")

    def run(messages: DataFrame, batch_id: int) -> None:
        score_batch(
            messages,
            batch_id,
            model,
            features,
            history_path,
            scores_path,
            features_path,
            quarantine_path,
            drop_known=redelivered_within is None,
        )

    if redelivered_within is not None:
        stream = distinct_within(stream, ["key", "value"], redelivered_within)
    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def write_scores_stream(
    scores: DataFrame, checkpoint: str, topic: str, options: dict[str, str], trigger: dict | None = None
) -> StreamingQuery:
    """Send (key, value) score messages on to a Kafka topic."""
    writer = scores.select("key", "value").writeStream.format("kafka").option("topic", topic)
    writer = writer.options(**options).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def persist_scores(
    scores: DataFrame, checkpoint: str, forecasts_path: str, trigger: dict | None = None
) -> StreamingQuery:
    """The second reader: score messages into the table of daily forecasts."""

    def run(messages: DataFrame, batch_id: int) -> None:
        append_forecasts(decode_scores(messages), forecasts_path, batch_id)

    writer = scores.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
