"""The end of each day as part of the stream: its scores are tested once, and what comes later is set aside."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txrisk.functions.calendar import date_stamp
from txrisk.functions.scores import score_of
from txrisk.operators.compare import score_drift
from txrisk.schema import P_VALUE
from txrisk.session import list_dir
from txrisk.sources.messages import decode_scores
from txrisk.sources.runs import log_run
from txrisk.sources.tables import append_forecasts, read_forecasts, read_if_exists
from txrisk.streaming.history import write_batch

DRIFT = "score drift"
CLOSES = (
    "n_ref BIGINT, mean_ref DOUBLE, sd_ref DOUBLE, n_live BIGINT, mean_live DOUBLE, sd_live DOUBLE, "
    "t DOUBLE, df DOUBLE, p DOUBLE, direction INT, different BOOLEAN, refit BOOLEAN, forecast_date STRING, batch_id BIGINT"
)


def read_closes(spark: SparkSession, path: str) -> DataFrame:
    """One row per closed day: the statistics of its scores and of the reference, the test and the verdict."""
    found = read_if_exists(spark, path, CLOSES)
    return found if found is not None else spark.createDataFrame([], CLOSES)


def close_batch(
    messages: DataFrame,
    batch_id: int,
    reference: DataFrame,
    forecasts_path: str,
    closes_path: str,
    quarantine_path: str,
    runs_path: str | None = None,
    delay: dt.timedelta = dt.timedelta(hours=1),
    which: str = "positive",
    **options,
) -> list[str]:
    """Everything one micro-batch of score messages does; returns the days it closed.

    Scores join their day's forecasts, or quarantine if an earlier batch closed that day or they have none.
    Then every open day is closed that ended ``delay`` before the newest message was sent.
    Times of messages decide, so a stray time inside one closes nothing. All output goes to folders of this
    batch and run ids follow from the day, so that a batch that is run again changes nothing.
    """
    spark = messages.sparkSession
    rows = decode_scores(messages).withColumn("forecast_date", date_stamp(F.col("tx_datetime").try_cast("timestamp")))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        before = read_closes(spark, closes_path).where(F.col("batch_id") < batch_id)
        # A day has one row; the driver may hold them.
        closed = {r["forecast_date"] for r in before.select("forecast_date").distinct().collect()}
        late = F.col("forecast_date").isin(sorted(closed)) | F.col("forecast_date").isNull()
        append_forecasts(rows.where(~late).drop("forecast_date"), forecasts_path, batch_id)
        reason = F.when(F.col("forecast_date").isNull(), "no_time").otherwise("closed_day")
        write_batch(rows.where(late).withColumn("reason", reason), quarantine_path, batch_id)
        newest = messages.agg(F.max("timestamp").alias("at")).first()["at"]
    finally:
        rows.unpersist()
    if newest is None:
        return []
    ended = (newest - delay).date()  # days before this one are over
    stored = [n.removeprefix("forecast_date=") for n in list_dir(spark, forecasts_path) if n.startswith("forecast_date=")]
    ready = sorted(d for d in stored if d not in closed and _is_day(d) and d < ended.strftime("%Y_%m_%d"))
    if ready:
        _close(spark, ready, batch_id, reference, forecasts_path, closes_path, runs_path, which, options)
    return ready


def _is_day(name: str) -> bool:
    return len(name) == 10 and name[4] == name[7] == "_"


def _close(spark, days, batch_id, reference, forecasts_path, closes_path, runs_path, which, options) -> None:
    live = read_forecasts(spark, forecasts_path).where(F.col("forecast_date").isin(days))
    scores = live.select("forecast_date", score_of(live, which).alias("score"))
    score = F.col("score") if "score" in reference.columns else score_of(reference, which).alias("score")
    found = score_drift(reference.select(score), scores, "forecast_date", **options)
    # A row per day; written first, so that the run record follows what is on record.
    write_batch(found, closes_path, batch_id, "forecast_date")
    if runs_path is not None:
        for row in read_closes(spark, closes_path).where((F.col("batch_id") == batch_id) & F.col("forecast_date").isin(days)).collect():
            log_run(
                spark,
                runs_path,
                uuid.uuid5(uuid.NAMESPACE_URL, f"{closes_path}/{row['forecast_date']}").hex,
                DRIFT,
                metrics={P_VALUE: row["p"]},
                params={"date": row["forecast_date"], "refit": str(row["refit"])},
            )


def close_days(
    scores: DataFrame,
    checkpoint: str,
    reference: DataFrame,
    forecasts_path: str,
    closes_path: str,
    quarantine_path: str,
    runs_path: str | None = None,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Score messages into daily forecasts, with each day's drift test when it is over; see ``close_batch``.

    ``reference`` has a ``score`` column, or is a scored DataFrame of the model in use.
    """

    def run(messages: DataFrame, batch_id: int) -> None:
        close_batch(messages, batch_id, reference, forecasts_path, closes_path, quarantine_path, runs_path, **options)

    writer = scores.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()
