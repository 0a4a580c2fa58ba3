"""The table of training and comparison runs, and the models they saved.

    <runs>/write=.../experiment=.../

Every write has a folder of its own, so that writers do not meet. A run may be written several times, by a job
that was retried or to bring a result; of its records the one logged last counts.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.schema import RUNS
from txrisk.session import list_dir, remove_path
from txrisk.sources.tables import read_if_exists

STORED = f"{RUNS}, logged_at TIMESTAMP, record STRING, write STRING"
COLUMNS = ["run_id", "experiment", "status", "started_at", "metrics", "params", "artifact_path"]


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    experiment: str,
    status: str = "FINISHED",
    metrics: dict[str, float] | None = None,
    params: dict[str, str] | None = None,
    artifact_path: str | None = None,
    started_at: dt.datetime | None = None,
) -> None:
    """Write one run record; it replaces what was logged under the same id."""
    started = started_at or dt.datetime.now(dt.timezone.utc)
    values = {k: None if v is None else float(v) for k, v in (metrics or {}).items()}
    texts = {k: None if v is None else str(v) for k, v in (params or {}).items()}
    row = (run_id, experiment, status, started, values, texts, artifact_path)
    write_runs(spark.createDataFrame([row], RUNS).coalesce(1), path)


def write_runs(runs: DataFrame, path: str, logged_at: dt.datetime | None = None) -> None:
    """Write run records, replacing those of the same ids; safe beside other writers."""
    now = logged_at or dt.datetime.now(dt.timezone.utc)
    marked = runs.select(*COLUMNS).withColumns({"logged_at": F.lit(now), "record": F.lit(uuid.uuid4().hex)})
    _write(marked, path)


def _write(marked: DataFrame, path: str) -> str:
    """A search by experiment reads only the folders of that experiment."""
    folder = f"write={uuid.uuid4().hex}"
    marked.hint("rebalance", F.col("experiment")).write.partitionBy("experiment").parquet(f"{path}/{folder}")
    return folder


def _latest(stored: DataFrame) -> DataFrame:
    """Of each run the record logged last; equal times are decided by the record's own id."""
    columns = ["logged_at", "record", *[c for c in COLUMNS if c not in ("run_id", "metrics", "params")]]
    # Maps cannot be compared, so they follow the record they belong to.
    order = F.struct("logged_at", "record")
    newest = stored.groupBy("run_id").agg(F.max_by(F.struct(*columns, "metrics", "params"), order).alias("r"))
    return newest.select("run_id", "r.*")


def read_runs(
    spark: SparkSession, path: str, experiment: str | None = None, status: str | None = None
) -> DataFrame:
    """Run records as last logged, optionally of one experiment or status; none where nothing was written."""
    df = read_if_exists(spark, path, STORED)
    if df is None:
        return spark.createDataFrame([], RUNS)
    if experiment is not None:
        df = df.where(F.col("experiment") == experiment)
    df = _latest(df).select(*COLUMNS)
    if status is not None:
        df = df.where(F.col("status") == status)
    return df


def compact_runs(spark: SparkSession, path: str) -> None:
    """Put the records of all writes so far into one and drop replaced ones.

    Writes that come meanwhile are left alone. A run of this that is lost leaves records twice at most, which
    count once. Readers that began before may have to be repeated.
    """
    folders = [f for f in list_dir(spark, path) if f.startswith("write=")]
    done = [f for f in folders if "_SUCCESS" in list_dir(spark, f"{path}/{f}")]
    if len(done) < 2:
        return
    stored = spark.read.schema(STORED).parquet(path).where(F.col("write").isin([f.removeprefix("write=") for f in done]))
    _write(_latest(stored), path)
    for folder in done:
        remove_path(spark, f"{path}/{folder}")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
