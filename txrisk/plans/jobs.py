"""The batch jobs, put together from the operators."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions.scores import score_of
from txrisk.operators.compare import compare_models, score_drift
from txrisk.operators.evaluate import class_metrics, roc_auc
from txrisk.operators.features import feature_table
from txrisk.operators.curve import operating_point, threshold_curve
from txrisk.operators.learn import build_pipeline, score, train
from txrisk.operators.profile import profile_duplicates, profile_missing, profile_numeric
from txrisk.operators.tuning import tune_rounds
from txrisk.schema import (
    AUC_CV,
    AUC_TEST,
    P_VALUE,
    PRECISION_TEST,
    PRECISION_TRAIN,
    RECALL_TEST,
    RECALL_TRAIN,
    THRESHOLD,
)
from txrisk.sources.raw import read_raw
from txrisk.sources.runs import load_model, log_run, read_runs, save_model
from txrisk.sources.tables import read_forecasts, read_snapshots, write_clean
from txrisk.streaming.history import KEEP_DAYS, Manifest, upkeep

TRAINING, COMPARISON, DRIFT = "model refit", "model comparison", "score drift"


def profile_job(spark: SparkSession, raw_path: str, glob: str = "*.txt") -> dict[str, DataFrame]:
    """Duplicates of each raw file, numeric ranges and missing values of its distinct rows."""
    rows = read_raw(spark, raw_path, glob, source_file=True)
    distinct = rows.distinct()
    return {
        "duplicates": profile_duplicates(rows, "source_file"),
        "numeric": profile_numeric(distinct, by="source_file"),
        "missing": profile_missing(distinct, "source_file"),
    }


def clean_job(spark: SparkSession, raw_path: str, table_path: str, glob: str = "*.txt") -> DataFrame:
    """Raw text files to the dated feature table; returns the table."""
    write_clean(feature_table(read_raw(spark, raw_path, glob)), table_path)
    return spark.read.parquet(table_path)


def _quality(scored: DataFrame, positive_label: int) -> tuple[float, float]:
    row = class_metrics(scored, positive_label).first()
    return row["precision"], row["recall"]


def refit_job(
    spark: SparkSession,
    table_path: str,
    runs_path: str,
    models_path: str,
    train_dates: list,
    test_dates: list,
    grid: dict[str, list] | None = None,
    positive_label: int = 1,
    seed: int = 42,
    targets: tuple[float, float] = (0.98, 0.05),
    **params,
) -> str:
    """Fit (or tune, given a grid) on some dates, measure on others, log; returns the run id.

    ``targets`` are the least recall and greatest false-positive rate of the logged threshold; ``params`` go to the classifier. A tuned run logs every grid point with its AUC and the
    winner's parameters; a plain one logs its AUC on the other dates under the name that
    ``compare_job`` ranks by as well.
    """
    run_id = uuid.uuid4().hex
    training = read_snapshots(spark, table_path, train_dates)
    testing = read_snapshots(spark, table_path, test_dates)
    metrics: dict[str, float] = {}
    logged = {k: str(v) for k, v in params.items()}
    if grid is None:
        model = train(training, build_pipeline(seed=seed, **params))
    else:
        tuned = tune_rounds(training, grid, seed=seed, **params)
        model = tuned.model
        points = [{k: str(v) for k, v in point.items()} for point in tuned.points]
        for i, (point, auc) in enumerate(zip(points, tuned.aucs)):
            name = ", ".join(f"{k}={v}" for k, v in sorted(point.items()))
            logged[f"grid point {i}"] = name
            metrics[f"{AUC_CV} of grid point {i}"] = auc
        metrics[AUC_CV] = tuned.aucs[tuned.best]
        logged |= points[tuned.best]
    on_train, on_test = score(training, model), score(testing, model)
    # The rows that are measured twice are scored once.
    scored = on_test.select("tx_fraud", "prediction", score_of(on_test).alias("score"))
    scored = scored.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        metrics[PRECISION_TRAIN], metrics[RECALL_TRAIN] = _quality(on_train, positive_label)
        metrics[PRECISION_TEST], metrics[RECALL_TEST] = _quality(scored, positive_label)
        metrics[AUC_TEST] = roc_auc(scored, "score")
        # Where the targets can be met, the score from which on rows are to be called frauds.
        point = operating_point(threshold_curve(scored, "score"), *targets).first()
        if point["found"]:
            metrics[THRESHOLD] = point["threshold"]
    finally:
        scored.unpersist()
    metrics.setdefault(AUC_CV, metrics[AUC_TEST])
    artifact = f"{models_path}/{run_id}"
    save_model(model, artifact)
    log_run(spark, runs_path, run_id, TRAINING, metrics=metrics, params=logged, artifact_path=artifact)
    return run_id


def compare_job(spark: SparkSession, table_path: str, runs_path: str, dates: list, **options) -> DataFrame:
    """Compare the two best logged models on some dates and log the winner."""
    runs = read_runs(spark, runs_path, TRAINING)
    result = compare_models(read_snapshots(spark, table_path, dates), runs, load_model, **options)
    row = result.first()
    log_run(
        spark,
        runs_path,
        uuid.uuid4().hex,
        COMPARISON,
        metrics={P_VALUE: row["p"]},
        params={
            "current_run_id": row["current_run_id"],
            "new_run_id": row["new_run_id"],
            "best_run_id": row["best_run_id"],
            "status": row["status"],
        },
    )
    return spark.createDataFrame([row], result.schema)


def upkeep_job(spark: SparkSession, history_path: str, today: dt.date, keep_days: int = KEEP_DAYS) -> Manifest:
    """Nightly: merge the small files of a stream's history and let days beyond its windows expire."""
    return upkeep(spark, history_path, today, keep_days)


def daily_drift(
    spark: SparkSession,
    reference: DataFrame,
    forecasts_path: str,
    date: str,
    runs_path: str | None = None,
    which: str = "positive",
    **options,
) -> DataFrame:
    """Day's end: do that day's forecasts still look like ``reference``'s scores?

    ``reference`` is a scored DataFrame of the model in use.
    """
    day = read_forecasts(spark, forecasts_path, date)
    live = day.select("forecast_date", score_of(day, which).alias("score"))
    base = reference.select(score_of(reference, which).alias("score"))
    result = score_drift(base, live, "forecast_date", **options)
    if runs_path is None:
        return result
    row = result.first()
    if row is not None:
        log_run(
            spark,
            runs_path,
            uuid.uuid4().hex,
            DRIFT,
            metrics={P_VALUE: row["p"]},
            params={"date": date, "refit": str(row["refit"])},
        )
    return spark.createDataFrame([row] if row is not None else [], result.schema)
