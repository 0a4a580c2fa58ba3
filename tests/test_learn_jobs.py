import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from txrisk.functions.scores import score_of
from txrisk.operators.features import build_features
from txrisk.operators.learn import (
    build_pipeline,
    grid_scores,
    minmax_scale,
    sample_rows,
    score,
    train,
    tune,
    union_snapshots,
    with_class_weight,
)
from txrisk.plans.jobs import clean_job, compare_job, daily_drift, profile_job, refit_job
from txrisk.schema import AUC_CV, AUC_TEST, FEATURES, P_VALUE, RAW_COLUMNS, RECALL_TEST
from txrisk.sources.messages import decode_scores, encode_scores
from txrisk.sources.runs import load_model, read_runs, save_model
from txrisk.sources.tables import append_forecasts, snapshot_dates


def raw_lines(n=300, days=6):
    """Amounts above 200 are mostly frauds, so that a model has something to learn."""
    rng = random.Random(9)
    start = dt.datetime(2024, 1, 1)
    for i in range(n):
        at = start + dt.timedelta(seconds=rng.randrange(days * 86400))
        amount = round(rng.uniform(1, 300), 2)
        fraud = int((amount > 200) != (rng.random() < 0.1))
        seconds = int((at - start).total_seconds())
        yield f"{i},{at},{rng.randrange(20)},{rng.randrange(6)},{amount},{seconds},{seconds // 86400},{fraud},{fraud}"


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("job")
    (folder / "raw").mkdir()
    text = ["# " + " | ".join(RAW_COLUMNS), *raw_lines()]
    (folder / "raw" / "a.txt").write_text("\n".join(text) + "\n")
    clean_job(spark, str(folder / "raw"), str(folder / "table"))
    return folder


def test_profile_job(spark, table):
    (table / "raw" / "b.txt").write_text("1,2024-01-01 00:00:00,5,Err,1.5,0,0,0,0\n" * 2)
    found = profile_job(spark, str(table / "raw"))
    copies = {os.path.basename(r["source_file"]): r["n_duplicates"] for r in found["duplicates"].collect()}
    assert copies == {"a.txt": 0, "b.txt": 1}
    gaps = {(os.path.basename(r["source_file"]), r["column"]): r["n_null"] for r in found["missing"].collect()}
    assert gaps["b.txt", "terminal_id"] == 1 and gaps["a.txt", "terminal_id"] == 0
    counts = {(os.path.basename(r["source_file"]), r["column"]): r["count"] for r in found["numeric"].collect()}
    assert counts["a.txt", "customer_id"] == 300 and counts["b.txt", "terminal_id"] == 0


def test_class_weight_and_union(spark):
    df = spark.createDataFrame([(1, 0), (2, 1), (3, None)], "id INT, tx_fraud INT")
    assert [r["classWeights"] for r in with_class_weight(df).orderBy("id").collect()] == [1, 5, 1]
    swapped = df.select("tx_fraud", "id")
    assert union_snapshots([df, swapped]).agg(F.sum("id")).first()[0] == 12


def test_sample_and_scale(spark):
    df = spark.range(2000).select(F.col("id").alias("x"), F.lit(4).alias("c"))
    drawn = sample_rows(df, 0.05, 1)
    assert 50 < drawn.count() < 150
    assert drawn.exceptAll(sample_rows(df.repartition(7), 0.05, 1)).count() == 0
    assert sample_rows(df, 0, 1).count() == 0 and sample_rows(df, 1, 1).count() == 2000
    ends = minmax_scale(df, ["x", "c"]).agg(F.min("x"), F.max("x"), F.min("c"), F.max("c")).first()
    assert tuple(ends) == (0.0, 1.0, 0.5, 0.5)


def test_scale_agrees_with_the_ml_scaler(spark, table):
    rows = spark.read.parquet(str(table / "table"))
    model = train(rows, build_pipeline(["tx_amount", "hour"], maxIter=1))
    ours = minmax_scale(rows.select("tranaction_id", "tx_amount", "hour"), ["tx_amount", "hour"])
    got = {r["tranaction_id"]: (r["tx_amount"], r["hour"]) for r in ours.collect()}
    for r in score(rows, model).select("tranaction_id", "scaledFeatures").collect():
        assert got[r["tranaction_id"]] == pytest.approx(tuple(r["scaledFeatures"]), abs=1e-12)


def test_model_learns_and_survives_saving(spark, table, tmp_path):
    rows = spark.read.parquet(str(table / "table"))
    model = train(rows, build_pipeline(maxIter=3))
    scored = score(rows, model)
    mean = {r["tx_fraud"]: r["s"] for r in scored.groupBy("tx_fraud").agg(F.avg(score_of(scored)).alias("s")).collect()}
    assert mean[1] > mean[0] + 0.2
    save_model(model, str(tmp_path / "m"))
    again = score(rows, load_model(str(tmp_path / "m")))
    one = scored.select("tranaction_id", score_of(scored).alias("s"))
    two = again.select("tranaction_id", score_of(again).alias("s"))
    assert one.exceptAll(two).count() == 0


def test_grid(spark, table):
    rows = spark.read.parquet(str(table / "table"))
    tuned = tune(rows, {"maxDepth": [1, 2], "maxIter": [1]}, features=FEATURES[:4])
    points = grid_scores(rows, tuned).collect()
    assert len(points) == 2 and sum(r["best"] for r in points) == 1
    assert max(r["auc"] for r in points) == next(r["auc"] for r in points if r["best"])


def test_refit_compare_and_daily_drift(spark, table):
    path, runs = str(table / "table"), str(table / "runs")
    dates = sorted(r[0] for r in snapshot_dates(spark, path).collect())
    for depth in (1, 3):
        refit_job(spark, path, runs, str(table / "models"), dates[:4], dates[4:], grid={"maxDepth": [depth], "maxIter": [2]})
    logged = read_runs(spark, runs, "model refit").collect()
    assert len(logged) == 2
    assert all({AUC_CV, AUC_TEST, RECALL_TEST} <= set(r["metrics"]) for r in logged)
    result = compare_job(spark, path, runs, dates).first()
    assert result["status"] in ("compared", "not_enough_samples", "equal_metrics")
    assert read_runs(spark, runs, "model comparison").first()["params"]["status"] == result["status"]
    # Parameters reach the classifier, every grid point is logged, and a plain run can be ranked.
    tuned = refit_job(spark, path, runs, str(table / "models"), dates[:4], dates[4:], grid={"maxDepth": [1, 2]}, maxIter=1)
    plain = refit_job(spark, path, runs, str(table / "models"), dates[:4], dates[4:], maxIter=1, maxDepth=1)
    by_id = {r["run_id"]: r for r in read_runs(spark, runs, "model refit").collect()}
    assert {by_id[tuned]["params"][f"grid point {i}"] for i in (0, 1)} == {"maxDepth=1", "maxDepth=2"}
    assert by_id[tuned]["params"]["maxIter"] == "1" and by_id[tuned]["params"]["maxDepth"] in ("1", "2")
    assert load_model(by_id[tuned]["artifact_path"]).stages[-1].getNumTrees == 1
    assert by_id[plain]["params"] == {"maxIter": "1", "maxDepth": "1"} and AUC_CV in by_id[plain]["metrics"]

    rows = spark.read.parquet(path)
    scored = score(rows, load_model(logged[0]["artifact_path"]))
    live = scored.withColumn("key", F.lit("k"))
    append_forecasts(decode_scores(encode_scores(live)), str(table / "forecasts"), 0)
    day = daily_drift(spark, scored, str(table / "forecasts"), "2024_01_02", runs)
    row = day.first()
    assert row["forecast_date"] == "2024_01_02" and row["n_ref"] == rows.count() and not row["refit"]
    assert P_VALUE in read_runs(spark, runs, "score drift").first()["metrics"]
    assert daily_drift(spark, scored, str(table / "forecasts"), "1999_01_01", runs).count() == 0


def test_features_need_no_labels(spark, table):
    rows = spark.read.parquet(str(table / "table")).select(*RAW_COLUMNS)
    unlabelled = rows.withColumn("tx_fraud", F.lit(None).cast("int"))
    out = build_features(unlabelled)
    assert out.where("number_of_fraud_tx_per_terminal_for_1_day is not null").count() == 0
    assert out.where("number_of_tx_per_terminal_for_1_day is null").count() == 0


def test_fitted_and_scored_rows_are_computed_once(spark):
    """Scoring reads the rows that were fitted; their cleaning and windows are not done again."""
    from txrisk.plans.queries import queries

    for name, rows in (("model_roundtrip", "same"), ("gbt_scores", "sound")):
        out = queries()[name](spark, "/root/testdata/sf0.001")
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "Window" not in plan and "Join" not in plan and "Aggregate" not in plan
        assert out.where(f"not {rows} or {rows} is null").count() == 0 and out.count() > 0
