import datetime as dt

from pyspark.sql import functions as F

from txrisk.operators.compare import score_drift
from txrisk.schema import P_VALUE
from txrisk.sources.messages import encode_scores
from txrisk.sources.runs import read_runs
from txrisk.sources.tables import read_forecasts, read_if_exists
from txrisk.streaming.close import close_batch, close_days, read_closes
from txrisk.streaming.scoring import read_tx_stream


def scores(spark, rows):
    """(id, event time, score, sent) as score messages."""
    df = spark.createDataFrame(rows, "tranaction_id LONG, at STRING, p DOUBLE, sent STRING")
    df = df.select(
        F.concat(F.lit("k"), "tranaction_id").alias("key"), "tranaction_id", F.col("at").cast("timestamp").alias("tx_datetime"),
        (F.col("p") > 0.5).cast("double").alias("prediction"), F.array(1 - F.col("p"), F.col("p")).alias("probability"), "sent",
    )
    sent = df.select("key", F.col("sent").cast("timestamp").alias("timestamp"))
    return encode_scores(df).join(sent, "key")


def day_rows(day, n, first_id, shift=0.0):
    return [(first_id + i, f"{day} {i % 24:02}:00:00", ((i * 7) % 10) / 20 + shift, f"{day} {i % 24:02}:00:00") for i in range(n)]


def run(messages, batch_id, paths, reference):
    return close_batch(messages, batch_id, reference, *(paths[n] for n in ("f", "c", "q", "r")))


def test_days_close_once_and_late_rows_are_set_aside(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in "fcqr"}
    reference = spark.range(200).select((F.col("id") % 10 / 20).alias("score"))
    one, two, three = day_rows("2024-01-01", 48, 0), day_rows("2024-01-02", 48, 100, 0.4), day_rows("2024-01-03", 24, 200)
    assert run(scores(spark, one + two[:1]), 0, paths, reference) == []  # the second day has just begun
    assert run(scores(spark, two[1:]), 1, paths, reference) == ["2024_01_01"]
    late = [(900, "2024-01-01 05:00:00", 0.9, "2024-01-03 01:00:00"), (901, "2024-01-02 05:00:00", 0.9, "2024-01-03 00:30:00")]
    stray = [(902, "9999-01-01 05:00:00", 0.9, "2024-01-03 01:00:00")]
    for _ in range(2):  # a batch that is run again changes nothing
        assert run(scores(spark, three + late + stray), 2, paths, reference) == ["2024_01_02"]
    assert run(scores(spark, []), 3, paths, reference) == []
    set_aside = spark.read.parquet(paths["q"]).collect()
    assert [(r["tranaction_id"], r["reason"]) for r in set_aside] == [(900, "closed_day")]
    closes = {r["forecast_date"]: r for r in read_closes(spark, paths["c"]).collect()}
    assert set(closes) == {"2024_01_01", "2024_01_02"}
    live = read_forecasts(spark, paths["f"])
    want = score_drift(reference, live.select("forecast_date", F.col("probability")[1].alias("score")))
    for r in want.where("forecast_date < '2024_01_03'").collect():
        got = closes[r["forecast_date"]]
        assert all(got[n] == r[n] for n in ("n_live", "mean_live", "t", "p", "refit"))
    assert not closes["2024_01_01"]["refit"] and closes["2024_01_02"]["refit"] and closes["2024_01_02"]["n_live"] == 49
    logged = read_runs(spark, paths["r"], "score drift").collect()
    assert sorted((r["params"]["date"], r["params"]["refit"]) for r in logged) == [("2024_01_01", "False"), ("2024_01_02", "True")]
    assert all(P_VALUE in r["metrics"] for r in logged)
    # No score is lost: each is a forecast or set aside.
    assert live.count() + len(set_aside) == 48 + 48 + 24 + 3


def test_as_a_stream(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("in", "check", "f", "c", "q")}
    reference = spark.range(100).select((F.col("id") % 10 / 20).alias("score"))
    for day, first in (("2024-01-01", 0), ("2024-01-02", 100), ("2024-01-04", 200)):
        scores(spark, day_rows(day, 24, first)).write.mode("append").parquet(paths["in"])
        close_days(
            read_tx_stream(spark, paths["in"]), paths["check"], reference, paths["f"], paths["c"], paths["q"], delay=dt.timedelta(hours=2)
        ).awaitTermination()
    assert sorted(r["forecast_date"] for r in read_closes(spark, paths["c"]).collect()) == ["2024_01_01", "2024_01_02"]
    assert read_if_exists(spark, paths["q"]) is None


def test_messages_without_scores_or_times(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in "fcqr"}
    reference = spark.range(10).select((F.col("id") / 20).alias("score"))
    rows = [("a", "{oops", "2024-01-05 00:00:00"), ("b", '{"tx_datetime":"never","prediction":1.0}', None), ("c", None, None)]
    sent = spark.createDataFrame(rows, "key STRING, value STRING, t STRING").withColumn("timestamp", F.col("t").cast("timestamp"))
    assert run(sent, 0, paths, reference) == []
    assert {r["reason"] for r in spark.read.parquet(paths["q"]).collect()} == {"no_time"}
    assert spark.read.parquet(paths["q"]).count() == 3
