import json

import pytest
from pyspark.sql import functions as F

from txrisk.operators.features import feature_table
from txrisk.schema import RAW_STRING, REQUIRED_COLUMNS
from txrisk.sources.messages import encode_scores, to_messages
from txrisk.sources.tables import read_forecasts
from txrisk.streaming.scoring import (
    persist_scores,
    read_tx_stream,
    score_batch,
    score_stream,
)

from txrisk.streaming.history import recent_history

from test_sources import SAMPLE, scored


def transactions(spark, n=240):
    """Three days with ties, a negative customer and a bad terminal."""
    rows = []
    for i in range(n):
        at = f"2024-01-0{1 + i * 3 // n} {i % 24:02}:{i % 2:02}:00"
        customer = "-4" if i % 17 == 0 else str(i % 3)
        terminal = "Err" if i % 29 == 0 else str(i % 2)
        rows.append((str(i), at, customer, terminal, str(i * 1.25), str(i), "0", str(int(i % 5 == 0)), "0"))
    return spark.createDataFrame(rows, RAW_STRING)


def deliver(df, path):
    df.withColumn("timestamp", F.current_timestamp()).write.mode("append").parquet(path)


def compare(got, want):
    names = [c for c in want.columns if c != "key"]
    rounded = [F.round(F.col(c) + 1e-9, 6).alias(c) if c.startswith("avg") else F.col(c) for c in names]
    got, want = got.select(rounded), want.select(rounded)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0


def test_history_features_equal_the_batch_job(spark, tmp_path):
    inbox, history, out, check, bad = (str(tmp_path / n) for n in ("in", "h", "out", "c", "bad"))
    df = transactions(spark)
    for day in ("2024-01-01", "2024-01-02", "2024-01-03"):
        deliver(to_messages(df.where(F.col("tx_datetime").startswith(day))), inbox)
        score_stream(
            read_tx_stream(spark, inbox), check, history_path=history, features_path=out, quarantine_path=bad
        ).awaitTermination()
    compare(spark.read.parquet(out), feature_table(df, REQUIRED_COLUMNS))
    rejected = spark.read.parquet(bad)
    assert {r["reason"] for r in rejected.collect()} == {"unparsable"}
    assert rejected.count() == df.where("terminal_id = 'Err'").count()


def test_whole_days_come_from_totals(spark, tmp_path):
    """Forty days of rows, then single later days: windows reach into stored totals."""
    rows = []
    for i in range(400):
        day, minute = divmod(i * 144, 1440)
        at = f"2024-{1 + day // 31:02}-{1 + day % 31:02} {minute // 60:02}:{minute % 60:02}:00"
        rows.append((str(i), at, str(i % 3), str(i % 2), str(i * 1.25), str(i), "0", str(int(i % 5 == 0)), "0"))
    df = spark.createDataFrame(rows, RAW_STRING)
    history, out = str(tmp_path / "h"), str(tmp_path / "out")
    cuts = ["2024-01-01", "2024-02-04", "2024-02-05", "2024-02-09", "2025"]
    for batch_id, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        part = df.where((F.col("tx_datetime") >= lo) & (F.col("tx_datetime") < hi))
        score_batch(to_messages(part), batch_id, None, "history", history, None, out, None)
    compare(spark.read.parquet(out), feature_table(df))
    batch = df.where("tx_datetime >= '2024-02-09 12:00:00'").select(F.col("tx_datetime").cast("timestamp"))
    found = recent_history(batch, history, 9)
    days = {r[0] for r in found["history"].select(F.to_date("tx_datetime").cast("string")).distinct().collect()}
    assert days == {"2024-02-09", "2024-02-08", "2024-02-02", "2024-01-10"}
    assert found["customer_totals"].select("day").distinct().count() == 27


def test_late_rows_see_only_what_came_before_them_in_time(spark, tmp_path):
    history, out = str(tmp_path / "h"), str(tmp_path / "out")
    df = transactions(spark, 60).where("terminal_id <> 'Err'")
    late, early = df.where("tx_datetime < '2024-01-02'"), df.where("tx_datetime >= '2024-01-02'")
    for batch_id, part in enumerate((early, late)):
        score_batch(to_messages(part), batch_id, None, "history", history, None, out, None)
    got = spark.read.parquet(out).where("tx_datetime < '2024-01-02'")
    compare(got, feature_table(late))


def test_a_repeated_batch_counts_once(spark, tmp_path):
    history, out = str(tmp_path / "h"), str(tmp_path / "out")
    df = transactions(spark, 60)
    first, second = (to_messages(df.where(F.col("tx_datetime").startswith(d))) for d in ("2024-01-01", "2024-01-02"))
    for batch_id, batch in ((0, first), (1, second), (1, second)):
        score_batch(batch, batch_id, None, "history", history, None, out, None)
    compare(
        spark.read.parquet(out), feature_table(df.where("tx_datetime < '2024-01-03'"), REQUIRED_COLUMNS)
    )


def test_stateless_known_message(spark, tmp_path):
    inbox, out = str(tmp_path / "in"), str(tmp_path / "out")
    unlabelled = {k: v for k, v in SAMPLE.items() if not k.startswith("tx_fraud")}
    rows = [("tx_2", json.dumps(SAMPLE)), ("tx_3", json.dumps(unlabelled))]
    deliver(spark.createDataFrame(rows, "key STRING, value STRING"), inbox)
    score_stream(
        read_tx_stream(spark, inbox), str(tmp_path / "c"), features="stateless", features_path=out
    ).awaitTermination()
    got = {r["key"]: r for r in spark.read.parquet(out).collect()}
    assert got["tx_2"]["avg_amount_per_customer_for_30_days"] == 41.75
    assert got["tx_2"]["number_of_fraud_tx_per_terminal_for_1_day"] == 0
    assert got["tx_3"]["number_of_fraud_tx_per_terminal_for_1_day"] is None
    assert (got["tx_3"]["day_of_week"], got["tx_3"]["hour"], got["tx_3"]["is_day"]) == (7, 14, 1)


def test_redelivered_rows_count_once(spark, tmp_path):
    """Across batches too; another row with the same key, or a late one, is no redelivery."""
    history, out = str(tmp_path / "h"), str(tmp_path / "out")
    df = transactions(spark, 60)
    messages = to_messages(df, F.lit("one key"))
    for batch_id in (0, 1):
        score_batch(messages, batch_id, None, "history", history, None, out, None)
    compare(spark.read.parquet(out), feature_table(df, REQUIRED_COLUMNS))


def test_redelivery_bounded_in_time(spark, tmp_path):
    """Messages that come again are dropped by state; another value under the same key is none of them."""
    inbox, history, out, check, bad = (str(tmp_path / n) for n in ("in", "h", "out", "c", "bad"))
    df = transactions(spark, 60)
    sent = to_messages(df, F.lit("one key"))
    early = sent.where(F.get_json_object("value", "$.tx_datetime") < "2024-01-02")
    for part in (early.unionByName(early), sent):
        deliver(part, inbox)
        score_stream(
            read_tx_stream(spark, inbox), check, history_path=history, features_path=out, quarantine_path=bad, redelivered_within="1 day"
        ).awaitTermination()
    compare(spark.read.parquet(out), feature_table(df, REQUIRED_COLUMNS))
    # Every message is a row or on record as rejected, once.
    assert spark.read.parquet(out).count() + spark.read.parquet(bad).count() == 60


def test_a_stray_date_reads_nothing(spark, tmp_path):
    history, out = str(tmp_path / "h"), str(tmp_path / "out")
    df = transactions(spark, 60).where("terminal_id <> 'Err'")
    score_batch(to_messages(df), 0, None, "history", history, None, out, None)
    stray = df.limit(1).withColumns({"tx_datetime": F.lit("0001-01-01 00:00:00"), "tranaction_id": F.lit("999")})
    now = df.where("tx_datetime >= '2024-01-03'").withColumn("tranaction_id", F.concat(F.lit("9"), "tranaction_id"))
    batch = to_messages(stray.unionByName(now))
    score_batch(batch, 1, None, "history", history, None, out, None)
    compare(spark.read.parquet(out).where("batch_id = 1").drop("batch_id"),
            feature_table(df.unionByName(now).unionByName(stray)).join(
                now.unionByName(stray).selectExpr("cast(tranaction_id as long) tranaction_id"), "tranaction_id", "left_semi"))


def test_scores_become_daily_forecasts(spark, tmp_path):
    inbox, forecasts = str(tmp_path / "in"), str(tmp_path / "f")
    deliver(encode_scores(scored(spark)), inbox)
    persist_scores(read_tx_stream(spark, inbox), str(tmp_path / "c"), forecasts).awaitTermination()
    row = read_forecasts(spark, forecasts, "2022_03_12").first()
    assert row["tranaction_id"] == 71200345 and row["probability"][0] == 0.6210937515


def test_wrong_arguments(spark, tmp_path):
    stream = read_tx_stream(spark, str(tmp_path))
    with pytest.raises(ValueError):
        score_stream(stream, str(tmp_path / "c"), features="history")
    with pytest.raises(ValueError):
        score_stream(stream, str(tmp_path / "c"), features="none")


def test_distinct_rows_of_a_batch_are_computed_once(spark, tmp_path, monkeypatch):
    """The look for the days of a batch leaves its distinct rows to all that reads them after."""
    from txrisk.streaming import scoring

    seen = []

    def recent(rows, *rest):
        seen.append(rows.is_cached)
        return recent_history(rows, *rest)

    monkeypatch.setattr(scoring, "recent_history", recent)
    df, out = transactions(spark, 60), str(tmp_path / "out")
    score_batch(to_messages(df.union(df)), 0, None, "history", str(tmp_path / "h"), None, out, None)
    assert seen == [True]
    compare(spark.read.parquet(out), feature_table(df, REQUIRED_COLUMNS))


def test_only_the_rows_of_a_step_are_encoded(spark):
    """Rows of other days are left out before messages are made, and the messages are those of all rows."""
    from datetime import timedelta

    from txrisk.plans.adapters import raw_transactions
    from txrisk.plans.queries import _dated_rows, _messages_between

    sf = "/root/testdata/sf0.001"
    rows, (lo, hi) = _dated_rows(spark, sf)
    parts = [_messages_between(rows, day, day + timedelta(days=11)) for day in (lo, lo + timedelta(days=11), lo + timedelta(days=22))]
    for part in parts:
        lines = part._jdf.queryExecution().optimizedPlan().toString().splitlines()
        encoded, filtered = ([i for i, x in enumerate(lines) if word in x] for word in ("StructsToJson", "Filter"))
        assert encoded and filtered and max(encoded) < min(filtered)
    sent = parts[0].union(parts[1]).union(parts[2])
    every = to_messages(raw_transactions(spark, sf))
    assert sent.columns == ["key", "value", "timestamp"] and hi < lo + timedelta(days=33)
    assert sent.count() == every.count() and sent.select("key", "value").exceptAll(every).count() == 0
    at = F.get_json_object("value", "$.tx_datetime").cast("timestamp")
    assert sent.where(~F.col("timestamp").eqNullSafe(at)).count() == 0
