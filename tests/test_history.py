import datetime as dt

import pytest
from pyspark.sql import functions as F

from txrisk.operators.features import feature_table
from txrisk.operators.clean import clamp_negative
from txrisk.schema import RAW_STRING
from txrisk.session import list_dir, remove_path
from txrisk.sources.messages import check_messages, to_messages, valid_rows
from txrisk.streaming import history
from txrisk.streaming.history import _read, live_batches, read_manifest, recent_history, store_history, upkeep
from txrisk.streaming.scoring import score_batch

from test_streaming import compare

START = dt.date(2024, 1, 1)


def rows_of(spark, days, per_day=12):
    rows = []
    for d in range(days):
        for i in range(per_day):
            n = d * per_day + i
            at = f"{START + dt.timedelta(days=d)} {i * 2:02}:{n % 2:02}:00"
            rows.append((str(n), at, str(n % 3), str(n % 2), str(n * 1.25), str(n), "0", str(int(n % 5 == 0)), "0"))
    return spark.createDataFrame(rows, RAW_STRING)


def day(df, d, half=None):
    one = df.where(F.col("tx_datetime").startswith(str(START + dt.timedelta(days=d))))
    return one if half is None else one.where((F.col("tranaction_id").cast("int") % 2 == half))


def run(batch, batch_id, path, out):
    score_batch(to_messages(batch), batch_id, None, "history", path, None, out, None)


def store(spark, batch, batch_id, path):
    """A batch's rows as ``score_batch`` leaves them, without its features."""
    store_history(clamp_negative(valid_rows(check_messages(to_messages(batch)))), path, batch_id)


def files_read(spark, path, at):
    batch = spark.createDataFrame([(at,)], "t STRING").select(F.col("t").cast("timestamp").alias("tx_datetime"))
    found = recent_history(batch, path, 10**6)
    return sum(len(df.inputFiles()) for df in found.values())


def test_files_do_not_grow_with_the_batches(spark, tmp_path):
    """Two batches a day; what a batch reads is bounded by the days in reach."""
    path = str(tmp_path / "h")
    df = rows_of(spark, 7, 4)
    without = []
    batch_id = 0
    for d in range(7):
        for half in (0, 1):
            store(spark, day(df, d, half), batch_id, path)
            batch_id += 1
        without.append(files_read(spark, path, f"{START + dt.timedelta(days=d)} 23:00:00"))
        upkeep(spark, path, START + dt.timedelta(days=d), keep_days=3)
    # A day is one file per part once it is merged; before, each batch adds its own.
    assert max(without[4:]) == without[4] and max(without[4:]) <= 6 * 3 + 3 * 2
    assert len(live_batches(spark, path)) <= 2
    assert len(list_dir(spark, f"{path}/manifest")) <= 6  # two versions, checksums and the mark of success
    assert set(read_manifest(spark, path).days) <= {history.day_number(START) + d for d in range(3, 7)}


def test_features_are_those_without_upkeep(spark, tmp_path):
    path, out = str(tmp_path / "h"), str(tmp_path / "out")
    df = rows_of(spark, 40, 6)
    cuts = [0, 20, 33, 40]
    for batch_id, (a, b) in enumerate(zip(cuts, cuts[1:])):
        lo, hi = (str(START + dt.timedelta(days=d)) for d in (a, b))
        run(df.where((F.col("tx_datetime") >= lo) & (F.col("tx_datetime") < hi)), batch_id, path, out)
        upkeep(spark, path, START + dt.timedelta(days=b))
    compare(spark.read.parquet(out), feature_table(df))


def test_late_rows_of_a_merged_day_and_redelivery(spark, tmp_path):
    path, out = str(tmp_path / "h"), str(tmp_path / "out")
    df = rows_of(spark, 5)
    late = day(df, 1, 0)
    run(day(df, 0).unionByName(day(df, 1, 1)), 0, path, out)
    run(day(df, 2), 1, path, out)
    run(day(df, 3), 2, path, out)
    upkeep(spark, path, START + dt.timedelta(days=4))
    run(late.unionByName(day(df, 0)), 3, path, out)  # day 0 is a redelivery of merged rows
    run(day(df, 4), 4, path, out)
    upkeep(spark, path, START + dt.timedelta(days=5))
    upkeep(spark, path, START + dt.timedelta(days=5))
    assert spark.read.parquet(out).count() == df.count()
    last = spark.read.parquet(out).where("batch_id = 4").drop("batch_id")
    ids = day(df, 4).selectExpr("cast(tranaction_id as bigint) tranaction_id")
    compare(last, feature_table(df).join(ids, "tranaction_id", "left_semi"))


def test_the_newest_batch_may_be_run_again(spark, tmp_path):
    path, out = str(tmp_path / "h"), str(tmp_path / "out")
    df = rows_of(spark, 3)
    run(day(df, 0), 0, path, out)
    run(day(df, 1), 1, path, out)
    upkeep(spark, path, START + dt.timedelta(days=1))
    run(day(df, 1), 1, path, out)
    run(day(df, 2), 2, path, out)
    compare(spark.read.parquet(out), feature_table(df))


@pytest.mark.parametrize("step", ["_commit", "_discard"])
def test_a_lost_run_changes_nothing(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "h")
    df = rows_of(spark, 4)
    for d in range(3):
        store(spark, day(df, d), d, path)
    upkeep(spark, path, START + dt.timedelta(days=2))
    before = read_manifest(spark, path)
    store(spark, day(df, 0).withColumn("tranaction_id", F.concat(F.lit("9"), "tranaction_id")), 3, path)
    store(spark, day(df, 3), 4, path)

    def seen():
        manifest = read_manifest(spark, path)
        days = sorted({d for d, (f, _) in manifest.days.items() if f} | set(live_batches(spark, path)))
        return sorted(map(str, _read(spark, path, history.ROWS, manifest, days, -1).collect()))

    rows = seen()
    with monkeypatch.context() as m:
        real = getattr(history, step)

        def lost(*args):
            if step == "_discard":
                # Lost half way: one replaced folder is gone, the others are not.
                remove_path(spark, f"{path}/rows/day={history.day_number(START)}/batch_id=0")
            raise RuntimeError("lost")

        m.setattr(history, step, lost)
        with pytest.raises(RuntimeError):
            upkeep(spark, path, START + dt.timedelta(days=3))
    assert real is getattr(history, step)
    assert read_manifest(spark, path) == before and seen() == rows
    upkeep(spark, path, START + dt.timedelta(days=3))
    assert seen() == rows
    upkeep(spark, path, START + dt.timedelta(days=3))
    assert seen() == rows and len(list_dir(spark, f"{path}/closed/rows")) <= 3


def test_expiry_and_an_empty_store(spark, tmp_path):
    path = str(tmp_path / "h")
    assert upkeep(spark, path, START).days == {}
    df = rows_of(spark, 3)
    for d in range(3):
        store(spark, day(df, d), d, path)
    upkeep(spark, path, dt.date(2024, 3, 1))
    batch = spark.createDataFrame([("2024-01-03 12:00:00",)], "t STRING").select(F.col("t").cast("timestamp").alias("tx_datetime"))
    found = recent_history(batch, path, 99)
    # The newest batch may be run again and stays; the days before it have expired.
    assert {str(r[0]) for r in found["history"].select(F.to_date("tx_datetime")).distinct().collect()} == {"2024-01-03"}
    upkeep(spark, path, dt.date(2024, 3, 1))
    assert set(live_batches(spark, path)) == {history.day_number(dt.date(2024, 1, 3))}
