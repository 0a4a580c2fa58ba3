import json
import os
from multiprocessing.pool import ThreadPool

import pytest
from pyspark.sql import functions as F

from txrisk.schema import AUC_CV, RAW_COLUMNS
from txrisk.session import list_dir
from txrisk.sources.messages import (
    decode_column_maps,
    decode_messages,
    decode_scores,
    encode_column_maps,
    encode_scores,
    file_messages,
    split_invalid,
    to_messages,
)
from txrisk.sources.raw import number_lines, raw_header, read_raw
from txrisk.sources import runs
from txrisk.sources.runs import compact_runs, log_run, read_runs
from txrisk.sources.tables import (
    append_forecasts,
    choose_snapshots,
    read_forecast_text,
    read_forecasts,
    read_if_exists,
    read_snapshots,
    snapshot_dates,
    write_clean,
)

HEADER = "# " + " | ".join(RAW_COLUMNS)
SAMPLE = {
    "tranaction_id": "71200345",
    "tx_datetime": "2022-03-12 14:05:07",
    "customer_id": "1",
    "terminal_id": "902",
    "tx_amount": "41.75",
    "tx_time_seconds": "7310055",
    "tx_time_days": "84",
    "tx_fraud": "0",
    "tx_fraud_scenario": "0",
}


def write(path, *lines):
    path.write_text("\n".join(lines) + "\n")


def test_read_raw(spark, tmp_path):
    good = "1,2024-01-01 00:00:00,5,6,1.5,0,0,0,0"
    write(tmp_path / "2024-01-01.txt", HEADER, good, "2,2024-01-01 00:00:01,5,Err,1.5,0,0,0,0", "3,2024-01-01 00:00:02,5")
    write(tmp_path / "2024-01-02.txt", HEADER, good)
    write(tmp_path / "notes.md", "4,2024-01-01 00:00:00,5,6,1.5,0,0,0,0")
    found = read_raw(spark, str(tmp_path), "*.txt", True).collect()
    assert all(r["source_file"].endswith(str(tmp_path) + "/" + os.path.basename(r["source_file"])) for r in found)
    rows = {(os.path.basename(r["source_file"]), r["tranaction_id"]): r for r in found}
    assert sorted(rows) == [("2024-01-01.txt", 1), ("2024-01-01.txt", 2), ("2024-01-01.txt", 3), ("2024-01-02.txt", 1)]
    assert rows["2024-01-01.txt", 2]["terminal_id"] is None
    assert rows["2024-01-01.txt", 3]["tx_fraud"] is None
    assert raw_header(spark, str(tmp_path / "2024-01-01.txt")) == RAW_COLUMNS


def test_line_numbers_across_blocks_and_files(spark, tmp_path):
    for name, n in (("a", 400), ("b", 37)):
        write(tmp_path / f"{name}.txt", *[f"{name}{i}" for i in range(1, n + 1)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        rows = number_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 437
    assert all(r["value"] == os.path.basename(r["file"])[0] + str(r["line"]) for r in rows)


def test_file_messages(spark, tmp_path):
    write(tmp_path / "x.txt", HEADER, ",".join(SAMPLE.values()), "2,2024-01-01 00:00:00,7")
    rows = file_messages(spark, str(tmp_path / "x.txt")).collect()
    assert all(r["key"].endswith("/x.txt") for r in rows)
    got = {r["key"].split("@")[0]: json.loads(r["value"]) for r in rows}
    assert got["tx_2"] == SAMPLE
    assert got["tx_3"] == {"tranaction_id": "2", "tx_datetime": "2024-01-01 00:00:00", "customer_id": "7"}
    limited = file_messages(spark, str(tmp_path / "x.txt"), limit=3).collect()
    assert [r["key"].split("@")[0] for r in limited] == ["tx_2"]


def test_files_with_other_headers(spark, tmp_path):
    """Each file's header names its own fields; without one the raw layout holds."""
    turned = RAW_COLUMNS[::-1]
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "a.txt", "# " + " | ".join(turned), ",".join(SAMPLE[c] for c in turned))
    write(tmp_path / "in" / "b.txt", "# tranaction_id | note | customer_id", "5,hello,7", "# again | other", "6")
    write(tmp_path / "in" / "c.txt", ",".join(SAMPLE.values()))
    got = {r["key"].split("@")[0] + r["key"][-5:]: json.loads(r["value"]) for r in file_messages(spark, str(tmp_path / "in")).collect()}
    assert got == {
        "tx_2a.txt": SAMPLE,
        "tx_2b.txt": {"tranaction_id": "5", "customer_id": "7"},
        "tx_4b.txt": {"tranaction_id": "6"},
        "tx_1c.txt": SAMPLE,
    }


def messages(spark, *values):
    rows = [(f"k{i}", v if isinstance(v, str) or v is None else json.dumps(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "key STRING, value STRING")


def test_split_invalid(spark):
    no_labels = {k: v for k, v in SAMPLE.items() if not k.startswith("tx_fraud")}
    no_customer = {k: v for k, v in SAMPLE.items() if k != "customer_id"}
    numbers = SAMPLE | {"customer_id": 5}
    valid, rejected = split_invalid(
        messages(spark, SAMPLE, no_labels, no_customer, "{oops", "[1]", None, SAMPLE | {"terminal_id": "Err"}, numbers)
    )
    assert sorted(r["key"] for r in valid.collect()) == ["k0", "k1", "k7"]
    reasons = {r["key"]: r["reason"] for r in rejected.collect()}
    assert reasons == {"k2": "missing_field", "k3": "not_json", "k4": "not_json", "k5": "not_json", "k6": "unparsable"}


def test_messages_round_trip(spark):
    df = spark.createDataFrame([tuple(SAMPLE.values())], ", ".join(f"{c} STRING" for c in RAW_COLUMNS))
    sent = to_messages(df)
    assert sent.first()["key"] == "tx_71200345"
    back = decode_messages(sent).first()
    assert back["reason"] is None and all(back[c] == SAMPLE[c] for c in RAW_COLUMNS)


def scored(spark):
    df = spark.createDataFrame([("k", 71200345, 0.0, [0.6210937515, 0.3789062485])], "key STRING, tranaction_id LONG, prediction DOUBLE, probability ARRAY<DOUBLE>")
    return df.withColumn("tx_datetime", F.lit("2022-03-12 14:05:07").cast("timestamp"))


def test_score_payloads(spark):
    for encode, decode in ((encode_scores, decode_scores), (encode_column_maps, decode_column_maps)):
        row = decode(encode(scored(spark))).first()
        assert row["tranaction_id"] == 71200345 and row["tx_datetime"] == "2022-03-12 14:05:07"
        assert row["probability"] == [0.6210937515, 0.3789062485]
    assert json.loads(encode_column_maps(scored(spark)).first()["value"]) == {
        "tranaction_id": {"0": 71200345},
        "tx_datetime": {"0": "2022-03-12 14:05:07"},
        "prediction": {"0": 0.0},
        "probability": {"0": "[0.6210937515,0.3789062485]"},
    }
    two = {"tranaction_id": {"0": 1, "1": 2}, "tx_datetime": {"0": "a", "1": "b"}, "prediction": {"0": 0.0, "1": 1.0}, "probability": {"0": "[1.0,0.0]"}}
    got = {r["tranaction_id"]: r["probability"] for r in decode_column_maps(messages(spark, two)).collect()}
    assert got == {1: [1.0, 0.0], 2: None}


def dated(spark, *items):
    return spark.createDataFrame(items, "tranaction_id LONG, day STRING").select(
        "tranaction_id", F.col("day").cast("timestamp").alias("tx_datetime")
    )


def test_clean_table_replaces_only_touched_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    write_clean(dated(spark, (1, "2024-01-01"), (2, "2024-01-02")), path)
    write_clean(dated(spark, (3, "2024-01-02")), path)
    assert sorted(r["tranaction_id"] for r in read_snapshots(spark, path).collect()) == [1, 3]
    pruned = read_snapshots(spark, path, ["2024-01-01"])
    assert [r["tranaction_id"] for r in pruned.collect()] == [1]
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "(tx_date" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert snapshot_dates(spark, path).count() == 2


def test_choose_snapshots(spark):
    dates = spark.createDataFrame([(f"2024-01-{d:02}",) for d in range(1, 11)], "tx_date STRING")
    one = [r[0] for r in choose_snapshots(dates, 3, 1).collect()]
    assert len(set(one)) == 3
    assert one == [r[0] for r in choose_snapshots(dates.repartition(7), 3, 1).collect()]
    assert {tuple(r[0] for r in choose_snapshots(dates, 3, s).collect()) for s in range(5)} != {tuple(one)}


def test_forecasts(spark, tmp_path):
    path = str(tmp_path / "f")
    rows = spark.createDataFrame(
        [(1, "2024-01-01 10:00:00", 0.0, [0.9, 0.1]), (2, "2024-01-02 10:00:00", 1.0, [0.2, 0.8])],
        "tranaction_id LONG, tx_datetime STRING, prediction DOUBLE, probability ARRAY<DOUBLE>",
    )
    append_forecasts(rows, path, 0)
    append_forecasts(rows, path, 0)  # a repeated batch
    append_forecasts(rows.where("tranaction_id = 1"), path, 1)
    assert read_forecasts(spark, path).count() == 3
    assert read_forecasts(spark, path, "2024_01_01").count() == 2


def test_forecast_text_is_positional(spark, tmp_path):
    write(tmp_path / "f.csv", "tranaction_id,tx_datetime,prediction,probability", '7,2024-01-01 10:00:00,1.0,"[0.25,0.75]"')
    row = read_forecast_text(spark, str(tmp_path)).first()
    assert row["tranaction_id"] == 7 and row["probability"] == [0.25, 0.75]


def test_runs(spark, tmp_path):
    path = str(tmp_path / "runs")
    log_run(spark, path, "a", "x", metrics={AUC_CV: 0.5, "none": None}, params={"depth": 3})
    log_run(spark, path, "b", "y", status="FAILED")
    assert read_runs(spark, path).count() == 2
    row = read_runs(spark, path, "x", "FINISHED").first()
    assert row["metrics"][AUC_CV] == 0.5 and row["params"] == {"depth": "3"} and row["started_at"] is not None
    assert read_runs(spark, path, "y", "FINISHED").count() == 0


def test_runs_are_replaced_by_id(spark, tmp_path):
    path = str(tmp_path / "runs")
    assert read_runs(spark, path).count() == 0
    log_run(spark, path, "a", "x", status="RUNNING")
    for _ in range(2):  # a retry
        log_run(spark, path, "a", "x", metrics={AUC_CV: 0.5}, params={"n": 1})
    log_run(spark, path, "b", "y")
    for _ in range(3):
        found = {r["run_id"]: r for r in read_runs(spark, path).collect()}
        assert set(found) == {"a", "b"} and read_runs(spark, path).count() == 2
        assert found["a"]["status"] == "FINISHED" and found["a"]["metrics"] == {AUC_CV: 0.5} and found["a"]["params"] == {"n": "1"}
        compact_runs(spark, path)
        assert len(list_dir(spark, path)) == 1


def test_writers_do_not_meet(spark, tmp_path):
    path = str(tmp_path / "runs")
    with ThreadPool(4) as pool:
        pool.map(lambda i: log_run(spark, path, f"r{i % 10}", "x", metrics={"m": i}), range(20))
    assert {r["run_id"] for r in read_runs(spark, path).collect()} == {f"r{i}" for i in range(10)}
    assert read_runs(spark, path).count() == 10


def test_a_lost_compaction_counts_runs_once(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "runs")
    for i in range(4):
        log_run(spark, path, f"r{i % 3}", "x", metrics={"m": i})
    before = sorted(map(str, read_runs(spark, path).collect()))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(runs, "remove_path", lost)
        with pytest.raises(RuntimeError):
            compact_runs(spark, path)
    assert sorted(map(str, read_runs(spark, path).collect())) == before
    compact_runs(spark, path)
    assert sorted(map(str, read_runs(spark, path).collect())) == before and len(list_dir(spark, path)) == 1


def test_read_if_exists(spark, tmp_path):
    assert read_if_exists(spark, str(tmp_path / "nothing")) is None
