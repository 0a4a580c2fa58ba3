import os

from txrisk.schema import RAW_COLUMNS
from txrisk.sources.messages import file_messages
from txrisk.streaming.replay import replay_files

VALUES = ["7", "2024-01-01 00:00:00", "1", "2", "3.5", "0", "0", "0", "0"]


def write(path, columns, rows):
    values = dict(zip(RAW_COLUMNS, VALUES))
    lines = [",".join(str(i) if c == "tranaction_id" else values[c] for c in columns) for i in rows]
    path.write_text("\n".join(["# " + " | ".join(columns), *lines]) + "\n")


def test_stream_and_batch_send_the_same_messages(spark, tmp_path):
    """Files with different column orders, one larger than a block, arriving over several runs."""
    raw, out, check = tmp_path / "raw", str(tmp_path / "out"), str(tmp_path / "check")
    raw.mkdir()
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        batches = 0
        for step, files in enumerate((["a", "b", "c"], ["d"])):
            for i, name in enumerate(files):
                columns = RAW_COLUMNS[step + i :] + RAW_COLUMNS[: step + i]
                write(raw / f"{name}.txt", columns, range(300 if name == "b" else 9))
            (raw / "notes.md").write_text("x")
            replay_files(spark, str(raw), check, out, files_per_batch=2).awaitTermination()
            batches = len([n for n in os.listdir(out) if n.startswith("batch_id=")])
        sent = spark.read.schema("key STRING, value STRING, batch_id LONG").parquet(out)
        got = sorted((r["key"], r["value"]) for r in sent.collect())
        os.remove(raw / "notes.md")
        assert got == sorted((r["key"], r["value"]) for r in file_messages(spark, str(raw)).collect())
        assert len(got) == 300 + 3 * 9 and batches == 3
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
