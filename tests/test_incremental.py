import random

import pytest
from pyspark.sql import functions as F

from txrisk.operators.features import feature_table
from txrisk.plans import incremental
from txrisk.plans.incremental import finish_pending, stored_rows, update_clean, update_job
from txrisk.schema import RAW_COLUMNS, REQUIRED_COLUMNS
from txrisk.sources.tables import snapshot_dates

TEXT = ", ".join(f"{c} STRING" for c in RAW_COLUMNS)


def raw_rows(n=260, days=75, seed=3):
    """Rows with repeats, negative and broken ids, ties and rows exactly a window apart."""
    r = random.Random(seed)
    out = []
    for i in range(n):
        day = r.choice([r.randrange(days), 5, 35])
        clock = r.choice(["00:00:00", "12:00:00", "23:59:59", f"{r.randrange(24):02}:30:00"])
        month, rest = divmod(day, 31)
        at = f"2024-{[1, 3, 5][month % 3]:02}-{rest + 1:02} {clock}"
        customer, terminal = str(r.choice([-3, -5, 0, 1, 2])), r.choice(["1", "2", "Err", "7.0", "-1"])
        out.append((str(i if r.random() < 0.9 else -1), at, customer, terminal, str(r.randrange(9)), "5", "0", str(r.randrange(2)), "0"))
    return out + out[:20]


def frame(spark, rows):
    return spark.createDataFrame(rows, TEXT)


def contents(df):
    names = sorted(set(df.columns) - {"tx_date"})
    return sorted(tuple(str(r[c]) for c in names) for r in df.select(*names).collect())


@pytest.mark.parametrize("seed,parts", [(1, 3)])
def test_any_split_gives_the_table_of_one_job(spark, tmp_path, seed, parts):
    rows = raw_rows(seed=seed)
    r = random.Random(seed)
    owner = [r.randrange(parts) for _ in rows]
    path = str(tmp_path / "t")
    for p in range(parts):
        # Some rows come a second time, in a later job.
        update_clean(frame(spark, [x for x, o in zip(rows, owner) if o == p or (o < p and r.random() < 0.2)]), path)
    assert contents(spark.read.parquet(path)) == contents(feature_table(frame(spark, rows)))


def test_only_changed_days_are_written(spark, tmp_path):
    path = str(tmp_path / "t")

    def row(i, day, customer, terminal):
        return (str(i), f"2024-{day} 10:00:00", customer, terminal, "1.5", "1", "1", "0", "0")

    first = [row(1, "03-01", "1", "1"), row(2, "03-10", "1", "2"), row(3, "03-11", "9", "9"), row(4, "05-20", "1", "1")]
    assert [str(d) for d in update_clean(frame(spark, first), path)] == ["2024-03-01", "2024-03-10", "2024-03-11", "2024-05-20"]
    # A late row of customer 1: the 10th sees it, the 11th shares no key, May is out of reach.
    late = [row(5, "03-05", "1", "77")]
    assert [str(d) for d in update_clean(frame(spark, late), path)] == ["2024-03-05", "2024-03-10"]
    assert update_clean(frame(spark, late + first), path) == []
    assert contents(spark.read.parquet(path)) == contents(feature_table(frame(spark, first + late)))


@pytest.mark.parametrize("step", ["_add_rows", "write_clean"])
def test_a_lost_job_may_be_run_again(spark, tmp_path, monkeypatch, step):
    rows = raw_rows(120, 40, 5)
    path = str(tmp_path / "t")
    update_clean(frame(spark, rows[:80]), path)
    real = getattr(incremental, step)
    with monkeypatch.context() as m:

        def lost(*args):
            if step == "_add_rows":
                real(*args)  # rows are there, their days are not
            raise RuntimeError("lost")

        m.setattr(incremental, step, lost)
        with pytest.raises(RuntimeError):
            update_clean(frame(spark, rows[80:]), path)
    update_clean(frame(spark, rows[80:]), path)
    assert contents(spark.read.parquet(path)) == contents(feature_table(frame(spark, rows)))
    assert finish_pending(spark, path) == []


def test_other_ways_of_cleaning(spark, tmp_path):
    rows = [(*x[:7], None, None) if i % 3 == 0 else x for i, x in enumerate(raw_rows(100, 40, 6))]
    path = str(tmp_path / "t")
    options = {"required": REQUIRED_COLUMNS, "invalid_keys": "drop"}
    for part in (rows[60:], rows[:70]):
        update_clean(frame(spark, part), path, **options)
    assert contents(spark.read.parquet(path)) == contents(feature_table(frame(spark, rows), **options))


def test_files_and_nothing_new(spark, tmp_path):
    (tmp_path / "raw").mkdir()
    path, raw = str(tmp_path / "t"), str(tmp_path / "raw")
    header = "# " + " | ".join(RAW_COLUMNS)
    rows = raw_rows(60, 20, 7)
    for name, part in (("b.txt", rows[30:]), ("a.txt", rows[:40])):
        (tmp_path / "raw" / name).write_text("\n".join([header, *map(",".join, part)]) + "\n")
        table = update_job(spark, f"{raw}/{name}", path)
    assert table.count() == stored_rows(spark, path).count()
    assert update_clean(frame(spark, []), path) == []
    # Readers of the table see its days only.
    assert snapshot_dates(spark, path).where("tx_date is null").count() == 0
    assert set(spark.read.parquet(path).columns) >= {"tx_date", "is_day"} and "job" not in spark.read.parquet(path).columns


def test_a_first_job_without_rows(spark, tmp_path):
    assert update_clean(frame(spark, []), str(tmp_path / "none")) == []
    assert stored_rows(spark, str(tmp_path / "none")) is None


def test_stray_years(spark, tmp_path):
    rows = [(str(i), f"{y}-01-01 00:00:00", "1", "1", "2", "3", "4", "0", "0") for i, y in enumerate(("0001", "9999", "2024"))]
    path = str(tmp_path / "t")
    for part in (rows[:2], rows[2:]):
        update_clean(frame(spark, part), path)
    assert spark.read.parquet(path).agg(F.count("*")).first()[0] == 3
