import datetime as dt
import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from txrisk.functions.calendar import time_features
from txrisk.operators.features import (
    CUSTOMER_AGGS,
    TERMINAL_AGGS,
    build_features,
    customer_features,
    feature_table,
    single_row_features,
    terminal_features,
)
from txrisk.plans.adapters import raw_transactions
from txrisk.operators.rolling import rolling_range

DAY = 86400
SCHEMA = "id INT, k INT, sec LONG, x DOUBLE, y INT"
AGGS = {"n{d}": ("count", "*"), "nx{d}": ("count", "x"), "avg{d}": ("avg", "x"), "sum{d}": ("sum", "x"), "sy{d}": ("sum", "y")}


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA).withColumn("t", F.timestamp_seconds("sec"))


def brute(data, days, delay=0, past=()):
    """The definition, row by row."""
    out = {}
    for i, k, sec, _, _ in data:
        row = {}
        for d in days:
            lo, hi = sec - (d + delay) * DAY, sec - delay * DAY
            peers = [r for r in (*data, *past) if r[1] == k and lo <= r[2] <= hi]
            xs = [r[3] for r in peers if r[3] is not None]
            ys = [r[4] for r in peers if r[4] is not None]
            row[f"n{d}"], row[f"nx{d}"] = len(peers), len(xs)
            row[f"avg{d}"] = sum(xs) / len(xs) if xs else None
            row[f"sum{d}"] = sum(xs) if xs else None
            row[f"sy{d}"] = sum(ys) if ys else None
        out[i] = row
    return out


def same(a, b):
    if a is None or b is None:
        return a is b
    if math.isnan(a) or math.isnan(b):
        return math.isnan(a) and math.isnan(b)
    return a == b or abs(a - b) <= 1e-9 * max(1.0, abs(a))


def check(got, want):
    assert len(got) == len(want)
    for r in got:
        for name, value in want[r["id"]].items():
            assert same(r[name], value), (r["id"], name, r[name], value)


def random_rows(n, seed, span_days, keys=3, start=1_700_000_000):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # A third of the rows share one key, and whole hours make ties.
        k = 0 if rng.random() < 0.34 else rng.randrange(1, keys)
        sec = start + rng.randrange(span_days * 24) * 3600 + rng.choice([0, 0, 1])
        x = None if rng.random() < 0.1 else round(rng.uniform(0, 500), 2)
        y = None if rng.random() < 0.1 else rng.randrange(2)
        rows.append((i, k, sec, x, y))
    return rows


@pytest.mark.parametrize("span,start", [(40, 1_700_000_000), (270, 1_700_000_000), (100, -50 * DAY)])
def test_matches_the_definition(spark, span, start):
    data = random_rows(400, span, span, start=start)
    got = rolling_range(frame(spark, data), "k", "t", (1, 7, 30), AGGS).collect()
    check(got, brute(data, (1, 7, 30)))


def test_delay_and_history_match_the_definition(spark):
    data = random_rows(300, 5, 120)
    got = rolling_range(frame(spark, data), "k", "t", (1, 7), AGGS, delay_days=3).collect()
    check(got, brute(data, (1, 7), delay=3))
    cut = 1_700_000_000 + 60 * DAY
    past, now = [r for r in data if r[2] < cut], [r for r in data if r[2] >= cut]
    got = rolling_range(frame(spark, now), "k", "t", (1, 7, 30), AGGS, history=frame(spark, past)).collect()
    check(got, brute(now, (1, 7, 30), past=past))


def test_frame_ends_are_inclusive(spark):
    data = [(0, 1, 0, 1.0, 1), (1, 1, DAY, 2.0, 0), (2, 1, DAY + 1, 4.0, 0), (3, 1, DAY + 1, 8.0, 1)]
    got = {r["id"]: r for r in rolling_range(frame(spark, data), "k", "t", (1,), AGGS).collect()}
    assert got[1]["n1"] == 2  # exactly one day old is still inside
    assert got[2]["n1"] == got[3]["n1"] == 3  # the first is a second too old; peers see each other
    assert got[2]["sum1"] == 14.0 and got[2]["sy1"] == 1


def test_day_boundary(spark):
    edge = 90 * DAY
    data = [(i, 1, edge + s, float(i), 1) for i, s in enumerate([-30 * DAY - 1, -30 * DAY, -DAY, -1, 0, 1])]
    check(rolling_range(frame(spark, data), "k", "t", (1, 30), AGGS).collect(), brute(data, (1, 30)))


def test_non_finite_values_leave_the_window_again(spark):
    inf, nan = float("inf"), float("nan")
    data = [
        (0, 1, 0, 5.25, 1),
        (1, 1, 10, inf, 1),
        (2, 1, 2 * DAY, 41.75, 1),
        (3, 2, 0, nan, 1),
        (4, 2, 2 * DAY, 1e300 * 0 + 0.1, 1),
        (5, 3, 0, -inf, 1),
        (6, 3, 5, inf, 1),
        (7, 3, 2 * DAY, 7.0, 1),
    ]
    check(rolling_range(frame(spark, data), "k", "t", (1,), AGGS).collect(), brute(data, (1,)))


def test_small_value_after_huge_ones_is_exact(spark):
    data = [(i, 1, i, 1e12 + 0.37, 0) for i in range(200)] + [(200, 1, 3 * DAY, 41.75, 0)]
    last = rolling_range(frame(spark, data), "k", "t", (1,), AGGS).where("id = 200").first()
    assert last["avg1"] == pytest.approx(41.75, abs=1e-11)


def test_null_key_is_a_group_and_null_time_gives_null(spark):
    data = [(0, None, 0, 1.0, 1), (1, None, 5, 2.0, 1), (2, 1, None, 2.0, 1)]
    got = {r["id"]: r for r in rolling_range(frame(spark, data), "k", "t", (1,), AGGS).collect()}
    assert got[1]["n1"] == 2 and got[0]["n1"] == 1 and got[2]["n1"] is None


def test_windows_of_any_length(spark):
    data = random_rows(200, 9, 900)
    check(rolling_range(frame(spark, data), "k", "t", (2, 400), AGGS).collect(), brute(data, (2, 400)))


@pytest.mark.parametrize(
    "values", [[1e-12, 1e-12, 3e-10], [1e19], [4e18, 4e18, 4e18], [1e300, 1e-300, -1e300], [5e-324, 5e-324]]
)
def test_sums_of_any_magnitude_equal_plain_windows(spark, values):
    data = [(i, 1, i * DAY + i, x, 1) for i, x in enumerate(values)]
    df = frame(spark, data)
    got = {r["id"]: r for r in rolling_range(df, "k", "t", (1, 7), AGGS).collect()}
    for d in (1, 7):
        w = Window.partitionBy("k").orderBy("sec").rangeBetween(-d * DAY, 0)
        for r in df.select("id", F.sum("x").over(w).alias("s"), F.avg("x").over(w).alias("a")).collect():
            assert got[r["id"]][f"sum{d}"] == pytest.approx(r["s"], rel=1e-12, abs=0)
            assert got[r["id"]][f"avg{d}"] == pytest.approx(r["a"], rel=1e-12, abs=0)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(0, 9 * DAY), st.integers(-500, 500)), min_size=1, max_size=40))
def test_any_rows(spark, items):
    data = [(i, k, sec, x / 4, x % 2) for i, (k, sec, x) in enumerate(items)]
    check(rolling_range(frame(spark, data), "k", "t", (1, 7), AGGS).collect(), brute(data, (1, 7)))


def direct(df):
    """The features as plain windows."""
    df = df.withColumn("sec", F.col("tx_datetime").cast("long"))
    for key, aggs in (("terminal_id", TERMINAL_AGGS), ("customer_id", CUSTOMER_AGGS)):
        for d in (1, 7, 30):
            w = Window.partitionBy(key).orderBy("sec").rangeBetween(-d * DAY, 0)
            for name, (func, column) in aggs.items():
                f = {"count": F.count, "sum": F.sum, "avg": F.avg}[func]
                df = df.withColumn(name.format(d=d), f(F.lit(1) if column == "*" else column).over(w))
    return time_features(df.drop("sec"))


def transactions(spark, rows):
    return spark.createDataFrame(
        rows,
        "tranaction_id LONG, tx_datetime TIMESTAMP, customer_id INT, terminal_id INT, tx_amount DOUBLE, tx_fraud INT",
    )


def test_features_equal_plain_windows_with_a_hot_key(spark):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [
        (
            i,
            start + dt.timedelta(seconds=rng.randrange(50 * DAY)),
            0 if i % 3 == 0 else rng.randrange(40),
            0 if i % 3 == 1 else rng.randrange(5),
            round(rng.uniform(1, 300), 2),
            rng.randrange(2),
        )
        for i in range(1500)
    ]
    df = transactions(spark, rows)
    got, want = build_features(df), direct(df)
    assert got.columns == want.columns
    rounded = [F.round(F.col(c) + 1e-9, 6).alias(c) if c.startswith("avg") else F.col(c) for c in got.columns]
    got, want = got.select(rounded), want.select(rounded)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_known_single_row(spark):
    df = transactions(spark, [(71200345, dt.datetime(2022, 3, 12, 14, 5, 7, tzinfo=dt.timezone.utc), 1, 902, 41.75, 0)])
    for out in (build_features(df), time_features(single_row_features(df))):
        r = out.first()
        assert (r["day_of_week"], r["week_of_year"], r["is_weekend"], r["hour"], r["is_day"]) == (7, 10, 1, 14, 1)
        for d in (1, 7, 30):
            assert r[f"avg_amount_per_customer_for_{d}_days"] == pytest.approx(41.75, abs=1e-11)
            assert r[f"number_of_tx_per_customer_for_{d}_days"] == 1
            assert r[f"number_of_tx_per_terminal_for_{d}_day"] == 1
            assert r[f"number_of_fraud_tx_per_terminal_for_{d}_day"] == 0


def test_unlabelled_rows_count_but_are_no_fraud(spark):
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    df = transactions(spark, [(1, at, 1, 1, 5.0, None), (2, at, 1, 1, 7.0, 1), (3, at, 1, 2, 7.0, None)])
    got = {r["tranaction_id"]: r for r in terminal_features(df).collect()}
    assert got[1]["number_of_tx_per_terminal_for_1_day"] == 2
    assert got[1]["number_of_fraud_tx_per_terminal_for_1_day"] == 1
    assert got[3]["number_of_fraud_tx_per_terminal_for_1_day"] is None
    assert customer_features(df).first()["number_of_tx_per_customer_for_7_days"] == 3


def test_clean_rows_are_computed_once(spark):
    out = feature_table(raw_transactions(spark, "/root/testdata/sf0.001"))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and final.count("ReusedExchange") >= 2


def test_a_hot_second_is_split_in_both_joins(spark):
    """Half of all rows share customer, terminal and second."""
    sizes = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
        # Real statistics are too large for this.
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {k: spark.conf.get(k) for k in sizes}
    for k, v in sizes.items():
        spark.conf.set(k, v)
    try:
        hot, i = F.col("id") % 2 == 0, F.col("id")
        df = spark.range(0, 20000, 1, 8).select(
            i.alias("tranaction_id"),
            F.timestamp_seconds(F.when(hot, 1_700_000_000).otherwise(i + 1_700_000_000)).alias("tx_datetime"),
            F.when(hot, 0).otherwise(i % 97).cast("int").alias("customer_id"),
            F.when(hot, 0).otherwise(i % 89).cast("int").alias("terminal_id"),
            F.lit(1.5).alias("tx_amount"),
            (i % 3 == 0).cast("int").alias("tx_fraud"),
            F.md5(i.cast("string")).alias("filler"),
        )
        out = build_features(df)
        rows = out.where("tranaction_id = 0").collect()
        out.collect()
        final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert final.count("skew=true") == 2
    assert rows[0]["number_of_tx_per_customer_for_1_days"] == 10000
    assert rows[0]["avg_amount_per_customer_for_30_days"] == 1.5


def test_windows_share_one_shuffle_of_the_seconds(spark):
    """Seconds are shuffled twice, to be combined and into blocks; their copies never are."""
    data = random_rows(300, 13, 90)
    out = rolling_range(frame(spark, data), "k", "t", (1, 7, 30), AGGS, delay_days=7)
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning(__key") == 2 and "__day" not in "".join(
        line for line in final.split("\n") if "Exchange hashpartitioning" in line
    )


def test_windows_reach_over_the_ends_of_blocks(spark):
    """Days around the ends of blocks of 64 days, before and after 1970, with and without a delay."""
    days = [b * 64 + d for b in (-1, 0, 1, 4) for d in (-38, -31, -30, -8, -7, -1, 0, 1, 6, 30, 37)]
    data = [(i, 1, d * DAY + (i * 7001) % DAY, float(i), i % 2) for i, d in enumerate(days)]
    data += [(1000 + i, 1, d * DAY, 0.5, 1) for i, d in enumerate(days)]
    for delay in (0, 7):
        got = rolling_range(frame(spark, data), "k", "t", (1, 7, 30), AGGS, delay_days=delay).collect()
        check(got, brute(data, (1, 7, 30), delay=delay))


@pytest.mark.parametrize(
    "stamp,want",
    [
        ("2024-01-06 06:59:59", (7, 1, 1, 6, 0)),
        ("2024-01-07 07:00:00", (1, 1, 1, 7, 1)),
        ("2024-01-08 00:00:00", (2, 2, 0, 0, 0)),
        ("2024-12-30 23:59:59", (2, 1, 0, 23, 1)),
        ("2021-01-03 12:00:00", (1, 53, 1, 12, 1)),
    ],
)
def test_calendar(spark, stamp, want):
    df = spark.range(1).select(F.lit(stamp).cast("timestamp").alias("tx_datetime"))
    r = time_features(df).first()
    assert (r["day_of_week"], r["week_of_year"], r["is_weekend"], r["hour"], r["is_day"]) == want
