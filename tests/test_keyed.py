import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from txrisk.operators.features import feature_table
from txrisk.schema import RAW_STRING, REQUIRED_COLUMNS, WINDOW_DAYS
from txrisk.sources.messages import to_messages
from txrisk.streaming.keyed import DAY, KEEP_DAYS, MEASURES, SECOND, KeyState, distinct_within, keyed_stream
from txrisk.streaming.scoring import read_tx_stream

from test_streaming import compare

START = dt.datetime(2024, 1, 1)


def state(store=None):
    store = {} if store is None else store

    def write(day, data):
        store.pop(day) if data is None else store.__setitem__(day, data)

    return KeyState(b"", store.get, write), store


def random_rows(n, days, seed):
    r = np.random.default_rng(seed)
    sec = r.integers(0, days, n) * 86400 + r.choice([0, 43200, 86399], n)
    amount = np.where(r.random(n) < 0.1, np.nan, r.choice([1e-11, 2.5, 1e12], n))
    return pd.DataFrame({"sec": sec, "amount": amount, "fraud": np.where(r.random(n) < 0.2, np.nan, r.integers(0, 2, n))})


def test_windows_by_definition():
    rows = random_rows(400, 50, 1)
    keyed, _ = state()
    for part in (rows[:150], rows[150:151], rows[151:]):
        keyed.add(part)
    found = keyed.windows(rows["sec"].to_numpy())
    for i, t in enumerate(rows["sec"]):
        for d in WINDOW_DAYS:
            seen = rows[(rows["sec"] <= t) & (rows["sec"] >= t - d * 86400)]
            assert found[f"n_{d}"][i] == len(seen)
            assert found[f"n_amount_{d}"][i] == seen["amount"].count() and found[f"n_fraud_{d}"][i] == seen["fraud"].count()
            assert found[f"s_fraud_{d}"][i] == seen["fraud"].sum()
            assert np.isclose(found[f"s_amount_{d}"][i], seen["amount"].sum(), rtol=1e-12, atol=0)


def test_infinite_amounts_stay_infinite():
    keyed, _ = state()
    keyed.add(pd.DataFrame({"sec": [10, 90_000], "amount": [np.inf, 1.0], "fraud": [0.0, 1.0]}))
    assert keyed.windows(np.array([10, 90_000, 200_000]))["s_amount_1"].tolist() == [np.inf, 1.0, 0.0]


def test_a_key_holds_its_last_days_only():
    """However long a key lives, its state is bounded by its seconds in the days it keeps."""
    keyed, store = state()
    sizes = []
    for day in range(120):
        keyed.add(pd.DataFrame({"sec": day * 86400 + np.arange(10) * 60, "amount": 1.0, "fraud": 0.0}))
        full = keyed.windows(np.array([day * 86400 + 600]))
        keyed.forget(day - KEEP_DAYS)
        sizes.append(sum(map(len, store.values())) + keyed.totals.nbytes)
        assert full["n_30"][0] == 10 * min(day + 1, 30)
    assert max(sizes) == sizes[-1] <= (KEEP_DAYS + 1) * (10 * SECOND.itemsize + DAY.itemsize)
    assert len(store) == KEEP_DAYS + 1 and set(keyed.totals.dtype.names) == {"day", *MEASURES}


def transactions(spark, days=70, per_day=5):
    rows = []
    for d in range(days):
        for i in range(per_day):
            n = d * per_day + i
            at = START + dt.timedelta(days=d, hours=i * 4, seconds=n % 2)
            customer = "-4" if n % 17 == 0 else str(n % 3)
            terminal = "Err" if n % 29 == 0 else str(n % 2)
            rows.append((str(n), str(at), customer, terminal, str(n * 1.25), str(n), "0", str(int(n % 5 == 0)), "0"))
    return spark.createDataFrame(rows, RAW_STRING)


def deliver(df, path):
    sent = to_messages(df).withColumn("timestamp", F.get_json_object("value", "$.tx_datetime").cast("timestamp"))
    sent.coalesce(1).write.mode("append").parquet(path)


def test_stream_equals_the_batch_job(spark, tmp_path):
    inbox, out, check = (str(tmp_path / n) for n in ("in", "out", "c"))
    df = transactions(spark)
    cuts = ["2024-01-01", "2024-01-20", "2024-02-19", "2024-02-20", "2025"]
    progress = None
    for lo, hi in zip(cuts, cuts[1:]):
        part = df.where((F.col("tx_datetime") >= lo) & (F.col("tx_datetime") < hi))
        # Some rows are delivered again, within a batch and in the next.
        deliver(part.unionByName(part.where("tranaction_id % 10 = 0")), inbox)
        deliver(df.where((F.col("tx_datetime") < lo) & (F.col("tranaction_id") % 25 == 1)), inbox)
        query = keyed_stream(read_tx_stream(spark, inbox), check, out)
        query.awaitTermination()
        assert query.exception() is None
        progress = query.lastProgress or progress
    compare(spark.read.parquet(out).drop("batch_id"), feature_table(df, REQUIRED_COLUMNS))
    names = {op["operatorName"] for op in progress["stateOperators"]}
    assert any("transformWithState" in n for n in names) and any("dedupe" in n.lower() for n in names)


def test_same_key_with_another_value_is_no_redelivery(spark, tmp_path):
    inbox, out, check = (str(tmp_path / n) for n in ("in", "out", "c"))
    for rows in ([("k", "a"), ("k", "b"), ("k", "a")], [("k", "a"), ("l", "a"), ("k", "c")]):
        spark.createDataFrame(rows, "key STRING, value STRING").withColumn("timestamp", F.lit(None).cast("timestamp")).coalesce(
            1
        ).write.mode("append").parquet(inbox)
        stream = distinct_within(read_tx_stream(spark, inbox), ["key", "value"])
        stream.select("key", "value").writeStream.format("parquet").option("path", out).option("checkpointLocation", check).trigger(
            availableNow=True
        ).start().awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [("k", "a"), ("k", "b"), ("k", "c"), ("l", "a")]


def test_seconds_of_several_days_are_parted_by_day():
    import numpy as np

    from txrisk.streaming.keyed import DAY_SECONDS, SECOND, by_day

    days = {}
    for day in (-1, 0, 5, 6):
        entries = np.zeros(2, dtype=SECOND)
        entries["at"] = [day * DAY_SECONDS, (day + 1) * DAY_SECONDS - 1]
        days[day] = entries.tobytes()
    assert by_day(b"".join(days.values())) == days and by_day(b"") == {}


class Store:
    """What a processor's handle gives, without a stream; counts the calls."""

    def __init__(self):
        self.value, self.map, self.calls = None, {}, 0

    def getValueState(self, *_):
        return self

    getMapState = getValueState

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value

    def getValue(self, key):
        self.calls += 1
        return self.map.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self.map[key] = value

    def removeKey(self, key):
        self.calls += 1
        del self.map[key]


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentProcessingTimeInMs(self):
        return self.ms


def bucket_rows(n, keys, days, seed):
    rows = random_rows(n, days, seed)
    r = np.random.default_rng(seed)
    rows["id"] = r.integers(0, keys, n) * 1_000_003
    rows["sec"] -= 20 * 86400  # before 1970 as well
    rows["message_day"] = (rows["sec"] // 86400).where(r.random(n) < 0.9)
    rows["payload"] = [str(i) for i in range(n)]
    return rows


def fed(processor, rows, ms):
    return pd.concat(processor.handleInputRows((3,), iter([rows[:7], rows[7:]]), Clock(ms)), ignore_index=True)


@pytest.mark.parametrize("together", [0, 1 << 30])
def test_keys_of_a_bucket_do_not_meet(monkeypatch, together):
    """A bucket gives each key what a bucket of its own gives it, and keeps as much."""
    from txrisk.streaming import keyed

    monkeypatch.setattr(keyed, "TOGETHER", together)
    rows = bucket_rows(900, 40, 90, 3).sort_values("sec", kind="stable", ignore_index=True)
    one, store = keyed.Windows(MEASURES, ("payload",)), Store()
    one.init(store)
    single = {k: (keyed.Windows(MEASURES, ("payload",)), Store()) for k in rows["id"].unique()}
    for p, s in single.values():
        p.init(s)
    for a, b in ((0, 300), (300, 301), (301, 700), (700, 900)):
        part = rows[a:b].reset_index(drop=True)
        found = fed(one, part, a)
        apart = pd.concat([fed(single[k][0], g.reset_index(drop=True), a) for k, g in part.groupby("id")])
        pd.testing.assert_frame_equal(found, apart.set_index("payload").loc[found["payload"]].reset_index(), rtol=1e-12)
    kept = [np.frombuffer(s.value[1], dtype=DAY) for _, s in single.values()]
    totals = np.frombuffer(store.value[1], dtype=DAY)
    assert len(totals) == sum(map(len, kept)) and totals["n"].sum() == sum(k["n"].sum() for k in kept)
    if not together:
        size = sum(len(v[0]) for v in store.map.values())
        assert size == sum(len(v[0]) for _, s in single.values() for v in s.map.values())


def test_calls_to_the_store_do_not_grow_with_the_keys():
    from txrisk.streaming import keyed

    processor, store = keyed.Windows(MEASURES, ("payload",)), Store()
    processor.init(store)
    for ms in (0, 1):
        found = fed(processor, bucket_rows(3000, 1000, 5, 9), ms)
    assert len(found) == 3000 and store.calls < 60


def test_an_idle_key_goes_and_its_era_is_free_again():
    from txrisk.streaming import keyed

    def row(key, day):
        return pd.DataFrame({"id": [key], "sec": [day * 86400], "amount": 1.0, "fraud": 0.0, "message_day": float(day), "payload": "x"})

    processor, store = keyed.Windows(MEASURES, ("payload",)), Store()
    processor.init(store)
    fed(processor, row(5, 100), 0)
    assert fed(processor, row(6, 100), 10)["n_30"].tolist() == [1]
    assert fed(processor, row(6, 101), keyed.KEY_LIFE_MS)["n_30"].tolist() == [2]
    keys = np.frombuffer(store.value[0], dtype=keyed.KEY)
    assert keys["id"].tolist() == [6]
    assert fed(processor, row(5, 101), keyed.KEY_LIFE_MS + 1)["n_30"].tolist() == [1]
    keys = np.frombuffer(store.value[0], dtype=keyed.KEY)
    assert keys["id"].tolist() == [5, 6] and keys["era"].tolist() == [0, 1]
    assert np.frombuffer(store.value[1], dtype=DAY)["n"].sum() == 3
