"""Live features out of keyed state: customers and terminals keep their own last days in a state store.

The other design, ``history``, reads stored days and splits hot keys; this one reads nothing but the
batch. Keys are dealt to buckets by a hash and handled a bucket at a time. A bucket's rows of one micro-batch are
handled by one task, so limit micro-batches where single keys are hot.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from txrisk.functions.calendar import DAY_SECONDS, epoch_seconds, time_features
from txrisk.operators.clean import clamp_negative
from txrisk.schema import CLEAN_TYPES, RAW_COLUMNS, WINDOW_DAYS
from txrisk.sources.messages import check_messages
from txrisk.streaming.history import write_batch

# Settings a query takes over when it starts. Processing time alone would otherwise ask for batches without end;
# state that has outlived its time goes with the next batch that has rows.
QUERY_CONF = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}
# Days a key keeps before that of its newest message; a key without messages goes as a whole after as long.
KEEP_DAYS = max(WINDOW_DAYS) + 1
KEY_LIFE_MS = (KEEP_DAYS + 1) * DAY_SECONDS * 1000

MEASURES = ("n", "n_amount", "s_amount", "n_fraud", "s_fraud")
KINDS = [(m, "<f8" if m == "s_amount" else "<i8") for m in MEASURES]
SECOND, DAY = np.dtype([("at", "<i8"), *KINDS]), np.dtype([("day", "<i8"), *KINDS])
KEY = np.dtype([("id", "<i8"), ("era", "<i8"), ("used", "<i8")])
# Bytes of seconds up to which a bucket has them in one value; beyond, in one per day.
TOGETHER = 1 << 16
# Keys of a kind share this many states, as each call of the processor costs far more than a key in it. Part of a checkpoint.
BUCKETS = 1024
# Keys of a bucket lie on one axis of time, each in an era of its own that is longer than any calendar Spark has.
ERA_DAYS = 1 << 28
MAX_KEYS = (1 << 63) // (ERA_DAYS * DAY_SECONDS) - 1
CUSTOMER, TERMINAL = "customer", "terminal"
OF_CUSTOMER, OF_TERMINAL = ("n_amount", "s_amount"), ("n", "n_fraud", "s_fraud")
ROW = ", ".join(f"{c} {t}" for c, t in CLEAN_TYPES.items())


def totals_of(measures: tuple[str, ...]) -> dict[str, str]:
    """Names and types of the totals of all windows."""
    return {f"{m}_{d}": "DOUBLE" if m == "s_amount" else "BIGINT" for d in WINDOW_DAYS for m in measures}


def calendar(day: np.ndarray) -> np.ndarray:
    """Days without their era."""
    return (day + ERA_DAYS // 2) % ERA_DAYS - ERA_DAYS // 2


def era(day: np.ndarray) -> np.ndarray:
    return (day + ERA_DAYS // 2) // ERA_DAYS


def starts(places: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]])) if len(places) else np.zeros(0, dtype=np.int64)


def added(entries: np.ndarray, place: str) -> np.ndarray:
    """Entries of one place summed, in order of places."""
    entries = entries[np.argsort(entries[place], kind="stable")]
    first = starts(entries[place])
    out = entries[first]
    for m in MEASURES:
        if len(first):
            out[m] = np.add.reduceat(entries[m], first)
    return out


def running(values: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Running totals within runs; ``inside`` is each value's number in its run. Only adds, never takes away."""
    out, step = values, 1
    while step <= inside.max(initial=0):
        at = np.flatnonzero(inside >= step)
        more = out.copy()
        more[at] += out[at - step]
        out, step = more, 2 * step
    return out


def by_day(seconds: bytes) -> dict[int, bytes]:
    """Seconds of several days, those of a day next to one another, as the bytes of each day."""
    entries = np.frombuffer(seconds, dtype=SECOND)
    day = calendar(entries["at"] // DAY_SECONDS)
    first = [*starts(day).tolist(), len(entries)]
    return {int(day[a]): entries[a:b].tobytes() for a, b in zip(first, first[1:])}


class KeyState:
    """The days of some keys over a store of bytes: ``read(day)`` and ``write(day, data)``, ``None`` to forget it.

    Stored are calendar days, with the seconds of all keys; seconds and totals carry the era of their key.
    """

    def __init__(self, totals: bytes, read, write):
        self.totals = np.frombuffer(totals, dtype=DAY)
        self.read, self.write = read, write
        self.seen: dict[int, np.ndarray] = {}
        self.known = set(calendar(self.totals["day"]).tolist())

    def seconds(self, day: int) -> np.ndarray:
        if day not in self.seen:
            data = self.read(day) if day in self.known else None
            self.seen[day] = np.frombuffer(data or b"", dtype=SECOND)
        return self.seen[day]

    def add(self, rows: pd.DataFrame) -> None:
        """Count rows: ``sec``, ``amount`` and ``fraud``, nulls as NaN."""
        entries = np.zeros(len(rows), dtype=SECOND)
        amount, fraud = rows["amount"].to_numpy(dtype=float), rows["fraud"].to_numpy(dtype=float)
        entries["at"], entries["n"] = rows["sec"].to_numpy(), 1
        entries["n_amount"], entries["s_amount"] = ~np.isnan(amount), np.nan_to_num(amount, nan=0.0, posinf=np.inf, neginf=-np.inf)
        entries["n_fraud"], entries["s_fraud"] = ~np.isnan(fraud), np.nan_to_num(fraud).astype(np.int64)
        day = calendar(entries["at"] // DAY_SECONDS)
        order = np.argsort(day, kind="stable")
        first = starts(day[order])
        for part in np.split(order, first[1:]) if len(order) else []:
            d = int(day[part[0]])
            self.seen[d] = added(np.concatenate([self.seconds(d), entries[part]]), "at")
            self.write(d, self.seen[d].tobytes())
        daily = np.zeros(len(entries), dtype=DAY)
        daily["day"] = entries["at"] // DAY_SECONDS
        for m in MEASURES:
            daily[m] = entries[m]
        self.totals = added(np.concatenate([self.totals, daily]), "day")
        self.known.update(day.tolist())

    def forget(self, before: int | np.ndarray) -> None:
        """Forget calendar days before this one; an array has one for each of ``totals``."""
        old = calendar(self.totals["day"]) < before
        gone = self.totals["day"][old]
        for d in np.unique(calendar(gone)).tolist():
            left = self.seconds(d)
            left = left[~np.isin(left["at"] // DAY_SECONDS, gone)]
            self.seen[d] = left
            self.write(d, left.tobytes() if len(left) else None)
        self.totals = self.totals[~old]

    def windows(self, sec: np.ndarray, measures: tuple[str, ...] = MEASURES) -> dict[str, np.ndarray]:
        """Totals over ``[t - d days, t]`` at some seconds: tail of the first day, whole days, head of the last.

        Sums are only added, so values of any magnitude come out as in the batch job.
        """
        days, of = np.unique(sec // DAY_SECONDS, return_inverse=True)
        own = np.unique(calendar(days))
        needed = np.unique(np.concatenate([own, *[own - d for d in WINDOW_DAYS]])).tolist()
        entries = np.concatenate([self.seconds(d) for d in needed]) if needed else np.zeros(0, dtype=SECOND)
        entries = entries[np.argsort(entries["at"], kind="stable")]
        at, day = entries["at"], entries["at"] // DAY_SECONDS
        first = starts(day)
        size = np.diff([*first, len(at)])
        inside = np.arange(len(at)) - np.repeat(first, size)
        after = np.repeat(size, size) - 1 - inside

        def picked(totals: np.ndarray, where: np.ndarray, wanted: np.ndarray) -> np.ndarray:
            """The totals at some entries, 0 where an entry is not of the wanted day."""
            out = np.zeros(len(where), dtype=totals.dtype)
            there = np.flatnonzero((where >= 0) & (where < len(at)))
            there = there[day[where[there]] == wanted[there]]
            out[there] = totals[where[there]]
            return out

        head = np.searchsorted(at, sec, side="right") - 1
        tail = {d: np.searchsorted(at, sec - d * DAY_SECONDS, side="left") for d in WINDOW_DAYS}
        out = {}
        for m in measures:
            heads = picked(running(entries[m], inside), head, days[of])
            tails = running(entries[m][::-1], after[::-1])[::-1]
            between = self._between(days, m)
            for d in WINDOW_DAYS:
                out[f"{m}_{d}"] = heads + between[d][of] + picked(tails, tail[d], days[of] - d)
        return out

    def _between(self, days: np.ndarray, measure: str) -> dict[int, np.ndarray]:
        """For each of some days, the totals of the whole days that lie inside its windows."""
        stored, values = self.totals["day"], self.totals[measure]
        out = {d: np.zeros(len(days), dtype=values.dtype) for d in WINDOW_DAYS}
        left = np.arange(len(days))
        at = np.searchsorted(stored, days, side="left") - 1
        # From the day before back, as long as the longest window reaches: a day more with each step, at least.
        while len(left):
            inside = at[left] >= 0
            left = left[inside]
            back = days[left] - stored[at[left]]
            left, back = left[back < max(WINDOW_DAYS)], back[back < max(WINDOW_DAYS)]
            for d in WINDOW_DAYS:
                reached = left[back < d]
                out[d][reached] += values[at[reached]]
            at[left] -= 1
        return out


class Windows(StatefulProcessor):
    """Adds the rows of a bucket's keys to their state and returns each with its windows, all rows of the batch counted."""

    def __init__(self, measures: tuple[str, ...], passed: tuple[str, ...]):
        self.measures, self.passed = measures, passed

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.totals = handle.getValueState("totals", "keys BINARY, days BINARY, seconds BINARY", KEY_LIFE_MS)
        self.days = handle.getMapState("seconds", "day BIGINT", "seconds BINARY", KEY_LIFE_MS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        stored = self.totals.get()
        # Each call to the store is a message to the JVM: a bucket of few seconds has all of them beside its totals.
        together = stored is None or stored[2] is not None
        held = by_day(bytes(stored[2])) if stored and together else {}

        def read(day: int) -> bytes | None:
            if together:
                return held.get(day)
            found = self.days.getValue((day,))
            return bytes(found[0]) if found else None

        def write(day: int, data: bytes | None) -> None:
            if together and data is None:
                held.pop(day, None)
            elif together:
                held[day] = data
            elif data is None:
                self.days.removeKey((day,))
            else:
                self.days.updateValue((day,), (data,))

        state = KeyState(bytes(stored[1]) if stored else b"", read, write)
        keys = np.frombuffer(bytes(stored[0]) if stored else b"", dtype=KEY)
        now = timerValues.getCurrentProcessingTimeInMs()
        idle = keys["used"] + KEY_LIFE_MS <= now
        if idle.any():  # as the store does with a state of its own
            state.forget(np.where(np.isin(era(state.totals["day"]), keys["era"][idle]), ERA_DAYS, -ERA_DAYS))
            keys = keys[~idle]
        ids, of = np.unique(batch["id"].to_numpy(dtype=np.int64), return_inverse=True)
        keys = used(keys, ids, now)
        eras = keys["era"][np.searchsorted(keys["id"], ids)]
        sec = batch["sec"].to_numpy(dtype=np.int64) + eras[of] * (ERA_DAYS * DAY_SECONDS)
        values = {c: batch[c] if c in batch else np.nan for c in ("amount", "fraud")}
        state.add(pd.DataFrame({"sec": sec} | values))
        found = state.windows(sec, self.measures)
        # By the time of messages: a stray time in one does not make a key forget.
        newest = np.full(len(ids), -np.inf)
        np.fmax.at(newest, of, batch["message_day"].to_numpy(dtype=float))
        before = np.full(int(keys["era"].max()) + 1, -np.inf)
        before[eras] = newest - KEEP_DAYS
        state.forget(before[era(state.totals["day"])])
        if together and sum(map(len, held.values())) > TOGETHER:
            for day, data in held.items():
                self.days.updateValue((day,), (data,))
            together = False
        self.totals.update((keys.tobytes(), state.totals.tobytes(), b"".join(held.values()) if together else None))
        yield pd.DataFrame({c: batch[c] for c in self.passed} | found)

    def close(self) -> None:
        pass


def used(keys: np.ndarray, ids: np.ndarray, now: int) -> np.ndarray:
    """Keys by id, with those of ``ids`` used now; a new one gets the first era that is free."""
    new = np.setdiff1d(ids, keys["id"])
    if len(keys) + len(new) > MAX_KEYS:
        raise ValueError(f"a bucket has more than {MAX_KEYS} keys")
    more = np.zeros(len(new), dtype=KEY)
    more["id"] = new
    more["era"] = np.setdiff1d(np.arange(len(keys) + len(new)), keys["era"])[: len(new)]
    keys = np.concatenate([keys, more])
    keys = keys[np.argsort(keys["id"])]
    keys["used"][np.searchsorted(keys["id"], ids)] = now
    return keys


def distinct_within(stream: DataFrame, columns: list[str], within: str = "1 day") -> DataFrame:
    """Rows that differ in ``columns`` from all that arrived in the time before: a redelivery is no new row.

    The time is that of arrival, which never goes back, so that no row is late and none is lost. The state is
    that of the rows of this time, however long the stream runs; after it a redelivery counts as new.
    """
    return (
        stream.withColumn("__arrived", F.current_timestamp())
        .withWatermark("__arrived", within)
        .dropDuplicatesWithinWatermark(columns)
        .drop("__arrived")
    )


def keyed_rows(messages: DataFrame) -> DataFrame:
    """Usable messages with what their keys' states need; ``uid`` names the row itself."""
    checked = check_messages(messages).where("reason is null")
    # The identity of a row is that of cleaning: all its values before clamping.
    checked = checked.withColumn("uid", F.md5(F.to_json(F.struct(*RAW_COLUMNS))))
    return clamp_negative(checked).select(
        "uid",
        F.floor(epoch_seconds("timestamp") / F.lit(DAY_SECONDS)).cast("double").alias("message_day"),
        F.to_json(F.struct("key", *RAW_COLUMNS)).alias("payload"),
        epoch_seconds("tx_datetime").alias("sec"),
        F.col("tx_amount").alias("amount"),
        F.col("tx_fraud").cast("double").alias("fraud"),
        F.col("customer_id").alias(CUSTOMER),
        F.col("terminal_id").alias(TERMINAL),
    )


def with_windows(rows: DataFrame, kind: str, measures: tuple[str, ...], *spent: str) -> DataFrame:
    """Rows of a stream with the windows of their key of this kind; it and the columns ``spent`` are left out."""
    passed = [(c, t) for c, t in rows.dtypes if c not in (kind, *spent)]
    fields = dict(passed) | totals_of(measures)
    of = F.pmod(F.xxhash64(kind), F.lit(BUCKETS)).cast("int").alias("bucket")
    return rows.select(of, F.col(kind).alias("id"), *[c for c in rows.columns if c != kind]).groupBy("bucket").transformWithStateInPandas(
        statefulProcessor=Windows(measures, tuple(c for c, _ in passed)),
        outputStructType=", ".join(f"{c} {t}" for c, t in fields.items()),
        outputMode="append",
        timeMode="ProcessingTime",
    )


def keyed_windows(stream: DataFrame, within: str = "1 day") -> DataFrame:
    """A stream of messages as rows with their customer's windows and their terminal's."""
    rows = distinct_within(keyed_rows(stream), ["uid"], within).drop("uid")
    # Shipped with the query, so executors need no copy of this package.
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    # One kind after the other, so that a row stays one and nothing has to be joined.
    rows = with_windows(rows, CUSTOMER, OF_CUSTOMER, "amount")
    return with_windows(rows, TERMINAL, OF_TERMINAL, "sec", "fraud", "message_day")


def shown_features(rows: DataFrame) -> DataFrame:
    """Rows with their windows, with the columns of the batch job."""
    columns = {}
    for d in WINDOW_DAYS:
        columns[f"number_of_tx_per_terminal_for_{d}_day"] = F.col(f"n_{d}")
        columns[f"number_of_fraud_tx_per_terminal_for_{d}_day"] = F.when(F.col(f"n_fraud_{d}") > 0, F.col(f"s_fraud_{d}"))
    for d in WINDOW_DAYS:
        n, total = F.col(f"n_amount_{d}"), F.col(f"s_amount_{d}")
        columns[f"avg_amount_per_customer_for_{d}_days"] = F.when(n > 0, total / n)
        columns[f"number_of_tx_per_customer_for_{d}_days"] = n
    parsed = F.from_json("payload", f"key STRING, {ROW}").alias("row")
    named = rows.select(parsed, *[c.alias(name) for name, c in columns.items()])
    return named.select("row.*", *columns).transform(time_features)


def keyed_stream(
    stream: DataFrame, checkpoint: str, features_path: str, within: str = "1 day", trigger: dict | None = None
) -> StreamingQuery:
    """Features of messages as they arrive, out of keyed state, written per micro-batch.

    A row's windows hold all rows of its key up to its own micro-batch, as far back as the state reaches; a row
    that repeats another within ``within`` is left out. State is kept in RocksDB, with changes in the checkpoint.
    """
    spark = stream.sparkSession
    before = {k: spark.conf.get(k, None) for k in QUERY_CONF}
    for k, v in QUERY_CONF.items():
        spark.conf.set(k, v)
    try:

        def run(rows: DataFrame, batch_id: int) -> None:
            write_batch(shown_features(rows), features_path, batch_id)

        writer = keyed_windows(stream, within).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
        return writer.outputMode("append").trigger(**(trigger or {"availableNow": True})).start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
