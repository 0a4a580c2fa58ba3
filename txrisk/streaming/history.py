"""What earlier micro-batches leave for the windows of later ones, and its upkeep.

    <history>/{rows,customers,terminals}/day=.../batch_id=.../     as the batches wrote them
    <history>/closed/{rows,customers,terminals}/set=.../day=.../   days merged by an upkeep run
    <history>/manifest/                                            one file per upkeep run

The manifest says for each merged day which set holds it and through which batch it was merged: of that day a
reader takes the set, and the folders of later batches only. A new manifest is one file, so a reader sees all of an upkeep
run or nothing of it.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions.calendar import DAY_SECONDS, epoch_seconds
from txrisk.operators.features import CUSTOMER_AGGS, TERMINAL_AGGS
from txrisk.operators.rolling import daily_totals
from txrisk.schema import CLEAN_TYPES, RAW_COLUMNS, WINDOW_DAYS
from txrisk.session import list_dir, remove_path
from txrisk.sources.tables import read_if_exists

ROWS, CUSTOMERS, TERMINALS = "rows", "customers", "terminals"
STORED = {
    ROWS: ", ".join(["key STRING", *(f"{c} {t}" for c, t in CLEAN_TYPES.items())]),
    CUSTOMERS: "customer_id INT, n_tx_amount BIGINT, s_tx_amount DOUBLE",
    TERMINALS: "terminal_id INT, n_ BIGINT, n_tx_fraud BIGINT, s_tx_fraud BIGINT",
}
CLOSED, MANIFEST = "closed", "manifest"
MANIFEST_SCHEMA = "version BIGINT, day BIGINT, folder STRING, through BIGINT"
# Days a store keeps before the current one: the longest window and a day to spare.
KEEP_DAYS = max(WINDOW_DAYS) + 1


@dataclass
class Manifest:
    """Per merged day its folder, or None if it has expired, and the last batch that was merged."""

    version: int = 0
    days: dict[int, tuple[str | None, int]] = field(default_factory=dict)

    def through(self, day: int) -> int:
        return self.days.get(day, (None, -1))[1]


def read_manifest(spark: SparkSession, path: str) -> Manifest:
    """The manifest with the highest version; a row per day, which the driver may hold."""
    stored = read_if_exists(spark, f"{path}/{MANIFEST}", MANIFEST_SCHEMA)
    if stored is None:
        return Manifest()
    rows = stored.where(F.col("version") == stored.agg(F.max("version")).scalar()).collect()
    days = {r["day"]: (r["folder"], r["through"]) for r in rows if r["day"] is not None}
    return Manifest(rows[0]["version"] if rows else 0, days)


def _live(spark: SparkSession, path: str, name: str) -> DataFrame | None:
    """What batches wrote, by its fixed schema: no file is opened to find the columns."""
    return read_if_exists(spark, f"{path}/{name}", f"{STORED[name]}, day BIGINT, batch_id BIGINT")


def live_batches(spark: SparkSession, path: str) -> dict[int, set[int]]:
    """The batches that wrote rows of each day, from the names of files; none is opened."""
    rows = _live(spark, path, ROWS)
    found: dict[int, set[int]] = {}
    for file in rows.inputFiles() if rows is not None else []:
        day, batch = re.search(r"/day=(-?\d+)/batch_id=(\d+)/", file).groups()
        found.setdefault(int(day), set()).add(int(batch))
    return found


def _read(
    spark: SparkSession, path: str, name: str, manifest: Manifest, days: list[int], skip_batch: int, last: int | None = None
) -> DataFrame:
    """A part of the history on some days, without what one batch, and batches after ``last``, wrote."""
    kinds = f"{STORED[name]}, day BIGINT"
    columns = [c.split()[0] for c in kinds.split(", ")]
    merged = [f"{path}/{CLOSED}/{name}/{manifest.days[d][0]}/day={d}" for d in days if manifest.days.get(d, (None,))[0]]
    parts = []
    if merged:
        parts.append(spark.read.schema(kinds).option("basePath", f"{path}/{CLOSED}/{name}").parquet(*merged).select(*columns))
    live = _live(spark, path, name)
    if live is not None:
        unmerged = [(F.col("day") == d) & (F.col("batch_id") > manifest.through(d)) for d in days]
        wanted = reduce(Column.__or__, unmerged, F.lit(False)) & (F.col("batch_id") != skip_batch)
        if last is not None:
            wanted = wanted & (F.col("batch_id") <= last)
        parts.append(live.where(wanted).select(*columns))
    if not parts:
        return spark.createDataFrame([], kinds)
    return reduce(DataFrame.unionByName, parts)


def recent_history(batch: DataFrame, path: str, batch_id: int) -> dict[str, DataFrame]:
    """What earlier batches stored and windows of this batch can reach.

    Single rows are read only for the days in which some window starts or ends:
    for a batch within one day that is four days. The days between come from the
    daily totals per key. The range reaches back from the rows of the batch,
    not from now, and leaves out what an earlier attempt at the same batch wrote. Days
    are looked up among those that are stored, by the names of their folders, so that a message with a stray date
    reads nothing. The result holds arguments for ``build_features``.
    """
    spark = batch.sparkSession
    manifest = read_manifest(spark, path)
    stored = {d for d, (folder, _) in manifest.days.items() if folder} | set(live_batches(spark, path))
    if not stored:
        return {}
    day = F.floor(epoch_seconds("tx_datetime") / F.lit(DAY_SECONDS))
    back = sorted({0, *WINDOW_DAYS})
    # Only days that a stored one may lie behind come to the driver.
    reached = F.exists(F.array(*[F.lit(d) for d in sorted(stored)]), lambda d: d.between(F.col("of") - max(back), F.col("of")))
    present = [r["of"] for r in batch.select(day.alias("of")).distinct().where(reached).collect()]
    single = sorted({d - n for d in present for n in back} & stored)
    whole = sorted({d - n for d in present for n in range(max(back) + 1)} & stored - set(single))
    out = {}
    if single:
        out["history"] = _read(spark, path, ROWS, manifest, single, batch_id).select(*RAW_COLUMNS)
    if whole:
        out["customer_totals"] = _read(spark, path, CUSTOMERS, manifest, whole, batch_id)
        out["terminal_totals"] = _read(spark, path, TERMINALS, manifest, whole, batch_id)
    return out


def without_known(rows: DataFrame, history: DataFrame | None) -> DataFrame:
    """Rows that no earlier batch holds with all the same values; a redelivered message is no new row."""
    if history is None:
        return rows
    same = [rows[c].eqNullSafe(history[c]) for c in RAW_COLUMNS]
    return rows.join(history, reduce(Column.__and__, same), "left_anti")


def write_batch(df: DataFrame, path: str, batch_id: int, *within: str) -> None:
    """Replace this batch's own partitions, so that a repeated batch adds nothing.

    ``within`` names columns to partition by first; ``rebalance`` then gathers
    each of their values into few files.
    """
    if within:
        df = df.hint("rebalance", *[F.col(c) for c in within])
    (
        df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*within, "batch_id")
        .parquet(path)
    )


def store_history(rows: DataFrame, path: str, batch_id: int) -> None:
    """Keep a batch's rows and their daily totals for the batches to come."""
    day = F.floor(epoch_seconds("tx_datetime") / F.lit(DAY_SECONDS))
    customers = daily_totals(rows, "customer_id", "tx_datetime", CUSTOMER_AGGS)
    terminals = daily_totals(rows, "terminal_id", "tx_datetime", TERMINAL_AGGS)
    write_batch(customers, f"{path}/{CUSTOMERS}", batch_id, "day")
    write_batch(terminals, f"{path}/{TERMINALS}", batch_id, "day")
    # Last, because readers look for the rows first.
    write_batch(rows.select("key", *RAW_COLUMNS, day.alias("day")), f"{path}/{ROWS}", batch_id, "day")


def day_number(day: dt.date) -> int:
    return (day - dt.date(1970, 1, 1)).days


def upkeep(spark: SparkSession, path: str, today: dt.date, keep_days: int = KEEP_DAYS) -> Manifest:
    """Merge what batches wrote on each day and let days expire that are more than ``keep_days`` before ``today``.

    The newest batch is left out, as it may be run again. Only days with unmerged batches are
    written anew. Files that a manifest no longer names are deleted by the run after, so that readers
    of the one before can finish; a run that is lost anywhere leaves things as they were. One run at a time; the
    stream may go on meanwhile. Rows that arrive for an expired day find no history on it.
    """
    before = read_manifest(spark, path)
    _discard(spark, path, before)
    live = live_batches(spark, path)
    last = max((b for batches in live.values() for b in batches), default=0) - 1
    oldest = day_number(today) - keep_days
    days = {d: entry for d, entry in before.days.items() if d >= oldest or d in live}
    merge = []
    for day, batches in live.items():
        if any(before.through(day) < b <= last for b in batches):
            if day >= oldest:
                merge.append(day)
            else:
                days[day] = (None, last)
    # An expired day's folder goes with its entry; the entry stays while files of its batches do.
    days = {d: (entry if d >= oldest else (None, entry[1])) for d, entry in days.items()}
    if merge:
        folder = f"set={uuid.uuid4().hex}"
        for name, key in ((CUSTOMERS, "customer_id"), (TERMINALS, "terminal_id"), (ROWS, None)):
            part = _read(spark, path, name, before, sorted(merge), -1, last)
            if key:
                sums = [c for c in part.columns if c not in (key, "day")]
                part = part.groupBy(key, "day").agg(*[F.sum(c).alias(c) for c in sums])
            part.hint("rebalance", F.col("day")).write.partitionBy("day").parquet(f"{path}/{CLOSED}/{name}/{folder}")
        days |= {d: (folder, last) for d in merge}
    after = Manifest(before.version + 1, days)
    if after.days != before.days:
        _commit(spark, path, after)
        return after
    return before


def _commit(spark: SparkSession, path: str, manifest: Manifest) -> None:
    rows = [(manifest.version, d, folder, through) for d, (folder, through) in sorted(manifest.days.items())]
    # A version without days is a row without a day.
    table = spark.createDataFrame(rows or [(manifest.version, None, None, None)], MANIFEST_SCHEMA)
    table.coalesce(1).write.mode("append").parquet(f"{path}/{MANIFEST}")


def _discard(spark: SparkSession, path: str, manifest: Manifest) -> None:
    """Delete what the manifest, now the one of all readers, has replaced."""
    for name in (ROWS, CUSTOMERS, TERMINALS):
        for day, (_, through) in manifest.days.items():
            folder = f"{path}/{name}/day={day}"
            batches = [int(b.removeprefix("batch_id=")) for b in list_dir(spark, folder) if b.startswith("batch_id=")]
            for batch in batches:
                if batch <= through:
                    remove_path(spark, f"{folder}/batch_id={batch}")
            if batches and max(batches) <= through:
                remove_path(spark, folder)
    named = {folder for folder, _ in manifest.days.values()}
    for name in (ROWS, CUSTOMERS, TERMINALS):
        for folder in list_dir(spark, f"{path}/{CLOSED}/{name}"):
            at = f"{path}/{CLOSED}/{name}/{folder}"
            if folder not in named:
                remove_path(spark, at)
                continue
            held = {f"day={d}" for d, (f, _) in manifest.days.items() if f == folder}
            for day in list_dir(spark, at):
                if day.startswith("day=") and day not in held:
                    remove_path(spark, f"{at}/{day}")
    if manifest.version:
        old = [r["file"] for r in spark.read.schema(MANIFEST_SCHEMA).parquet(f"{path}/{MANIFEST}").where(
            F.col("version") < manifest.version).select(F.col("_metadata.file_path").alias("file")).distinct().collect()]
        for file in old:
            remove_path(spark, file)
