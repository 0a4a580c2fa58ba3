"""Time-range rolling aggregates that hold up under any key distribution.

``Window.partitionBy(key).orderBy(sec).rangeBetween(-d * 86400, 0)`` defines the
result, but run directly it puts a whole key into one task and re-reads the
frame for every row. Windows are whole numbers of days long, so the same numbers
are put together from parts of days:

1. Pre-aggregate to one row per (key, second). Rows of the same second are
   peers in a RANGE frame, so they share one result.
2. Shuffle these once, by key and block of days. A row that windows of the next block
   reach back to goes there as well. A group then holds at most the seconds of a block and of
   the longest window before it, however many rows a key has.
3. A window is the tail of the day it starts in, the whole days between and the
   head of the day it ends in. Whole days are summed over a frame of days, once per day. Heads and
   tails are running sums within (key, day), read at the second of the row: each second is copied
   into the days whose windows start or end in its own, and only if the key has rows there.
   This takes place within the task that holds the block.
4. Join the per-second results back to the rows on (key, second). AQE can split
   a skewed partition of that join, down to a single hot second.

Sums are only ever added to, never subtracted from one another, so large and small,
infinite and NaN values come out as in a plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.functions.calendar import DAY_SECONDS

KEY, SEC, DAY, OFF, OWN, SHIFT, AT = "__key", "__sec", "__day", "__off", "__own", "__shift", "__at"
BLOCK, TOTAL = "__block", "__total"
# Days of a key that are handled together, at least; longer windows need longer blocks.
BLOCK_DAYS = 64


def _second(ts: str) -> str:
    return f"cast(cast(`{ts}` as timestamp) as bigint)"


def _measures(aggs: dict[str, tuple[str, str]]) -> dict[str, str]:
    """What one row adds to each total needed for ``aggs``, by internal name."""
    out: dict[str, str] = {}
    for func, column in aggs.values():
        if func not in ("count", "sum", "avg"):
            raise ValueError(f"unknown rolling function {func!r}")
        if column == "*":
            out["n_"] = "1L"
            continue
        out[f"n_{column}"] = f"cast(`{column}` is not null as bigint)"
        if func != "count":
            out[f"s_{column}"] = f"`{column}`"
    return out


def _named(expressions: dict[str, str]) -> list[str]:
    return [f"{text} as `{name}`" for name, text in expressions.items()]


def _sums(names) -> list[Column]:
    return [F.expr(f"sum(`{n}`) as `{n}`") for n in names]


def daily_totals(df: DataFrame, key: str, ts: str, aggs: dict[str, tuple[str, str]]) -> DataFrame:
    """Totals per key and UTC day, from which ``rolling_stats`` can take whole days."""
    measures = _measures(aggs)
    day = f"floor({_second(ts)} / {DAY_SECONDS}) as day"
    return df.selectExpr(f"`{key}`", day, *_named(measures)).groupBy(key, "day").agg(*_sums(measures))


def rolling_stats(
    source: DataFrame,
    key: str,
    ts: str,
    days: Sequence[int],
    aggs: dict[str, tuple[str, str]],
    history: DataFrame | None = None,
    delay_days: int = 0,
    totals: DataFrame | None = None,
) -> DataFrame:
    """One row per (key, second) of ``source`` with its rolling aggregates.

    The result has the columns ``__key``, ``__sec`` and one per (window, output).
    ``totals`` (of ``daily_totals``) stand in for earlier rows on days that no
    window starts or ends in. See ``rolling_range`` for the other arguments.
    """
    measures = _measures(aggs)

    def slim_rows(df: DataFrame, own: int) -> DataFrame:
        return df.selectExpr(
            f"`{key}` as {KEY}", f"{_second(ts)} as {SEC}", *_named(measures), f"{own} as {OWN}"
        )

    rows = slim_rows(source, 1)
    with_past = history is not None or totals is not None
    if with_past:
        # Only the keys at hand; AQE broadcasts their list if it is small.
        keys = source.select(key).distinct()
    if history is not None:
        rows = rows.unionByName(slim_rows(history.join(keys, key, "left_semi"), 0))
    own = [F.max(OWN).alias(OWN)] if with_past else []
    slim = (
        rows.groupBy(KEY, SEC)
        .agg(*_sums(measures), *own)
        .selectExpr("*", f"floor({SEC} / {DAY_SECONDS}) as {DAY}", f"pmod({SEC}, {DAY_SECONDS}) as {OFF}")
    )
    asked = f"{OWN} = 1" if with_past else "true"
    # Days back from a row's own day: to the one its windows end in, to those they start in.
    ends = [delay_days, *(delay_days + d for d in days)]
    if totals is not None:
        # Whole days, in no second of theirs.
        earlier = totals.join(keys, key, "left_semi").selectExpr(
            f"`{key}` as {KEY}", f"cast(day as bigint) as {DAY}", *[f"`{n}`" for n in measures], f"0 as {OWN}"
        )
        slim = slim.withColumn(TOTAL, F.lit(False)).unionByName(earlier.withColumn(TOTAL, F.lit(True)), allowMissingColumns=True)

    # Every row goes to the block of its own day and to the next one, if windows of that reach back to it.
    length = max(BLOCK_DAYS, 2 * max(ends))
    block = f"floor({DAY} / {length})"
    further = f"floor(({DAY} + {max(ends)}) / {length}) > {block}"
    blocked = slim.selectExpr(
        "*", f"explode(case when {further} then array({block}, {block} + 1) else array({block}) end) as {BLOCK}"
    )
    # The one shuffle for all that follows; windows by day alone would ask for one more.
    blocked = blocked.repartition(KEY, BLOCK)
    own_block = f"{BLOCK} <=> {block}"
    group = f"partition by {KEY}, {BLOCK}"

    def running(value: str, day: str, order: str) -> str:
        return (
            f"sum({value}) over ({group}, {day} order by {OFF} {order} "
            "range between unbounded preceding and current row)"
        )

    if not delay_days:
        # Before the copies are made, in the order that the whole days need as well.
        live = "`{n}`" if totals is None else f"case when not {TOTAL} then `{{n}}` end"
        blocked = blocked.selectExpr("*", *_named({f"now_{n}": running(live.format(n=n), DAY, "asc") for n in measures}))
    whole = {} if delay_days else {f"now_{n}": f"`now_{n}`" for n in measures}
    between = {}
    for d in days:
        for n in measures:
            frame = f"range between {delay_days + d - 1} preceding and {delay_days + 1} preceding"
            if d > 1:
                between[f"days{d}_{n}"] = f"sum(`{n}`) over ({group} order by {DAY} {frame})"
    whole |= between
    # A copy is needed on days only that the key has rows of its own on.
    wanted = {
        back: f"max({own_block} and {asked}) over ({group} order by {DAY} range between {back} following and {back} following)"
        for back in sorted({back for back in ends if back})
    }
    seen = blocked.selectExpr("*", *_named(between), *_named({f"__to{back}": text for back, text in wanted.items()}))
    if totals is not None:
        seen = seen.where(f"not {TOTAL}")

    # The second itself, with the sums so far, and its copies in the days whose windows end or start at it.
    kept = f"named_struct({', '.join(f"'{n}', `{n}`" for n in whole) or "'none', 0"})"
    itself = f"struct(0 as back, {asked} as real, {kept} as whole)"
    copies = [
        f"case when `__to{back}` then struct({back} as back, false as real, cast(null as struct<{{whole}}>) as whole) end"
        for back in wanted
    ]
    kinds = seen.selectExpr(f"{kept} as whole").schema["whole"].dataType.simpleString().removeprefix("struct<").removesuffix(">")
    places = [f"case when {own_block} then {itself} end", *[text.replace("{whole}", kinds) for text in copies]]
    spread = seen.selectExpr("*", f"inline(array_compact(array({', '.join(places)})))").selectExpr(
        KEY, BLOCK, f"{DAY} + back as {AT}", OFF, f"back as {SHIFT}", "real", "whole", *[f"`{n}`" for n in measures]
    )

    def of(name: str, back: int) -> str:
        return f"case when {SHIFT} = {back} then `{name}` end"

    heads = {f"now_{n}": running(of(n, delay_days), AT, "asc") for n in measures if delay_days}
    tails = {f"old{d}_{n}": running(of(n, delay_days + d), AT, "desc") for d in days for n in measures}
    points = spread.selectExpr("*", *_named(heads)).selectExpr("*", *_named(tails)).where("real")
    joined = points.select("*", "whole.*")

    def total(name: str, d: int) -> str:
        zero = "0D" if name in doubles else "0L"
        terms = [f"now_{name}", f"old{d}_{name}", *([f"days{d}_{name}"] if d > 1 else [])]
        return "(" + " + ".join(f"coalesce(`{t}`, {zero})" for t in terms) + ")"

    doubles = {
        n
        for n in measures
        if n.startswith("s_") and source.schema[n[2:]].dataType.typeName() in ("double", "float")
    }
    out: dict[str, str] = {}
    for d in days:
        for template, (func, column) in aggs.items():
            n = total("n_" if column == "*" else f"n_{column}", d)
            out[template.format(d=d)] = {
                "count": lambda: n,
                "sum": lambda: f"case when {n} > 0 then {total(f's_{column}', d)} end",
                "avg": lambda: f"case when {n} > 0 then cast({total(f's_{column}', d)} as double) / {n} end",
            }[func]()
    return joined.selectExpr(KEY, f"{AT} * {DAY_SECONDS} + {OFF} as {SEC}", *_named(out))


def attach_stats(df: DataFrame, key: str, ts: str, stats: DataFrame) -> DataFrame:
    """Add the columns of ``rolling_stats`` to the rows of ``df``."""
    # The match is null-safe on the key: null keys form a group, as in a window. It
    # also keeps Spark from pushing a null filter below the shared input, which
    # would stop the exchange under it from being reused.
    match = F.expr(f"`{key}` <=> {KEY} and {AT} = {SEC}")
    rows = df.selectExpr("*", f"{_second(ts)} as {AT}")
    return rows.join(stats, match, "left").drop(AT, KEY, SEC)


def rolling_range(
    df: DataFrame,
    key: str,
    ts: str,
    days: Sequence[int],
    aggs: dict[str, tuple[str, str]],
    history: DataFrame | None = None,
    delay_days: int = 0,
) -> DataFrame:
    """Add rolling aggregates over ``[t - d days, t]`` per ``key`` to each row.

    ``aggs`` maps an output name with a ``{d}`` placeholder to
    ``(function, column)``, function being count, sum or avg and column a
    numeric column or ``"*"`` (rows, for count). Both frame ends are inclusive
    at whole-second resolution. Rows of ``history`` count in the windows but are
    not returned. A positive ``delay_days`` moves the windows back to
    ``[t - delay - d days, t - delay]``. A row without a time gets nulls.
    """
    return attach_stats(df, key, ts, rolling_stats(df, key, ts, days, aggs, history, delay_days))
