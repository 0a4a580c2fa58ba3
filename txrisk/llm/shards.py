"""Balanced shards by label propagation with quotas, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from txrisk.llm.common import keep

SHARDS = 16
ROUNDS = 5
# Ranks are counted within hash buckets and before them. With 16 shards that is a table of
# 16 * BUCKETS sums, whatever the input, and a bucket holds that small a part of a shard.
BUCKETS = 1024


def ranked(rows: DataFrame, group: list[str], name: str, buckets: int = BUCKETS) -> DataFrame:
    """``rows`` (with ``doc_id`` and ``size``) with a rank ``name`` from 0 without gaps in each group.

    Rows are ordered by hash bucket of the id and by id within it. No task holds more of a
    group than one bucket.
    """
    bucketed = rows.withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "size"), F.lit(buckets)))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        bucketed.groupBy(*group, "_bucket")
        .agg(F.count("*").alias("_n"))
        .select(*group, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    )
    within = Window.partitionBy(*group, "_bucket").orderBy("doc_id", "size", "text_crc32", "g")
    # Rows that a join has dealt out by a group alone would do for the window, with a whole group in one task.
    dealt = bucketed.repartition(*group, "_bucket")
    return (
        dealt.withColumn("_within", F.row_number().over(within) - 1)
        .join(starts, [*group, "_bucket"])
        .withColumn(name, F.col("_start") + F.col("_within"))
        .drop("_bucket", "_within", "_start")
    )


def prefix_sums(rows: DataFrame, group: list[str], order: str, amount: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``amount`` over the rows before it in its group, counted like ``ranked``."""
    bucketed = rows.withColumn("_bucket", F.pmod(F.xxhash64(order), F.lit(BUCKETS)))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        bucketed.groupBy(*group, "_bucket")
        .agg(F.sum(amount).alias("_sum"))
        .select(*group, "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(*group, "_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        bucketed.repartition(*group, "_bucket").withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
        .join(starts, [*group, "_bucket"])
        .withColumn(name, F.col("_start") + F.col("_inside"))
        .drop("_bucket", "_inside", "_start")
    )


def quotas(wants: dict[tuple[int, int], int], loads: list[int], capacity: int) -> dict[tuple[int, int], int]:
    """How many rows may move from shard to shard, so that no load passes the capacity.

    Of two opposite wishes both move as many rows as the smaller wish, which changes no
    load. What is left of the wishes shares the room of the wanted shard in proportion.
    """
    out = {(s, t): min(n, wants.get((t, s), 0)) for (s, t), n in wants.items()}
    rest = {p: n - out[p] for p, n in wants.items()}
    for t in range(len(loads)):
        room = max(0, capacity - loads[t])
        asked = sum(n for (_, to), n in rest.items() if to == t)
        given = min(room, asked)
        parts = {s: n * given // asked for (s, to), n in sorted(rest.items()) if to == t and asked}
        over = given - sum(parts.values())  # by rounding, less than one each
        for s, n in parts.items():
            more = min(1, over, rest[s, t] - n)
            out[s, t] += n + more
            over -= more
    return out


def propagate(placed: DataFrame, capacity: int, shards: int, rounds: int) -> DataFrame:
    """Moves linked rows towards the shard of most of their group; ``placed`` is ``(g, shard, n)``.

    Each round, the rows of a group want to be where most of the group is, shards with room
    before full ones; a group too large for one shard has as many homes as it needs. Wishes are
    granted in an order by hash until the quota of their pair of shards is used up; the wish at
    the border is granted in part. Ends when nothing moves.
    """
    for _ in range(rounds):
        # At most one row per shard, or pair of shards, come to the driver.
        loads = [0] * shards
        for row in placed.groupBy("shard").agg(F.sum("n").alias("n")).collect():
            loads[row.shard] = row.n
        full = [s for s in range(shards) if loads[s] >= capacity]
        # At most one part per shard; ties by hash, so that wishes spread.
        part = F.struct(
            F.col("shard").isin(full).alias("full"), (-F.col("n")).alias("less"),
            F.xxhash64("g", "shard").alias("tie"), "shard", "n",
        )
        parts = placed.groupBy("g").agg(F.sort_array(F.collect_list(part)).alias("parts"), F.sum("n").alias("total"))
        homes = F.least(F.size("parts"), F.ceil(F.col("total") / max(1, capacity)).cast("int"))
        wishes = parts.select("g", "parts", homes.alias("homes"), F.posexplode("parts").alias("place", "own"))
        wishes = wishes.where("place >= homes").selectExpr(
            "g", "own.shard shard", "parts[(place - homes) % homes].shard target", "own.n n"
        )
        wishes = keep(wishes, "wishes")
        wants = {
            (r.shard, r.target): r.n for r in wishes.groupBy("shard", "target").agg(F.sum("n").alias("n")).collect()
        }
        granted = {p: n for p, n in quotas(wants, loads, capacity).items() if n}
        if not granted:
            break
        values = ", ".join(f"({s}, {t}, {n}L)" for (s, t), n in granted.items())
        allowed = placed.sparkSession.sql(f"select * from values {values} as t(shard, target, quota)")
        ordered = prefix_sums(wishes.join(F.broadcast(allowed), ["shard", "target"]), ["shard", "target"], "g", "n", "before")
        moves = ordered.withColumn("moved", F.least("n", F.col("quota") - F.col("before"))).where("moved > 0")
        moves = keep(moves.select("g", "shard", "target", "moved"), "moves")
        changed = (
            placed.select("g", "shard", "n")
            .union(moves.select("g", "shard", (-F.col("moved")).alias("n")))
            .union(moves.select("g", F.col("target").alias("shard"), F.col("moved").alias("n")))
        )
        placed = keep(changed.groupBy("g", "shard").agg(F.sum("n").alias("n")).where("n > 0"), "placed")
    return placed


def balanced_shards(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` for every row; row counts differ by at most one.

    Documents of equal text (a null text counts as empty) are linked. Linked rows start on shards
    dealt out evenly, and move by label propagation under quotas: a shard never
    holds more linked rows than ``rows // shards``. Unlinked rows then fill every shard to its
    size. ``slot`` counts the rows of a shard from 0. Null and repeated ids are rows like
    others. Only sums per shard reach the driver.
    """
    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "coalesce(text, '') t").selectExpr(
        "doc_id", "octet_length(t) + 1L size", "crc32(cast(t as binary)) text_crc32", "sha2(t, 256) g"
    )
    rows = keep(rows, "shard-rows")
    total = rows.count()
    small = total // shards
    sizes = [small + (s < total % shards) for s in range(shards)]
    groups = rows.groupBy("g").agg(F.count("*").alias("members")).where("members > 1")
    groups = keep(groups, "text-groups")
    columns = ["doc_id", "size", "text_crc32", "g"]
    linked = rows.join(groups, "g").select(columns)
    alone = rows.join(groups, "g", "left_anti").select(columns)

    # A group's rows start on consecutive shards from one chosen by its hash: an even deal.
    deal = groups.select(
        "g", "members", F.pmod(F.xxhash64("g"), F.lit(shards)).cast("int").alias("first"),
        F.explode(F.expr(f"sequence(0, cast(least(members, {shards}) as int) - 1)")).alias("i"),
    )
    placed = deal.select(
        "g", F.pmod(F.col("first") + F.col("i"), F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"(members - i + {shards - 1}) div {shards}").alias("n"),
    )
    placed = propagate(keep(placed, "placed"), small, shards, rounds)

    # What the first deal put into a shard beyond its size goes where there is room, as unlinked rows do.
    size_of = F.element_at(F.array(*[F.lit(n) for n in sizes]), F.col("shard") + 1)
    fits = F.greatest(F.lit(0), F.least("n", size_of - F.col("before")))
    cut = prefix_sums(placed, ["shard"], "g", "n", "before").select("g", "shard", "n", fits.alias("fit"))
    placed = cut.select("g", "shard", F.col("fit").alias("n")).union(
        cut.groupBy("g").agg(F.sum(F.col("n") - F.col("fit")).alias("n")).select("g", F.lit(-1).alias("shard"), "n")
    )
    placed = keep(placed.where("n > 0"), "placed")
    loads = {r.shard: r.n for r in placed.groupBy("shard").agg(F.sum("n").alias("n")).collect()}

    # Which rows of a group go where does not matter: by rank, in the order of the shards.
    upto = Window.partitionBy("g").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    intervals = placed.withColumn("high", F.sum("n").over(upto)).selectExpr("g", "shard", "high - n low", "high")
    inside = ranked(linked, ["g"], "place").join(intervals, "g").where("place >= low and place < high")
    inside = keep(inside.select("doc_id", "size", "text_crc32", "g", "shard"), "linked-shards")

    free = inside.where("shard < 0").drop("shard").union(alone)
    edges = [sum(sizes[t] - loads.get(t, 0) for t in range(s + 1)) for s in range(shards)]
    filled = F.expr(f"size(filter(array({', '.join(f'{e}L' for e in edges)}), e -> e <= place))")
    outside = ranked(free, [], "place", buckets=shards * BUCKETS).withColumn("shard", filled).drop("place")
    everything = inside.where("shard >= 0").unionByName(outside)
    return ranked(everything, ["shard"], "slot").select("doc_id", "size", "text_crc32", "shard", "slot")
