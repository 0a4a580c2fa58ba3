import zlib
from collections import Counter, defaultdict

import pytest

from txrisk.llm.common import prepare
from txrisk.llm.shards import balanced_shards, propagate, quotas, ranked

SCHEMA = "doc_id long, text string, shard string, slot string, g string, n string, place string, size string"


def check(rows, source, shards):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in source
    )
    counts = Counter(r.shard for r in rows)
    sizes = [counts.get(s, 0) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(source)
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def cut(rows):
    """Rows that are not with most of their text's rows."""
    by = defaultdict(Counter)
    for r in rows:
        by[r.text_crc32, r.size][r.shard] += 1
    return sum(sum(c.values()) - max(c.values()) for c in by.values())


def frame(spark, source):
    return prepare(spark).createDataFrame([(i, t, "a", "b", "c", "d", "e", "f") for i, t in source], SCHEMA)


def test_groups_stay_together_where_they_fit(spark):
    source = [(i, f"single {i}") for i in range(300)] + [(1000 + i, f"group {i // 6}") for i in range(120)]
    rows = balanced_shards(frame(spark, source), 8).collect()
    check(rows, source, 8)
    assert cut(rows) == 0


def test_a_group_of_a_third_of_all_rows(spark):
    source = [(i, "everywhere" if i % 3 == 0 else f"text {i}") for i in range(600)]
    rows = balanced_shards(frame(spark, source), 16).collect()
    check(rows, source, 16)
    hot = Counter(r.shard for r in rows if r.size == len("everywhere") + 1 and r.text_crc32 == zlib.crc32(b"everywhere"))
    assert len(hot) <= 9  # 200 rows over shards of 37 or 38


def test_no_room_at_all(spark):
    source = [(i, f"pair {i // 2}") for i in range(64)]
    check(balanced_shards(frame(spark, source), 4).collect(), source, 4)


@pytest.mark.parametrize("n", [0, 5])
def test_small_tables(spark, n):
    source = [(i, f"t{i % 2}") for i in range(n)]
    check(balanced_shards(frame(spark, source), 16).collect(), source, 16)


def test_odd_documents(spark, odd_docs):
    source = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check(balanced_shards(odd_docs, 4).collect(), source, 4)


def test_quotas_never_pass_the_capacity():
    loads, wants = [8, 3, 10, 0], {(0, 1): 5, (1, 0): 3, (2, 1): 4, (0, 2): 2, (3, 2): 0, (2, 3): 1}
    granted = quotas(wants, loads, 10)
    after = loads[:]
    for (s, t), n in granted.items():
        assert 0 <= n <= wants[s, t]
        after[s] -= n
        after[t] += n
    assert max(after) <= 10
    assert granted[0, 1] >= 3 and granted[1, 0] >= 3


def test_propagation_moves_towards_neighbours(spark):
    placed = prepare(spark).createDataFrame([("a", 0, 5), ("a", 1, 2), ("b", 1, 4), ("b", 0, 1)], "g string, shard int, n long")
    rows = {(r.g, r.shard): r.n for r in propagate(placed, 8, 2, 5).collect()}
    assert rows == {("a", 0): 7, ("b", 1): 5}
    rows = {(r.g, r.shard): r.n for r in propagate(placed, 6, 2, 5).collect()}
    assert sum(n for (g, s), n in rows.items() if s == 0) <= 6 and sum(rows.values()) == 12


def test_main_path_is_native(spark, sf_docs):
    plan = balanced_shards(sf_docs)._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_a_hot_group_is_cut_into_buckets(spark):
    """Also where a join has dealt the rows out by their group."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = spark.range(500).selectExpr("id as doc_id", "id % 9 as size", "id as text_crc32", "if(id % 3 = 0, 0, id) as g")
        joined = rows.join(rows.groupBy("g").count(), "g")
        found = ranked(joined, ["g"], "place")
        plan = found._jdf.queryExecution().executedPlan().toString()
        places = sorted(r.place for r in found.where("g = 0").collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    exchanges = [line for line in plan.splitlines() if "REPARTITION_BY_COL" in line]
    assert any("hashpartitioning(g#" in line and "_bucket#" in line for line in exchanges)
    assert places == list(range(len(places)))
