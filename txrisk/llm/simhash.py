"""SimHash near-duplicates: pigeonring candidates, full Hamming check, components."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from txrisk.llm.common import Batches, components, emit, keep, texts_of

BITS = 64
# Shingles turned into bits at once.
SLICE = 1 << 14
HASH_SEED = 42


def fingerprint(text: str, shingle: int) -> int:
    """Signed 64-bit SimHash of a text's word shingles; 0 for a text without words.

    A bit is set if it is set in more than half of the shingles' XXH64 values.
    """
    from xxhash import xxh64_digest

    # On bytes, lower() and split() touch exactly A-Z and the six ASCII spaces.
    words = text.encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    digests = b"".join([xxh64_digest(g, HASH_SEED) for g in grams])
    n = len(digests) // 8
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, n, SLICE):
        part = np.frombuffer(digests, np.uint8, 8 * min(SLICE, n - start), 8 * start)
        ones += np.unpackbits(part).reshape(-1, BITS).sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, fp`` for every row; null texts count as empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            yield emit(schema, batch.column(0), [fingerprint(t, shingle) for t in texts_of(batch.column(1))])

    rows = docs.selectExpr("cast(doc_id as bigint) doc_id", "text")
    return rows.mapInArrow(run, "doc_id long, fp long")


def ring_keys(fps: DataFrame, segments: int, max_bits: int) -> DataFrame:
    """``fp, start, key``: the segments of the ring that a chain from ``start`` needs equal.

    If two fingerprints differ in at most ``max_bits`` of the bits that ``segments``
    segments share out, then from some segment on every chain of ``k`` segments differs
    in at most ``k * max_bits / segments`` bits. As long as that is below one, the
    chain's segments are equal, which is what can be joined on.
    """
    width = BITS // segments
    equal = segments if max_bits == 0 else -(-segments // max_bits) - 1
    if equal < 1:
        raise ValueError("more segments than bits may differ are needed")
    starts = F.explode(F.array(*[F.lit(i) for i in range(segments)])).alias("start")
    # The ring turned so that segment `start` comes first.
    turned = f"shiftleft(fp, start * {width}) | shiftrightunsigned(fp, 64 - start * {width})"
    rows = fps.select("fp", starts).withColumn("ring", F.expr(f"case when start = 0 then fp else {turned} end"))
    chain = F.expr(f"shiftrightunsigned(ring, {BITS - equal * width})")
    return rows.withColumn("key", F.xxhash64("start", chain))


def chain_condition(segments: int, max_bits: int) -> str:
    """Every chain within its budget; a budget's longest chain speaks for its shorter ones."""
    width = BITS // segments
    parts = []
    for budget in range(max_bits + 1):
        longest = max((k for k in range(1, segments + 1) if k * max_bits // segments == budget), default=0)
        if longest:
            cut = BITS - longest * width
            parts.append(f"bit_count(shiftrightunsigned(x.ring ^ y.ring, {cut})) <= {budget}")
    return " and ".join(parts)


def masks(radius: int) -> list[int]:
    """All 64-bit patterns of at most ``radius`` ones, as signed numbers."""
    out = []
    for n in range(radius + 1):
        for places in combinations(range(BITS), n):
            value = sum(1 << p for p in places)
            out.append(value - (1 << 64) if value >> 63 else value)
    return out


def crowded_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links that connect what lies within ``max_bits``, at a cost in proportion to the rows.

    Two fingerprints are that near just if a pattern lies within half the distance of
    both; those who share a pattern are linked to the smallest of them instead of to
    one another.
    """
    near, far = max_bits // 2, -(-max_bits // 2)
    if far > 2:
        raise ValueError("at most 4 bits")
    close = set(masks(near))
    struct = [F.struct(F.lit(m).cast("long").alias("mask"), F.lit(m in close).alias("near")) for m in masks(far)]
    patterns = F.explode(F.array(*struct)).alias("p")
    rows = fps.select("fp", patterns).select("fp", F.col("fp").bitwiseXOR(F.col("p.mask")).alias("pattern"), "p.near")
    low = rows.where("near").groupBy("pattern").agg(F.min("fp").alias("low"))
    return rows.join(low, "pattern").where("fp <> low").select(F.col("low").alias("a"), F.col("fp").alias("b"))


def near_links(fps: DataFrame, max_bits: int, segments: int = 16, crowd: int = 64) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints ``fp``; their components are those of all links.

    Pigeonring: rows of a key whose chain is equal are compared, first along the chain and then
    in full. Keys that more than ``crowd`` fingerprints share are not compared pair by
    pair but linked through shared patterns, which misses no link among them.
    """
    keys = ring_keys(fps, segments, max_bits)
    sizes = keys.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    shared = keep(keys.join(sizes, "key").select("key", "fp", "ring", "n"), "ring-keys")
    few = shared.where(F.col("n") <= crowd)
    pairs = (
        few.alias("x")
        .join(few.alias("y"), F.expr(f"x.key = y.key and x.fp < y.fp and {chain_condition(segments, max_bits)}"))
        .select(F.col("x.fp").alias("a"), F.col("y.fp").alias("b"))
    )
    many = shared.where(F.col("n") > crowd).select("fp").distinct()
    return pairs.union(crowded_links(many, max_bits)) if max_bits else pairs


def simhash_components(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """``doc_id, fp, component_id`` for every row of ``docs``.

    Documents are linked if their fingerprints differ in at most ``max_bits`` bits;
    ``component_id`` is the smallest doc_id that links lead to. Null and empty texts share
    fingerprint 0. A null id is nobody's component: a component of null ids alone has a null
    component_id. Repeated ids and rows stay as they are. Copies are one fingerprint
    before anything is compared.
    """
    found = keep(fingerprints(docs, shingle), "fingerprints")
    nodes = keep(found.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(near_links(nodes.select("fp"), max_bits), "simhash-edges")
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    names = rooted.join(smallest, "root").select(F.col("fp").alias("named"), "component_id")
    return found.join(names, F.col("fp") == F.col("named")).select("doc_id", "fp", "component_id")
