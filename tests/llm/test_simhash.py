import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from txrisk.llm.common import components, prepare
from txrisk.llm.simhash import fingerprint, near_links, simhash_components


def by_definition(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return bits - (1 << 64) if bits >> 63 else bits


def brute_components(fps, bits):
    """The smallest fingerprint reachable from each."""
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in fps:
        for b in fps:
            if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= bits:
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {f: find(f) for f in fps}


def clustered(n, seed):
    r = random.Random(seed)
    centers = [r.getrandbits(64) for _ in range(6)]
    out = set()
    while len(out) < n:
        x = r.choice(centers)
        for _ in range(r.randrange(6)):
            x ^= 1 << r.randrange(64)
        out.add(x - (1 << 64) if x >> 63 else x)
    return sorted(out)


@pytest.mark.parametrize("text", ["", " \t", "One", "one two", "A b C d", "É é Ü x y", "x\x1cy z w", "a " * 500])
def test_fingerprint_by_definition(text):
    assert fingerprint(text, 3) == by_definition(text)


@pytest.mark.parametrize("crowd", [0, 1000])
@pytest.mark.parametrize(("bits", "segments"), [(0, 4), (1, 8), (2, 16), (3, 8)])
def test_links_against_brute_force(spark, crowd, bits, segments):
    prepare(spark)
    fps = clustered(150, bits)
    links = near_links(spark.createDataFrame([(f,) for f in fps], "fp long"), bits, segments, crowd)
    for a, b in links.collect():
        assert bin((a ^ b) & (2**64 - 1)).count("1") <= bits
    found = {r.node: r.root for r in components(links, "test").collect()}
    assert {f: found.get(f, f) for f in fps} == brute_components(fps, bits)


def test_components_of_chains_stars_and_rings(spark):
    prepare(spark)
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 230)] + [(i, 300 + (i + 1) % 20) for i in range(300, 320)]
    edges += [(5, 5), (200, 7), (r.randrange(400, 450), r.randrange(400, 450))]
    found = {x.node: x.root for x in components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
    assert all(found[i] == 100 for i in range(100, 141))
    assert all(found[i] == 7 for i in (7, *range(200, 230)))
    assert all(found[i] == 300 for i in range(300, 320))
    assert 5 not in found


def test_components_of_nothing(spark):
    prepare(spark)
    assert components(spark.createDataFrame([], "a long, b long"), "test").count() == 0


def test_documents_against_brute_force(spark, sf_docs):
    prepare(spark)
    rows = simhash_components(sf_docs).collect()
    texts = {r.doc_id: r.text for r in sf_docs.collect()}
    fps = {i: by_definition(t) for i, t in texts.items()}
    assert {r.doc_id: r.fp for r in rows} == fps
    root = brute_components(sorted(set(fps.values())), 2)
    smallest = {}
    for i, f in fps.items():
        smallest[root[f]] = min(smallest.get(root[f], i), i)
    assert {r.doc_id: r.component_id for r in rows} == {i: smallest[root[f]] for i, f in fps.items()}


def test_odd_documents(spark, odd_docs, no_docs):
    prepare(spark)
    rows = simhash_components(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    found = {r.doc_id: r.component_id for r in rows}
    assert found[1] == found[7] == 1  # equal texts
    assert found[2] == found[3] == found[4] == 2  # nothing to hash
    assert found[None] is None
    assert simhash_components(no_docs).count() == 0
    alone = odd_docs.where(F.col("doc_id").isNull())
    assert [r.component_id for r in simhash_components(alone).collect()] == [None]


def test_many_segments_keep_chains_equal():
    with pytest.raises(ValueError):
        from txrisk.llm.simhash import ring_keys

        ring_keys(None, 2, 3)
    assert np.bitwise_count(np.uint64(7)) == 3
