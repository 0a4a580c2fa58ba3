import math
import os
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from txrisk.llm import lexical_search, queries
from txrisk.llm.common import prepare
from txrisk.llm.lexical_search import rank_documents, terms_of

SF = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, k):
    """By definition; ``docs`` and ``items`` are (id, text) rows."""
    counted = [(d, Counter(plain_terms(t))) for d, t in docs]
    counted = [(d, c) for d, c in counted if c]
    n, total = len(counted), sum(sum(c.values()) for _, c in counted)
    frequency = Counter(t for _, c in counted for t in c)
    wanted = {}
    for item, text in items:
        wanted.setdefault(item, set()).update(plain_terms(text))
    out = []
    for item, terms in wanted.items():
        scores = []
        for d, c in counted:
            m = 10 + 90 * sum(c.values()) * n // total
            s = 0
            for t in terms & set(c):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * frequency[t] + 1)))
                s += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if s > 0:
                scores.append((-s, d is None, d or 0))
        for rank, (s, none, d) in enumerate(sorted(scores)[:k], 1):
            out.append((item, rank, None if none else d, -s))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x or 0) for x in r))


def check(spark, docs, items, k=10):
    prepare(spark)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    found = order(map(tuple, rank_documents(d, i, k).collect()))
    assert found == order(brute_force(docs, items, k))
    return found


def test_terms():
    for text in ["A-b_c É9 x\x7fy\x80z", "ÀB日本C {~} a b", "", "...", "İI", "a\x00b"]:
        assert [t.decode() for t in terms_of(text)] == plain_terms(text)


def some_docs(seed, n, words=60):
    r = random.Random(seed)
    names = [f"w{i}" for i in range(400)]
    return [(i, " ".join(names[int(400 * r.random() ** 2)] for _ in range(r.randrange(0, words)))) for i in range(n)]


def test_random_documents(spark):
    docs = some_docs(1, 700)
    assert check(spark, docs, some_docs(2, 30, 25))


def test_pruning_beyond_the_first_buckets(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "FIRST_ROWS", 20)
    monkeypatch.setattr(lexical_search, "BUCKET_ROWS", 4)
    check(spark, some_docs(3, 900), some_docs(4, 40, 12), 3)


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_PAIRS", 150)
    check(spark, some_docs(5, 120), [*some_docs(6, 20, 15), (99, " ".join(f"w{i}" for i in range(60)))])


def test_ties_copies_nulls_and_repeated_ids(spark):
    text = "alpha beta gamma"
    docs = [(i, text) for i in range(300, 0, -1)] + [(None, text), (7, text), (7, text), (900, "alpha"), (901, None), (902, ""), (903, "...")]
    docs += [(904, "zeta " * 20_000 + "beta"), (None, None)]
    items = [(1, "beta delta"), (1, "alpha"), (2, None), (3, "---"), (None, "gamma"), (4, "nowhere"), (5, "zeta ALPHA alpha")]
    found = check(spark, docs, items)
    assert [r[2] for r in sorted(r for r in found if r[0] == 1)][:4] == [1, 2, 3, 4]


def test_extra_columns_and_empty_tables(spark):
    prepare(spark)
    docs = spark.createDataFrame([(1, "a b", "x", 2, "t", 3.0)], "doc_id int, text string, terms string, n int, score string, length double")
    items = spark.createDataFrame([("i", "a", 1, 2)], "item_id string, text string, rank int, doc_id int")
    assert [tuple(r)[:3] for r in rank_documents(docs, items).collect()] in ([("i", 1, 1)], [])
    assert rank_documents(docs.limit(0), items).count() == 0
    empty = rank_documents(docs, items.limit(0))
    assert empty.count() == 0 and empty.columns == ["item_id", "rank", "doc_id", "score"]


def test_bounds_leave_out_most_vectors(spark):
    """The searcher compares few of many vectors once its thresholds stand."""
    r = np.random.default_rng(1)
    q = lexical_search.Queries([0], [np.arange(5)], {}, np.full(50, 1000))
    q.threshold = np.zeros(1, np.int64)
    searcher = lexical_search.Searcher(q, 3)
    terms = [np.sort(r.choice(50, 6, replace=False)) for _ in range(2000)]
    terms[0] = np.arange(6)
    terms[1] = terms[2] = terms[0]
    impacts = [r.integers(50_000, 100_000, 6) for _ in range(2000)]
    length = np.array([np.sqrt((1000 * i.astype(float) ** 2).sum()) for i in impacts])
    by_length = sorted(range(3, 2000), key=lambda i: -length[i])
    for rows in ([0, 1, 2], by_length):
        searcher.add(list(rows), length[rows], np.concatenate([terms[i] for i in rows]),
                     np.concatenate([impacts[i] for i in rows]), np.full(len(rows), 6))
    assert searcher.compared < 300
    scores = sorted(((-int((1000 * impacts[i])[terms[i] < 5].sum()), i) for i in range(2000)))[:3]
    assert [(-s, d) for _, s, d in searcher.rows()] == scores


def test_query_against_brute_force(spark, sf_docs):
    found = queries.op13_lexical_search(spark, SF)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()
    docs = sf_docs.select("doc_id", "text").collect()
    assert order(map(tuple, found.collect())) == order(brute_force(map(tuple, docs), map(tuple, items), 10))


@pytest.mark.parametrize("n", [3 * 10**9])
def test_lengths_beyond_64_bits(n):
    assert 10 + 90 * n * n // 7 > 2**63  # why a document's m is worked out in Python's whole numbers


def test_batches_that_hold_the_ends_of_several_files():
    """A task reads files one after another, each with its longest vectors first; short ones before long ones hide none."""
    r = np.random.default_rng(2)
    n = 1500
    impacts = r.integers(50_000, 100_000, n)
    impacts[:900] //= 50
    length = np.sqrt(1000 * impacts.astype(float) ** 2)
    q = lexical_search.Queries([0], [np.arange(1)], {}, np.full(1, 1000))
    q.threshold = np.array([1000 * 90_000])
    searcher = lexical_search.Searcher(q, 3)
    searcher.add(list(range(n)), length, np.zeros(n, np.int64), impacts, np.ones(n, np.int64))
    best = sorted((-1000 * int(i), d) for d, i in enumerate(impacts))[:3]
    assert [(-s, d) for _, s, d in searcher.rows()] == best


def test_a_block_is_searched_when_it_returns(spark, monkeypatch):
    """What it wrote on the way is gone; a plan that reads the result searches nothing, however many blocks there are."""
    prepare(spark)
    kept, files = lexical_search.keep, {}

    def noted(df, name):
        out = kept(df, name)
        files[name] = [f.removeprefix("file://") for f in out.inputFiles()]
        return out

    monkeypatch.setattr(lexical_search, "keep", noted)
    docs = spark.createDataFrame(some_docs(7, 60), "doc_id long, text string")
    items = spark.createDataFrame(some_docs(8, 5, 12), "item_id long, text string")
    found = rank_documents(docs, items, 3)
    assert "MapInArrow" not in found._jdf.queryExecution().toString()
    left = {name: [f for f in names if os.path.exists(f)] for name, names in files.items()}
    assert files["impact-vectors"] and not left["impact-vectors"] and not left["term-counts"] and not left["first-found"]
    assert left["found"] == files["found"] and found.count() == found.count() > 0


def test_a_task_of_many_batches():
    """Pieces grow to whole batches, and no further however many batches come."""
    batches = [pa.RecordBatch.from_pydict({"n": list(range(i, i + 300))}) for i in range(0, 60_000, 300)]
    pieces = list(lexical_search._growing(iter(batches)))
    assert pa.Table.from_batches(pieces)["n"].to_pylist() == list(range(60_000))
    assert [p.num_rows for p in pieces[:4]] == [128, 172, 300, 300] and pieces[-1].num_rows == 300
