"""Ranked lexical search: impact vectors ordered by length, pruned by norm and by coordinate, rescored in integers."""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from txrisk.llm.common import Batches, discard, emit, keep, prepare, spans

# (item, term) pairs that are searched at once; more items are searched in several passes. Bounds what is broadcast.
BLOCK_PAIRS = 400_000
# The buckets of the longest vectors, this many at least, are searched first: all others start from their thresholds.
FIRST_ROWS = 4096
# Buckets of lengths for that choice, per doubling of the length: so fine that the last one adds few vectors.
STEPS = 256
# Rows of a task's first piece.
BUCKET_ROWS = 128
# Columns of a batch that are kept for other items.
COLUMNS = 500
# An item's heaviest terms, whose coordinates are bounded before a vector is rescored.
FOCUS = 6
# Room for rounding in bounds made of floating-point numbers.
SLACK = 1e-9
# Parts of one item's candidates that are ranked apart first.
SALTS = 64

# Terms are runs of ASCII letters and digits and of anything beyond ASCII, with A-Z lower-cased. In UTF-8
# all bytes beyond ASCII belong to such characters, so bytes can be mapped one by one.
KEPT = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") | set(range(128, 256))
TERM_BYTES = bytes(b if b in KEPT else 32 for b in range(256)).lower()


def terms_of(text: str) -> list[bytes]:
    """The terms of a whole text, in order, as UTF-8."""
    return text.encode().translate(TERM_BYTES).split()


def _item_terms(items: DataFrame) -> DataFrame:
    """Distinct ``(item_id, term)``; rows that repeat an item_id are one item."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            found = [sorted(set(terms_of(t or ""))) for t in batch.column(1).to_pylist()]
            at = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            terms = pa.array([t for f in found for t in f], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), terms], names=["item_id", "term"])

    return items.select("item_id", "text").mapInArrow(run, f"item_id {_kind(items)}, term binary").distinct()


def _kind(df: DataFrame) -> str:
    return df.schema["item_id"].dataType.simpleString()


def _blocks(pairs: DataFrame) -> list[DataFrame]:
    """Pairs by item in blocks of ``BLOCK_PAIRS`` at most, or of one larger item."""
    sizes = pairs.groupBy("item_id").count()
    n = 1
    while True:
        at = F.pmod(F.xxhash64("item_id"), F.lit(n))
        block = sizes.groupBy(at.alias("block")).agg(F.sum("count").alias("pairs"), F.count("*").alias("items"))
        if block.where((F.col("pairs") > BLOCK_PAIRS) & (F.col("items") > 1)).isEmpty():
            return [pairs.where(at == i) for i in range(n)]
        n *= 2


@dataclass
class Queries:
    """A block of items: each one's terms by number, and from the corpus each term's weight."""

    ids: list
    terms: list[np.ndarray]
    dictionary: dict[bytes, int]
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    n_docs: int = 0
    n_terms: int = 0


def _queries(pairs: DataFrame) -> Queries:
    by_id: dict = {}
    dictionary: dict[bytes, int] = {}
    for row in pairs.collect():
        by_id.setdefault(row["item_id"], []).append(dictionary.setdefault(bytes(row["term"]), len(dictionary)))
    return Queries(list(by_id), [np.array(sorted(t)) for t in by_id.values()], dictionary)


def count_terms(docs: DataFrame, dictionary: dict[bytes, int]) -> DataFrame:
    """Per document with terms: ``doc_id, n`` and its terms in the dictionary with their occurrences, map-only."""
    shared = docs.sparkSession.sparkContext.broadcast(dictionary)
    out = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))]
    )

    def run(batches: Batches) -> Batches:
        number = shared.value.get
        for batch in batches:
            ids, n, terms, counts = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = terms_of(text or "")
                if found:
                    known = sorted((i, c) for t, c in Counter(found).items() if (i := number(t)) is not None)
                    ids.append(doc_id)
                    n.append(len(found))
                    terms.append([i for i, _ in known])
                    counts.append([c for _, c in known])
            yield emit(out, ids, n, terms, counts)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, n bigint, terms array<int>, counts array<bigint>")


def weigh(queries: Queries, counted: DataFrame) -> Queries:
    """``queries`` with the corpus's number of documents and terms and the terms' weights."""
    total = counted.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
    queries.n_docs, queries.n_terms = total["docs"], total["terms"] or 0
    frequency = np.zeros(len(queries.dictionary), dtype=np.int64)
    # At most one row per term of the block.
    for row in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        frequency[row["term"]] = row["count"]
    ratio = [(2 * queries.n_docs + 2) / (2 * df + 1) for df in frequency.tolist()]
    queries.weight = np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)
    queries.threshold = np.zeros(len(queries.ids), dtype=np.int64)
    return queries


def impact_vectors(counted: DataFrame, queries: Queries) -> DataFrame:
    """``doc_id, length, terms, impacts`` of each document that has a weighty term of the block, each file's longest first.

    A coordinate is the impact times the root of the term's weight, as is an item's the root of the weight, so
    that their product is the score. Long vectors cost most of the search, so rows are dealt by a hash that
    knows no length: every file holds its share of each.
    """
    shared = counted.sparkSession.sparkContext.broadcast((queries.weight, queries.n_docs, queries.n_terms))
    fields = [("doc_id", pa.int64()), ("length", pa.float64()), ("row", pa.int64())]
    out = pa.schema([*fields, ("terms", pa.list_(pa.int32())), ("impacts", pa.list_(pa.int64()))])

    def run(batches: Batches) -> Batches:
        weight, n_docs, n_terms = shared.value
        seen = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            terms = batch.column(2).flatten().to_numpy(zero_copy_only=False)
            counts = batch.column(3).flatten().to_numpy(zero_copy_only=False)
            sizes = np.diff(batch.column(2).offsets.to_numpy())
            # Python's whole numbers, as n times the number of documents may be beyond 64 bits.
            m = np.array([10 + 90 * n * n_docs // n_terms for n in batch.column(1).to_pylist()], dtype=np.int64)
            impacts = 1_000_000_000 * counts // (1000 * counts + 8 * np.repeat(m, sizes))
            at = spans(sizes)
            length = np.sqrt(np.add.reduceat(weight[terms] * impacts.astype(float) ** 2, at[:-1]))
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(impacts, pa.int64()))
            yield emit(out, batch.column(0), length, np.arange(seen, seen + len(sizes)), batch.column(2), lists)
            seen += len(sizes)

    vectors = counted.where("size(terms) > 0").mapInArrow(
        run, "doc_id bigint, length double, row bigint, terms array<int>, impacts array<bigint>"
    )
    spread = vectors.where("length > 0").repartition(F.xxhash64("doc_id", "row"))
    return spread.sortWithinPartitions(F.col("length").desc()).drop("row")


class Searcher:
    """The best ``k`` documents of each item among the vectors seen so far."""

    def __init__(self, queries: Queries, k: int):
        self.q, self.k = queries, k
        self.root = np.sqrt(queries.weight.astype(float))
        self.norm = np.array([np.sqrt(queries.weight[t].sum()) for t in queries.terms])
        # Each item's heaviest terms, with their coordinates in its unit vector.
        self.focus = []
        for terms, norm in zip(queries.terms, self.norm, strict=True):
            heavy = terms[np.argsort(-queries.weight[terms], kind="stable")[:FOCUS]]
            self.focus.append([(t, self.root[t] / norm) for t in heavy.tolist()] if norm else [])
        self.threshold = queries.threshold.copy()
        self.best: list[list[tuple]] = [[] for _ in queries.ids]
        self.compared = 0

    def add(self, ids: list, length: np.ndarray, terms: np.ndarray, impacts: np.ndarray, sizes: np.ndarray) -> None:
        """Search a batch of vectors, in any order."""
        at = spans(sizes)
        row = np.repeat(np.arange(len(sizes)), sizes)
        contribution = self.q.weight[terms] * impacts
        coordinate = self.root[terms] * impacts / np.repeat(length, sizes)
        by_term = np.argsort(terms, kind="stable")
        ends = np.searchsorted(terms[by_term], np.arange(len(self.q.weight) + 1))
        columns: dict[int, np.ndarray] = {}

        def column(t: int) -> np.ndarray:
            """A coordinate of all unit vectors of the batch."""
            if t not in columns:
                if len(columns) >= COLUMNS:
                    columns.clear()
                columns[t] = np.zeros(len(sizes))
                chosen = by_term[ends[t] : ends[t + 1]]
                columns[t][row[chosen]] = coordinate[chosen]
            return columns[t]

        member = np.zeros(len(self.q.weight), dtype=bool)
        for i, mine in enumerate(self.q.terms):
            norm, threshold = self.norm[i], self.threshold[i]
            if not norm:
                continue  # all its terms weigh nothing
            # Cauchy and Schwarz. A task reads several files, so a batch may hold the end of one and the longest of the next.
            rows = np.flatnonzero(length * (norm * (1 + SLACK)) >= threshold)
            if threshold > 0 and len(rows):
                # The cosine a vector needs bounds its coordinates: what those looked at give, and at most the
                # product of what is left of both unit vectors, must reach it.
                need = np.minimum(threshold / (norm * length[rows]), 1.0) * (1 - SLACK)
                given, used, left = np.zeros(len(rows)), np.zeros(len(rows)), 1.0
                for t, own in self.focus[i]:
                    x = column(t)[rows]
                    given, used, left = given + own * x, used + x * x, left - own * own
                    inside = given + np.sqrt(max(left, 0.0) * np.maximum(1.0 - used, 0.0)) >= need - SLACK
                    rows, need, given, used = rows[inside], need[inside], given[inside], used[inside]
            if not len(rows):
                continue
            self.compared += len(rows)
            member[mine] = True
            scores = self._exact(rows, at, terms, contribution, member)
            member[mine] = False
            good = np.flatnonzero((scores > 0) & (scores >= threshold))
            if len(good):
                self._offer(i, [(-s, ids[r] is None, ids[r] or 0) for s, r in zip(scores[good].tolist(), rows[good].tolist())])

    @staticmethod
    def _exact(rows, at, terms, contribution, member) -> np.ndarray:
        """Whole-number scores of some rows."""
        sizes = at[rows + 1] - at[rows]
        start = spans(sizes)
        entry = np.arange(start[-1]) + np.repeat(at[rows] - start[:-1], sizes)
        return np.add.reduceat(np.where(member[terms[entry]], contribution[entry], 0), start[:-1])

    def _offer(self, i: int, found: list[tuple]) -> None:
        best = sorted(self.best[i] + found)[: self.k]
        self.best[i] = best
        if len(best) == self.k:
            self.threshold[i] = max(self.threshold[i], -best[-1][0])

    def rows(self) -> list[tuple[int, int, int | None]]:
        """``(item, score, doc_id)`` of what is best so far."""
        return [(i, -s, None if none else d) for i, best in enumerate(self.best) for s, none, d in best]


FOUND = "item int, score bigint, doc_id bigint"


def _growing(batches: Batches) -> Batches:
    """A task's batches, the first in pieces of growing size, so that thresholds rise before much is compared."""
    size = BUCKET_ROWS
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            yield batch.slice(at, size)
            at += size
            if size < batch.num_rows:  # else it would outgrow 64 bits in a task of many batches
                size *= 2


def _search(vectors: DataFrame, queries: Queries, k: int) -> DataFrame:
    """Each task's best ``k`` documents of each item that reach its threshold."""
    shared = vectors.sparkSession.sparkContext.broadcast(queries)
    out = pa.schema([("item", pa.int32()), ("score", pa.int64()), ("doc_id", pa.int64())])

    def run(batches: Batches) -> Batches:
        searcher = Searcher(shared.value, k)
        for batch in _growing(batches):
            if batch.num_rows:
                searcher.add(
                    batch.column(0).to_pylist(),
                    batch.column(1).to_numpy(),
                    batch.column(2).flatten().to_numpy(zero_copy_only=False),
                    batch.column(3).flatten().to_numpy(zero_copy_only=False),
                    batch.column(2).value_lengths().to_numpy(),
                )
        rows = searcher.rows()
        yield emit(out, *(list(zip(*rows, strict=True)) or [[], [], []]))

    return vectors.mapInArrow(run, FOUND)


def _top(found: DataFrame, k: int) -> DataFrame:
    """The best ``k`` rows of each item, first of each part of its rows and then of what is left."""
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    part = Window.partitionBy("item", "part").orderBy(*order)
    salted = found.withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    some = salted.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k).drop("rank", "part")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= k)


def search_block(docs: DataFrame, pairs: DataFrame, k: int) -> DataFrame:
    spark = docs.sparkSession
    queries = _queries(pairs)
    counted = keep(count_terms(docs, queries.dictionary), "term-counts")
    queries = weigh(queries, counted)
    vectors = keep(impact_vectors(counted, queries), "impact-vectors")
    discard(counted)
    cut = _first_length(vectors)
    first = keep(_top(_search(vectors.where(F.col("length") >= cut), queries, k), k), "first-found")
    # The k-th best score among some documents is a lower bound of that among all. At most k rows an item.
    seen: dict[int, list[int]] = {}
    for row in first.collect():
        seen.setdefault(row["item"], []).append(row["score"])
    for i, scores in seen.items():
        if len(scores) >= k:
            queries.threshold[i] = min(scores)
    rest = _search(vectors.where(F.col("length") < cut), queries, k)
    # Kept, so that the caller's plan searches nothing: there blocks would run at once, and hold up the names' broadcast.
    best = keep(_top(first.select(rest.columns).unionByName(rest), k), "found")
    discard(vectors, first)
    names = spark.createDataFrame(list(enumerate(queries.ids)), f"item int, item_id {_kind(pairs)}")
    # One row per item of the block.
    return best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


def _first_length(vectors: DataFrame) -> float:
    """The least length of the longest buckets that hold ``FIRST_ROWS`` vectors or more."""
    step = F.floor(F.log2("length") * STEPS)
    seen = 0
    # One row per bucket: their number grows with the logarithm of the lengths.
    for row in vectors.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min("length").alias("least")).orderBy(F.desc("step")).collect():
        seen += row["n"]
        if seen >= FIRST_ROWS:
            return row["least"]
    return 0.0


def rank_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` documents that score highest for each item: ``item_id, rank, doc_id, score``.

    The score is a sum over an item's distinct terms of a weight (rarer terms count more) times an impact (more
    occurrences count more, in a longer document less), in whole numbers. Documents that score nothing are not
    ranked. Equal scores are ranked by ascending doc_id, null last; every row of ``docs`` is a document of its own, also
    one that repeats another. Null and empty texts have no terms and do not count. Rows that repeat an item_id are one
    item; an item without terms, and an empty table, have no rows. Other columns, whatever their names, play no part.

    Documents are read once per block of items and once more as vectors of the block's terms, ordered by
    length. A task keeps ``k`` rows an item and prunes by what it has and by the best of the longest vectors.
    """
    spark = prepare(docs.sparkSession)
    pairs = keep(_item_terms(items), "item-terms")
    found = [search_block(docs, block, k) for block in _blocks(pairs) if not block.isEmpty()]
    if not found:
        return spark.createDataFrame([], f"item_id {_kind(pairs)}, rank int, doc_id bigint, score bigint")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out
