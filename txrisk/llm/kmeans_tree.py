"""Approximate nearest neighbours in a hierarchical k-means tree, searched best bin first."""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from txrisk.llm.common import Batches, emit, keep

BRANCHES = 8
LEAF_ROWS = 48  # of the sample
SAMPLE_ROWS = 16_000
PROBES = 400  # sample rows that the number of visits is calibrated on
ROUNDS = 8
# Rows of a leaf, and queries of a leaf, that one task compares at once.
BLOCK_ROWS = 4096
# Scores of one matrix product that are this near may be in another order when computed exactly.
SLACK = 1e-9

USABLE = (
    "vec_id is not null and embedding is not null"
    " and forall(embedding, v -> v is not null and not isnan(v) and abs(v) < double('infinity'))"
    " and exists(embedding, v -> v <> 0)"
)


@dataclass
class Tree:
    """Nodes by number, 0 the root; a node without children is a leaf."""

    centers: list[np.ndarray] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)  # number among the leaves, or -1
    leaves: int = 0

    def pack(self) -> None:
        self.matrix = np.array(self.centers)

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each unit vector: the nearest child at each level, ties to the first."""
        out = np.zeros(len(x), dtype=np.int32)
        stack = [(0, np.arange(len(x)))]
        while stack:
            node, rows = stack.pop()
            if not self.children[node]:
                out[rows] = self.leaf[node]
            elif len(rows):
                kids = self.children[node]
                best = (x[rows] @ self.matrix[kids].T).argmax(axis=1)
                stack += [(kid, rows[best == j]) for j, kid in enumerate(kids)]
        return out

    def visit(self, q: np.ndarray, visits: int) -> list[int]:
        """The first leaves that a traversal by priority reaches: the nearest centre met so far is next."""
        near = self.matrix @ q
        queue, out = [(0.0, 0)], []
        while queue and len(out) < visits:
            _, node = heapq.heappop(queue)
            while self.children[node]:
                kids = self.children[node]
                best = max(kids, key=near.__getitem__)
                for kid in kids:
                    if kid != best:
                        heapq.heappush(queue, (-near[kid], kid))
                node = best
            out.append(self.leaf[node])
        return out


def matrix_of(vectors: pa.ListArray) -> np.ndarray:
    """Vectors of one length, as rows."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def grow(sample: np.ndarray, branches: int = BRANCHES, leaf_rows: int = LEAF_ROWS, seed: int = 7) -> Tree:
    """Spherical k-means, node by node, until a node has few sample rows or only equal ones."""
    random = np.random.default_rng(seed)
    tree = Tree()

    def add(center: np.ndarray) -> int:
        tree.centers.append(center)
        tree.children.append([])
        tree.leaf.append(-1)
        return len(tree.centers) - 1

    stack = [(add(sample.mean(axis=0)), sample)]
    while stack:
        node, rows = stack.pop()
        groups: list[tuple[np.ndarray, np.ndarray]] = []
        if len(rows) > leaf_rows:
            distinct = np.unique(rows, axis=0)
            k = min(branches, len(distinct))
            if k > 1:
                centers = distinct[random.choice(len(distinct), k, replace=False)]
                for _ in range(ROUNDS):
                    own = (rows @ centers.T).argmax(axis=1)
                    sums = np.zeros_like(centers)
                    np.add.at(sums, own, rows)
                    norm = np.sqrt((sums * sums).sum(axis=1))
                    centers = np.where(norm[:, None] > 0, sums / np.maximum(norm, 1e-300)[:, None], centers)
                own = (rows @ centers.T).argmax(axis=1)
                groups = [(centers[j], rows[own == j]) for j in range(k) if (own == j).any()]
        if len(groups) > 1:
            for center, part in groups:
                tree.children[node].append(add(center))
                stack.append((tree.children[node][-1], part))
        else:
            tree.leaf[node] = tree.leaves
            tree.leaves += 1
    tree.pack()
    return tree


def calibrate(tree: Tree, sample: np.ndarray, k: int, target: float, probes: int = PROBES) -> int:
    """Leaf visits that find ``target`` of the true neighbours of sample rows, widened until they do."""
    queries = np.arange(0, len(sample), max(1, len(sample) // probes))[:probes]
    leaf = tree.assign(sample)
    scores = sample[queries] @ sample.T
    scores[np.arange(len(queries)), queries] = -np.inf
    k = min(k, len(sample) - 1)
    if k < 1:
        return tree.leaves
    truth = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    # The place of each true neighbour's leaf in the order of visits.
    place = np.empty(truth.shape)
    for i, q in enumerate(queries):
        order = np.empty(tree.leaves)
        order[tree.visit(sample[q], tree.leaves)] = np.arange(tree.leaves)
        place[i] = order[leaf[truth[i]]]
    visits = 1
    while visits < tree.leaves and (place < visits).mean() < target:
        visits += max(1, visits // 8)
    return min(visits, tree.leaves)


def top_of_block(queries: pa.Table, rows: pa.Table, k: int) -> tuple[list, list, list]:
    """The ``k`` nearest rows of a block for each query, by a matrix product and then exactly.

    Equal (id, vector) rows count once; a query's own id is left out.
    """
    ids, x = rows["vec_id"].to_numpy(), matrix_of(rows["embedding"].combine_chunks())
    order = np.lexsort((*x.T, ids))
    ids, x = ids[order], x[order]
    fresh = np.ones(len(ids), dtype=bool)
    fresh[1:] = (ids[1:] != ids[:-1]) | (x[1:] != x[:-1]).any(axis=1)
    ids, x = ids[fresh], x[fresh]
    q_ids, q = queries["query_id"].to_numpy(), matrix_of(queries["vector"].combine_chunks())
    norms, q_norms = np.sqrt((x * x).sum(axis=1)), np.sqrt((q * q).sum(axis=1))
    rough = (q @ x.T) / (q_norms[:, None] * norms)
    out: tuple[list, list, list] = ([], [], [])
    for i, own in enumerate(q_ids):
        allowed = ids != own
        n = int(allowed.sum())
        if not n:
            continue
        score = np.where(allowed, rough[i], -np.inf)
        edge = np.partition(score, len(score) - min(k, n))[len(score) - min(k, n)]
        near = np.flatnonzero((score >= edge - SLACK) & allowed)
        exact = (x[near] * q[i]).sum(axis=1) / (norms[near] * q_norms[i])
        best = np.lexsort((ids[near], -exact))[:k]
        out[0].extend([own] * len(best))
        out[1].extend(ids[near[best]])
        out[2].extend(exact[best])
    return out


def nearest(
    vectors: DataFrame,
    query_rows: str = "vec_id % 50 = 0",
    k: int = 5,
    target: float = 0.99,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of largest cosine found for each query.

    The tree is fitted on about ``sample_rows`` rows, chosen by a hash of the id; every
    row is put into a leaf. The visits per query are widened until they find ``target`` of
    the true neighbours within the sample; against all rows, which lie closer, they find
    at least as many. Scores are exact, in double precision; ties go to the smaller
    vec_id. Null ids and vectors, zero vectors and such with null or non-finite
    components take no part, nor do vectors of another length than most of the sample.
    Of repeated query ids the smallest vector asks; rows equal in id and vector count
    once. An empty table gives an empty result. A leaf of very many rows (a vector that a
    third of all rows share, say) is split into blocks, all of which its visitors see.
    """
    spark = vectors.sparkSession
    rows = vectors.selectExpr("cast(vec_id as bigint) vec_id", "cast(embedding as array<double>) embedding").where(USABLE)
    total = rows.count()
    share = min(1.0, sample_rows / max(1, total))
    drawn = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int(share * (1 << 30))).limit(2 * sample_rows)
    if not total or not (found := drawn.orderBy("vec_id").collect()):
        found = rows.orderBy("vec_id").limit(sample_rows).collect()
    result = "query_id long, rank int, vec_id long, score double"
    if not found:
        return spark.createDataFrame([], result)
    sizes = np.bincount([len(r.embedding) for r in found])
    dimension = int(sizes.argmax())
    sample = unit(np.array([r.embedding for r in found if len(r.embedding) == dimension], dtype=float))
    tree = grow(sample)
    visits = calibrate(tree, sample, k, target)
    shared = spark.sparkContext.broadcast((tree, visits))
    rows = rows.where(F.size("embedding") == dimension)

    def place(batches: Batches) -> Batches:
        schema = pa.schema([("leaf", pa.int32()), ("vec_id", pa.int64()), ("embedding", pa.list_(pa.float64()))])
        for batch in batches:
            if len(batch):
                leaves = shared.value[0].assign(unit(matrix_of(batch.column(1))))
                yield emit(schema, leaves, batch.column(0), batch.column(1))

    index = keep(rows.mapInArrow(place, "leaf int, vec_id long, embedding array<double>"), "tree-leaves")

    def route(batches: Batches) -> Batches:
        schema = pa.schema([("leaf", pa.int32()), ("query_id", pa.int64()), ("vector", pa.list_(pa.float64()))])
        worker_tree, n = shared.value
        for batch in batches:
            if len(batch):
                x = unit(matrix_of(batch.column(1)))
                seen = [worker_tree.visit(q, n) for q in x]
                take = pa.array(np.repeat(np.arange(len(x)), [len(s) for s in seen]))
                leaves = [leaf for s in seen for leaf in s]
                yield emit(schema, leaves, batch.column(0).take(take), batch.column(1).take(take))

    asking = index.where(query_rows).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    routed = asking.mapInArrow(route, "leaf int, query_id long, vector array<double>")

    # At most one row per leaf, and the sample bounds the leaves.
    blocks = index.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    askers = routed.groupBy("leaf").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("groups"))
    plan = keep(blocks.join(askers, "leaf"), "leaf-blocks")
    numbered = index.join(F.broadcast(plan), "leaf").select(
        "leaf", F.pmod(F.xxhash64("vec_id"), "blocks").cast("int").alias("block"),
        F.explode(F.expr("sequence(0, groups - 1)")).alias("askers"), "vec_id", "embedding",
    )
    asked = routed.join(F.broadcast(plan), "leaf").select(
        "leaf", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"),
        F.pmod(F.xxhash64("query_id"), "groups").cast("int").alias("askers"), "query_id", "vector",
    )

    def compare(queries: pa.Table, block: pa.Table) -> pa.Table:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        found = top_of_block(queries, block, k) if len(queries) and len(block) else ([], [], [])
        return pa.table([pa.array(c, f.type) for c, f in zip(found, schema, strict=True)], schema=schema)

    by = ["leaf", "block", "askers"]
    partial = asked.groupBy(by).cogroup(numbered.groupBy(by)).applyInArrow(compare, "query_id long, vec_id long, score double")
    ranked = partial.selectExpr(
        "query_id", "cast(row_number() over (partition by query_id order by score desc, vec_id) as int) rank", "vec_id", "score"
    )
    return ranked.where(f"rank <= {int(k)}")
