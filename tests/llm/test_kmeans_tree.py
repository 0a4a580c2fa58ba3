import numpy as np
import pytest

from txrisk.llm.common import prepare
from txrisk.llm.kmeans_tree import calibrate, grow, nearest, unit

SCHEMA = "vec_id long, embedding array<float>, leaf string, score string, block string"


def brute(rows, k):
    """Nearest by definition; repeated equal rows once, own id out."""
    good = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    queries = {}
    for i, v in good:
        if i % 50 == 0:
            queries.setdefault(i, v)
    out = {}
    for q, v in queries.items():
        a = np.array(v, dtype=float)
        found = []
        for i, w in good:
            if i != q:
                b = np.array(w, dtype=float)
                found.append((-((a * b).sum() / (np.sqrt((a * a).sum()) * np.sqrt((b * b).sum()))), i))
        out[q] = [(i, -s) for s, i in sorted(found)[:k]]
    return out


def frame(spark, rows):
    return prepare(spark).createDataFrame([(i, v, "a", "b", "c") for i, v in rows], SCHEMA)


def got(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    assert all([x[0] for x in v] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [(i, s) for _, i, s in v] for q, v in out.items()}


def recall(found, truth):
    hits = sum(len({i for i, _ in found.get(q, [])} & {i for i, _ in v}) for q, v in truth.items())
    return hits / sum(map(len, truth.values()))


def test_recall_on_the_table(spark):
    vectors = prepare(spark).read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    truth = brute([(r.vec_id, r.embedding) for r in vectors.collect()], 5)
    found = got(nearest(vectors))
    assert recall(found, truth) >= 0.9
    scores = {(q, i): s for q, v in truth.items() for i, s in v}
    assert all(abs(scores[q, i] - s) < 1e-12 for q, v in found.items() for i, s in v if (q, i) in scores)


def test_recall_beyond_the_sample(spark):
    r = np.random.default_rng(4)
    centers = r.normal(size=(30, 16))
    x = (centers[r.integers(0, 30, 6000)] + 0.4 * r.normal(size=(6000, 16))).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    vectors = frame(spark, rows)
    found = got(nearest(vectors, sample_rows=1000))
    assert recall(found, brute(rows, 5)) >= 0.9


def test_odd_vectors_take_no_part(spark):
    rows = [(i, [float(i % 7 - 3), 1.0, float(i % 5)]) for i in range(101)]
    rows += [(150, None), (200, []), (250, [0.0, 0.0, 0.0]), (300, [1.0, None, 2.0]), (350, [1.0, float("nan"), 2.0])]
    rows += [(400, [1.0, float("inf"), 2.0]), (None, [1.0, 1.0, 1.0]), (50, [-2.0, 1.0, 0.0]), (7, [-3.0, 1.0, 2.0]), (450, [1.0, 2.0])]
    truth = brute([r for r in rows if r[0] != 450], 5)
    found = got(nearest(frame(spark, rows)))
    assert found.keys() == truth.keys() == {0, 50, 100}
    for q, v in truth.items():
        assert [i for i, _ in found[q]] == [i for i, _ in v]
        assert np.allclose([s for _, s in found[q]], [s for _, s in v], atol=1e-15)


def test_a_vector_that_many_rows_share(spark, monkeypatch):
    from txrisk.llm import kmeans_tree

    monkeypatch.setattr(kmeans_tree, "BLOCK_ROWS", 50)
    r = np.random.default_rng(5)
    rows = [(i, [0.1, 0.2, 0.3, 0.4] if i % 3 else r.normal(size=4).tolist()) for i in range(600)]
    rows = [(i, np.array(v, dtype=np.float32).tolist()) for i, v in rows]
    truth = brute(rows, 5)
    found = got(nearest(frame(spark, rows), target=1.0))
    for q in truth:
        if q % 3:  # ties go to the smallest ids
            assert [i for i, _ in found[q]] == [i for i, _ in truth[q]]
    assert recall(found, truth) >= 0.9


@pytest.mark.parametrize("rows", [[], [(0, [1.0, 2.0])], [(0, [1.0, 2.0]), (1, [2.0, 1.0])], [(0, None)], [(1, [1.0])]])
def test_small_tables(spark, rows):
    truth = {q: v for q, v in brute(rows, 5).items() if v}
    assert {q: [i for i, _ in v] for q, v in got(nearest(frame(spark, rows))).items()} == {
        q: [i for i, _ in v] for q, v in truth.items()
    }


def test_visits_widen_until_the_target():
    r = np.random.default_rng(6)
    sample = unit(r.normal(size=(2000, 8)))
    tree = grow(sample)
    few, many = calibrate(tree, sample, 5, 0.5), calibrate(tree, sample, 5, 0.99)
    assert 1 <= few < many <= tree.leaves
    for q in sample[:20]:
        assert sorted(tree.visit(q, tree.leaves)) == list(range(tree.leaves))
        assert tree.visit(q, 1) == [tree.assign(q[None])[0]]
