import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from txrisk.operators.compare import compare_models, score_drift, top_models, ttest
from txrisk.operators.evaluate import acceptance, class_metrics, confusion_matrix, roc_auc
from txrisk.operators.profile import profile_duplicates, profile_missing, profile_numeric
from txrisk.schema import AUC_CV, RUNS


@pytest.fixture(scope="module")
def predictions(spark):
    # (prediction, label) and how often
    cells = [((0, 0), 1), ((0, 1), 2), ((1, 0), 3), ((1, 1), 1)]
    rows = [(float(p), y) for (p, y), n in cells for _ in range(n)]
    return spark.createDataFrame(rows, "prediction DOUBLE, tx_fraud INT")


def test_confusion_matrix(predictions):
    got = {(r["label"], r["prediction"]): r["n"] for r in confusion_matrix(predictions).collect()}
    assert got == {(0, 0): 1, (0, 1): 3, (1, 0): 2, (1, 1): 1}


def test_class_metrics(predictions):
    got = {r["positive_label"]: r for r in class_metrics(predictions).collect()}
    assert got[0]["precision"] == pytest.approx(1 / 3) and got[0]["recall"] == pytest.approx(1 / 4)
    assert got[1]["precision"] == pytest.approx(1 / 4) and got[1]["recall"] == pytest.approx(1 / 3)
    assert got[1]["fpr"] == pytest.approx(3 / 4) and got[1]["f1"] == pytest.approx(2 / 7)
    assert class_metrics(predictions, 0).count() == 1


def test_metrics_without_a_class(spark):
    df = spark.createDataFrame([(0.0, 0)], "prediction DOUBLE, tx_fraud INT")
    row = class_metrics(df, 1).first()
    assert row["precision"] is None and row["recall"] is None and row["tn"] == 1
    assert acceptance(class_metrics(df, 1)).first()["accepted"] is False


def test_acceptance(predictions):
    row = acceptance(class_metrics(predictions, 1), 0.3, 0.8).first()
    assert row["recall_ok"] and row["fpr_ok"] and row["accepted"]
    assert not acceptance(class_metrics(predictions, 1)).first()["accepted"]


def test_auc_with_ties(spark):
    rng = random.Random(1)
    rows = [(float(rng.randrange(12)), rng.randrange(2)) for _ in range(300)]
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "score DOUBLE, tx_fraud INT")
    assert roc_auc(df, "score") == pytest.approx(want, abs=1e-12)


def arms(spark, a, b):
    rows = [("a", float(x)) for x in a] + [("b", float(x)) for x in b]
    return spark.createDataFrame(rows, "arm STRING, score DOUBLE")


def test_ttest_variants(spark):
    a, b = [1, 2, 3, 4, 5, 6], [2, 4, 6, 8, 10, 13, 11]
    va, vb = statistics.variance(a) / len(a), statistics.variance(b) / len(b)
    difference = statistics.mean(a) - statistics.mean(b)
    row = ttest(arms(spark, a, b), "arm", "a", "b").first()
    assert row["t"] == pytest.approx(difference / (math.sqrt(va + vb) + 1e-5)) and row["df"] == 11
    assert row["direction"] == -1 and row["different"] and row["p"] < 0.05
    welch = ttest(arms(spark, a, b), "arm", "a", "b", variant="welch").first()
    assert welch["t"] == pytest.approx(difference / math.sqrt(va + vb))
    assert welch["df"] == pytest.approx((va + vb) ** 2 / (va**2 / 5 + vb**2 / 6))


def test_ttest_of_constant_and_single_rows(spark):
    row = ttest(arms(spark, [1, 1], [1, 1]), "arm", "a", "b").first()
    assert row["t"] == 0 and not row["different"]
    row = ttest(arms(spark, [1], [2, 3]), "arm", "a", "b").first()
    assert row["t"] is None and row["different"] is False


def test_drift_flags_only_the_shifted_day(spark):
    rng = random.Random(2)
    base = [(rng.gauss(0.5, 0.1),) for _ in range(400)]
    live = [("d1", rng.gauss(0.5, 0.1)) for _ in range(200)] + [("d2", rng.gauss(0.7, 0.1)) for _ in range(200)]
    got = score_drift(
        spark.createDataFrame(base, "score DOUBLE"),
        spark.createDataFrame(live, "forecast_date STRING, score DOUBLE"),
    )
    assert {r["forecast_date"]: r["refit"] for r in got.collect()} == {"d1": False, "d2": True}


def runs(spark, *items):
    rows = [(i, "e", s, None, {} if m is None else {AUC_CV: m}, {}, i) for i, s, m in items]
    return spark.createDataFrame(rows, RUNS)


def test_top_models(spark):
    df = runs(spark, ("a", "FINISHED", 0.8), ("b", "FAILED", 0.99), ("c", "FINISHED", 0.8), ("d", "FINISHED", None), ("e", "FINISHED", 0.7))
    assert [r["run_id"] for r in top_models(df).collect()] == ["a", "c"]
    assert [r["run_id"] for r in top_models(df, ascending=True).collect()] == ["e", "a"]
    assert [r["run_id"] for r in top_models(df, k=9).collect()][-1] == "d"


class Shift:
    """Stands in for a model: a fixed offset on a stored score."""

    def __init__(self, by):
        self.by = by

    def transform(self, df):
        p = F.col("s") + F.lit(self.by)
        return df.withColumns({"prediction": F.lit(0.0), "probability": F.array(1 - p, p)})


def test_compare_models(spark):
    rng = random.Random(4)
    test = spark.createDataFrame([(rng.gauss(0.4, 0.1),) for _ in range(500)], "s DOUBLE")
    load = {"a": Shift(0.2), "b": Shift(0.0), "c": Shift(0.0)}.__getitem__
    one = compare_models(test, runs(spark, ("a", "FINISHED", 0.9)), load).first()
    assert one["status"] == "not_enough_models" and one["best_run_id"] is None
    missing = compare_models(test, runs(spark, ("a", "FINISHED", 0.9), ("b", "FINISHED", None)), load).first()
    assert missing["status"] == "missing_metric"
    equal = compare_models(test, runs(spark, ("a", "FINISHED", 0.9), ("b", "FINISHED", 0.9)), load).first()
    assert equal["status"] == "equal_metrics"
    close = compare_models(test, runs(spark, ("a", "FINISHED", 0.9), ("b", "FINISHED", 0.899)), load).first()
    assert close["status"] == "not_enough_samples" and close["required_n"] > 500
    pair = runs(spark, ("a", "FINISHED", 0.9), ("b", "FINISHED", 0.7), ("c", "FINISHED", 0.6))
    better = compare_models(test, pair, load).first()
    assert better["status"] == "compared" and better["best_run_id"] == "a" and better["direction"] == 1
    alike = compare_models(test, pair, load, models=("b", "c")).first()
    assert alike["new_run_id"] == "b" and alike["best_run_id"] == "c" and not alike["different"]
    # A different but worse model wins only if asked for.
    swapped = compare_models(test, pair, load, models=("b", "a")).first()
    assert swapped["different"] and swapped["best_run_id"] == "a"
    either = compare_models(test, pair, load, models=("b", "a"), require_better=False).first()
    assert either["best_run_id"] == "b"


def test_profiles(spark):
    rows = [("f", 1, 2.0), ("f", 1, 2.0), ("f", 2, float("nan")), ("g", None, 4.0), ("g", 1, 2.0)]
    df = spark.createDataFrame(rows, "source_file STRING, tranaction_id INT, tx_amount DOUBLE")
    dup = {r["source_file"]: (r["n_rows"], r["n_distinct"], r["n_duplicates"]) for r in profile_duplicates(df, "source_file").collect()}
    assert dup == {"f": (3, 2, 1), "g": (2, 2, 0)}
    assert profile_duplicates(df.drop("source_file")).first()["n_duplicates"] == 2
    gaps = {r["column"]: (r["n_null"], r["n_nan"]) for r in profile_missing(df).collect()}
    assert gaps == {"source_file": (0, 0), "tranaction_id": (1, 0), "tx_amount": (0, 1)}
    got = {r["column"]: r for r in profile_numeric(df, ["tranaction_id"]).collect()}["tranaction_id"]
    assert (got["count"], got["mean"], got["min"], got["max"]) == (4, 1.25, 1.0, 2.0)
    assert got["stddev"] == pytest.approx(0.5)
    single = profile_numeric(df.where("tranaction_id = 2"), ["tranaction_id"]).first()
    assert single["stddev"] is None


def test_paired_differences(spark):
    from txrisk.operators.compare import paired_t

    df = spark.createDataFrame([(1.0, 0.5), (2.0, 2.5), (3.0, 1.0), (4.0, 3.0), (None, 1.0), (5.0, None)], "a DOUBLE, b DOUBLE")
    r = paired_t(df, "a", "b").first()
    assert (r["n"], r["mean"], r["df"]) == (4, 0.75, 3.0)
    assert r["t"] == pytest.approx(0.75 / (((0.25**2 + 1.25**2 + 1.25**2 + 0.25**2) / 3) ** 0.5 / 2))
    assert r["p"] == pytest.approx(0.2452, abs=1e-4) and not r["different"]
    assert paired_t(df, "a", "a").first()["t"] is None


def test_ks_drift_by_brute_force(spark):
    from bisect import bisect_left, bisect_right
    from random import Random

    from txrisk.operators.compare import ks_drift

    r = Random(4)
    ref = [round(r.gauss(0, 1), 1) for _ in range(300)]
    live = {"a": [round(r.gauss(0, 1), 1) for _ in range(80)], "b": [round(r.gauss(0.8, 1), 1) for _ in range(60)], None: [5.0]}
    reference = spark.createDataFrame([(x,) for x in [*ref, None]], "score DOUBLE")
    days = spark.createDataFrame([(d, x) for d, xs in live.items() for x in [*xs, None]], "forecast_date STRING, score DOUBLE")
    found = {x["forecast_date"]: x for x in ks_drift(reference, days).collect()}
    for d, xs in live.items():
        a, b = sorted(ref), sorted(xs)
        want = max(abs(f(a, x) / len(a) - f(b, x) / len(b)) for x in a + b for f in (bisect_left, bisect_right))
        assert found[d]["distance"] == pytest.approx(want, abs=1e-12)
        assert (found[d]["n_ref"], found[d]["n_live"]) == (300, len(xs))
    assert not found["a"]["refit"] and found["b"]["refit"]


def test_kolmogorov_series(spark):
    import math

    from txrisk.functions.stats import kolmogorov_p

    for x in (0.0, 0.05, 0.3, 0.828, 0.999, 1.0, 1.36, 2.5, 9.0):
        got = spark.range(1).select(kolmogorov_p(F.lit(x)).alias("p")).first()["p"]
        want = 1.0 if x < 0.1 else 2 * math.fsum((-1) ** (k - 1) * math.exp(-2 * k * k * x * x) for k in range(1, 400))
        assert got == pytest.approx(want, abs=1e-9)
