"""Comparison of score distributions: two models, or one model over time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from txrisk.functions.scores import score_of
from txrisk.functions.stats import kolmogorov_p, required_n, two_sided_p
from txrisk.operators.running import running_totals
from txrisk.schema import AUC_CV

ALPHA = 0.05
STATS = ("n", "mean", "sd")


def score_stats(df: DataFrame, by: str | list[str] | None = None, score: str = "score") -> DataFrame:
    """Count, mean and sample stddev of a score in one pass."""
    groups = [by] if isinstance(by, str) else (by or [])
    return df.groupBy(*groups).agg(
        F.count(score).alias("n"), F.avg(score).alias("mean"), F.stddev_samp(score).alias("sd")
    )


def _t_columns(a: Callable[[str], Column], b: Callable[[str], Column], variant: str) -> dict[str, Column]:
    """t and its degrees of freedom from the two arms' n, mean and sd."""
    va, vb = a("sd") * a("sd") / a("n"), b("sd") * b("sd") / b("n")
    difference, error = a("mean") - b("mean"), F.sqrt(va + vb)
    if variant == "damped":
        # The small constant keeps t finite when both arms are constant.
        return {
            "t": difference / (error + F.lit(1e-5)),
            "df": (a("n") + b("n") - 2).cast("double"),
        }
    if variant == "welch":
        spread = va * va / (a("n") - 1) + vb * vb / (b("n") - 1)
        return {
            "t": F.when(error > 0, difference / error),
            "df": F.when(spread > 0, (va + vb) * (va + vb) / spread),
        }
    raise ValueError(f"unknown variant {variant!r}")


def _with_p(df: DataFrame, alpha: float) -> DataFrame:
    p = df.withColumn("p", two_sided_p(F.col("t"), F.col("df")))
    return p.withColumns(
        {
            "direction": F.signum("t").cast("int"),
            "different": F.coalesce(F.col("p") < alpha, F.lit(False)),
        }
    )


def two_arm_t(stats: DataFrame, arm: str, a: str, b: str, variant: str = "damped") -> DataFrame:
    """One row with both arms' statistics and t out of ``score_stats(df, arm)``."""

    def pick(which: str, name: str) -> Column:
        return F.max(F.when(F.col(arm) == which, F.col(name)))

    wide = stats.agg(
        *[pick(a, s).alias(f"{s}_a") for s in STATS], *[pick(b, s).alias(f"{s}_b") for s in STATS]
    )
    return wide.withColumns(
        _t_columns(lambda s: F.col(f"{s}_a"), lambda s: F.col(f"{s}_b"), variant)
    )


def ttest(
    df: DataFrame,
    arm: str,
    a: str,
    b: str,
    score: str = "score",
    variant: str = "damped",
    alpha: float = ALPHA,
) -> DataFrame:
    """Two-sample t-test of ``score`` between the rows of arm ``a`` and of arm ``b``."""
    rows = df.where(F.col(arm).isin(a, b))
    return _with_p(two_arm_t(score_stats(rows, arm, score), arm, a, b, variant), alpha)


def paired_t(df: DataFrame, a: str, b: str, alpha: float = ALPHA) -> DataFrame:
    """t-test of two scores of the same rows: is the mean of their differences zero?

    Rows with a null on either side do not count. Without spread of the differences t is null.
    """
    difference = F.col(a).cast("double") - F.col(b).cast("double")
    stats = df.select(difference.alias("d")).agg(
        F.count("d").alias("n"), F.avg("d").alias("mean"), F.stddev_samp("d").alias("sd")
    )
    t = F.when(F.col("sd") > 0, F.col("mean") / (F.col("sd") / F.sqrt("n")))
    return _with_p(stats.withColumns({"t": t, "df": (F.col("n") - 1).cast("double")}), alpha)


def drift_t(
    reference: DataFrame, live: DataFrame, by: str, score: str = "score", variant: str = "damped"
) -> DataFrame:
    """Per group of ``live``: its statistics, those of ``reference`` and t."""
    one = score_stats(reference, score=score).select(F.struct(*STATS).alias("ref"))
    daily = score_stats(live, by, score).withColumn("ref", one.scalar())
    wide = daily.select(
        by,
        *[F.col(f"ref.{s}").alias(f"{s}_ref") for s in STATS],
        *[F.col(s).alias(f"{s}_live") for s in STATS],
    )
    return wide.withColumns(
        _t_columns(lambda s: F.col(f"{s}_ref"), lambda s: F.col(f"{s}_live"), variant)
    )


def score_drift(
    reference: DataFrame,
    live: DataFrame,
    by: str = "forecast_date",
    score: str = "score",
    variant: str = "damped",
    alpha: float = ALPHA,
) -> DataFrame:
    """Per group of live scores: does their distribution call for a refit?"""
    return _with_p(drift_t(reference, live, by, score, variant), alpha).withColumn(
        "refit", F.col("different")
    )


def ks_drift(
    reference: DataFrame, live: DataFrame, by: str = "forecast_date", score: str = "score", alpha: float = ALPHA
) -> DataFrame:
    """Per group of live scores: the greatest distance of their distribution from that of ``reference``.

    ``n_ref, n_live, distance`` and ``p`` by the Kolmogorov distribution; ``refit`` where p is under ``alpha``.
    Null scores do not count; a null group is one. Both sides are counted per distinct score
    on the map side; the running counts never put a group into one task.
    """
    value = F.col(score).cast("double").alias("score")
    ref = reference.select(value).dropna().groupBy("score").agg(F.count("*").alias("n_ref"))
    mine = live.select(by, value).where("score is not null").groupBy(by, "score").agg(F.count("*").alias("n_live"))
    # The reference's running count at every score of either side.
    points = ref.unionByName(mine.select("score", F.lit(0).cast("bigint").alias("n_ref"))).groupBy("score")
    points = running_totals(points.agg(F.sum("n_ref").alias("n_ref")), "score", ["n_ref"])
    points = points.select(F.col("score").alias("at"), "n_ref", "cum_n_ref")
    running = running_totals(mine, "score", ["n_live"], [by]).join(points, F.col("score") == F.col("at"))
    ends = mine.groupBy(F.col(by).alias("__by")).agg(F.sum("n_live").alias("__live"))
    running = running.join(ends, F.col(by).eqNullSafe(F.col("__by")))
    running = running.withColumn("__ref", ref.agg(F.sum("n_ref")).scalar())
    # Between two live scores their share stands still and the reference's only grows, so that
    # the distance is greatest at a live score or just before one.
    after = F.abs(F.col("cum_n_ref") / F.col("__ref") - F.col("cum_n_live") / F.col("__live"))
    before = F.abs(
        (F.col("cum_n_ref") - F.col("n_ref")) / F.col("__ref") - (F.col("cum_n_live") - F.col("n_live")) / F.col("__live")
    )
    found = running.groupBy(by).agg(
        F.max("__ref").alias("n_ref"), F.max("__live").alias("n_live"), F.max(F.greatest(after, before)).alias("distance")
    )
    effective = F.col("n_ref") * F.col("n_live") / (F.col("n_ref") + F.col("n_live"))
    p = found.withColumn("p", kolmogorov_p(F.sqrt(effective) * F.col("distance")))
    return p.withColumn("refit", F.coalesce(F.col("p") < alpha, F.lit(False)))


def top_models(runs: DataFrame, metric: str = AUC_CV, k: int = 2, ascending: bool = False) -> DataFrame:
    """The ``k`` finished runs with the best metric; ties go to the smaller run id."""
    value = F.col("metrics").getItem(metric)
    ranked = runs.where(F.col("status") == "FINISHED").withColumn("metric", value)
    order = F.asc_nulls_last("metric") if ascending else F.desc_nulls_last("metric")
    return ranked.orderBy(order, "run_id").limit(k)


def compare_models(
    test: DataFrame,
    runs: DataFrame,
    load: Callable[[str], object],
    metric: str = AUC_CV,
    models: tuple[str, str] | None = None,
    which: str = "positive",
    variant: str = "damped",
    alpha: float = ALPHA,
    ascending: bool = False,
    require_better: bool = True,
) -> DataFrame:
    """Compare two trained models on the same rows and name the winner.

    The two best finished runs, or the two in ``models``, are "new" and
    "current". The result is one row; ``status`` is one of not_enough_models, missing_metric,
    equal_metrics, not_enough_samples and compared. With ``require_better`` the
    new model must also have the better metric; without it a significant
    difference alone makes it win. ``load`` maps an artifact path to a model.
    """
    spark = test.sparkSession
    if models is None:
        picked = top_models(runs, metric, 2, ascending).collect()
    else:
        known = top_models(runs.where(F.col("run_id").isin(*models)), metric).collect()
        picked = sorted(known, key=lambda r: models.index(r["run_id"]))
    new, current = (picked + [None, None])[:2]

    base = spark.range(1)
    p1, p2 = (F.lit(r["metric"] if r else None).cast("double") for r in (current, new))
    needed = base.select(required_n(p1, p2).alias("n")).first()["n"]
    if current is None:
        status, tested = "not_enough_models", None
    elif new["metric"] is None or current["metric"] is None:
        status, tested = "missing_metric", None
    elif needed is None:
        status, tested = "equal_metrics", None
    elif test.limit(needed + 1).count() <= needed:
        status, tested = "not_enough_samples", None
    else:
        status = "compared"
        arms = [
            scored.select(F.lit(name).alias("arm"), score_of(scored, which).alias("score"))
            for name, scored in (
                ("new", load(new["artifact_path"]).transform(test)),
                ("current", load(current["artifact_path"]).transform(test)),
            )
        ]
        rows = arms[0].unionByName(arms[1])
        tested = ttest(rows, "arm", "new", "current", variant=variant, alpha=alpha)

    def known_of(row: Row | None, name: str, kind: str) -> Column:
        return F.lit(row[name] if row else None).cast(kind)

    if tested is None:
        tested = base.select(
            *[F.lit(None).cast("double").alias(c) for c in ("mean_a", "mean_b", "t", "df", "p")],
            F.lit(None).cast("bigint").alias("n_a"),
            F.lit(None).cast("int").alias("direction"),
            F.lit(False).alias("different"),
        )
        best = F.lit(None).cast("string")
    else:
        better = F.lit(not require_better or new["metric"] > current["metric"])
        best = F.when(F.col("different") & better, new["run_id"]).otherwise(current["run_id"])
    return tested.select(
        F.lit(status).alias("status"),
        known_of(new, "run_id", "string").alias("new_run_id"),
        known_of(current, "run_id", "string").alias("current_run_id"),
        known_of(new, "metric", "double").alias("new_metric"),
        known_of(current, "metric", "double").alias("current_metric"),
        F.lit(needed).cast("bigint").alias("required_n"),
        F.col("n_a").alias("n"),
        F.col("mean_a").alias("new_mean"),
        F.col("mean_b").alias("current_mean"),
        "t",
        "df",
        "p",
        "direction",
        "different",
        best.alias("best_run_id"),
    )
