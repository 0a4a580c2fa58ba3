"""Every operator run over the driver's tables, by query name.

Results that another engine must reproduce have their floating-point columns
rounded with ``r6`` and their times written as text.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions.calendar import date_stamp, epoch_seconds, time_features
from txrisk.functions.scores import probability_text, probability_vector, score_of
from txrisk.functions.stats import required_n
from txrisk.operators import clean as c
from txrisk.operators import compare, curve, evaluate, features, learn, profile, tuning
from txrisk.plans import incremental, jobs
from txrisk.plans.adapters import (
    dirty_raw,
    lineitem_transactions,
    raw_transactions,
    table,
    transactions,
)
from txrisk.schema import AUC_CV, RAW_COLUMNS, REQUIRED_COLUMNS, WINDOW_DAYS
from txrisk.session import configure, work_dir
from txrisk.sources import messages, raw, runs, tables
from txrisk.streaming import close, keyed, replay, scoring

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register a query under its function's name, less a trailing ``_query``."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    REGISTRY[function.__name__.removesuffix("_query")] = run
    return function


def r6(column: Column | str) -> Column:
    """Round to six places; the nudge keeps exact ties from going either way."""
    return F.round((F.col(column) if isinstance(column, str) else column) + F.lit(1e-9), 6)


def text_time(column: str = "tx_datetime") -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def shown(df: DataFrame) -> DataFrame:
    """Times as text and averages rounded."""
    return df.select(
        *[
            text_time(n)
            if n == "tx_datetime" and df.schema[n].dataType.typeName() != "string"
            else r6(n).alias(n)
            if n.startswith("avg_")
            else F.col(n)
            for n in df.columns
        ]
    )


# --- sources and sinks -----------------------------------------------------


def _write_raw_text(spark: SparkSession, sf_dir: str) -> str:
    """The dirty rows as comma-separated ``.txt`` files with a comment header."""
    path = work_dir(spark, "raw")
    fields = [F.coalesce(F.col(n), F.lit("")) for n in RAW_COLUMNS]
    lines = raw_transactions(spark, sf_dir).select(F.concat_ws(",", *fields).alias("value"))
    header = spark.range(1).select(F.lit("# " + " | ".join(RAW_COLUMNS)).alias("value"))
    header.unionByName(lines).write.text(path)
    return path


@query
def read_raw_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.read_raw(spark, _write_raw_text(spark, sf_dir), "*.txt")


@query
def raw_file_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of all files, and whether each file's keys number its lines without a gap."""
    sent = messages.file_messages(spark, _write_raw_text(spark, sf_dir))
    decoded = c.coerce_types(messages.decode_messages(sent)).withColumns(
        {
            "line": F.regexp_extract("key", "^tx_([0-9]+)@", 1).cast("bigint"),
            "file": F.regexp_extract("key", "@(.+)$", 1),
        }
    )
    files = decoded.groupBy("file").agg(F.min("line").alias("a"), F.max("line").alias("b"), F.count("*").alias("n"),
                                        F.sum("line").alias("s"))
    # A file may begin with the header line.
    whole = (F.col("a") <= 2) & (F.col("n") == F.col("b") - F.col("a") + 1) & (2 * F.col("s") == F.col("n") * (F.col("a") + F.col("b")))
    checked = decoded.join(files.select("file", whole.alias("numbered")), "file")
    unique = checked.groupBy("key").count().where("count > 1").select(F.count("*").alias("n")).scalar() == 0
    return checked.select(
        *[n for n in RAW_COLUMNS if n != "tx_datetime"], text_time(), (F.col("numbered") & unique).alias("numbered")
    )


@query
def replay_file_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files sent as a stream, a few per micro-batch, and how each message compares with the batch job's."""
    path, sent, check = _write_raw_text(spark, sf_dir), work_dir(spark, "sent"), work_dir(spark, "checkpoint")
    replay.replay_files(spark, path, check, sent, files_per_batch=3).awaitTermination()
    streamed = spark.read.schema("key STRING, value STRING").parquet(sent)
    batch = messages.file_messages(spark, path).select(F.col("key").alias("k"), F.col("value").alias("v"))
    joined = streamed.join(batch, F.col("key") == F.col("k"), "full_outer")
    same = joined.where(~F.col("value").eqNullSafe(F.col("v"))).select(F.count("*").alias("n")).scalar() == 0
    decoded = c.coerce_types(messages.decode_messages(joined))
    return decoded.select(*[n for n in RAW_COLUMNS if n != "tx_datetime"], text_time(), same.alias("same"))


@query
def snapshot_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "clean")
    tables.write_clean(c.clean(raw_transactions(spark, sf_dir)), path)
    dates = [r["tx_date"] for r in tables.snapshot_dates(spark, path).collect()]
    rows = tables.read_snapshots(spark, path, dates)
    return rows.select(*[n for n in RAW_COLUMNS if n != "tx_datetime"], text_time(), F.col("tx_date").cast("string"))


@query
def choose_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = transactions(spark, sf_dir).select(F.to_date("tx_datetime").alias("tx_date")).distinct()
    return tables.choose_snapshots(dates, 3, seed=7).select(F.col("tx_date").cast("string"))


def _scored_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with a prediction and probabilities that follow from the data."""
    p = F.col("terminal_id") / F.lit(100.0)
    return transactions(spark, sf_dir).select(
        "*",
        F.concat(F.lit("tx_"), F.col("tranaction_id").cast("string")).alias("key"),
        (p > 0.5).cast("double").alias("prediction"),
        F.array(1 - p, p).alias("probability"),
    )


def _flat_scores(df: DataFrame, *extra: str) -> DataFrame:
    return df.select(
        "tranaction_id",
        "tx_datetime",
        "prediction",
        F.col("probability")[0].alias("p0"),
        F.col("probability")[1].alias("p1"),
        *extra,
    )


@query
def forecast_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "forecast-text")
    rows = messages.score_fields(_scored_by_rule(spark, sf_dir)).drop("key")
    rows.write.option("header", True).option("escape", '"').csv(path)
    return _flat_scores(tables.read_forecast_text(spark, path))


def _part_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run record per part."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("run_id"),
        F.col("p_brand").alias("experiment"),
        F.when(F.col("p_partkey") % 7 == 0, "FAILED").otherwise("FINISHED").alias("status"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("started_at"),
        F.create_map(F.lit(AUC_CV), F.col("p_size") / F.lit(100.0)).alias("metrics"),
        F.create_map(F.lit("type"), F.col("p_type")).alias("params"),
        F.concat(F.lit("models/"), F.col("p_partkey").cast("string")).alias("artifact_path"),
    )


@query
def run_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_dir(spark, "runs")
    runs.write_runs(_part_runs(spark, sf_dir), path)
    return runs.read_runs(spark, path, status="FINISHED").select(
        "run_id", "experiment", F.col("metrics")[AUC_CV].alias("auc"), F.col("params")["type"].alias("type")
    )


@query
def runs_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every run logged as it starts, most again with their result, with the table compacted in between."""
    path = work_dir(spark, "runs")
    found = _part_runs(spark, sf_dir)
    started = found.withColumns({"status": F.lit("RUNNING"), "metrics": F.create_map(F.lit(AUC_CV), F.lit(0.0))})
    ended = found.where(F.col("run_id").cast("bigint") % 3 > 0)
    runs.write_runs(started, path)
    runs.write_runs(ended.where(F.col("run_id").cast("bigint") % 2 == 0), path)
    runs.compact_runs(spark, path)
    runs.write_runs(ended, path)  # a retry: the even ones come again
    return runs.read_runs(spark, path).select("run_id", "experiment", "status", F.col("metrics")[AUC_CV].alias("auc"))


@query
def messages_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = messages.decode_messages(messages.to_messages(raw_transactions(spark, sf_dir)))
    return decoded.drop("value").withColumn("tx_amount", F.col("tx_amount").try_cast("double"))


@query
def score_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = messages.encode_scores(_scored_by_rule(spark, sf_dir))
    return _flat_scores(messages.decode_scores(sent))


@query
def column_map_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = messages.encode_column_maps(_scored_by_rule(spark, sf_dir))
    return _flat_scores(messages.decode_column_maps(sent))


def _faulty_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages of the dirty rows; some lose a field, some are not JSON."""
    rows = raw_transactions(spark, sf_dir).withColumn("id", F.col("tranaction_id").cast("bigint"))
    rows = rows.withColumn("customer_id", F.when(F.col("id") % 29 != 0, F.col("customer_id")))
    sent = messages.to_messages(rows)
    number = F.substring_index("key", "_", -1).cast("bigint")
    return sent.withColumn("value", F.when(number % 31 == 0, "{oops").otherwise(F.col("value")))


@query
def split_invalid(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, rejected = messages.split_invalid(_faulty_messages(spark, sf_dir))
    good = valid.select("key", F.lit("ok").alias("reason"), "customer_id", "terminal_id")
    bad = rejected.select(
        "key", "reason", F.lit(None).cast("int").alias("customer_id"), F.lit(None).cast("int").alias("terminal_id")
    )
    return good.unionByName(bad)


# --- profile and cleaning --------------------------------------------------


@query
def profile_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_duplicates(dirty_raw(spark, sf_dir), by="source_file")


@query
def profile_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_missing(c.coerce_types(raw_transactions(spark, sf_dir)))


@query
def profile_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = profile.profile_numeric(c.coerce_types(dirty_raw(spark, sf_dir)).distinct(), by="source_file")
    return out.withColumns({n: r6(n) for n in ("mean", "stddev")})


@query
def coerce_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(c.coerce_types(raw_transactions(spark, sf_dir)))


@query
def drop_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(c.drop_nulls(c.coerce_types(raw_transactions(spark, sf_dir))))


@query
def drop_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(c.drop_duplicates(raw_transactions(spark, sf_dir))).withColumn(
        "tx_amount", F.col("tx_amount").cast("double")
    )


@query
def clamp_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(c.clamp_negative(c.coerce_types(raw_transactions(spark, sf_dir))))


@query
def clean_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(c.clean(raw_transactions(spark, sf_dir)))


@query
def clean_drop_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(c.clean(raw_transactions(spark, sf_dir), REQUIRED_COLUMNS, invalid_keys="drop"))


# --- features --------------------------------------------------------------


@query
def time_features_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = time_features(transactions(spark, sf_dir))
    return rows.select(
        "tranaction_id",
        epoch_seconds("tx_datetime").alias("epoch"),
        date_stamp("tx_datetime").alias("stamp"),
        *["day_of_week", "week_of_year", "is_weekend", "hour", "is_day"],
    )


@query
def customer_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(features.customer_features(transactions(spark, sf_dir)).drop("tx_time_days", "tx_fraud_scenario"))


@query
def terminal_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(features.terminal_features(transactions(spark, sf_dir)).drop("tx_time_days", "tx_fraud_scenario"))


@query
def terminal_features_delayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.terminal_features(transactions(spark, sf_dir), delay_days=7)
    return shown(rows.drop("tx_time_days", "tx_fraud_scenario"))


@query
def feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(features.feature_table(raw_transactions(spark, sf_dir)))


@query
def feature_table_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table from three jobs, each with new and late rows and some that came before."""
    path = work_dir(spark, "table")
    rows = raw_transactions(spark, sf_dir)
    number = F.col("tranaction_id").cast("bigint")
    # Later days first; the second part fills in, the third repeats a tenth and brings the rest.
    first = (F.col("tx_datetime") >= "2024-01-15") & (number % 3 > 0)
    second = (F.col("tx_datetime") < "2024-01-08") | (number % 9 == 0)
    for part in (first, ~first & second, (~first & ~second) | (number % 10 == 0)):
        incremental.update_clean(rows.where(part), path)
    return shown(spark.read.parquet(path).drop("tx_date"))


@query
def rolling_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = features.build_features(lineitem_transactions(spark, sf_dir))
    return shown(rows.drop("day_of_week", "week_of_year", "is_weekend", "hour", "is_day"))


@query
def rolling_small_amounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages of amounts around 1e-11, shown on the scale of the amounts before."""
    rows = lineitem_transactions(spark, sf_dir).withColumn("tx_amount", F.col("tx_amount") / 1e15)
    rows = features.customer_features(rows)
    names = [f"avg_amount_per_customer_for_{d}_days" for d in WINDOW_DAYS]
    return rows.select(
        *[n for n in rows.columns if n.startswith("l_")], *[r6(F.col(n) * 1e15).alias(n) for n in names]
    )


# --- learning --------------------------------------------------------------


@query
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learn.with_class_weight(transactions(spark, sf_dir)).select("tranaction_id", "tx_fraud", "classWeights")


@query
def union_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table cut into weeks, each read as a snapshot, and put together again."""
    path = work_dir(spark, "weeks")
    tables.write_clean(transactions(spark, sf_dir), path)
    dates = sorted(r["tx_date"] for r in tables.snapshot_dates(spark, path).collect())
    weeks = [tables.read_snapshots(spark, path, dates[i : i + 7]) for i in range(0, len(dates), 7)]
    rows = learn.with_class_weight(learn.union_snapshots(weeks))
    return rows.select("tranaction_id", F.col("tx_date").cast("string"), "tx_amount", "classWeights")


@query
def sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = learn.sample_rows(transactions(spark, sf_dir), 0.05, seed=11, by=["tranaction_id"])
    return rows.select("tranaction_id", "tx_amount")


@query
def minmax_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transactions(spark, sf_dir).select(
        "tranaction_id", "tx_amount", "tx_time_seconds", "terminal_id", F.lit(3).alias("constant")
    )
    names = ["tx_amount", "tx_time_seconds", "terminal_id", "constant"]
    return learn.minmax_scale(rows, names).withColumns({n: r6(n) for n in names})


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.feature_table(raw_transactions(spark, sf_dir))


def _kept_labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, written once to the shared folder, for queries that read it to fit and again to score."""
    rows, path = _labelled(spark, sf_dir), work_dir(spark, "labelled")
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@query
def gbt_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each row's label, and whether its score is a probability that the prediction follows."""
    rows = _kept_labelled(spark, sf_dir)
    scored = learn.score(rows, learn.train(rows))
    p = score_of(scored)
    sound = p.between(0, 1) & (F.col("prediction") == (p > 0.5).cast("double"))
    return scored.select("tranaction_id", "tx_fraud", sound.alias("sound"))


@query
def cv_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every point of the full grid, whether its AUC is one and whether the winner's is the highest."""
    tuned = tuning.tune_rounds(_labelled(spark, sf_dir), parallelism=4, refit=False)
    rows = tuned.table(spark)
    return rows.withColumn("highest", rows.agg(F.max("auc")).scalar()).select(
        "point",
        *[F.col("params")[n].cast(kind).alias(n) for n, kind in (("maxDepth", "int"), ("maxIter", "int"), ("subsamplingRate", "double"))],
        (F.col("auc").between(0, 1) & (~F.col("best") | (F.col("auc") == F.col("highest")))).alias("sound"),
    )


@query
def model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Does a model give the same scores after it was saved and loaded?"""
    rows = _kept_labelled(spark, sf_dir)
    model = learn.train(rows)
    path = work_dir(spark, "model")
    runs.save_model(model, path)
    both = learn.score(rows, model).select(*rows.columns, F.col("probability").alias("fitted"))
    again = learn.score(both, runs.load_model(path))
    same = score_of(again, column="fitted") == score_of(again)
    return again.select("tranaction_id", "tx_fraud", same.alias("same"))


# --- evaluation ------------------------------------------------------------


def _predicted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = F.when(F.col("tx_amount") > 60, 1).otherwise(0)
    return transactions(spark, sf_dir).withColumn("prediction", rule)


@query
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.confusion_matrix(_predicted(spark, sf_dir))


@query
def class_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluate.class_metrics(_predicted(spark, sf_dir))


@query
def acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = evaluate.class_metrics(_predicted(spark, sf_dir), positive_label=1)
    return evaluate.acceptance(metrics, min_recall=0.2, max_fpr=0.5)


@query
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    auc = evaluate.roc_auc(transactions(spark, sf_dir), "tx_amount")
    return spark.range(1).select(F.round(F.lit(auc), 9).alias("auc"))


RATES = ("precision", "recall", "fpr")


@query
def threshold_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality at every distinct amount as the least one that is called a fraud."""
    found = curve.threshold_curve(transactions(spark, sf_dir), "tx_amount")
    return found.withColumns({n: r6(n) for n in RATES})


@query
def curve_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact area per terminal."""
    found = curve.threshold_curve(transactions(spark, sf_dir), "tx_amount", by=["terminal_id"])
    return curve.curve_auc(found, ["terminal_id"]).withColumn("auc", r6("auc"))


@query
def operating_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per terminal the smallest amount that meets both targets, where there is one."""
    found = curve.threshold_curve(transactions(spark, sf_dir), "tx_amount", by=["terminal_id"])
    point = curve.operating_point(found, min_recall=0.5, max_fpr=0.5, by=["terminal_id"])
    return point.withColumns({n: r6(n) for n in RATES})


@query
def operating_point_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stated targets, over a score that meets them and one that does not."""
    rows = transactions(spark, sf_dir).withColumn("telling", F.col("tx_fraud") * 1000 + F.col("tx_amount"))
    points = [
        curve.operating_point(curve.threshold_curve(rows, name)).withColumn("score", F.lit(name))
        for name in ("telling", "tx_amount")
    ]
    return points[0].unionByName(points[1]).withColumns({n: r6(n) for n in (*RATES, "threshold")})


@query
def score_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored_by_rule(spark, sf_dir)
    rows = rows.withColumn("probability", probability_vector(rows))
    return rows.select(
        "tranaction_id",
        score_of(rows, "positive").alias("positive"),
        score_of(rows, "unpredicted").cast("double").alias("unpredicted"),
    )


@query
def parse_probability(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored_by_rule(spark, sf_dir)
    rows = rows.withColumn("probability", probability_text(rows))
    rows = rows.withColumn("probability", probability_vector(rows))
    return rows.select("tranaction_id", score_of(rows).alias("p1"))


# --- comparison ------------------------------------------------------------


def _score_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions(spark, sf_dir).select(
        F.when(F.col("tx_fraud") == 1, "fraud").otherwise("legitimate").alias("arm"),
        date_stamp("tx_datetime").alias("forecast_date"),
        F.col("tx_amount").alias("score"),
    )


@query
def score_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = compare.score_stats(_score_rows(spark, sf_dir), ["arm", "forecast_date"])
    return stats.withColumns({"mean": r6("mean"), "sd": r6("sd")})


def _rounded_t(df: DataFrame) -> DataFrame:
    names = [n for n in df.columns if n.startswith(("mean", "sd")) or n in ("t", "df", "p")]
    return df.withColumns({n: r6(n) for n in names})


@query
def ttest_two_arms(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = compare.score_stats(_score_rows(spark, sf_dir), "arm")
    return _rounded_t(compare.two_arm_t(stats, "arm", "fraud", "legitimate"))


@query
def ttest_welch(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = compare.score_stats(_score_rows(spark, sf_dir), "arm")
    return _rounded_t(compare.two_arm_t(stats, "arm", "fraud", "legitimate", "welch"))


@query
def ttest_p_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded_t(compare.ttest(_score_rows(spark, sf_dir), "arm", "fraud", "legitimate"))


@query
def ttest_paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two scores of the same transactions."""
    rows = transactions(spark, sf_dir).select("tx_amount", (F.col("tx_amount") + F.col("terminal_id") / 100 - 0.5).alias("other"))
    return _rounded_t(compare.paired_t(rows, "tx_amount", "other"))


@query
def daily_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _score_rows(spark, sf_dir)
    return _rounded_t(compare.drift_t(rows, rows, "forecast_date"))


@query
def daily_drift_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _score_rows(spark, sf_dir)
    return _rounded_t(compare.score_drift(rows, rows))


@query
def ks_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _score_rows(spark, sf_dir)
    found = compare.ks_drift(rows, rows)
    return found.withColumns({"distance": r6("distance"), "p": r6("p")})


@query
def top_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = compare.top_models(_part_runs(spark, sf_dir), k=10)
    return best.select("run_id", "experiment", "metric")


@query
def top_models_ascending(spark: SparkSession, sf_dir: str) -> DataFrame:
    worst = compare.top_models(_part_runs(spark, sf_dir), ascending=True)
    return worst.select("run_id", "experiment", "metric")


@query
def required_n_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    p1 = F.col("p_size") / F.lit(100.0)
    p2 = (F.col("p_size") + F.col("p_partkey") % 3) / F.lit(100.0)
    return table(spark, sf_dir, "part").select("p_partkey", required_n(p1, p2).alias("n"))


class _AmountRule:
    """A scorer in place of a fitted model: the amount over a scale that its path names."""

    def __init__(self, path: str):
        self.scale = 50 + int(path.rsplit("/", 1)[1]) % 50

    def transform(self, df: DataFrame) -> DataFrame:
        p = F.least(F.col("tx_amount") / F.lit(float(self.scale)), F.lit(1.0))
        return df.withColumns({"probability": F.array(1 - p, p), "prediction": (p > 0.5).cast("double")})


@query
def compare_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best and the worst run compared over all transactions."""
    found = _part_runs(spark, sf_dir)
    best, worst = (compare.top_models(found, k=1, ascending=up).first()["run_id"] for up in (False, True))
    result = compare.compare_models(transactions(spark, sf_dir), found, _AmountRule, models=(best, worst))
    names = ["new_metric", "current_metric", "new_mean", "current_mean", "t", "df", "p"]
    return result.withColumns({n: r6(n) for n in names})


@query
def compare_fitted_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two models fitted, logged, compared on the last days, and the winner logged."""
    table_path, runs_path, models = (work_dir(spark, n) for n in ("table", "runs", "models"))
    tables.write_clean(_labelled(spark, sf_dir), table_path)
    dates = sorted(r["tx_date"] for r in tables.snapshot_dates(spark, table_path).collect())
    cut = len(dates) * 3 // 4
    for depth in (2, 3):
        jobs.refit_job(
            spark,
            table_path,
            runs_path,
            models,
            dates[:cut],
            dates[cut:],
            maxDepth=depth,
        )
    return jobs.compare_job(spark, table_path, runs_path, dates[cut:])


# --- streaming -------------------------------------------------------------


def _dated_rows(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, tuple]:
    """The dirty rows with their time and day, and the first and last day."""
    rows = raw_transactions(spark, sf_dir).withColumn("timestamp", F.col("tx_datetime").cast("timestamp"))
    rows = rows.withColumn("day", F.to_date("timestamp"))
    first = rows.agg(F.min("day").alias("lo"), F.max("day").alias("hi")).first()
    return rows, (first["lo"], first["hi"])


def _messages_between(rows: DataFrame, day: date, until: date) -> DataFrame:
    """Messages of the rows of some days; only these rows are encoded."""
    part = rows.where((F.col("day") >= F.lit(day)) & (F.col("day") < F.lit(until)))
    return messages.to_messages(part, also=["timestamp"])


def _stream_features(spark: SparkSession, sf_dir: str, kind: str, step: int, upkeep: bool = False) -> DataFrame:
    """Feed the messages in event order, ``step`` days per micro-batch, with upkeep of the history between them."""
    rows, (lo, hi) = _dated_rows(spark, sf_dir)
    inbox, out, history, checkpoint = (
        work_dir(spark, n) for n in ("inbox", "features", "history", "checkpoint")
    )
    day = lo
    while day <= hi:
        until = day + timedelta(days=step)
        _messages_between(rows, day, until).write.mode("append").parquet(inbox)
        scoring.score_stream(
            scoring.read_tx_stream(spark, inbox),
            checkpoint,
            features=kind,
            history_path=history if kind == "history" else None,
            features_path=out,
        ).awaitTermination()
        if upkeep:
            jobs.upkeep_job(spark, history, until)
        day = until
    return spark.read.parquet(out).drop("batch_id")


@query
def stream_stateless_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_stream_features(spark, sf_dir, "stateless", step=40))


@query
def stream_history_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(_stream_features(spark, sf_dir, "history", step=11))


@query
def stream_history_upkeep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over a history whose days are merged and expire while the stream runs."""
    return shown(_stream_features(spark, sf_dir, "history", step=8, upkeep=True))


@query
def stream_persist_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    inbox, forecasts, checkpoint = (work_dir(spark, n) for n in ("scores", "forecasts", "checkpoint"))
    sent = messages.encode_scores(_scored_by_rule(spark, sf_dir))
    sent.withColumn("timestamp", F.current_timestamp()).write.parquet(inbox)
    scoring.persist_scores(
        scoring.read_tx_stream(spark, inbox), checkpoint, forecasts
    ).awaitTermination()
    rows = tables.read_forecasts(spark, forecasts)
    return _flat_scores(rows, "forecast_date")


def _live_scores(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Forecasts of all transactions through both streams, and the same model's scores by the batch job."""
    rows = transactions(spark, sf_dir)
    trained = features.single_row_features(rows).transform(time_features)
    model = learn.train(trained)
    inbox, scores, forecasts, check1, check2 = (
        work_dir(spark, n) for n in ("inbox", "scores", "forecasts", "checkpoint", "checkpoint")
    )
    sent = messages.to_messages(rows.withColumn("tx_datetime", text_time()))
    sent.withColumn("timestamp", F.current_timestamp()).write.parquet(inbox)
    scoring.score_stream(
        scoring.read_tx_stream(spark, inbox), check1, model, "stateless", scores_path=scores
    ).awaitTermination()
    scoring.persist_scores(
        scoring.read_tx_stream(spark, scores), check2, forecasts
    ).awaitTermination()
    return tables.read_forecasts(spark, forecasts), learn.score(trained, model)


@query
def stream_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages scored by a model, kept as daily forecasts, and each day checked for drift."""
    live, reference = _live_scores(spark, sf_dir)
    return compare.score_drift(
        reference.select(score_of(reference).alias("score")),
        live.select("forecast_date", score_of(live).alias("score")),
    )


@query
def stream_scores_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each live score beside that of the batch job: do they agree?"""
    live, reference = _live_scores(spark, sf_dir)
    batch = reference.select("tranaction_id", F.col("prediction").alias("called"), score_of(reference).alias("score"))
    both = live.join(batch, "tranaction_id", "full_outer")
    same = (F.col("prediction") == F.col("called")) & (F.abs(score_of(live) - F.col("score")) < 1e-12)
    return both.select("tranaction_id", "forecast_date", F.coalesce(same, F.lit(False)).alias("same"))


@query
def stream_keyed_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job's features out of keyed state, rows fed in event order."""
    rows, (lo, hi) = _dated_rows(spark, sf_dir)
    inbox, out, checkpoint = (work_dir(spark, n) for n in ("inbox", "features", "checkpoint"))
    day = lo
    while day <= hi:
        until = day + timedelta(days=11)
        _messages_between(rows, day, until).write.mode("append").parquet(inbox)
        keyed.keyed_stream(scoring.read_tx_stream(spark, inbox), checkpoint, out).awaitTermination()
        day = until
    return shown(spark.read.parquet(out).drop("batch_id"))


@query
def daily_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days closed while their scores stream in; some scores of the first days come when these are closed."""
    rows = _scored_by_rule(spark, sf_dir)
    sent = messages.encode_scores(rows).join(rows.select("key", "tranaction_id", "tx_datetime"), "key")
    first = sent.agg(F.min(F.to_date("tx_datetime"))).first()[0]
    late = (F.col("tranaction_id") % 23 == 0) & (F.col("tx_datetime") < F.lit(first + timedelta(days=8)))
    paths = {n: work_dir(spark, n) for n in ("scores", "checkpoint", "forecasts", "closes", "quarantine", "runs")}
    reference = rows.select(score_of(rows).alias("score"))
    for a, b in ((0, 10), (10, 20), (20, 10_000)):
        on = F.col("tx_datetime") >= F.lit(first + timedelta(days=a))
        part = sent.where(on & (F.col("tx_datetime") < F.lit(first + timedelta(days=b))) & ~late)
        part = part.unionByName(sent.where(late)) if a == 20 else part
        part.select("key", "value", F.col("tx_datetime").alias("timestamp")).write.mode("append").parquet(paths["scores"])
        close.close_days(
            scoring.read_tx_stream(spark, paths["scores"]), paths["checkpoint"], reference, paths["forecasts"],
            paths["closes"], paths["quarantine"], paths["runs"],
        ).awaitTermination()
    set_aside = spark.read.parquet(paths["quarantine"]).groupBy("forecast_date").agg(F.count("*").alias("n_late"))
    logged = runs.read_runs(spark, paths["runs"]).select(F.col("params")["date"].alias("forecast_date"), F.lit(True).alias("logged"))
    found = close.read_closes(spark, paths["closes"]).drop("batch_id").join(set_aside, "forecast_date", "left")
    found = found.join(logged, "forecast_date", "left").withColumns(
        {"n_late": F.coalesce("n_late", F.lit(0)), "logged": F.coalesce("logged", F.lit(False))}
    )
    return _rounded_t(found)


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
