"""The same results in SQL, for checking on another engine."""

from __future__ import annotations

import re

from txrisk.schema import WINDOW_DAYS

# Two-sided 95 % and one-sided 80 % normal quantiles, as 2 * (z1 + z2) ** 2.
SAMPLE_SIZE_FACTOR = "15.697759468698171"

TX = """tx as (
  select event_id as tranaction_id, ts,
    strftime(ts, '%Y-%m-%d %H:%M:%S') as tx_datetime,
    cast(floor(epoch(ts)) as bigint) as sec,
    cast(user_id as integer) as customer_id,
    cast(json_extract_string(props, '$.k') as integer) as terminal_id,
    value as tx_amount,
    cast(floor(epoch(ts)) as bigint) - 1704067200 as tx_time_seconds,
    cast(floor((floor(epoch(ts)) - 1704067200) / 86400) as bigint) as tx_time_days,
    cast(event_type = 'error' as integer) as tx_fraud,
    cast(case when event_type = 'error' then 1 + event_id % 3 else 0 end as integer)
      as tx_fraud_scenario
  from events)"""

# terminal_text is what the raw file holds, terminal_id what it parses to.
DIRTY = (
    TX
    + """,
dirty as (
  select tranaction_id, tx_datetime, sec, ts,
    case when tranaction_id % 41 = 0 then -customer_id - 1 else customer_id end as customer_id,
    case when tranaction_id % 43 = 0 then null when tranaction_id % 37 = 0 then null
      else terminal_id end as terminal_id,
    case when tranaction_id % 43 = 0 then 'Err' when tranaction_id % 37 = 0 then null
      else cast(terminal_id as varchar) end as terminal_text,
    tx_amount, tx_time_seconds, tx_time_days, tx_fraud, tx_fraud_scenario,
    strftime(ts, '%Y-%m-%d') || '.txt' as source_file,
    unnest(case when tranaction_id % 50 = 0 then [0, 1] else [0] end) as copy
  from tx)"""
)

RAW = (
    "tranaction_id, tx_datetime, customer_id, terminal_id, tx_amount, "
    "tx_time_seconds, tx_time_days, tx_fraud, tx_fraud_scenario"
)
RAW_AS_TEXT = RAW.replace("terminal_id", "terminal_text as terminal_id")

CLEAN = (
    DIRTY
    + f""",
clean as (
  select greatest(tranaction_id, 0) as tranaction_id, tx_datetime, sec,
    greatest(customer_id, 0) as customer_id, greatest(terminal_id, 0) as terminal_id, tx_amount,
    greatest(tx_time_seconds, 0) as tx_time_seconds, tx_time_days, tx_fraud, tx_fraud_scenario
  from (select distinct {RAW}, sec from dirty where terminal_id is not null))"""
)


def _frame(key: str, days: int, delay: int = 0) -> str:
    end = f"{delay * 86400} preceding" if delay else "current row"
    return (
        f"over (partition by {key} order by sec "
        f"range between {(days + delay) * 86400} preceding and {end})"
    )


def _customer(key: str = "customer_id") -> str:
    return ",\n  ".join(
        f"round(avg(tx_amount) {_frame(key, d)} + 1e-9, 6) as avg_amount_per_customer_for_{d}_days,\n"
        f"  count(tx_amount) {_frame(key, d)} as number_of_tx_per_customer_for_{d}_days"
        for d in WINDOW_DAYS
    )


def _terminal(key: str = "terminal_id", delay: int = 0) -> str:
    return ",\n  ".join(
        f"count(*) {_frame(key, d, delay)} as number_of_tx_per_terminal_for_{d}_day,\n"
        f"  cast(sum(tx_fraud) {_frame(key, d, delay)} as bigint) as number_of_fraud_tx_per_terminal_for_{d}_day"
        for d in WINDOW_DAYS
    )


def _calendar(ts: str) -> str:
    return f"""cast(dayofweek({ts}) + 1 as integer) as day_of_week,
  cast(weekofyear({ts}) as integer) as week_of_year,
  cast(dayofweek({ts}) in (0, 6) as integer) as is_weekend,
  cast(hour({ts}) as integer) as hour,
  cast(hour({ts}) > 6 as integer) as is_day"""


SOME = "tranaction_id, tx_datetime, customer_id, terminal_id, tx_amount, tx_time_seconds, tx_fraud"

SCORED = (
    TX
    + """,
scored as (
  select *, 'tx_' || tranaction_id as key, terminal_id / 100.0::double as p1,
    1 - terminal_id / 100.0::double as p0,
    cast(terminal_id / 100.0::double > 0.5 as integer)::double as prediction
  from tx)"""
)
FLAT = f"with {SCORED} select tranaction_id, tx_datetime, prediction, p0, p1 from scored"

RUNS = """runs as (
  select cast(p_partkey as varchar) as run_id, p_brand as experiment, p_type as type,
    case when p_partkey % 7 = 0 then 'FAILED' else 'FINISHED' end as status,
    p_size / 100.0::double as metric
  from part)"""

CELLS = (
    TX
    + """,
cells as (
  select cast(tx_fraud as double) as label, cast(cast(tx_amount > 60 as integer) as double) as prediction,
    count(*) as n
  from tx group by all),
counts as (
  select k.positive_label,
    cast(sum(case when label = k.positive_label and prediction = k.positive_label then n else 0 end) as bigint) as tp,
    cast(sum(case when label <> k.positive_label and prediction = k.positive_label then n else 0 end) as bigint) as fp,
    cast(sum(case when label = k.positive_label and prediction <> k.positive_label then n else 0 end) as bigint) as fn,
    cast(sum(case when label <> k.positive_label and prediction <> k.positive_label then n else 0 end) as bigint) as tn
  from cells, (values (0), (1)) k(positive_label) group by 1),
metrics as (
  select positive_label, tp, fp, fn, tn,
    case when tp + fp > 0 then tp / (tp + fp) end as precision,
    case when tp + fn > 0 then tp / (tp + fn) end as recall,
    case when fp + tn > 0 then fp / (fp + tn) end as fpr,
    case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn) end as f1
  from counts)"""
)

ARMS = (
    TX
    + """,
arms as (
  select case when tx_fraud = 1 then 'fraud' else 'legitimate' end as arm,
    strftime(ts, '%Y_%m_%d') as forecast_date, tx_amount as score
  from tx)"""
)


def _two_arms(t: str, df: str) -> str:
    return f"""with {ARMS},
s as (select arm, count(score) as n, avg(score) as mean, stddev_samp(score) as sd from arms group by 1),
w as (
  select a.n as n_a, a.mean as mean_a, a.sd as sd_a, b.n as n_b, b.mean as mean_b, b.sd as sd_b,
    a.sd * a.sd / a.n as va, b.sd * b.sd / b.n as vb
  from s a, s b where a.arm = 'fraud' and b.arm = 'legitimate')
select n_a, round(mean_a + 1e-9, 6) as mean_a, round(sd_a + 1e-9, 6) as sd_a,
  n_b, round(mean_b + 1e-9, 6) as mean_b, round(sd_b + 1e-9, 6) as sd_b,
  round({t} + 1e-9, 6) as t, round({df} + 1e-9, 6) as df
from w"""


# P(|T| > |t|) of the columns t and df: one minus Simpson's sum of the density from 0 to |t|.
P_VALUE = """greatest(0, 1 - 2 * exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(pi() * df) * abs(t) / 60000 * (
    select sum((case when k in (0, 20000) then 1 when k % 2 = 1 then 4 else 2 end)
      * pow(1 + pow(t * k / 20000, 2) / df, -(df + 1) / 2))
    from generate_series(0, 20000) g(k)))"""


def _curve(score: str, by: str = "") -> str:
    """The threshold curve of a score in tx, per group."""
    group, over = (f"{by}, ", f"partition by {by} ") if by else ("", "")
    return f"""counted as (
  select {group}{score} as threshold, cast(sum(tx_fraud) as bigint) as n_pos,
    cast(sum(1 - tx_fraud) as bigint) as n_neg
  from tx group by all),
summed as (
  select *, cast(sum(n_pos) over w as bigint) as tp, cast(sum(n_neg) over w as bigint) as fp,
    cast(sum(n_pos) over ({over}) as bigint) as pos, cast(sum(n_neg) over ({over}) as bigint) as neg
  from counted window w as ({over}order by threshold desc)),
curve as (
  select {group}threshold, n_pos, n_neg, tp, fp, pos - tp as fn, neg - fp as tn, tp / (tp + fp) as precision,
    case when pos > 0 then tp / pos end as recall, case when neg > 0 then fp / neg end as fpr
  from summed)"""


def _rounded(*names: str) -> str:
    return ", ".join(f"round({n} + 1e-9, 6) as {n}" for n in names)


# P(sup |B| > x): 80 terms of the alternating series, or of its transform where x is small.
KOLMOGOROV = """case when x < 0.5 then 1 - sqrt(2 * pi()) / x * (
    select sum(exp(-pi() * pi() * (2 * k - 1) * (2 * k - 1) / (8 * x * x))) from generate_series(1, 80) g(k))
  else 2 * (select sum((case when k % 2 = 1 then 1 else -1 end) * exp(-2 * k * k * x * x)) from generate_series(1, 80) g(k)) end"""


def _with_p(exact: str, keys: str, more: str = "") -> str:
    """``exact`` with p and what follows from it, rounded like the query."""
    arms = re.findall(r"\b(?:mean|sd)\w*", keys)
    shown = ", ".join(f"round({n} + 1e-9, 6) as {n}" if n in arms else n for n in keys.split(", "))
    return f"""{exact}, tested as (select *, {P_VALUE} as p from exact)
select {shown}, round(t + 1e-9, 6) as t, round(df + 1e-9, 6) as df, round(p + 1e-9, 6) as p,
  cast(sign(t) as integer) as direction, p < 0.05 as different{more}
from tested"""


def _numeric_profile() -> str:
    names = ["tranaction_id", "customer_id", "terminal_id", "tx_time_days", "tx_fraud", "tx_fraud_scenario"]
    one = (
        "select source_file, '{c}' as \"column\", count({c}) as count, round(avg({c}) + 1e-9, 6) as mean, "
        "round(stddev_samp({c}) + 1e-9, 6) as stddev, cast(min({c}) as double) as min, "
        "cast(max({c}) as double) as max from single group by 1"
    )
    single = f"single as (select distinct {RAW}, source_file from dirty)"
    return f"with {DIRTY}, {single} " + " union all ".join(one.format(c=c) for c in names)


def _missing_profile() -> str:
    names = RAW.split(", ")
    one = (
        "select '{c}' as \"column\", count(*) filter ({c} is null) as n_null, {nan} as n_nan from dirty"
    )
    return f"with {DIRTY} " + " union all ".join(
        one.format(c=c, nan=f"count(*) filter (isnan({c}))" if c == "tx_amount" else "cast(0 as bigint)")
        for c in names
    )


MISSING = "tranaction_id % 29 = 0 or terminal_text is null"


def oracle_sql() -> dict[str, str]:
    features = f"""with {CLEAN}
select {RAW},
  {_terminal()},
  {_customer()},
  {_calendar("cast(tx_datetime as timestamp)")}
from clean"""
    delivered = f"""with {CLEAN}
select 'tx_' || tranaction_id as key, {RAW},"""
    return {
        "read_raw_csv": f"with {DIRTY} select {RAW} from dirty",
        "raw_file_messages": f"with {DIRTY} select {RAW}, true as numbered from dirty",
        "replay_file_messages": f"with {DIRTY} select {RAW}, true as same from dirty",
        "snapshot_roundtrip": f"with {CLEAN} select {RAW}, tx_datetime[:10] as tx_date from clean",
        "choose_snapshots": """select tx_date from (
  select distinct strftime(ts, '%Y-%m-%d') as tx_date from events)
order by md5('7:' || tx_date) limit 3""",
        "forecast_text": FLAT,
        "run_records": f"""with {RUNS}
select run_id, experiment, metric as auc, type from runs where status = 'FINISHED'""",
        "runs_upsert": f"""with {RUNS}
select run_id, experiment, case when cast(run_id as bigint) % 3 > 0 then status else 'RUNNING' end as status,
  case when cast(run_id as bigint) % 3 > 0 then metric else 0 end as auc
from runs""",
        "messages_json": f"""with {DIRTY}
select 'tx_' || tranaction_id as key, cast(tranaction_id as varchar) as tranaction_id, tx_datetime,
  cast(customer_id as varchar) as customer_id, terminal_text as terminal_id, tx_amount,
  cast(tx_time_seconds as varchar) as tx_time_seconds, cast(tx_time_days as varchar) as tx_time_days,
  cast(tx_fraud as varchar) as tx_fraud, cast(tx_fraud_scenario as varchar) as tx_fraud_scenario,
  case when terminal_text is null then 'missing_field' end as reason
from dirty""",
        "score_messages": FLAT,
        "column_map_messages": FLAT,
        "split_invalid": f"""with {DIRTY}, marked as (
  select 'tx_' || tranaction_id as key, customer_id, terminal_id,
    case when tranaction_id % 31 = 0 then 'not_json' when {MISSING} then 'missing_field'
      when terminal_text = 'Err' then 'unparsable' else 'ok' end as reason
  from dirty)
select key, reason, case when reason = 'ok' then customer_id end as customer_id,
  case when reason = 'ok' then terminal_id end as terminal_id
from marked""",
        "profile_duplicates": f"""with {DIRTY}, rows as (
  select source_file, {RAW_AS_TEXT}, count(*) as copies from dirty group by all)
select source_file, cast(sum(copies) as bigint) as n_rows, count(*) as n_distinct,
  cast(sum(copies - 1) as bigint) as n_duplicates
from rows group by 1""",
        "profile_missing": _missing_profile(),
        "profile_numeric": _numeric_profile(),
        "coerce_types": f"with {DIRTY} select {RAW} from dirty",
        "drop_nulls": f"with {DIRTY} select {RAW} from dirty where terminal_id is not null",
        "drop_duplicates": f"""with {DIRTY}
select distinct cast(tranaction_id as varchar) as tranaction_id, tx_datetime,
  cast(customer_id as varchar) as customer_id, terminal_text as terminal_id, tx_amount,
  cast(tx_time_seconds as varchar) as tx_time_seconds, cast(tx_time_days as varchar) as tx_time_days,
  cast(tx_fraud as varchar) as tx_fraud, cast(tx_fraud_scenario as varchar) as tx_fraud_scenario
from dirty""",
        "clamp_negative": f"""with {DIRTY}
select {RAW.replace("customer_id", "greatest(customer_id, 0) as customer_id")} from dirty""",
        "clean_transactions": f"with {CLEAN} select {RAW} from clean",
        "clean_drop_negative": f"""with {DIRTY}
select distinct {RAW} from dirty where terminal_id is not null and customer_id >= 0""",
        "time_features": f"""with {TX}
select tranaction_id, sec as epoch, strftime(ts, '%Y_%m_%d') as stamp, {_calendar("ts")} from tx""",
        "customer_features": f"with {TX} select {SOME}, {_customer()} from tx",
        "terminal_features": f"with {TX} select {SOME}, {_terminal()} from tx",
        "terminal_features_delayed": f"with {TX} select {SOME}, {_terminal(delay=7)} from tx",
        "feature_table": features,
        "feature_table_in_parts": features,
        "rolling_small_amounts": f"""with li as (
  select l_orderkey, l_linenumber, l_partkey as customer_id, l_suppkey as terminal_id,
    l_extendedprice / 1e15 as tx_amount, cast(floor(epoch(l_shipdate)) as bigint) as sec
  from lineitem)
select l_orderkey, l_linenumber,
  {", ".join(f"round(avg(tx_amount) {_frame('customer_id', d)} * 1e15 + 1e-9, 6) as avg_amount_per_customer_for_{d}_days" for d in WINDOW_DAYS)}
from li""",
        "sample_rows": f"""with {TX} select tranaction_id, tx_amount from tx
where cast('0x' || left(md5('11:' || tranaction_id), 8) as bigint) < {int(0.05 * (1 << 32))}""",
        "rolling_lineitem": f"""with li as (
  select l_orderkey, l_linenumber, l_partkey as customer_id, l_suppkey as terminal_id,
    strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') as tx_datetime, l_extendedprice as tx_amount,
    cast(l_returnflag = 'R' as integer) as tx_fraud, cast(floor(epoch(l_shipdate)) as bigint) as sec
  from lineitem)
select l_orderkey, l_linenumber, customer_id, terminal_id, tx_datetime, tx_amount, tx_fraud,
  {_terminal()},
  {_customer()}
from li""",
        "class_weights": f"""with {TX}
select tranaction_id, tx_fraud, case when tx_fraud = 1 then 5 else 1 end as "classWeights" from tx""",
        "union_snapshots": f"""with {TX}
select tranaction_id, tx_datetime[:10] as tx_date, tx_amount,
  case when tx_fraud = 1 then 5 else 1 end as "classWeights"
from tx""",
        "minmax_scaled": f"""with {TX}, e as (
  select min(tx_amount) a0, max(tx_amount) a1, min(tx_time_seconds)::double s0,
    max(tx_time_seconds)::double s1, min(terminal_id)::double t0, max(terminal_id)::double t1
  from tx)
select tranaction_id, round((tx_amount - a0) / (a1 - a0) + 1e-9, 6) as tx_amount,
  round((tx_time_seconds - s0) / (s1 - s0) + 1e-9, 6) as tx_time_seconds,
  round((terminal_id - t0) / (t1 - t0) + 1e-9, 6) as terminal_id, 0.5::double as constant
from tx, e""",
        "cv_grid": """select cast(row_number() over (order by d, i, r) - 1 as integer) as point, d as "maxDepth", i as "maxIter",
  r as "subsamplingRate", true as sound
from (values (3), (5), (10)) a(d), (values (5), (10), (20)) b(i), (values (0.7::double), (0.8), (0.9)) c(r)""",
        "model_roundtrip": f"with {CLEAN} select tranaction_id, tx_fraud, true as same from clean",
        "confusion_matrix": f"with {CELLS} select label, prediction, n from cells",
        "class_metrics": f"with {CELLS} select * from metrics",
        "acceptance": f"""with {CELLS}
select *, recall > 0.2 as recall_ok, fpr <= 0.5 as fpr_ok, recall > 0.2 and fpr <= 0.5 as accepted
from metrics where positive_label = 1""",
        "roc_auc": f"""with {TX}, g as (
  select tx_amount as s, sum(tx_fraud) as p, sum(1 - tx_fraud) as q from tx group by 1),
r as (
  select p, q, coalesce(sum(q) over (order by s rows between unbounded preceding and 1 preceding), 0) as below
  from g)
select round(sum(p * (below + q / 2.0::double)) / (sum(p)::double * sum(q)::double), 9) as auc from r""",
        "threshold_curve": f"""with {TX}, {_curve("tx_amount")}
select threshold, n_pos, n_neg, tp, fp, fn, tn, {_rounded("precision", "recall", "fpr")} from curve""",
        "curve_auc": f"""with {TX}, {_curve("tx_amount", "terminal_id")}
select terminal_id, cast(sum(n_pos) as bigint) as n_pos, cast(sum(n_neg) as bigint) as n_neg,
  round(case when sum(n_pos) > 0 and sum(n_neg) > 0
    then sum(n_pos * (tn + n_neg / 2.0::double)) / (sum(n_pos)::double * sum(n_neg)) end + 1e-9, 6) as auc
from curve group by 1""",
        "operating_point": f"""with {TX}, {_curve("tx_amount", "terminal_id")},
best as (select terminal_id, min(threshold) as threshold from curve where recall > 0.5 and fpr <= 0.5 group by 1)
select terminal_id, threshold, tp, fp, fn, tn, {_rounded("precision", "recall", "fpr")}, threshold is not null as found
from (select distinct terminal_id from tx) left join best using (terminal_id) left join curve using (terminal_id, threshold)""",
        "operating_point_default": " union all ".join(
            f"""select * from (with {TX}, {_curve(text)},
best as (select min(threshold) as threshold from curve where recall > 0.98 and fpr <= 0.05)
select round(b.threshold + 1e-9, 6) as threshold, tp, fp, fn, tn, {_rounded("precision", "recall", "fpr")},
  b.threshold is not null as found, '{name}' as score
from best b left join curve using (threshold))"""
            for name, text in (("telling", "tx_fraud * 1000 + tx_amount"), ("tx_amount", "tx_amount"))
        ),
        "score_pick": f"""with {SCORED}
select tranaction_id, p1 as positive,
  cast(cast(case when prediction = 1 then p0 else p1 end as float) as double) as unpredicted
from scored""",
        "parse_probability": f"with {SCORED} select tranaction_id, p1 from scored",
        "score_stats": f"""with {ARMS}
select arm, forecast_date, count(score) as n, round(avg(score) + 1e-9, 6) as mean,
  round(stddev_samp(score) + 1e-9, 6) as sd
from arms group by 1, 2""",
        "ttest_two_arms": _two_arms(
            "(mean_a - mean_b) / (sqrt(va + vb) + 1e-5)", "cast(n_a + n_b - 2 as double)"
        ),
        "ttest_p_value": _with_p(
            f"""with {ARMS},
s as (select arm, count(score) as n, avg(score) as mean, stddev_samp(score) as sd from arms group by 1),
exact as (
  select a.n as n_a, a.mean as mean_a, a.sd as sd_a, b.n as n_b, b.mean as mean_b, b.sd as sd_b,
    (a.mean - b.mean) / (sqrt(a.sd * a.sd / a.n + b.sd * b.sd / b.n) + 1e-5) as t,
    cast(a.n + b.n - 2 as double) as df
  from s a, s b where a.arm = 'fraud' and b.arm = 'legitimate')""",
            "n_a, mean_a, sd_a, n_b, mean_b, sd_b",
        ),
        "ttest_paired": _with_p(
            f"""with {TX},
v as (select tx_amount - (tx_amount + terminal_id / 100.0::double - 0.5::double) as d from tx),
s as (select count(d) as n, avg(d) as mean_d, stddev_samp(d) as sd_d from v),
exact as (
  select n, mean_d as mean, sd_d as sd, mean_d / (sd_d / sqrt(n)) as t, cast(n - 1 as double) as df from s)""",
            "n, mean, sd",
        ),
        "daily_drift_flags": _with_p(
            f"""with {ARMS},
r as (select count(score) as n_ref, avg(score) as mean_ref, stddev_samp(score) as sd_ref from arms),
d as (
  select forecast_date, count(score) as n_live, avg(score) as mean_live, stddev_samp(score) as sd_live
  from arms group by 1),
exact as (
  select *, (mean_ref - mean_live)
      / (sqrt(sd_ref * sd_ref / n_ref + sd_live * sd_live / n_live) + 1e-5) as t,
    cast(n_ref + n_live - 2 as double) as df
  from d, r)""",
            "forecast_date, n_ref, mean_ref, sd_ref, n_live, mean_live, sd_live",
            ", p < 0.05 as refit",
        ),
        "ks_drift": f"""with {ARMS},
points as (select distinct score from arms),
days as (select forecast_date, count(*) as n_live from arms group by 1),
counted as (
  select d.forecast_date, n_live, p.score, count(a.score) filter (a.forecast_date = d.forecast_date) as mine,
    count(a.score) as n
  from points p join arms a on a.score = p.score, days d group by all),
running as (
  select forecast_date, n_live, sum(mine) over w / n_live as live, sum(n) over w / sum(n) over (partition by forecast_date) as ref,
    sum(n) over (partition by forecast_date) as n_ref
  from counted window w as (partition by forecast_date order by score)),
found as (
  select forecast_date, cast(max(n_ref) as bigint) as n_ref, max(n_live) as n_live, max(abs(ref - live)) as distance
  from running group by 1),
tested as (select *, sqrt(n_ref::double * n_live / (n_ref + n_live)) * distance as x from found)
select forecast_date, n_ref, n_live, round(distance + 1e-9, 6) as distance, round({KOLMOGOROV} + 1e-9, 6) as p,
  {KOLMOGOROV} < 0.05 as refit
from tested""",
        "gbt_scores": f"with {CLEAN} select tranaction_id, tx_fraud, true as sound from clean",
        "ttest_welch": _two_arms(
            "(mean_a - mean_b) / sqrt(va + vb)",
            "(va + vb) * (va + vb) / (va * va / (n_a - 1) + vb * vb / (n_b - 1))",
        ),
        "daily_drift": f"""with {ARMS},
r as (select count(score) as n_ref, avg(score) as mean_ref, stddev_samp(score) as sd_ref from arms),
d as (
  select forecast_date, count(score) as n_live, avg(score) as mean_live, stddev_samp(score) as sd_live
  from arms group by 1)
select forecast_date, n_ref, round(mean_ref + 1e-9, 6) as mean_ref, round(sd_ref + 1e-9, 6) as sd_ref,
  n_live, round(mean_live + 1e-9, 6) as mean_live, round(sd_live + 1e-9, 6) as sd_live,
  round((mean_ref - mean_live)
    / (sqrt(sd_ref * sd_ref / n_ref + sd_live * sd_live / n_live) + 1e-5) + 1e-9, 6) as t,
  round(cast(n_ref + n_live - 2 as double) + 1e-9, 6) as df
from d, r""",
        "compare_models": f"""with {TX}, {RUNS},
new as (select * from runs where status = 'FINISHED' order by metric desc, run_id limit 1),
cur as (select * from runs where status = 'FINISHED' order by metric, run_id limit 1),
scores as (
  select least(tx_amount / (50 + cast(new.run_id as bigint) % 50), 1) as a,
    least(tx_amount / (50 + cast(cur.run_id as bigint) % 50), 1) as b
  from tx, new, cur),
s as (select count(*) as n, avg(a) as ma, stddev_samp(a) as sa, avg(b) as mb, stddev_samp(b) as sb from scores),
exact as (
  select n, ma, mb, (ma - mb) / (sqrt(sa * sa / n + sb * sb / n) + 1e-5) as t, cast(2 * n - 2 as double) as df from s),
tested as (select *, {P_VALUE} as p from exact)
select 'compared' as status, new.run_id as new_run_id, cur.run_id as current_run_id,
  round(new.metric + 1e-9, 6) as new_metric, round(cur.metric + 1e-9, 6) as current_metric,
  cast(floor({SAMPLE_SIZE_FACTOR}::double * (cur.metric * (1 - cur.metric)) / ((cur.metric - new.metric) * (cur.metric - new.metric))) as bigint) + 1 as required_n,
  n, round(ma + 1e-9, 6) as new_mean, round(mb + 1e-9, 6) as current_mean, round(t + 1e-9, 6) as t,
  round(df + 1e-9, 6) as df, round(p + 1e-9, 6) as p, cast(sign(t) as integer) as direction, p < 0.05 as different,
  case when p < 0.05 and new.metric > cur.metric then new.run_id else cur.run_id end as best_run_id
from tested, new, cur""",
        "top_models": f"""with {RUNS}
select run_id, experiment, metric from runs where status = 'FINISHED'
order by metric desc nulls last, run_id limit 10""",
        "top_models_ascending": f"""with {RUNS}
select run_id, experiment, metric from runs where status = 'FINISHED'
order by metric asc nulls last, run_id limit 2""",
        "required_n": f"""with e as (
  select p_partkey, p_size / 100.0::double as p1, (p_size + p_partkey % 3) / 100.0::double as p2 from part)
select p_partkey, case when p1 - p2 <> 0 then cast(floor(
    {SAMPLE_SIZE_FACTOR}::double * (p1 * (1 - p1)) / ((p1 - p2) * (p1 - p2))) as bigint) + 1 end as n
from e""",
        "stream_stateless_features": delivered
        + ",\n  ".join(
            f"cast(1 as bigint) as number_of_tx_per_terminal_for_{d}_day, "
            f"cast(tx_fraud as bigint) as number_of_fraud_tx_per_terminal_for_{d}_day, "
            f"round(tx_amount + 1e-9, 6) as avg_amount_per_customer_for_{d}_days, "
            f"cast(1 as bigint) as number_of_tx_per_customer_for_{d}_days"
            for d in WINDOW_DAYS
        )
        + f""",
  {_calendar("cast(tx_datetime as timestamp)")}
from clean""",
        "stream_history_features": delivered
        + f"""
  {_terminal()},
  {_customer()},
  {_calendar("cast(tx_datetime as timestamp)")}
from clean""",
        "stream_history_upkeep": delivered
        + f"""
  {_terminal()},
  {_customer()},
  {_calendar("cast(tx_datetime as timestamp)")}
from clean""",
        "stream_keyed_features": delivered
        + f"""
  {_terminal()},
  {_customer()},
  {_calendar("cast(tx_datetime as timestamp)")}
from clean""",
        "stream_scores_match": f"""with {TX}
select tranaction_id, strftime(ts, '%Y_%m_%d') as forecast_date, true as same from tx""",
        "daily_close": _with_p(
            f"""with {SCORED},
marked as (
  select strftime(ts, '%Y_%m_%d') as forecast_date, p1 as score,
    tranaction_id % 23 = 0 and cast(ts as date) < (select cast(min(ts) as date) + 8 from tx) as late
  from scored),
r as (select count(score) as n_ref, avg(score) as mean_ref, stddev_samp(score) as sd_ref from marked),
d as (
  select forecast_date, count(*) as n_live, avg(score) as mean_live, stddev_samp(score) as sd_live
  from marked where not late group by 1 having forecast_date < (select strftime(max(ts) - interval 1 hour, '%Y_%m_%d') from tx)),
l as (select forecast_date, count(*) as n_late from marked where late group by 1),
exact as (
  select d.*, r.*, coalesce(n_late, 0) as n_late, true as logged, (mean_ref - mean_live)
      / (sqrt(sd_ref * sd_ref / n_ref + sd_live * sd_live / n_live) + 1e-5) as t,
    cast(n_ref + n_live - 2 as double) as df
  from d left join l using (forecast_date), r)""",
            "forecast_date, n_ref, mean_ref, sd_ref, n_live, mean_live, sd_live, n_late, logged",
            ", p < 0.05 as refit",
        ),
        "stream_persist_scores": f"""with {SCORED}
select tranaction_id, tx_datetime, prediction, p0, p1, strftime(ts, '%Y_%m_%d') as forecast_date
from scored""",
    }
