"""Risk features of a transaction: customer and terminal history, calendar."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from txrisk.functions.calendar import time_features
from txrisk.operators.clean import clean
from txrisk.operators.rolling import attach_stats, rolling_range, rolling_stats
from txrisk.schema import WINDOW_DAYS

CUSTOMER_AGGS = {
    "avg_amount_per_customer_for_{d}_days": ("avg", "tx_amount"),
    "number_of_tx_per_customer_for_{d}_days": ("count", "tx_amount"),
}
# Counts rows rather than labels: a live row has no label yet.
TERMINAL_AGGS = {
    "number_of_tx_per_terminal_for_{d}_day": ("count", "*"),
    "number_of_fraud_tx_per_terminal_for_{d}_day": ("sum", "tx_fraud"),
}


def customer_features(
    df: DataFrame, days: Sequence[int] = WINDOW_DAYS, history: DataFrame | None = None
) -> DataFrame:
    """Average amount and number of transactions per customer, per window."""
    return rolling_range(df, "customer_id", "tx_datetime", days, CUSTOMER_AGGS, history)


def terminal_features(
    df: DataFrame,
    days: Sequence[int] = WINDOW_DAYS,
    history: DataFrame | None = None,
    delay_days: int = 0,
) -> DataFrame:
    """Number of transactions and of frauds per terminal, per window.

    With ``delay_days = 0`` the windows end at the row itself and so include its
    own label. A positive delay moves them back by that many days, so that only
    labels known by then count.
    """
    return rolling_range(df, "terminal_id", "tx_datetime", days, TERMINAL_AGGS, history, delay_days)


def single_row_features(df: DataFrame, days: Sequence[int] = WINDOW_DAYS) -> DataFrame:
    """The rolling columns of a row that knows no other row: a plain projection."""
    columns = {}
    for d in days:
        columns[f"number_of_tx_per_terminal_for_{d}_day"] = "1L"
        columns[f"number_of_fraud_tx_per_terminal_for_{d}_day"] = "cast(tx_fraud as bigint)"
    for d in days:
        columns[f"avg_amount_per_customer_for_{d}_days"] = "cast(tx_amount as double)"
        columns[f"number_of_tx_per_customer_for_{d}_days"] = "1L"
    return df.selectExpr("*", *[f"{text} as {name}" for name, text in columns.items()])


def build_features(
    df: DataFrame,
    history: DataFrame | None = None,
    delay_days: int = 0,
    customer_totals: DataFrame | None = None,
    terminal_totals: DataFrame | None = None,
) -> DataFrame:
    """All 17 derived columns on already clean rows.

    Rows of ``history`` and the daily totals count in the windows as well.
    """
    terminals = rolling_stats(
        df, "terminal_id", "tx_datetime", WINDOW_DAYS, TERMINAL_AGGS, history, delay_days, terminal_totals
    )
    customers = rolling_stats(
        df, "customer_id", "tx_datetime", WINDOW_DAYS, CUSTOMER_AGGS, history, 0, customer_totals
    )
    # Both read the clean rows, not each other's result, so that these rows are
    # computed once and their exchange is shared.
    return (
        df.transform(attach_stats, "terminal_id", "tx_datetime", terminals)
        .transform(attach_stats, "customer_id", "tx_datetime", customers)
        .transform(time_features)
    )


def feature_table(
    raw: DataFrame, required: list[str] | None = None, invalid_keys: str = "clamp"
) -> DataFrame:
    """Raw rows to clean rows with features."""
    return raw.transform(clean, required, invalid_keys).transform(build_features)
