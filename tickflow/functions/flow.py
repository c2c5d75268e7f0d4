"""Order-flow arithmetic as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(col: str) -> Column:
    """Feed numbers arrive as text; text that is no number becomes NULL."""
    return F.expr(f"try_cast(`{col}` AS DOUBLE)")


def mid(bid: Column, ask: Column) -> Column:
    return (bid + ask) / F.lit(2.0)


def imbalance(plus: Column, minus: Column, total: Column) -> Column:
    """(plus - minus) / total, NULL when the total is zero."""
    return (plus - minus) / F.nullif(total, F.lit(0.0))


def order_flow(now: dict[str, Column], before: dict[str, Column]) -> Column:
    """Order-flow imbalance between two consecutive tops of book.

    Cont, Kukanov and Stoikov (2014): a side contributes its new quantity when
    its price did not get worse and gives back its old quantity when it did not
    get better; the ask side counts with the opposite sign.
    """

    def take(cond: Column, qty: Column) -> Column:
        return F.when(cond, qty).otherwise(F.lit(0.0))

    bid_in = take(now["bid"] >= before["bid"], now["bid_qty"])
    bid_out = take(now["bid"] <= before["bid"], before["bid_qty"])
    ask_in = take(now["ask"] <= before["ask"], now["ask_qty"])
    ask_out = take(now["ask"] >= before["ask"], before["ask_qty"])
    return (bid_in - bid_out) - (ask_in - ask_out)


def skill(model_error: Column, baseline_error: Column) -> Column:
    """1 - model / baseline, NULL when the baseline error is zero."""
    return F.lit(1.0) - model_error / F.nullif(baseline_error, F.lit(0.0))
