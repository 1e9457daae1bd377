"""Period arithmetic shared by the statistics operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = ("day", "week", "month")


def period_start(ts: Column, span: str) -> Column:
    """Start of the day / week / month holding ``ts``.

    Weeks start on Sunday (the document store's default), Spark's on Monday:
    shift one day forward, truncate, shift back.
    """
    ts = ts.cast("timestamp")
    if span == "week":
        return F.date_trunc("week", ts + F.expr("INTERVAL 1 DAY")) - F.expr("INTERVAL 1 DAY")
    if span in ("day", "month", "year", "hour"):
        return F.date_trunc(span, ts)
    raise ValueError(f"unknown span {span!r}")


def period_start_any(ts: Column, span: Column) -> Column:
    """Same as :func:`period_start` with the span taken from a column."""
    ts = ts.cast("timestamp")
    return (F.when(span == "week", F.date_trunc("week", ts + F.expr("INTERVAL 1 DAY")) - F.expr("INTERVAL 1 DAY"))
            .when(span == "month", F.date_trunc("month", ts))
            .otherwise(F.date_trunc("day", ts)))


def day_str(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")
