"""Conformed calendar: one row per date *seen* in the sources.

Each source column is projected to a date and de-duplicated on its own before
the union, so millions of timestamps collapse to a few thousand dates before
the (tiny) final distinct; the calendar is bounded by the number of distinct
days, which is what makes it safe for AQE to broadcast downstream.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.functions import keys as K


def seen_dates(sources: Iterable[tuple[DataFrame, str]]) -> DataFrame:
    parts = [df.select(F.col(c).cast("date").alias("date")).where(F.col("date").isNotNull()).distinct()
             for df, c in sources]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def calendar_rows(dates: DataFrame) -> DataFrame:
    d = F.col("date")
    return dates.select(
        K.calendar_key(d).alias("calendar_key"),
        d.alias("full_date"),
        K.weekday_abbrev(d).alias("weekday"),
        F.dayofmonth(d).alias("day_of_month"),
        K.month_text(d).alias("month"),
        F.quarter(d).alias("quarter"),
        F.year(d).alias("year"),
    )


def unseen_calendar_rows(dates: DataFrame, calendar: DataFrame) -> DataFrame:
    """Only dates not yet in ``calendar`` (NOT IN rewritten as an anti join;
    the calendar date is never NULL so the null-aware form is not needed)."""
    new = dates.join(calendar.select(F.col("full_date").alias("date")), "date", "left_anti")
    return calendar_rows(new)
