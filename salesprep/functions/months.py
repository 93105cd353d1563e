"""Months are ``yyyy/MM`` text, which sorts like the dates it stands for."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from salesprep.markets import WindowRule

MONTH_SHAPE = "^[0-9]{4}/(0[1-9]|1[0-2])$"


def month_to_date(month: Column) -> Column:
    """First day of the month; null for text that is no month."""
    return F.try_to_date(month, "yyyy/MM")


def date_to_month(day: Column, pattern: str = "yyyy/MM") -> Column:
    return F.date_format(day, pattern)


def is_month_end(day: Column) -> Column:
    return day.cast("date") == F.last_day(day)


def snapshot_tag(day: Column) -> Column:
    """``yyyyMMdd`` of the day, or of the next day when the day ends a month."""
    return F.date_format(F.when(is_month_end(day), F.date_add(day, 1)).otherwise(day.cast("date")), "yyyyMMdd")


def window_start(as_of: Column, rule: WindowRule) -> Column:
    """First month (``yyyyMM``) to load."""
    if rule.first_month is not None:
        return F.lit(rule.first_month)
    return F.date_format(F.add_months(as_of, -rule.months_back), "yyyyMM")


def window_end(as_of: Column, rule: WindowRule) -> Column:
    """Last month (``yyyyMM``) to load."""
    previous = F.add_months(as_of, -1)
    if rule.open_at_month_end:
        previous = F.when(is_month_end(as_of), as_of.cast("date")).otherwise(previous)
    return F.date_format(previous, "yyyyMM")


def month_sequence(start: Column, end: Column) -> Column:
    """Array of ``yyyy/MM`` months between two ``yyyyMM`` months, both included, oldest first; empty if the first is later."""
    first, last = F.to_date(start, "yyyyMM"), F.to_date(end, "yyyyMM")
    # where the first is later, the sequence is not used but must still be valid
    valid = F.sequence(F.least(first, last), last, F.expr("interval 1 month"))
    days = F.when(first <= last, valid).when(first > last, F.array().cast("array<date>"))
    return F.transform(days, lambda day: F.date_format(day, "yyyy/MM"))


def in_months(month: Column, start: Column, end: Column) -> Column:
    """True for a well-formed month between two ``yyyyMM`` months.

    The text bounds fold to constants and reach the scan; the shape test keeps
    out text that merely sorts between them.
    """

    def slashed(bound: Column) -> Column:
        return F.date_format(F.to_date(bound, "yyyyMM"), "yyyy/MM")

    return month.between(slashed(start), slashed(end)) & month.rlike(MONTH_SHAPE)
