"""Review-date columns: the free-text date and its parsed day."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veracity.functions import lexicons as lx
from veracity.functions.text import strip


def date_tail(col: Column) -> Column:
    """Text after the last ' on ' (the whole text when there is none)."""
    return F.substring_index(F.coalesce(col, F.lit("")), " on ", -1)


def review_day_text(col: Column) -> Column:
    """Day label of the local SQL summary: trimmed tail after ' on ', else 'Unknown'."""
    c = F.coalesce(col, F.lit(""))
    return F.when(F.instr(c, " on ") > 0, strip(date_tail(c))).otherwise(F.lit("Unknown"))


def review_day(col: Column) -> Column:
    """Parsed day of a '... on January 5, 2024' text; NULL when it does not parse."""
    return F.try_to_timestamp(date_tail(col), F.lit(lx.REVIEW_DATE_PATTERN)).cast("date")


def day_number(day: Column) -> Column:
    """Days since 1970-01-01, for range arithmetic on days."""
    return F.unix_date(day)
