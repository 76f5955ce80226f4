"""Dates, the day index (days since 2012-01-01) and 14-day buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Day 0 of the day index, and days in a snapshot bucket (fixed values of the data model).
EPOCH, BUCKET_DAYS = "2012-01-01", 14


def parse_timestamp(text: Column) -> Column:
    """TIMESTAMP_NTZ of a revision's time stamp in any of its spellings: `2013-05-31T01:02:03Z`, with an offset of zero, or
    with a blank and no zone. NULL if it is missing, written otherwise or no time of the calendar."""
    plain = F.when(text.rlike(r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d:\d\d(Z|\+00:00)?$"), F.substring(text, 1, 19))
    return F.replace(plain, F.lit("T"), F.lit(" ")).try_cast("timestamp_ntz")


def date_of(text: Column) -> Column:
    """DATE of the first ten characters; NULL if they are none."""
    head = F.substring(text, 1, 10)
    return F.when(head.rlike(r"^\d{4}-\d\d-\d\d$"), head.try_cast("date"))


def day_index(date: Column) -> Column:
    """Days since the epoch, negative before it."""
    return F.date_diff(date, F.lit(EPOCH).cast("date"))


def day_date(index: Column) -> Column:
    """The date of a day index."""
    return F.date_add(F.lit(EPOCH).cast("date"), index.cast("int"))


def bucket_end(index: Column) -> Column:
    """Last day of the 14-day bucket a day is in, also for days before the epoch."""
    return (F.floor(index / BUCKET_DAYS) * BUCKET_DAYS + BUCKET_DAYS - 1).cast("int")


def date_text(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")
