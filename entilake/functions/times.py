"""Extended time values (up to eleven-digit years, before the common era, precision 0 to 14) as XSD literals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from entilake.functions.text import typed_literal

#: Stands for broken dates (fixed value: valid and easy to find).
FALLBACK = '"2007-05-12T10:30:42Z"^^x:dateTime'


def time_literal(time: Column, precision: Column, bce_mode: str = "parity") -> Column:
    """Precision 11 gives a date, 10 a month, 9 and below a year, above 11 the raw time. Year 0 is -1; years before it
    are -1 where the precision is 9 or more (bce_mode `parity`) or one less (`shift`). A text without year, month and day
    gives FALLBACK; NULL only for a NULL time."""
    part = lambda k: F.regexp_extract(time, r"^([+-]?\d+)-(\d\d)-(\d\d)", k)
    year, p = part(1).try_cast("bigint"), precision.try_cast("int")
    before = F.lit(-1) if bce_mode == "parity" else year - 1
    shifted = F.when(year == 0, -1).when((year < 0) & (p >= 9), before).otherwise(year)
    text = F.when(shifted >= 0, F.lpad(shifted.cast("string"), 4, "0")).otherwise(F.concat(F.lit("-"), F.lpad(F.abs(shifted).cast("string"), 4, "0")))
    text = F.when(F.abs(shifted) > 9999, shifted.cast("string")).otherwise(text)
    literal = (
        F.when(p == 11, typed_literal(F.concat(text, F.lit("-"), part(2), F.lit("-"), part(3)), "date"))
        .when(p == 10, typed_literal(F.concat(text, F.lit("-"), part(2)), "gYearMonth"))
        .when(p <= 9, typed_literal(text, "gYear"))
        .otherwise(typed_literal(time, "dateTime"))
    )
    return F.when(time.isNull(), None).when(year.isNull(), FALLBACK).otherwise(literal)
