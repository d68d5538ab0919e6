"""Partial publication dates and date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: English month names.
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
HIGH_DATE = "9999-12-31"
UNKNOWN_KEY = -1


def month_number(c: Column) -> Column:
    """1 to 12 of a number, name or three-letter abbreviation; a range takes its first month."""
    first = F.lower(F.trim(F.split(c, "[-–—]")[0]))
    table = F.create_map(*(F.lit(x) for name, n in dict([(m[:3], i) for i, m in enumerate(MONTHS, 1)] + [(m, i) for i, m in enumerate(MONTHS, 1)]).items() for x in (name, n)))
    number = F.when(first.rlike("^[0-9]{1,2}$"), first.try_cast("int"))
    return F.coalesce(F.when(number.between(1, 12), number), F.element_at(table, first))


def publication(year: Column, month: Column, day: Column) -> Column:
    """struct(year, month, day, month_start, precision, unparsed, is_range).

    The day is kept only if the calendar has it; precision is the finest of day, month, year, or null.
    """
    y = F.when(F.trim(year).rlike("^[0-9]{4}$"), F.trim(year).try_cast("int"))
    present = F.trim(F.coalesce(month, F.lit(""))) != ""
    m = F.when(present, month_number(month))
    d = F.when(F.trim(day).rlike("^[0-9]{1,2}$"), F.trim(day).try_cast("int"))
    text = lambda *parts: F.concat_ws("-", F.lpad(y.cast("string"), 4, "0"), *parts)
    start = F.when(y.isNotNull() & m.isNotNull(), text(F.lpad(m.cast("string"), 2, "0"), F.lit("01")).try_cast("date"))
    exact = F.when(start.isNotNull() & d.between(1, 31), text(F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0")).try_cast("date"))
    precision = F.when(exact.isNotNull(), "day").when(start.isNotNull(), "month").when(y.isNotNull(), "year")
    return F.struct(
        y.alias("year"), m.alias("month"), F.when(exact.isNotNull(), d).alias("day"), start.alias("month_start"), precision.alias("precision"),
        (present & m.isNull()).alias("unparsed"), (present & month.rlike("[-–—]")).alias("is_range"),
    )


def date_key(c: Column, low: str = "2000-01-01", high: str = "2035-12-31") -> Column:
    """yyyyMMdd as INT, or -1 for null and for dates the date dimension doesn't hold."""
    day = c.cast("date")
    return F.when(day.between(F.lit(low).cast("date"), F.lit(high).cast("date")), F.date_format(day, "yyyyMMdd").cast("int")).otherwise(F.lit(UNKNOWN_KEY))
