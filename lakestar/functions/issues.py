"""Issue and article page facts that patterns alone can tell, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakestar.functions.dates import MONTHS, month_number
from lakestar.functions.text import clean

_MONTH = "|".join(f"{m}|{m[:3]}" for m in MONTHS)


def volume_issue(url: Column) -> Column:
    """struct(volume, issue) of an issue address: ``/vol/<n>/issue/<n>`` (or a range), a supplement has no issue."""
    pattern = r"/vol/(\d+)/(?:issue/(\d+(?:-\d+)?)|suppl/)"
    return F.struct(clean(F.regexp_extract(url, pattern, 1)).alias("volume"), clean(F.regexp_extract(url, pattern, 2)).alias("issue"))


def issue_date(heading: Column) -> Column:
    """struct(year, month) of a heading: its last year, and the last word that is a month."""
    year = F.element_at(F.regexp_extract_all(heading, F.lit(r"\b((?:19|20)\d\d)\b"), 1), -1)
    months = F.regexp_extract_all(F.lower(heading), F.lit(rf"\b({_MONTH})\b"), 1)
    return F.struct(F.when(F.size(F.regexp_extract_all(heading, F.lit(r"\b((?:19|20)\d\d)\b"), 1)) > 0, year).try_cast("int").alias("year"), F.when(F.size(months) > 0, month_number(F.element_at(months, -1))).alias("month"))


def total_pages(text: Column) -> Column:
    """n of ``Page x of n``; 1 without."""
    return F.coalesce(F.nullif(F.regexp_extract(text, r"Page\s+\d+\s+of\s+(\d+)", 1), F.lit("")).try_cast("int"), F.lit(1))


def pages(text: Column) -> Column:
    """struct(first, last) of ``Pages a-b``; one page is both, an article number neither."""
    found = F.regexp_extract(text, r"(?i)pages?\s+([A-Za-z]?\d+)(?:\s*[-–]\s*([A-Za-z]?\d+))?", 1)
    last = F.regexp_extract(text, r"(?i)pages?\s+([A-Za-z]?\d+)(?:\s*[-–]\s*([A-Za-z]?\d+))?", 2)
    return F.struct(clean(found).alias("first"), clean(F.when(last != "", last).otherwise(found)).alias("last"))
