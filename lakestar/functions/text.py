"""Text cleaning as Column expressions. ``trim`` strips U+0020 only and ``\\s`` is ASCII, as Spark has them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

def clean(c: Column, collapse: bool = False) -> Column:
    """Trimmed text, white-space runs collapsed on request, empty text null."""
    out = F.trim(c)
    if collapse:
        out = F.regexp_replace(out, r"\s+", " ")
    return F.nullif(out, F.lit(""))


def blank(c: Column) -> Column:
    """Null, empty or only blanks; never null itself."""
    return F.trim(F.coalesce(c, F.lit(""))) == ""


#: The patterns of slugs, DOIs, licences and name keys.
SLUG_RUN, SLUG_ENDS = r"[^a-z0-9]+", r"^_+|_+$"
DOI_RESOLVER, DOI = r"^(https?://(dx\.)?doi\.org/|doi:\s*)", r"^10\.\d{4,9}/\S+$"
LICENCE = r"creativecommons\.org/licenses/([a-z-]+)/([0-9.]+)"
NAME_MARKS = "[.,]"


def slug(c: Column) -> Column:
    """Lower-case key: runs of other characters become one underscore, none at the ends; empty is null."""
    return F.nullif(F.regexp_replace(F.regexp_replace(F.lower(c), SLUG_RUN, "_"), SLUG_ENDS, ""), F.lit(""))


def tokens(c: Column, separator: str = "|") -> Column:
    """Trimmed, non-empty, distinct parts in order; null text has none."""
    parts = F.split(F.coalesce(c, F.lit("")), "[" + separator + "]")
    return F.array_distinct(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != ""))


def whole_number(c: Column) -> Column:
    """INT of a text of digits only; anything else, or out of range, is null."""
    return F.when(c.rlike("^[0-9]+$"), c.try_cast("int"))


def integer(c: Column) -> Column:
    """INT of a text, with or without sign and blanks around it; anything else, or out of range, is null."""
    return F.trim(c).try_cast("int")


def number_between(c: Column, low: int, high: int | Column) -> Column:
    n = integer(c)
    return F.when(n.between(low, high), n)


def page_count(first: Column, last: Column) -> Column:
    """last - first + 1 where both are numbers and in order; computed in 64 bits."""
    a, b = integer(first).cast("long"), integer(last).cast("long")
    return F.when(b >= a, (b - a + 1).try_cast("int"))


def identifier(c: Column) -> tuple[Column, Column]:
    """A DOI without its resolver, in lower case, and whether it is well formed."""
    doi = clean(F.regexp_replace(F.lower(F.trim(c)), DOI_RESOLVER, ""))
    return doi, F.coalesce(doi.rlike(DOI), F.lit(False))


def licence(c: Column) -> Column:
    """``CC <KIND> <version>`` of a licence address; null for others."""
    kind = F.regexp_extract(F.lower(c), LICENCE, 1)
    return F.when(kind != "", F.concat_ws(" ", F.lit("CC"), F.upper(kind), F.regexp_extract(F.lower(c), LICENCE, 2)))


def contacts(c: Column, fields: tuple[str, ...] = ("name", "affiliation", "email")) -> Column:
    """Structs with every field cleaned; entries without the first field go, a null array is empty."""
    first, *_ = fields
    cleaned = F.transform(c, lambda x: F.struct(*(clean(x[f], collapse=True).alias(f) for f in fields)))
    kept = F.filter(cleaned, lambda x: x[first].isNotNull())
    return F.when(c.isNull(), F.filter(F.array(F.struct(*(F.lit("").alias(f) for f in fields))), lambda x: F.lit(False))).otherwise(kept)


def people(c: Column) -> Column:
    """Contacts of raw details (array of arrays name, affiliation, email): trimmed, slashes of affiliations as backslashes, empty ones gone."""
    part = lambda x, i: F.trim(F.coalesce(F.get(x, F.lit(i)), F.lit("")))
    made = F.transform(c, lambda x: F.struct(part(x, 0).alias("name"), F.replace(part(x, 1), F.lit("/"), F.lit("\\")).alias("affiliation"), part(x, 2).alias("email")))
    kept = F.filter(made, lambda x: F.concat(x["name"], x["affiliation"], x["email"]) != "")
    return F.coalesce(kept, F.array().cast("array<struct<name:string,affiliation:string,email:string>>"))


def person(c: Column) -> Column:
    """Contacts of details that are one text: one contact of that name, or none."""
    return F.when(F.coalesce(c, F.lit("")) == "", people(F.lit(None).cast("array<array<string>>"))).otherwise(people(F.array(F.array(c, F.lit(""), F.lit("")))))


def name_key(c: Column) -> Column:
    """Normalised person name: lower case, no dots or commas, single blanks; empty is null."""
    return F.nullif(F.trim(F.regexp_replace(F.regexp_replace(F.lower(c), NAME_MARKS, ""), r"\s+", " ")), F.lit(""))


def any_of(conditions: list[Column]) -> Column:
    """OR of conditions; false for none."""
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def differs(left: list[Column], right: list[Column]) -> Column:
    """Whether any attribute differs, nulls being values."""
    return any_of([~a.eqNullSafe(b) for a, b in zip(left, right, strict=True)])
