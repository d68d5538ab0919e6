"""Mixing sources to target weights by entropy balancing.

The mix takes a rate of each document, from 0 to ``MOST``; among all rates that meet every source's word target it is the
one of least relative entropy to taking each document once. The dual of that problem has one variable lambda per source,
and rates are exponentially tilted by size: rate = min(MOST, exp(lambda * size)), so documents of one size are taken alike,
and long ones more (or less) where a source is to give more (or less) than it has. Each Newton step is one Spark job over
all sources: the dual's gradient (the words taken at the present lambda) and curvature are summed over the documents'
sizes, of which equal ones are counted together beforehand. Steps that leave the interval known to hold the solution
bisect it. They end when every source's words are within ``TOLERANCE`` of its target.

Rates become whole copies within small buckets of a source: from the largest document to the smallest, each takes the
number of copies, at most one beside its rate, that brings the words taken so far nearest to those due, so what one document
leaves over the next ones make up for.

All of it is DataFrame expressions. A source of any size is summed by partial aggregation and dealt to as many buckets
as it has hundreds of documents; only one row per source is ever put in one order.

Defined results: null texts have size 0; a document of size 0 is taken 0 times. A null source is a source of its own,
last in order. Rows repeated under one doc_id are documents each, told apart as rows. A very long text is one document of
its size. An empty table gives an empty mix. Other columns of the input are ignored by ``mix`` and kept by
``materialized_mix``, whatever their names, but for its own copy_no and target, which replace theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakestar.llm.common import materialize, numbered

MOST = 3
NEWTON_STEPS = 100
TOLERANCE = 1e-6
BUCKET = 256


def size(text: str = "text") -> Column:
    """Number of runs of characters other than blank and 0x09 to 0x0D."""
    bare = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[^\x20\x09-\x0D]+", "x")
    return F.length(F.translate(bare, " \t\n\x0b\x0c\r", "")).cast("long")


def targets(sizes: DataFrame, cycle: int = 3, most: int = MOST) -> DataFrame:
    """source, n, source_size, target of rows (source, size); one row per source.

    Sources by code point, null last, weigh 1 to ``cycle``, repeating. A target stops at ``most`` times its source's
    size and the excess is shared again by weight: target = min(limit, weight * level), where the level is found from
    the sources in order of limit over weight.
    """
    per = sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("weight", (F.row_number().over(order) - 1) % cycle + 1).withColumn("limit", F.lit(most) * F.col("source_size"))
    ratio = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy()
    per = per.withColumn("total", F.sum("source_size").over(all_rows)).withColumn("weights", F.sum("weight").over(all_rows))
    # If all sources before this one stop at their limits, the others get this level. It rises along the order as long
    # as sources that it is above are set aside, and falls after: the largest is the one at which all is shared.
    before = ratio.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.col("total") - F.coalesce(F.sum("limit").over(before), F.lit(0))) / (F.col("weights") - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    per = per.withColumn("level", level)
    level = F.max("level").over(all_rows)
    share = F.least(F.col("limit").cast("double"), F.col("weight") * level)
    return per.select("source", "n", "source_size", share.alias("target"))


def _step(state: DataFrame, sizes: DataFrame) -> DataFrame:
    """One Newton step of every source: state is (of, target, unit, at, low, high, off); sizes (source, size, n)."""
    x = F.col("size") / F.col("unit")
    tilted = F.exp(F.col("at") * x)
    free = tilted < MOST
    words = F.col("n") * F.col("size")
    sums = sizes.join(state, F.col("source").eqNullSafe(F.col("of"))).groupBy("of").agg(
        *(F.first(c).alias(c) for c in ("target", "unit", "at", "low", "high")),
        F.sum(words * F.when(free, tilted).otherwise(F.lit(float(MOST)))).alias("f"), F.sum(F.when(free, words * x * tilted).otherwise(0.0)).alias("slope"),
    )
    # The words' logarithm is closer to a line than the words are.
    off = F.log(F.col("target") / F.col("f"))
    low, high = F.when(off > 0, F.col("at")).otherwise(F.col("low")), F.when(off > 0, F.col("high")).otherwise(F.col("at"))
    sums = sums.withColumns({"off": off, "low": low, "high": high, "next": F.col("at") + off * F.col("f") / F.col("slope")})
    fits = F.col("slope").cast("boolean") & (F.col("low").isNull() | (F.col("next") > F.col("low"))) & (F.col("high").isNull() | (F.col("next") < F.col("high")))
    halved = F.coalesce((F.col("low") + F.col("high")) / 2, F.col("low") + F.abs("low") + 1, F.col("high") - F.abs("high") - 1)
    return sums.select("of", "target", "unit", F.when(F.abs("off") <= TOLERANCE, F.col("at")).when(fits, F.col("next")).otherwise(halved).alias("at"), "low", "high", F.abs("off").alias("off"))


def balance(sizes: DataFrame, per: DataFrame) -> DataFrame:
    """of (the source), tilt (lambda; null for sources at the limit or with nothing to give), from rows (source, size) and their targets."""
    counted = materialize(sizes.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")), "mixing-sizes")
    wanted = per.where((F.col("target") > 0) & (F.col("target") < MOST * F.col("source_size") * (1 - 1e-12)))
    # The unit is a size that most words are in documents of, so that lambda is of the order of 1.
    unit = counted.groupBy("source").agg((F.sum(F.col("n") * F.col("size") * F.col("size").cast("double")) / F.sum(F.col("n") * F.col("size"))).alias("unit")).withColumnRenamed("source", "s")
    none = F.lit(None).cast("double")
    state = wanted.join(unit, F.col("source").eqNullSafe(F.col("s"))).select(F.col("source").alias("of"), "target", "unit", F.log(F.col("target") / F.col("source_size")).alias("at"), none.alias("low"), none.alias("high"), none.alias("off"))
    state = materialize(state, "mixing-dual")
    for _ in range(NEWTON_STEPS):
        state = materialize(_step(state, counted), "mixing-dual")
        if (state.agg(F.max("off")).first()[0] or 0) <= TOLERANCE:
            break
    return state.select("of", (F.col("at") / F.col("unit")).alias("tilt"))


def allot(rows: DataFrame) -> DataFrame:
    """``rows`` (row, doc_id, size, source) plus source_size, target, rate and copies."""
    rows = materialize(rows, "mixing")
    per = materialize(targets(rows), "mixing-targets")
    found = materialize(per.join(balance(rows, per), F.col("source").eqNullSafe(F.col("of")), "left").drop("of").withColumnRenamed("source", "of"), "mixing-rates")
    # One row per source: joined by broadcast where Spark's size check allows, by a (skew-split) shuffle elsewhere.
    size, most = F.col("size"), F.lit(float(MOST))
    rate = F.when((size == 0) | (F.col("target") <= 0), 0.0).when(F.col("tilt").isNull(), most).otherwise(F.least(most, F.exp(F.col("tilt") * size)))
    dealt = rows.join(found, F.col("source").eqNullSafe(F.col("of"))).withColumn("rate", rate)
    # The bucket depends on what a row holds, so that reruns agree; equal rows of a large group are dealt by their place.
    alike = materialize(rows.groupBy("source", "doc_id", "size").agg(F.count("*").alias("m")).where(F.col("m") > BUCKET), "mixing-alike")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ("source", "doc_id", "size")]
    alike = alike.select(*(F.col(c).alias(f"_{c}") for c in ("source", "doc_id", "size")), "m")
    dealt = dealt.join(alike, same[0] & same[1] & same[2], "left")
    salt = F.when(F.col("m").isNull(), 0).otherwise(F.pmod(F.xxhash64("row"), F.col("m")))
    bucket = F.pmod(F.xxhash64(F.lit(7), "doc_id", "size", salt), F.greatest(F.lit(1), (F.col("n") / BUCKET).cast("long")))
    grouped = dealt.groupBy("source", bucket.alias("bucket")).agg(
        F.sort_array(F.collect_list(F.struct("size", "doc_id", "row", "rate")), asc=False).alias("docs"), *(F.first(c).alias(c) for c in ("source_size", "target")),
    )

    def take(state: Column, doc: Column) -> Column:
        due = state["due"] + doc["size"] * doc["rate"]
        fewest, many = F.greatest(F.lit(0.0), F.floor(doc["rate"]) - 1), F.least(most, F.ceil(doc["rate"]) + 1)
        copies = F.when(doc["size"] > 0, F.greatest(fewest, F.least(many, F.round(due / doc["size"]))).cast("int")).otherwise(F.lit(0))
        return F.struct((due - copies * doc["size"]).alias("due"), F.concat(state["copies"], F.array(copies)).alias("copies"))

    start = F.struct(F.lit(0.0).alias("due"), F.array().cast("array<int>").alias("copies"))
    grouped = grouped.withColumn("copies", F.aggregate("docs", start, take, lambda s: s["copies"]))
    each = grouped.select("source", "source_size", "target", F.explode(F.arrays_zip("docs", "copies")).alias("x"))
    return each.select("x.docs.row", "x.docs.doc_id", "x.docs.size", "source", "source_size", "target", "x.docs.rate", "x.copies")


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source, source_size, target, rate, copies, taken of every row of ``docs`` (doc_id, text, source)."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", size().alias("size"), F.col("source").cast("string").alias("source"))
    return allot(rows).drop("row").withColumn("taken", (F.col("copies") * F.col("size")).cast("long"))


def materialized_mix(docs: DataFrame) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is taken, with copy_no from 1 and its source's target.

    Rows are told apart by themselves, not by doc_id; documents taken 0 times are not in the mix.
    """
    docs, row = numbered(docs.drop("copy_no", "target"), "mixing-docs")
    taken = allot(docs.select(F.col(row).alias("row"), "doc_id", size().alias("size"), F.col("source").cast("string").alias("source")))
    taken = taken.where("copies > 0").select(F.col("row").alias("_of"), F.col("copies").alias("_copies"), F.col("target").alias("_target"))
    joined = docs.join(taken, F.col(row) == F.col("_of"))
    return joined.select(*(F.col(c) for c in docs.columns if c != row), F.col("_target").alias("target"), F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("copy_no"))
