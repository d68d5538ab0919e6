"""Journal documents as files: one ordered JSON file per journal, written as a stream, read back by lines.

A journal is never a row: its articles are lines of a file, sorted by key, the first with the document's head before it and
the last with its tail behind. Journals are dealt out by ranges of their names, so that each is in one task, which sorts
(and spills) its rows and writes them one after another, as a single file must be; its memory doesn't grow with the journal.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakestar.sources import lines
from lakestar.sources.files import Files

HEAD, TAIL = '{"articles": [', "]}"
#: What can't be in a file name, and what becomes one underscore.
_ILLEGAL, _RUN, LONGEST = r'[<>:"/\\|?*\x00-\x1f\x7f]', r"[_\s]+", 150


def file_slug(title: Column) -> Column:
    """A title as the name of a folder and file on any system; ``untitled`` where nothing is left."""
    # White space of any script separates; it goes first, for control characters count as it too.
    name = F.regexp_replace(F.regexp_replace(title, _ILLEGAL, "_"), "(?U)" + _RUN, "_")
    name = F.left(F.regexp_replace(name, "^_+|_+$", ""), F.lit(LONGEST))
    return F.when(F.coalesce(name, F.lit("")) == "", "untitled").otherwise(name)


def _names(rows: DataFrame, group: str, title: str) -> DataFrame:
    """slug, articles of each group; raises for a group of several titles, and for groups whose titles have one name."""
    named = rows.groupBy(group).agg(F.min(title).alias("_title"), F.max(title).alias("_other"), F.count_if(F.col(title).isNull()).alias("_none"), F.count("*").alias("articles"))
    mixed = named.where("_title <> _other or _none between 1 and articles - 1").select(group).limit(5).collect()
    if mixed:
        raise ValueError(f"several titles in one journal: {[r[0] for r in mixed]}")
    named = named.select(F.col(group), file_slug(F.col("_title")).alias("slug"), "articles")
    twice = named.groupBy("slug").agg(F.count("*").alias("n"), F.min(group).alias("one"), F.max(group).alias("other")).where("n > 1").limit(5).collect()
    if twice:
        raise ValueError(f"journals of one name: {[(r.slug, r.one, r.other) for r in twice]}")
    return named


def write_documents(rows: DataFrame, root: str, group: str, title: str, key: str, columns: list[str] | None = None) -> DataFrame:
    """Writes <root>/<slug>/<slug>.json, {"articles": [...]} in order of ``key``, for each ``group``; returns its slug and count of articles.

    ``columns``: those of an article, by default all but the group. A group without rows has no file. A file of the name is
    replaced as a whole; others stay. Rows of a null group raise.
    """
    spark, files = rows.sparkSession, Files(rows.sparkSession, root)
    root = root.rstrip("/")
    body = F.struct(*(columns or [c for c in rows.columns if c != group]))
    slug = file_slug(F.col(title))
    checked = F.when(F.col(group).isNull() | (F.col(group).cast("string") == ""), F.raise_error(F.lit(f"an article without {group}")).cast("string")).otherwise(slug)
    named = _names(rows.withColumn("_checked", checked).where("_checked is not null"), group, title).persist()
    try:
        ordered = rows.select(slug.alias("slug"), F.col(key).alias("_key"), F.to_json(body, {"ignoreNullFields": "false"}).alias("_text")).repartitionByRange("slug")
        w = Window.partitionBy("slug").orderBy("_key", "_text")
        first, last = F.row_number().over(w) == 1, F.lead(F.lit(1)).over(w).isNull()
        value = F.concat(F.when(first, HEAD + "\n").otherwise(""), F.col("_text"), F.when(last, "\n" + TAIL).otherwise(","))
        staging = f"{root}/_staging-{uuid.uuid4().hex}"
        # The writer wants rows by slug, as they are; so each journal is one file, in order.
        ordered.select("slug", value.alias("value")).write.partitionBy("slug").text(staging)
        written: dict[str, list[str]] = {}
        for path, _ in files.tree(staging):
            folder, _, name = path.rpartition("/")
            if name.startswith("part-"):
                written.setdefault(folder, []).append(path)
        for folder, parts in written.items():
            if len(parts) != 1:
                raise RuntimeError(f"{folder} has {len(parts)} files")
            name = _unescaped(folder.rpartition("/")[2].removeprefix("slug="))
            target = f"{root}/{name}/{name}.json"
            files.delete(target)
            files.move(parts[0], target)
        files.delete(staging)
        if len(written) != named.count():
            raise RuntimeError(f"{len(written)} files for {named.count()} journals")
        return spark.createDataFrame(named.select("slug", "articles").orderBy("slug").collect(), "slug string, articles long")
    finally:
        named.unpersist()


def _unescaped(name: str) -> str:
    """A partition's value as Spark writes it into a folder's name."""
    from urllib.parse import unquote

    return unquote(name)


def read_documents(spark: SparkSession, root: str, schema: str | None = None) -> DataFrame:
    """slug, position (from 1) and article of documents below ``root``: its JSON text, or parsed by ``schema``.

    Files are read by lines, in parts, so that a journal may be of any size.
    """
    found = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.json").text(root).select(lines.place().alias("place"), "value")
    articles = lines.numbered(found.where(~F.col("value").isin(HEAD, TAIL, "")), "position")
    # The path is that of a URI.
    slug = F.url_decode(F.replace(F.regexp_extract("place.file", r"([^/]+)\.json$", 1), F.lit("+"), F.lit("%2B")))
    text = F.regexp_replace("value", ",$", "")
    return articles.select(slug.alias("slug"), "position", (F.from_json(text, schema, {"mode": "FAILFAST"}) if schema else text).alias("article"))
