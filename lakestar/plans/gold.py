"""Gold of the article lakehouse: five dimensions, one fact and a weighted bridge, built from the generic operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.functions import dates, hashing
from lakestar.operators import dims, relational
from lakestar.sources.table import Clause, MergeResult, VersionedTable, upsert

ARTICLE_KEY = ["publisher", "url_hash"]
TABLES = ("dim_date", "dim_article_type", "dim_journal", "dim_issue", "dim_author", "fact_article", "bridge_article_author")
#: Article classes by type key; the first two are scholarly.
CLASSES = {
    "research": ("research_article", "short_communication", "case_report", "original_article", "brief_report", "data_article"),
    "review": ("review_article", "mini_review", "systematic_review"),
    "opinion": ("editorial", "correspondence", "letter", "commentary", "perspective", "viewpoint", "discussion"),
    "correction": ("erratum", "correction", "retraction"),
    "other_content": ("book_review", "news", "obituary", "miscellaneous"),
    "front_back_matter": ("contents_list", "calendar", "editorial_board", "index", "announcement"),
}
SCHOLARLY = ("research", "review")
#: Columns of the issue dimension, fact and bridge, in order.
ISSUE_COLUMNS = ("publisher", "issue_url", "journal_url", "volume", "issue", "volume_num", "issue_num", "issue_pub_year", "issue_pub_month", "issue_pub_day", "issue_date_precision", "issue_pub_month_start")
JOURNAL = "journal_sk long, publisher string, journal_url string, journal_title string, effective_from timestamp, effective_to timestamp, is_current boolean, _attr_hash string"
FOREIGN_KEYS = {
    "fact_article": {"journal_sk": "dim_journal", "issue_sk": "dim_issue", "article_type_sk": "dim_article_type", "pub_month_date_sk": "dim_date", "first_seen_date_sk": "dim_date"},
    "bridge_article_author": {"article_sk": "fact_article", "author_sk": "dim_author"},
}
KEYS = {"dim_date": "date_sk", "dim_article_type": "article_type_sk", "dim_journal": "journal_sk", "dim_issue": "issue_sk", "dim_author": "author_sk", "fact_article": "article_sk"}
NATURAL = {"dim_date": ("date",), "dim_article_type": ("article_type_key",), "dim_issue": ("publisher", "issue_url"), "dim_author": ("author_nk",), "fact_article": ("publisher", "url_hash")}
#: What tells the latest of several articles.
RECENT = ["last_changed_at", "url_hash"]
BRIDGE_KEY = ["article_sk", "role", "author_position"]


def _latest() -> list[Column]:
    return [F.desc(c) for c in RECENT]


def classify(type_key: Column) -> Column:
    """The class of an article type key; "unclassified" for others and null."""
    table = F.create_map(*(F.lit(x) for cls, keys in CLASSES.items() for k in keys for x in (k, cls)))
    return F.coalesce(F.element_at(table, type_key), F.lit("unclassified"))


def classify_key(type_key: str | None) -> tuple[str, bool]:
    """Class of one type key, and whether it is scholarly; for callers without Spark."""
    found = next((cls for cls, keys in CLASSES.items() if type_key in keys), "unclassified")
    return found, found in SCHOLARLY


def article_types(silver: DataFrame) -> DataFrame:
    """One row per type key with its latest label, class and whether that is scholarly, and the unknown member."""
    latest = relational.latest_per_key(silver.where("article_type_key is not null"), ["article_type_key"], _latest())
    rows = latest.select(hashing.surrogate_key("article_type_key").alias("article_type_sk"), "article_type_key", "article_type", classify(F.col("article_type_key")).alias("content_class"))
    rows = rows.withColumn("is_scholarly", F.col("content_class").isin(*SCHOLARLY))
    return dims.with_unknown(rows, {"article_type_sk": -1, "article_type_key": "Unknown", "article_type": "Unknown", "content_class": "unclassified", "is_scholarly": False})


def issues(silver: DataFrame) -> DataFrame:
    """One row per issue, from its latest article, and the unknown member."""
    latest = relational.latest_per_key(silver.where("issue_url is not null"), ["publisher", "issue_url"], _latest())
    rows = latest.select(hashing.surrogate_key("publisher", "issue_url").alias("issue_sk"), *ISSUE_COLUMNS)
    return dims.with_unknown(rows, {"issue_sk": -1} | dict.fromkeys(("publisher", "issue_url", "journal_url", "volume", "issue", "issue_date_precision"), "Unknown"))


def authors(roles: DataFrame) -> DataFrame:
    """One row per normalised name with its latest attributes and first sight, and the unknown member; one shuffle."""
    rows = relational.latest_with(roles, ["name_key"], [*RECENT, "role", "position"], {"_first": F.min("first_seen_at")})
    rows = rows.select(hashing.surrogate_key("name_key").alias("author_sk"), F.col("name_key").alias("author_nk"), F.col("entry.name").alias("display_name"), F.col("entry.affiliation").alias("latest_affiliation"), F.col("entry.email").alias("latest_email"), F.col("_first").alias("first_seen_at"))
    return dims.with_unknown(rows, {"author_sk": -1, "author_nk": "Unknown", "display_name": "Unknown"})


def collisions(rows: DataFrame, table: DataFrame, key: str, natural: tuple[str, ...]) -> DataFrame:
    """Rows (key, natural columns, and as ``table_...`` the table's) whose surrogate key the table has for another natural key."""
    old = table.select(F.col(key).alias("_key"), *(F.col(c).alias(f"table_{c}") for c in natural))
    other = reduce(lambda a, c: a | ~F.col(c).eqNullSafe(F.col(f"table_{c}")), natural, F.lit(False))
    return rows.select(key, *natural).join(old, F.col(key) == F.col("_key")).where(other).drop("_key")


def merge_type1(table: VersionedTable, rows: DataFrame, key: str, natural: tuple[str, ...] = ()) -> MergeResult:
    """Type-1 upsert by surrogate key; a key that two natural keys share, in ``rows`` or with the table, raises."""
    table.create(rows.schema)
    if not relational.duplicate_keys(rows, [key]).isEmpty():
        raise ValueError(f"{key}: surrogate keys collide")
    if natural and not collisions(rows, table.read(), key, natural).isEmpty():
        raise ValueError(f"{key}: surrogate keys collide with the table's")
    changed = " or ".join(f"not (target.{c} <=> source.{c})" for c in rows.columns if c != key)
    return table.merge(rows, [key], upsert(changed))


def merge_journals(journals: VersionedTable, silver: DataFrame) -> MergeResult:
    """Type-2 merge of journal titles; new journals begin at their first sight, changed ones at the change."""
    key = ["publisher", "journal_url"]
    if not journals.exists():
        journals.create(JOURNAL)
        high = F.lit(dates.HIGH_DATE).cast("timestamp")
        unknown = silver.sparkSession.range(1).select(F.lit(-1).cast("long").alias("journal_sk"), *(F.lit("Unknown").alias(c) for c in (*key, "journal_title")), F.lit("2000-01-01").cast("timestamp").alias("effective_from"), high.alias("effective_to"), F.lit(True).alias("is_current"), F.lit("Unknown").alias("_attr_hash"))
        journals.append(unknown)
    now = relational.latest_with(silver.where("journal_url is not null"), key, RECENT, {"_first": F.min("first_seen_at")})
    known = journals.read().where("journal_sk <> -1")
    seen = known.select(*key).distinct().withColumn("_known", F.lit(True))
    attributes = hashing.row_hash("journal_title").alias("_attr_hash")
    now = now.join(seen, key, "left").select(*key, "journal_title", attributes, F.when(F.col("_known"), F.col("last_changed_at")).otherwise(F.col("_first")).alias("at"))
    staged = dims.scd2_changes(known, now, key, ["_attr_hash"], "at", ["journal_title"])
    high = F.lit(dates.HIGH_DATE).cast("timestamp")
    only_match = [F.when(F.col("match"), F.col(k)).alias(k) for k in key]
    staged = staged.select(*only_match, F.col("publisher").alias("p"), F.col("journal_url").alias("j"), "journal_title", "_attr_hash", "effective_from", high.alias("high"))
    values = {"journal_sk": "xxhash64(source.p, source.j, source.effective_from)", "publisher": "source.p", "journal_url": "source.j", "journal_title": "source.journal_title", "effective_from": "source.effective_from", "effective_to": "source.high", "is_current": "true", "_attr_hash": "source._attr_hash"}
    return journals.merge(staged, key, [Clause("update", "matched", "target.is_current", {"effective_to": "source.effective_from", "is_current": "false"}), Clause("insert", "not_matched", "true", values)])


def facts(silver: DataFrame, journals: DataFrame, issue: DataFrame, types: DataFrame) -> DataFrame:
    """One row per article: the journal version of its time, lookups with unknown members, measures and row hash."""
    versions = journals.where("journal_sk <> -1").select("journal_sk", "publisher", "journal_url", "effective_from", "effective_to")
    # Versions that overlap would leave it open which of them an article has; the dimension is the smaller side to ask.
    if not relational.overlaps(versions, ["publisher", "journal_url"]).isEmpty():
        raise ValueError("overlapping journal versions")
    if not relational.duplicate_keys(silver, ARTICLE_KEY).isEmpty():
        raise ValueError("articles held twice")
    rows = relational.asof_scan(silver, versions, ["publisher", "journal_url"], "last_changed_at", every="month")
    none = F.raise_error(F.concat(F.lit("an article without a journal version of its time: "), F.coalesce("publisher", F.lit("null")), F.lit(" "), F.coalesce("url_hash", F.lit("null"))))
    rows = rows.withColumn("journal_sk", F.coalesce("journal_sk", none.cast("long")))
    rows = relational.lookup(rows, types, "article_type_key", "article_type_key", "article_type_sk")
    issue = issue.select("publisher", "issue_url", F.col("issue_sk").alias("_issue"))
    rows = rows.join(issue, ["publisher", "issue_url"], "left").withColumn("issue_sk", F.coalesce("_issue", F.lit(-1).cast("long")))
    month = F.when(F.col("article_date_precision").isin("day", "month"), F.col("article_pub_month_start"))
    rows = rows.select(
        hashing.surrogate_key("publisher", "url_hash").alias("article_sk"), "journal_sk", "issue_sk", "article_type_sk", dates.date_key(month).alias("pub_month_date_sk"), dates.date_key(F.col("first_seen_at")).alias("first_seen_date_sk"),
        F.lit(1).alias("article_count"), "reference_count", "page_count", "author_count", F.size("keywords").alias("keyword_count"), F.col("version_count").cast("int").alias("version_count"), F.size("dq_flags").alias("dq_flag_count"),
        "publisher", "url_hash", "doi", "english_title", "article_url", F.col("article_pub_year").alias("pub_year"), F.col("article_date_precision").alias("pub_date_precision"), "license_code", "has_cc_license",
    )
    return rows.withColumn("_row_hash", hashing.row_hash(*rows.columns))


def bridge(roles: DataFrame) -> DataFrame:
    """One row per article, role and position, weighing 1 / the role's size, with row hash."""
    rows = dims.bridge(roles).select(
        hashing.surrogate_key("publisher", "url_hash").alias("article_sk"), hashing.surrogate_key("name_key").alias("author_sk"), "role", F.col("position").alias("author_position"),
        F.col("entry.affiliation").alias("affiliation_at_publication"), F.col("entry.email").alias("email_at_publication"), "weight", "publisher",
    )
    return rows.withColumn("_row_hash", hashing.row_hash(*rows.columns))


def build_gold(spark: SparkSession, silver: DataFrame, tables: dict[str, VersionedTable]) -> dict[str, MergeResult]:
    """All of TABLES from a silver table, in order; validated after the merges."""
    out = {"dim_date": merge_type1(tables["dim_date"], dims.date_dim(spark), "date_sk", NATURAL["dim_date"])}
    out["dim_article_type"] = merge_type1(tables["dim_article_type"], article_types(silver), "article_type_sk", NATURAL["dim_article_type"])
    out["dim_journal"] = merge_journals(tables["dim_journal"], silver)
    out["dim_issue"] = merge_type1(tables["dim_issue"], issues(silver), "issue_sk", NATURAL["dim_issue"])
    roles = dims.explode_roles(silver, [*ARTICLE_KEY, "first_seen_at", "last_changed_at"], {"author": "authors", "editor": "editors", "corporate": "corporate_authors"})
    out["dim_author"] = merge_type1(tables["dim_author"], authors(roles), "author_sk", NATURAL["dim_author"])
    rows = facts(silver, tables["dim_journal"].read(), tables["dim_issue"].read(), tables["dim_article_type"].read())
    tables["fact_article"].create(rows.schema, ("publisher",))
    out["fact_article"] = merge_type1(tables["fact_article"], rows, "article_sk", NATURAL["fact_article"])
    links = bridge(roles)
    if not relational.duplicate_keys(links, BRIDGE_KEY).isEmpty():
        raise ValueError("a bridge key is held twice")
    publishers = [r.publisher for r in silver.select("publisher").distinct().collect()]
    quoted = ", ".join("'" + p.replace("'", "''") + "'" for p in publishers)
    stale = " or ".join(f"not (target.{c} <=> source.{c})" for c in links.columns if c not in BRIDGE_KEY)
    clauses = [*upsert(stale), Clause("delete", "not_matched_by_source", f"target.publisher in ({quoted})" if publishers else "false")]
    out["bridge_article_author"] = tables["bridge_article_author"].create(links.schema, ("publisher",)).merge(links, BRIDGE_KEY, clauses)
    check_gold(silver, tables)
    return out


def star_violations(silver: DataFrame, tables: dict[str, VersionedTable]) -> DataFrame:
    """One row: how many rows break each invariant of the star."""
    read = {n: t.read() for n, t in tables.items()}
    fact, links, journals = read["fact_article"], read["bridge_article_author"], read["dim_journal"]
    checks = {f"keys_{n}": relational.duplicate_keys(read[n], [k]) for n, k in KEYS.items()}
    checks |= {f"unknown_{n}": read[n].agg(F.count(F.when(F.col(k) == -1, 1)).alias("n")).where("n <> 1") for n, k in KEYS.items() if n.startswith("dim_")}
    checks |= {f"orphans_{n}_{fk}": relational.orphans(read[n], read[d], fk, KEYS[d]) for n, fks in FOREIGN_KEYS.items() for fk, d in fks.items()}
    one = lambda df, name: df.agg(F.count("*").alias(name))
    entries = dims.expected_rows(silver, ("authors", "editors", "corporate_authors"))
    current = journals.groupBy("publisher", "journal_url").agg(F.count(F.when(F.col("is_current"), 1)).alias("n")).where("n <> 1")
    return dims.validate(checks | {
        "facts": one(fact, "facts").join(F.broadcast(one(silver, "articles"))).where("facts <> articles"), "bridge_keys": relational.duplicate_keys(links, BRIDGE_KEY), "current": current,
        "empty_versions": journals.where("effective_from >= effective_to"), "overlapping_versions": relational.overlaps(journals, ["publisher", "journal_url"]),
        "weights": dims.weight_errors(links, ["article_sk", "role"]), "bridge_rows": one(links, "links").join(F.broadcast(entries)).where("links <> expected"),
    })


def check_gold(silver: DataFrame, tables: dict[str, VersionedTable]) -> None:
    """Raises if the star breaks an invariant."""
    wrong = {k: n for k, n in star_violations(silver, tables).first().asDict().items() if n}
    if wrong:
        raise ValueError(f"the star is broken: {wrong}")
