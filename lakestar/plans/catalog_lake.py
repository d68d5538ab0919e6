"""The catalogue's queries of the lakehouse plan: landing to bronze, silver and gold over records made of the customers, and table operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakestar.functions import hashing
from lakestar.operators import dims, relational
from lakestar.plans import gold, lakehouse
from lakestar.plans.catalog import _ROLES, _SCD2, _base, _roles, _scratch, _t, _versions, query
from lakestar.sources import landing
from lakestar.sources.table import Clause, MergeCounts, MergeMismatch, VersionedTable, self_healing, upsert


# -- dimensions and keys ------------------------------------------------------------------------------------------------
def _silver_issues(spark, sf_dir) -> DataFrame:
    """Silver columns that the issue dimension reads, from the orders: issues of customers, some without an address."""
    k = F.col("o_custkey")
    text = lambda c: F.concat(*(x.cast("string") if not isinstance(x, str) else F.lit(x) for x in c))
    return _t(spark, sf_dir, "orders").select(
        text(("p", k % 3)).alias("publisher"), F.when(k % 50 != 0, text(("/vol/", k % 50))).alias("issue_url"), text(("/j", k % 5)).alias("journal_url"), F.col("o_orderkey").cast("string").alias("volume"), F.col("o_orderstatus").alias("issue"),
        F.col("o_orderkey").cast("int").alias("volume_num"), F.lit(None).cast("int").alias("issue_num"), F.year("o_orderdate").alias("issue_pub_year"), F.month("o_orderdate").alias("issue_pub_month"), F.lit(None).cast("int").alias("issue_pub_day"),
        F.lit("month").alias("issue_date_precision"), F.trunc("o_orderdate", "month").alias("issue_pub_month_start"), F.col("o_orderdate").alias("last_changed_at"), F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("url_hash"),
    )


@query("""with s as (select 'p' || (o_custkey % 3) as publisher, case when o_custkey % 50 <> 0 then '/vol/' || (o_custkey % 50) end as issue_url, '/j' || (o_custkey % 5) as journal_url, o_orderkey, o_orderstatus, o_orderdate from orders)
select publisher, issue_url, journal_url, cast(o_orderkey as varchar) as volume, o_orderstatus as issue, cast(o_orderkey as int) as volume_num, cast(year(o_orderdate) as int) as issue_pub_year, cast(month(o_orderdate) as int) as issue_pub_month, 'month' as issue_date_precision, cast(date_trunc('month', o_orderdate) as date) as issue_pub_month_start, false as is_unknown
from s where issue_url is not null qualify row_number() over (partition by publisher, issue_url order by o_orderdate desc, lpad(cast(o_orderkey as varchar), 12, '0') desc) = 1
union all select 'Unknown', 'Unknown', 'Unknown', 'Unknown', 'Unknown', null, null, null, 'Unknown', null, true""")
def r69_issue_dim(spark, sf_dir):
    dim = gold.issues(_silver_issues(spark, sf_dir))
    return dim.select("publisher", "issue_url", "journal_url", "volume", "issue", "volume_num", "issue_pub_year", "issue_pub_month", "issue_date_precision", "issue_pub_month_start", (F.col("issue_sk") == -1).alias("is_unknown"))


@query(_SCD2 + """, facts as (select e.event_id, e.user_id, v.event_type as then_type from events e join versions v on e.user_id = v.user_id and e.ts >= effective_from and e.ts < effective_to),
now as (select user_id, event_type as now_type from versions where effective_to = timestamp '9999-12-31') select now_type, then_type, count(*) as n from facts join now using (user_id) group by all""")
def r71_current_version(spark, sf_dir):
    """Facts by the label their dimension row has now, against the one it had at their time."""
    versions = _versions(spark, sf_dir)
    facts = relational.asof_scan(_t(spark, sf_dir, "events").select("event_id", "user_id", "ts"), versions.withColumnRenamed("event_type", "then_type").drop("is_current"), ["user_id"], "ts")
    now = versions.where("is_current").select("user_id", F.col("event_type").alias("now_type"))
    return facts.where("then_type is not null").join(now, "user_id").groupBy("now_type", "then_type").agg(F.count("*").alias("n"))


@query(f"select (select sum(c)::bigint from (select count(*) as c from ({_ROLES}) group by l_orderkey)) as expected, (select count(*) from ({_ROLES})) as links")
def r73_bridge_balance(spark, sf_dir):
    rows = _roles(spark, sf_dir)
    arrays = rows.groupBy("l_orderkey").agg(F.collect_list("name_key").alias("names"))
    return dims.expected_rows(arrays, ("names",)).join(F.broadcast(rows.agg(F.count("*").alias("links"))))


@query("select array_to_string(list_sort(list(distinct c_mktsegment)), ',') as segments, count(distinct c_mktsegment) as n from customer")
def r76_sorted_collect(spark, sf_dir):
    segments = _t(spark, sf_dir, "customer").select("c_mktsegment").distinct()
    return segments.agg(F.array_join(F.sort_array(F.collect_list("c_mktsegment")), ",").alias("segments"), F.count("*").alias("n"))


@query("""select c_mktsegment, count(*) filter (where c_custkey % 2 = 1) <> 1 as wrong, count(*) filter (where c_custkey % 2 = 1) as current_rows from customer group by c_mktsegment""")
def r78_current_rows(spark, sf_dir):
    found = _t(spark, sf_dir, "customer").groupBy("c_mktsegment").agg(F.count(F.when(F.col("c_custkey") % 2 == 1, 1)).alias("current_rows"))
    return found.withColumn("wrong", F.col("current_rows") != 1)


# -- tables ---------------------------------------------------------------------------------------------------------------
@query("""select o_orderkey, o_custkey, o_orderstatus from orders""")
def r70_self_healing(spark, sf_dir):
    """Rows altered under a right hash, rows with an old hash, and new rows: all end as the source has them."""
    rows = _t(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    source = rows.withColumn("_row_hash", hashing.row_hash(*rows.columns))
    tampered = F.when(F.col("o_orderkey") % 7 == 0, "tampered").otherwise(F.col("o_orderstatus"))
    stale = F.when(F.col("o_orderkey") % 5 == 0, "old").when(F.col("o_orderkey") % 11 != 0, F.col("_row_hash"))
    table = VersionedTable(spark, _scratch(spark, "r70")).create(source.schema)
    table.append(source.where("o_orderkey % 3 <> 0").withColumns({"o_orderstatus": tampered, "_row_hash": stale}))
    table.merge(source, ["o_orderkey"], self_healing(rows.columns))
    after = table.read()
    return after.where(F.col("_row_hash") == hashing.row_hash(*rows.columns)).drop("_row_hash")


@query("""with n as (select count(*) filter (where o_orderkey % 2 = 1 and o_orderkey % 3 = 0) as i, count(*) filter (where o_orderkey % 6 = 0) as u, count(*) filter (where o_orderkey % 2 = 0 and o_orderkey % 3 <> 0 and o_orderstatus = 'P') as d, count(*) filter (where o_orderkey % 2 = 0) as before from orders)
select 'insert' as action, i as planned, i as observed, before + i - d as rows_after, true as refused from n union all select 'update', u, u, before + i - d, true from n union all select 'delete', d, d, before + i - d, true from n""")
def r100_merge_observed(spark, sf_dir):
    """A merge's plan beside what was counted while it was written; ``refused``: a wrong plan of it raised before and left the table as it was."""
    table, orders = _base(spark, sf_dir, "r100")
    batch = orders.where("o_orderkey % 3 = 0").withColumn("o_orderstatus", F.lit("U"))
    clauses = [*upsert("not (target.o_orderstatus <=> source.o_orderstatus)"), Clause("delete", "not_matched_by_source", "target.o_orderstatus = 'P'")]
    before, refused = table.version(), False
    try:
        table.merge(batch, ["o_orderkey"], clauses, planned=MergeCounts(inserted=1))
    except MergeMismatch:
        refused = table.version() == before
    m = table.merge(batch, ["o_orderkey"], clauses)
    seen = spark.createDataFrame([("insert", m.planned.inserted, m.inserted), ("update", m.planned.updated, m.updated), ("delete", m.planned.deleted, m.deleted)], "action string, planned long, observed long")
    return seen.crossJoin(F.broadcast(table.read().agg(F.count("*").alias("rows_after")))).withColumn("refused", F.lit(refused))


@query("""select 0::bigint as version, 'CREATE TABLE' as operation, 0::bigint as n from orders having count(*) >= 0 union all select 1, 'WRITE', count(*) filter (where o_orderkey % 2 = 0) from orders union all select 2, 'WRITE', count(*) from orders
 union all select 3, 'WRITE', count(*) filter (where o_orderkey % 5 = 0) from orders union all select 4, 'WRITE', count(*) filter (where o_orderkey % 5 = 0 and o_orderstatus <> 'F') + 1 from orders""")
def r95_history(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    table = VersionedTable(spark, _scratch(spark, "r95")).create("o_orderkey long, o_orderstatus string")
    table.append(orders.where("o_orderkey % 2 = 0"))
    table.append(orders.where("o_orderkey % 2 = 1"), files=1)
    table.overwrite(orders.where("o_orderkey % 5 = 0"))
    table.replace_where(spark.createDataFrame([(-1, "F")], "o_orderkey long, o_orderstatus string"), "o_orderstatus = 'F'")
    counts = [table.read(v).agg(F.lit(v).cast("long").alias("version"), F.count("*").alias("n")) for v in range(table.version() + 1)]
    rows = counts[0]
    for more in counts[1:]:
        rows = rows.union(more)
    return table.history().join(rows, "version").select("version", "operation", "n")


# -- bronze, silver, gold -----------------------------------------------------------------------------------------------
def _records(spark, sf_dir) -> DataFrame:
    """Landed records of the customers: two runs each, the second of which changes some titles and breaks some records."""
    k = F.col("c_custkey")
    text = lambda *c: F.concat(*(x if not isinstance(x, str) else F.lit(x) for x in c))
    key = F.lpad(k.cast("string"), 8, "0")
    second = F.col("run") == 2
    made = dict.fromkeys((*lakehouse.TEXT_COLUMNS, *lakehouse.PROVENANCE), F.lit(""))
    made |= {
        "url_hash": key, "publisher": F.lit("pub"), "source_url": text("https://x/", key), "payload_hash": text("h", key), "run_id": text("run-", F.col("run").cast("string")),
        "scraped_at": F.when(second, "2024-02-01T00:00:00Z").otherwise("2024-01-01T00:00:00Z"), "article_url": text("https://x/a/", key), "journal_url": text("https://x/j", (k % 7).cast("string")),
        "journal_title": F.when(second, text("New ", (k % 7).cast("string"))).otherwise(text("Old ", (k % 7).cast("string"))), "issue_url": F.when(k % 4 != 0, text("https://x/i", (k % 40).cast("string"))).otherwise(""),
        "english_title": F.when(second & (k % 6 == 0), "").otherwise(text(" On  ", F.col("c_name"))), "doi": F.when(k % 5 == 0, "").otherwise(text("https://doi.org/10.1234/", key)), "article_type": F.when(k % 3 == 0, "Case Report").when(k % 3 == 1, "Book review").otherwise(""),
        "volume": F.when(k % 8 == 0, "+5").otherwise("7"), "reference_count": F.when(k % 9 == 0, "x").otherwise("12"), "author_keyword": F.lit("a|b||a"), "article_publication_month": F.lit("June"), "article_publication_year": F.lit("2023"),
    }
    person = lambda name: F.struct(name.alias("name"), F.lit("Uni").alias("affiliation"), F.lit("").alias("email"))
    people = F.array(person(text("Ann ", (k % 100).cast("string"))), person(F.lit("B. Cee")))
    roles = {"authors": F.when(k % 10 == 0, F.slice(people, 1, 0)).otherwise(people), "editors": F.slice(people, 1, 1), "corporate_authors": F.slice(people, 1, 0)}
    rows = relational.spread(_t(spark, sf_dir, "customer"), "c_custkey").select("c_custkey", "c_name", F.explode(F.array(F.lit(1), F.lit(2))).alias("run")).where("run = 1 or c_custkey % 2 = 0")
    empty = F.array().cast("array<struct<text:string,bold:boolean,italic:boolean,superscript:boolean,subscript:boolean>>")
    return rows.select(*(made[c].alias(c) for c in lakehouse.TEXT_COLUMNS), *(c.alias(n) for n, c in roles.items()), *(empty.alias(n) for n in lakehouse.RICH_COLUMNS), *(made[c].alias(c) for c in lakehouse.PROVENANCE), F.when(second, "2024-02-01").otherwise("2024-01-01").alias("ingest_date"))


def _lake(spark, sf_dir, name: str, upto: str) -> dict[str, VersionedTable]:
    root = _scratch(spark, name)
    tables = {n: VersionedTable(spark, f"{root}/{n}") for n in ("bronze", "silver", "quarantine", "dq", *gold.TABLES)}
    landing.write_jsonl(_records(spark, sf_dir), f"{root}/landing", flush=5000)
    lakehouse.load_bronze(spark, f"{root}/landing", tables["bronze"], "pub", "2024-03-01T00:00:00Z")
    if upto != "bronze":
        lakehouse.build_silver(tables["bronze"], tables["silver"], tables["quarantine"], tables["dq"], "dq-1", "2024-03-01T00:00:00Z")
    if upto == "gold":
        gold.build_gold(spark, tables["silver"].read(), tables)
    return tables


@query("""select lpad(cast(c_custkey as varchar), 8, '0') as url_hash, 'run-' || run as run_id, case when run = 2 then date '2024-02-01' else date '2024-01-01' end as ingest_date, 'raw_html/pub/' || case when run = 2 then '2024-02-01' else '2024-01-01' end || '/' || lpad(cast(c_custkey as varchar), 8, '0') || '.html.gz' as raw_html_key,
  case when run = 2 then timestamp '2024-02-01' else timestamp '2024-01-01' end as scraped_at, true as has_file from customer, (values (1), (2)) r(run) where run = 1 or c_custkey % 2 = 0""")
def r96_bronze_load(spark, sf_dir):
    rows = _lake(spark, sf_dir, "r96", "bronze")["bronze"].read()
    return rows.select("url_hash", "run_id", "ingest_date", "raw_html_key", "scraped_at", F.col("_source_file").contains("ingest_date=").alias("has_file"))


@query("""with r as (select c_custkey as k, c_name, run from customer, (values (1), (2)) r(run) where run = 1 or c_custkey % 2 = 0), v as (select * from r where not (run = 2 and k % 6 = 0)), latest as (select k, any_value(c_name) as c_name, max(run) as run from v group by k)
select lpad(cast(k as varchar), 8, '0') as url_hash, 'On ' || c_name as english_title, case when k % 5 <> 0 then '10.1234/' || lpad(cast(k as varchar), 8, '0') end as doi, k % 5 <> 0 as doi_valid, case when k % 8 <> 0 then 7 end as volume_num, case when k % 9 <> 0 then 12 end as reference_count, case k % 3 when 0 then 'case_report' when 1 then 'book_review' end as article_type_key,
  cast(case when k % 2 = 0 then 2 else 1 end as int) as version_count, timestamp '2024-01-01' as first_seen_at, 'run-' || run as latest_run_id, concat_ws(',', case when k % 5 = 0 then 'missing_doi' end, case when k % 10 = 0 then 'no_authors' end, 'missing_abstract', case when k % 9 = 0 then 'bad_reference_count' end) as flags from latest""")
def r97_silver_build(spark, sf_dir):
    rows = _lake(spark, sf_dir, "r97", "silver")["silver"].read()
    return rows.select("url_hash", "english_title", "doi", "doi_valid", "volume_num", "reference_count", "article_type_key", "version_count", "first_seen_at", "latest_run_id", F.concat_ws(",", "dq_flags").alias("flags"))


@query("""with r as (select c_custkey as k, run from customer, (values (1), (2)) r(run) where run = 1 or c_custkey % 2 = 0), silver as (select distinct k from r where not (run = 2 and k % 6 = 0)), authors as (select 'Ann ' || (k % 100) as a from silver union all select 'B. Cee' from silver where k % 10 <> 0)
select 'dim_date' as t, 13150::bigint as n union all select 'dim_article_type', 1 + count(distinct k % 3) filter (where k % 3 <> 2) from silver union all select 'dim_journal', 1 + count(distinct k % 7) from silver union all select 'dim_issue', 1 + count(distinct k % 40) filter (where k % 4 <> 0) from silver
 union all select 'dim_author', 1 + count(distinct a) from authors union all select 'fact_article', count(*) from silver union all select 'bridge_article_author', sum(case when k % 10 = 0 then 1 else 3 end)::bigint from silver""")
def r98_gold_build(spark, sf_dir):
    tables = _lake(spark, sf_dir, "r98", "gold")
    out = None
    for name in gold.TABLES:
        n = tables[name].read().agg(F.lit(name).alias("t"), F.count("*").alias("n"))
        out = n if out is None else out.union(n)
    return out


@query("""with r as (select c_custkey as k, run from customer, (values (1), (2)) r(run) where run = 1 or c_custkey % 2 = 0), silver as (select k, max(run) as run from r where not (run = 2 and k % 6 = 0) group by k)
select case k % 3 when 0 then 'research' when 1 then 'other_content' else 'unclassified' end as class, coalesce(case when k % 4 <> 0 then 'https://x/i' || (k % 40) end, 'Unknown') as issue_url, count(*) as n, count(*) filter (where k % 5 <> 0) as with_doi, sum(case when k % 10 = 0 then 0 else 2 end)::bigint as authors, 20230601 as month_sk, 20240101 as seen_sk from silver group by all""")
def r99_gold_star(spark, sf_dir):
    """The star read back: facts by class and issue."""
    t = {n: v.read() for n, v in _lake(spark, sf_dir, "r99", "gold").items() if n in gold.TABLES}
    star = t["fact_article"].join(t["dim_article_type"].select("article_type_sk", "content_class"), "article_type_sk").join(t["dim_issue"].select("issue_sk", "issue_url"), "issue_sk")
    star = star.groupBy(F.col("content_class").alias("class"), "issue_url")
    return star.agg(F.count("*").alias("n"), F.count("doi").alias("with_doi"), F.sum("author_count").alias("authors"), F.max("pub_month_date_sk").alias("month_sk"), F.max("first_seen_date_sk").alias("seen_sk"))


@query("""select o_orderstatus, o_orderkey, seen from (select o_orderstatus, o_orderkey, o_orderdate as seen, row_number() over (partition by o_orderstatus order by o_orderdate desc, o_orderkey desc) as rn from orders) where rn <= 3""")
def r99_samples(spark, sf_dir):
    """A few newest rows of each status, as samples of a build are shown."""
    rows = _t(spark, sf_dir, "orders").select("o_orderstatus", "o_orderkey", F.col("o_orderdate").alias("seen"))
    w = Window.partitionBy("o_orderstatus").orderBy(F.desc("seen"), F.desc("o_orderkey"))
    return rows.withColumn("rn", F.row_number().over(w)).where("rn <= 3").drop("rn")
