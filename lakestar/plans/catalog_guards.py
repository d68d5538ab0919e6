"""The catalogue's queries of what guards find and of whole procedures: key collisions, landing gates, publication, the command line."""

from __future__ import annotations

import atexit
import contextlib
import io
import shutil
import tempfile

from pyspark.sql import functions as F

from lakestar.operators import relational
from lakestar.plans import gold
from lakestar.plans.catalog import _scratch, _t, query
from lakestar.plans.catalog_lake import _records
from lakestar.sources import export, landing
from lakestar.sources.publish import Warehouse, publish_logged
from lakestar.sources.table import VersionedTable, upsert


@query("select c_custkey as sk, c_name as nk, c_name || '!' as table_nk, true as refused from customer where c_custkey % 50 = 0")
def r106_key_collisions(spark, sf_dir):
    """Surrogate keys that the table has for another natural key; a merge of such rows is refused."""
    rows = _t(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("sk"), F.col("c_name").alias("nk"))
    table = VersionedTable(spark, _scratch(spark, "r106")).create(rows.schema)
    table.append(rows.withColumn("nk", F.when(F.col("sk") % 50 == 0, F.concat("nk", F.lit("!"))).otherwise(F.col("nk"))))
    found, refused = gold.collisions(rows, table.read(), "sk", ("nk",)), False
    try:
        gold.merge_type1(table, rows, "sk", ("nk",))
    except ValueError:
        refused = table.version() == 1
    return found.withColumn("refused", F.lit(refused))


@query("""select 'dim_segment' as table_name, count(distinct c_mktsegment) as live, count(distinct c_mktsegment) as pinned, 1::bigint as version, 'failed,success' as runs from customer
union all select 'fact_customer', count(*), count(*), 1, 'failed,success' from customer""")
def r107_publication(spark, sf_dir):
    """A star in an embedded database of this process, on its own disk: published once, skipped, then refused with an orphan in it; the first is live."""
    root, customer = _scratch(spark, "r107"), _t(spark, sf_dir, "customer")
    key = F.xxhash64("c_mktsegment")
    tables = {"dim_segment": customer.select(key.alias("segment_sk"), F.col("c_mktsegment").alias("segment")).distinct(), "fact_customer": customer.select(F.col("c_custkey").cast("long").alias("customer_sk"), key.alias("segment_sk"))}
    stored = {name: VersionedTable(spark, f"{root}/{name}").create(rows.schema) for name, rows in tables.items()}
    for name, rows in tables.items():
        stored[name].append(rows)
    folder = tempfile.mkdtemp(prefix="lakestar-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    w, log = Warehouse(spark, f"jdbc:derby:{folder}/star;create=true"), VersionedTable(spark, f"{root}/log")
    keys, foreign = {"dim_segment": ["segment_sk"], "fact_customer": ["customer_sk"]}, {"fact_customer": {"segment_sk": ("dim_segment", "segment_sk")}}
    publish_logged(w, stored, keys, log, foreign=foreign)
    publish_logged(w, stored, keys, log, foreign=foreign)  # nothing moved: skipped, and not logged
    stored["fact_customer"].append(spark.createDataFrame([(-1, -1)], "customer_sk long, segment_sk long"))
    with contextlib.suppress(RuntimeError):
        publish_logged(w, stored, keys, log, foreign=foreign)
    live = spark.createDataFrame([(name, w.count(name)) for name in stored], "table_name string, live long")
    status = w.read("layer_status").select(F.col("TABLE_NAME").alias("table_name"), F.col("ROW_COUNT").alias("pinned"), F.col("TABLE_VERSION").alias("version"))
    runs = log.read().agg(F.array_join(F.sort_array(F.collect_list("status")), ",").alias("runs"))
    return live.join(status, "table_name").join(F.broadcast(runs))


@query("""with c as (select count(*) as n from customer) select step, n, 0 as code from c, unnest(['manifest', 'landed', 'bronze', 'silver', 'fact_article', 'exported', 'status']) t(step)""")
def r108_command_line(spark, sf_dir):
    """The commands from a listing to the export, over records of the customers: rows after each, and the worst exit code."""
    from lakestar.__main__ import main

    root = _scratch(spark, "r108")
    records = _records(spark, sf_dir).where("run_id = 'run-1'").withColumn("ordinal", F.col("url_hash").cast("long"))
    blank = lambda c: F.when(F.col(c) != "", F.col(c)).alias(c)
    listing = records.select("url_hash", F.col("article_url").alias("normalised_url"), F.lit("article").alias("url_type"), "ordinal", blank("doi"), "payload_hash", F.lit(200).alias("http_status"), F.lit("ok").alias("result"))
    listing.write.json(f"{root}/in/listing")
    records.drop("ingest_date").write.option("ignoreNullFields", "false").json(f"{root}/in/records")
    run = lambda command, *more: main([command, "--root", f"{root}/lake", "--publisher", "pub", *more])
    with contextlib.redirect_stdout(io.StringIO()):
        codes = [run("init"), run("producer", "--listing", f"{root}/in/listing", "--records", f"{root}/in/records")]
        codes += [run(c) for c in ("bronze", "silver", "gold", "export", "smoke")]
    table = lambda n: VersionedTable(spark, f"{root}/lake/{n}").read()
    rows = {"manifest": table("manifest").where("status = 'ok'"), "landed": landing.scan_jsonl(spark, f"{root}/lake/landing/pub", "url_hash string"), "exported": export.read_documents(spark, f"{root}/lake/out/pub")}
    rows |= {"bronze": table("bronze"), "silver": table("silver"), "fact_article": table("gold/fact_article")}
    counts = [df.agg(F.lit(step).alias("step"), F.count("*").alias("n")) for step, df in rows.items()] + [table("ops/status").agg(F.lit("status").alias("step"), F.sum("row_count").alias("n"))]
    out = counts[0]
    for more in counts[1:]:
        out = out.union(more)
    return out.withColumn("code", F.lit(max(codes)))


@query("""with e as (select * from events) select 'no landing' as guard, true as refused, 0::bigint as bad from e having count(*) >= 0 union all select 'bad times', true, count(*) filter (where value < 50) from e
union all select 'other publisher', true, count(*) filter (where event_type = 'click') from e union all select 'keys held twice', true, count(*) filter (where n > 1) from (select count(*) as n from e group by user_id)
union all select 'append only', true, count(*) filter (where value < 50) from e union all select 'good batch', false, 0 from e having count(*) >= 0""")
def r109_landing_gates(spark, sf_dir):
    """Each gate over a batch of the events that breaks it: whether it refused, and how many rows or keys were bad."""
    events, root = _t(spark, sf_dir, "events"), _scratch(spark, "r109")
    good = events.select(F.concat(F.lit("h"), F.col("event_id").cast("string")).alias("url_hash"), F.lit("p").alias("publisher"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"), F.col("ts").cast("date").alias("ingest_date"), "value", "event_type", "user_id")
    late, other = good.withColumn("at", F.when(F.col("value") < 50, "soon").otherwise(F.col("at"))), good.withColumn("publisher", F.when(F.col("event_type") == "click", "q").otherwise("p"))
    twice = good.withColumn("url_hash", F.concat(F.lit("u"), F.col("user_id").cast("string")))
    table = VersionedTable(spark, f"{root}/table").create("url_hash string, at string", properties={"appendOnly": "true"})
    table.append(good.select("url_hash", "at"))
    times, foreign = {"at": F.col("at").try_cast("timestamp").isNull()}, {"publisher": F.col("publisher") != "p"}
    count = lambda rows, rules: landing.violations(rows, rules, ["url_hash"]).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    batch = lambda rows: lambda: landing.check_batch(rows, ["url_hash"], "at", "p")
    none = spark.range(1).select(F.lit(0).cast("long").alias("n"))
    gates = {
        "no landing": (lambda: landing.scan_jsonl(spark, f"{root}/nowhere", "url_hash string"), none),
        "bad times": (batch(late), count(late, times)), "other publisher": (batch(other), count(other, foreign)),
        "keys held twice": (batch(twice), relational.duplicate_keys(twice, ["url_hash"]).agg(F.count("*").alias("n"))),
        "append only": (lambda: table.merge(late.select("url_hash", "at"), ["url_hash"], upsert("not (target.at <=> source.at)")), count(late, times)),
        "good batch": (batch(good), none),
    }
    out = None
    for name, (gate, bad) in gates.items():
        try:
            gate()
            refused = False
        except (ValueError, FileNotFoundError):
            refused = True
        row = bad.select(F.lit(name).alias("guard"), F.lit(refused).alias("refused"), F.col("n").cast("long").alias("bad"))
        out = row if out is None else out.union(row)
    return out
