"""The queries opN_<name> over the whole intended tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakestar.llm import clustering, ctw, decontam, divergence, jaccard, langid, licences, mixing, sadedup, secretscan, tokencount, topk, urlfilter
from lakestar.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

#: The url rules of op10: (verdict, host, path).
URL_RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.detect_languages(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.report(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokencount.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.neighbours(table(spark, sf_dir, "embeddings"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sadedup.deduplicate(table(spark, sf_dir, "documents"))


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(table(spark, sf_dir, "documents"))


def op9_ctw_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urlfilter.judge(pages, URL_RULES, urlfilter.train(word_counts=urlfilter.mixed(urlfilter.vocabulary(pages))))


def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster(table(spark, sf_dir, "embeddings"))


def op13_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.report(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_language_id, op2_secret_scan, op3_decontaminate, op4_token_counts, op5_topk, op6_suffix_dedup, op7_mix, op8_jaccard_join, op9_ctw_score, op10_url_filter, op11_divergence_audit, op12_clustering, op13_licence_scan)}


_OP3_SQL = r"""
with dw as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), iw as (
  select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), win as (
  select distinct item, least(len(w), 10) as n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') as g
  from (select item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) as i from iw where len(w) > 0)
), sizes as (select distinct n from win), grams as (
  select r, i, n, array_to_string(w[i : i + n - 1], ' ') as g
  from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from dw, sizes)
), hits as (select distinct r, i, g.n, g from grams g semi join win using (n, g)
), words as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from hits) group by r
), named as (select r, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct r, item from hits join win using (n, g) where item is not null) group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join words using (r) left join named using (r)
"""

_OP5_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0
), r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, cast(rank as int) as rank, vec_id, score from r where rank <= 5
"""


_OP8_SQL = r"""
with recursive d as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents
), g as (
  select distinct r, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') as g
  from (select r, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) as i from d where len(w) > 0)
), n as (select r, count(*) as n from g group by r),
links as (
  select a.r as a, b.r as b from g a join g b using (g) join n na on na.r = a.r join n nb on nb.r = b.r
  where a.r <> b.r group by a.r, b.r, na.n, nb.n having 100 * count(*) >= 75 * (na.n + nb.n - count(*))
), reach as (select r as a, r as b from d union select reach.a, links.b from reach join links on reach.b = links.a),
least as (select a as r, min(doc_id) as component_id from reach join d on d.r = b group by a)
select doc_id, cast(coalesce(n, 0) as bigint) as n_shingles, component_id from d left join n using (r) join least using (r)
"""


_OP11_SQL = r"""
with d as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w from documents
), g as (select distinct lang, source from d), t as (select r, lang, source, unnest(w) as term from d
), kept as (select lang, term from t group by lang, term having count(distinct r) >= 10
), v as (select lang, (select count(*) from kept where kept.lang = g.lang) as v from g group by lang
), c as (select lang, source, term, count(*) as n from t semi join kept using (lang, term) group by lang, source, term
), dense as (select g.lang, g.source, kept.term, coalesce(n, 0) as n from g join kept on g.lang = kept.lang left join c on c.lang = g.lang and c.source = g.source and c.term = kept.term
), mine as (
  select lang, source, term, n, 1 + (1000000000::hugeint * (n + 2)) // (sum(n) over (partition by lang, source) + 2 * v) as p from dense join v using (lang)
), whole as (
  select lang, term, 1 + (1000000000::hugeint * (n + 2)) // (sum(n) over (partition by lang) + 2 * v) as q
  from (select lang, term, sum(n) as n from dense group by lang, term) join v using (lang)
), pair as (
  select a.lang, a.source, b.source as item, coalesce(s, 0) as value from g a join g b on a.lang = b.lang and a.source <> b.source
  left join (select a.lang, a.source, b.source as other, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) as s
    from mine a join mine b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all) x on x.lang = a.lang and x.source = a.source and x.other = b.source
), term as (
  select lang, source, term as item, ((p - q) * (p - q)) // (p + q) as value from mine join whole using (lang, term) where n > 0 and p > q
), ranked as (
  select *, row_number() over (partition by lang, source, part order by value desc, item) as rank
  from (select lang, source, 'pair' as part, item, value from pair union all select lang, source, 'term', item, value from term)
)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as int) as rank from ranked where part = 'pair' or rank <= 10
"""


def _op12_sql(rounds: int = 3, k: int = 16) -> str:
    """One common table for each round's assignment and means."""
    far = "list_sum(list_transform(range(1, 65), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i])))"
    parts = [f"""with v as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as e
  from embeddings where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), c0 as (select row_number() over (order by name nulls last, e) - 1 as c, e from (select sha256('1:' || vec_id) as name, e from v order by name nulls last, e limit {k}))"""]
    for n in range(rounds + 1):
        parts.append(f"a{n} as (select r, vec_id, e, c, far from (select v.r, v.vec_id, v.e, c.c, {far} as far, row_number() over (partition by v.r order by {far}, c.c) as nth from v cross join c{n} c) where nth = 1)")
        parts.append(f"""c{n + 1} as (
  select c, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as e
  from (select c, i, sum(e[i])::hugeint as s, count(*) as n from (select c, e, unnest(range(1, 65)) as i from a{n}) group by c, i) group by c
  union all select c, e from c{n} where c not in (select c from a{n}))""")
    return ", ".join(parts) + f"""
select vec_id, cast(a.c as int) as cluster, cast(far as bigint) as distance, cast(sum(far) over (partition by a.c) as bigint) as cluster_inertia,
  cast(sum(far) over () as bigint) as inertia, sha256(array_to_string(c{rounds}.e, ',')) as centroid_sha256
from a{rounds} a join c{rounds} using (c)
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_decontaminate": _OP3_SQL, "op5_topk": _OP5_SQL, "op8_jaccard_join": _OP8_SQL, "op11_divergence_audit": _OP11_SQL, "op12_clustering": _op12_sql()}
