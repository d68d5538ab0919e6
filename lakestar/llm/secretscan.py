"""Secret scans: candidates by pattern, false positives removed by a random forest.

A candidate is a run of at least ``SHORTEST`` key characters, or whatever is assigned to a secret word: at
least ``SHORTEST_ASSIGNED`` characters without blanks or quotes, up to the closing quote, or else to <, >, a comma, a
semicolon or the next parameter. Names, blanks around the sign, values and their parameters may be of any length. The
forest sees its length, the transitions between character classes, how much of it words of a dictionary cover, whether it
reads as code or prose, the path it lies in, and the words around it. Runs inside an assigned value are judged too, and the value is as secret as the most secret of them.
It is trained by Spark's own learner on labelled findings and applied as one SQL expression over each document's
candidates: scanning has no shuffle and no Python.

Defined results: a null text has no candidates and stays null. All places of a repeated value are judged each, with
their own neighbours; repeated rows alike. A score at the threshold is a secret. A very long text is scanned whole, in
time proportional to its length, and so is a very long run. Control characters U+0001 to U+0003 of a text are kept,
but count for two in a value's least length.
Columns named like the scan's two are replaced by ``scan``; ``redact`` keeps all of the input's. An empty table gives an empty result.
"""

from __future__ import annotations

import json
from functools import cache, reduce

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestar.llm.common import packed, unpacked
from lakestar.llm.secret_findings import labelled_findings

SHORTEST = 16
#: Characters before and after a candidate that are looked at.
AROUND = 48
#: Pieces of a text whose beginnings are summed at a time.
BLOCK = 512
RUN = rf"(?<![A-Za-z0-9+/_\-])[A-Za-z0-9+/_\-]{{{SHORTEST},}}={{0,2}}"
SHORTEST_ASSIGNED = 4
#: What names of secrets hold, in English, German, French and Spanish.
_SECRET_WORDS = "token|secret|passw|pwd|api.?key|access.?key|auth|credential|private.?key|bearer|kennwort|geheim|mot.?de.?passe|contrase|clave.?secreta"
_QUOTE, _NAME = "[\"'`]", r"[A-Za-z0-9_.\-]"
#: Behind a name: a closing quote or bracket, any blanks, the sign, any blanks, an opening quote.
_SIGN = rf"{_QUOTE}?\]?[ \t]*+(?::=|=>|[=:])>?[ \t]*+{_QUOTE}?"
_SECRET_NAME = f"(?i:{_SECRET_WORDS})".replace(".?", f"{_NAME}?")
#: A whole name with a secret word in it, of any length, or the second word of one that something stands in, up to the value.
#: What is looked at ahead is passed over once for each name, so long names take time by their length.
_ASSIGNED = rf"(?:(?<!{_NAME})(?={_NAME}++{_SIGN})(?={_NAME}*?{_SECRET_NAME}){_NAME}++|(?<=(?i:api|access|private))[^A-Za-z0-9_.\-\n](?i:key){_NAME}*+){_SIGN}"
#: U+0003 stands for an ampersand before the name of a parameter, which ends a value.
_BARE = "[^\\s\"'`<>,;\x03]"
#: Up to the closing quote; or to what ends a bare value, without the sentence's or bracket's end. A value that is itself an
#: assignment to a secret name is that one's.
_QUOTED = rf"(?<={_QUOTE})[^\s\"'`]{{{SHORTEST_ASSIGNED},}}(?={_QUOTE})"
_UNQUOTED = rf"(?:(?<={_QUOTE})|(?![=:>]))(?!(?={_NAME}++{_SIGN}[^=:>\s])(?={_NAME}*?{_SECRET_NAME})){_BARE}{{{SHORTEST_ASSIGNED},}}(?<![.:)\]}}&])"
_PARAMETER = rf"&(?={_NAME}++=)"
VALUE = f"({_ASSIGNED})({_QUOTED}|{_UNQUOTED})"
#: Words of names, paths and placeholders.
DICTIONARY = (
    "example", "sample", "dummy", "fake", "placeholder", "change", "insert", "here", "your", "test", "demo", "default", "value", "name", "user", "data", "file", "image",
    "table", "index", "group", "count", "module", "package", "release", "version", "build", "project", "client", "server", "common", "core", "linux", "python", "home",
    "model", "part", "config", "secret", "token", "password", "key", "api", "http", "https", "www", "com", "the", "and", "for", "with", "from", "that", "this",
    "order", "number", "message", "request", "response", "session", "service", "system", "string", "object", "class", "function", "return", "public", "private",
    "static", "import", "export", "source", "target", "local", "global", "remote", "update", "delete", "create", "select", "insert", "lib", "usr", "src", "doc", "page",
)
_BENIGN_WORDS = r"commit|\brev|sha1|sha256|sha:|md5|checksum|digest|etag|hash|uuid|\bid\b|_id|isbn|order|number|account|phone|checkout"
_DUMMY_WORDS = "example|sample|dummy|fake|placeholder|your|changeme|insert"
_KNOWN_KEYS = r"^(AKIA|ASIA|ghp_|gho_|ghs_|sk-|sk_live_|glpat-|npm_|xox[abp]-|AIza|eyJ)"
#: Names that hold a secret word and name something else.
_OTHER_NAMES = "(author[a-z]*|authentic[a-z]*|tokens|_(count|limit|len|length|type|url|uri|name|path|id|file|field|env|size|hint|ttl|expires?|expiry))"
#: Calls, lookups, attributes, templates and masks; literals, types and words that stand where a value would.
_REFERENCE = r"^[A-Za-z_][A-Za-z0-9_.]*[(\[][A-Za-z0-9_.]*$|^(self|this|os|process|config|settings|env|request|req|args|options|user|params)[.][A-Za-z]|^[$]([A-Za-z_][A-Za-z0-9_]*$|[({])|^[%{\[(]+[A-Za-z_.]*[%}\])]*$|^[*xX.•_-]+$|^(https?:)?//"
_PLAIN_WORD = "^(true|false|null|none|nil|undefined|string|str|int|bool|boolean|bytes|text|password|passwd|token|secret|required|optional|hidden|empty|unknown|redacted|basic|bearer|digest|oauth2?|yes|no|on|off)[?!.]*$"
_TEST_PATH = r"(^|/)(tests?|fixtures?|examples?|samples?|docs?)(/|$)"

#: The path's column while the input's are packed away.
_PATH = "_path_of_the_text"

#: Feature name to SQL over a struct ``x`` of value, before, after, path.
FEATURES = {
    "length": "cast(length(x.value) as double)",
    "transitions": "(length(regexp_replace(regexp_replace(regexp_replace(regexp_replace(x.value, '[a-z]+', 'a'), '[A-Z]+', 'A'), '[0-9]+', '0'), '[^aA0]+', '-')) - 1) / cast(length(x.value) as double)",
    "distinct": "size(array_distinct(split(x.value, ''))) / cast(length(x.value) as double)",
    "digits": "length(regexp_replace(x.value, '[^0-9]', '')) / cast(length(x.value) as double)",
    "upper": "length(regexp_replace(x.value, '[^A-Z]', '')) / cast(length(x.value) as double)",
    "hex": "cast(x.value rlike '^[0-9a-f]+$' as double)",
    "dictionary": f"1 - length(regexp_replace(lower(x.value), '{'|'.join(sorted(set(DICTIONARY), key=lambda w: (-len(w), w)))}', '')) / cast(length(x.value) as double)",
    "known_key": f"cast(x.value rlike '{_KNOWN_KEYS}' as double)",
    "dummy": f"cast(lower(concat(x.value, ' ', x.before)) rlike '{_DUMMY_WORDS}' as double)",
    "slashes": "cast(length(regexp_replace(x.value, '[^/]', '')) as double)",
    "test_path": f"cast(coalesce(lower(x.path), '') rlike '{_TEST_PATH}' as double)",
    "url_before": "cast(x.before rlike '[:/.@][^ ]*$' and x.before rlike '(://|www[.])[^ ]*$' as double)",
    "secret_word": f"cast(lower(x.before) rlike '({_SECRET_WORDS})[^ ]*[ ]*[=:]?[ \"\\']*$' as double)",
    "secret_near": f"cast(lower(concat(x.before, ' ', x.after)) rlike '{_SECRET_WORDS}' as double)",
    "benign_word": f"cast(lower(x.before) rlike '({_BENIGN_WORDS})[^ ]*[ ]*[=:]?[ \"\\']*$' as double)",
    "bare": "cast(not x.before rlike '[\"\\'`]$' as double)",
    "punctuation": "length(regexp_replace(x.value, '[A-Za-z0-9]', '')) / cast(length(x.value) as double)",
    "reference": f"cast(x.value rlike '{_REFERENCE}' as double)",
    "plain_word": f"cast(lower(x.value) rlike '{_PLAIN_WORD}' as double)",
    "lower_only": "cast(x.value rlike '^[A-Z]?[a-z]+([-_.][a-z]+)*[.!?]*$' as double)",
    "other_name": f"cast(lower(x.before) rlike '{_OTHER_NAMES}[\"\\'`]? *[=:]>? *[\"\\'`]?$' as double)",
    "word_after": "cast(x.after rlike '^ +[A-Za-z]' as double)",
    "assigned": "cast(x.before rlike '[=:][ ]*[\"\\']?$' as double)",
}


def _sql(text: str) -> str:
    """Backslashes of patterns survive Spark's SQL string literals only when doubled; quotes are escaped already."""
    return text.replace("\\", "\\\\").replace("\\\\'", "\\'")


def findings(spark: SparkSession, rows: list[dict] | None = None) -> DataFrame:
    """Labelled findings as a DataFrame of value, before, after, path, label; by default the generated ones."""
    schema = "array<struct<value:string,before:string,after:string,path:string,label:double>>"
    text = json.dumps(rows if rows is not None else labelled_findings())
    return spark.range(1).select(F.explode(F.from_json(F.lit(text), schema)).alias("x")).select("x.*")


def train(labelled: DataFrame, trees: int = 24, depth: int = 8, seed: int = 5, max_rows: int = 50_000) -> RandomForestClassificationModel:
    """Fits the forest to at most ``max_rows`` labelled findings (value, before, after, path, label), the same ones each time."""
    x = F.struct("value", "before", "after", "path")
    rows = labelled.select(x.alias("x"), "label").orderBy(F.xxhash64("x"), "label").limit(max_rows)
    rows = rows.select("label", *(F.expr(_sql(sql)).cast("double").alias(name) for name, sql in FEATURES.items()))
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows).select("label", "features")
    learner = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt", subsamplingRate=0.8)
    return learner.fit(rows.repartition(1))


def forest_sql(model: RandomForestClassificationModel) -> str:
    """The forest as SQL over a struct ``f`` of features: the mean probability of a secret over its trees."""
    names = list(FEATURES)

    def tree(node) -> str:
        if node.subtreeDepth() == 0:
            stats = list(node.impurityStats().stats())
            return repr(round(stats[1] / sum(stats), 6)) + "D"
        split = node.split()
        return f"if(f.{names[split.featureIndex()]} <= {split.threshold()!r}D, {tree(node.leftChild())}, {tree(node.rightChild())})"

    roots = [t._call_java("rootNode") for t in model.trees]
    return "(" + " + ".join(tree(r) for r in roots) + f") / {len(roots)}D"


@cache
def _trained(app: str) -> str:
    return forest_sql(train(findings(SparkSession.getActiveSession())))


def default_forest(spark: SparkSession) -> str:
    """The forest of the generated findings, fitted once per application."""
    return _trained(spark.sparkContext.applicationId)


def scan(docs: DataFrame, forest: str | None = None, path: Column | None = None, threshold: float = 0.5) -> DataFrame:
    """``docs`` plus pieces (the text cut around candidates) and found (offset, length, value, score, secret of each candidate).

    ``path``: a string column, where documents have one.
    """
    forest = forest or default_forest(docs.sparkSession)
    columns = [c for c in docs.columns if c not in ("pieces", "found")]
    docs = packed(docs.withColumn(_PATH, path if path is not None else F.lit("")), "text", _PATH).withColumnRenamed(_PATH, "_path")
    # A text's own control characters are written as U+0002 and a sign that is in no run while U+0001 marks the candidates.
    text = F.col("text")
    swap = lambda c, *pairs: reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, c)
    safe = F.when(text.rlike("[\x01-\x03]"), swap(text, ("\x02", "\x02!"), ("\x01", "\x02#"), ("\x03", "\x02%"))).otherwise(text)
    safe = F.when(F.instr(safe, "&") > 0, F.regexp_replace(safe, _PARAMETER, "\x03")).otherwise(safe)
    # Assigned values first, then runs in what lies between them; a text without a sign has no assigned values.
    assigned = F.split(F.when(safe.rlike("[=:]"), F.regexp_replace(safe, VALUE, "$1\x01$2\x01")).otherwise(safe), "\x01")
    runs = F.transform(assigned, lambda p, i: F.when(i % 2 == 0, F.regexp_replace(p, RUN, "\x01$0\x01")).otherwise(p))
    marked = F.split(F.array_join(runs, "\x01"), "\x01")
    plain = lambda c: F.when(c.rlike("[\x02\x03]"), swap(c, ("\x03", "&"), ("\x02#", "\x01"), ("\x02%", "\x03"), ("\x02!", "\x02"))).otherwise(c)
    docs = docs.withColumn("pieces", F.transform(marked, plain))
    # Where each piece begins: summed in blocks, so that a text of very many candidates isn't copied for each of them.
    block = lambda b: f"slice(_len, {b} * {BLOCK} + 1, {BLOCK})"
    begin = "(a, x) -> array_append(a, element_at(a, -1) + x)"
    docs = docs.withColumn("_len", F.expr("transform(pieces, p -> length(p))"))
    docs = docs.withColumn("_sum", F.expr(f"aggregate(transform(sequence(0, (size(_len) - 1) div {BLOCK}), b -> aggregate({block('b')}, 0, (a, x) -> a + x)), array(0), {begin})"))
    blocks = f"sequence(0, (size(_len) - 1) div {BLOCK})"
    docs = docs.withColumn("_at", F.expr(f"flatten(zip_with({blocks}, slice(_sum, 1, size(_sum) - 1), (b, s) -> slice(aggregate({block('b')}, array(s), {begin}), 1, size({block('b')}))))"))
    # Arrays are zipped, never looked into by place from a function of their elements: Spark may put what makes them there,
    # to be made for each element anew.
    docs = docs.withColumn("_z", F.arrays_zip(F.col("pieces").alias("piece"), F.col("_at").alias("at")))
    # Neighbours are those of the text: another candidate that stands there is one of them.
    near = lambda k: f"coalesce({'right' if k < 0 else 'left'}(get(_z, i + ({k})).piece, {AROUND}), '')"
    around = f"""transform(if(size(_z) > 1, sequence(1, size(_z) - 1, 2), cast(array() as array<int>)), i -> named_struct(
        'value', _z[i].piece, 'before', right(concat({near(-3)}, {near(-2)}, _z[i - 1].piece), {AROUND}), 'after', left(concat(_z[i + 1].piece, {near(2)}, {near(3)}), {AROUND}), 'path', _path, 'offset', _z[i].at))"""
    docs = docs.withColumn("_x", F.expr(around))
    features = ", ".join(f"'{name}', cast({sql} as double)" for name, sql in FEATURES.items())
    docs = docs.withColumn("_f", F.expr(_sql(f"transform(_x, x -> named_struct({features}))")))
    # Runs inside a longer value: their best score, 0 where there are none.
    inner = f"""if(x.value rlike '^{RUN}$', cast(array() as array<string>), regexp_extract_all(x.value, '{RUN}', 0))"""
    inner = f"""transform({inner}, v -> named_struct('value', v, 'before', right(concat(x.before, left(x.value, locate(v, x.value) - 1)), {AROUND}),
        'after', left(concat(substr(x.value, locate(v, x.value) + length(v)), x.after), {AROUND}), 'path', x.path))"""
    docs = docs.withColumn("_y", F.expr(_sql(f"transform(_x, x -> {inner})")))
    docs = docs.withColumn("_g", F.expr(_sql(f"transform(_y, y -> transform(y, x -> named_struct({features})))")))
    docs = docs.withColumn("_q", F.expr(f"transform(_g, g -> coalesce(array_max(transform(g, f -> {forest})), 0D))"))
    docs = docs.withColumn("_p", F.expr(f"zip_with(transform(_f, f -> {forest}), _q, (p, q) -> greatest(p, q))"))
    found = f"zip_with(_x, _p, (x, p) -> named_struct('offset', x.offset, 'length', length(x.value), 'value', x.value, 'score', p, 'secret', p >= {threshold}D))"
    docs = docs.withColumn("found", F.coalesce(F.expr(found), F.expr("transform(cast(array() as array<int>), x -> named_struct('offset', 0, 'length', 0, 'value', '', 'score', 0D, 'secret', false))")))
    return unpacked(docs.select("text", *(c for c in docs.columns if c == "_columns_of_the_input"), "pieces", "found"), [*columns, "pieces", "found"], "text", "pieces", "found")


def redact(docs: DataFrame, mark: str = "[SECRET]", **options) -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by ``mark``; other texts stay as they are."""
    columns, docs = docs.columns, packed(docs, "text", into="_columns_of_the_redacted")
    cut = F.array_join(F.transform("pieces", lambda p, i: F.when((i % 2 == 1) & F.get(F.col("found"), ((i - 1) / 2).cast("int"))["secret"], F.lit(mark)).otherwise(p)), "")
    text = F.when(F.exists("found", lambda x: x["secret"]), cut).otherwise(F.col("text"))
    return unpacked(scan(docs, **options).withColumn("text", text), columns, "text", into="_columns_of_the_redacted")


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_candidates, n_secrets, max_score (null without candidates), secrets (offset, length, score of each) of every row."""
    found = scan(docs.select("doc_id", "text"), **options)
    secrets = F.filter("found", lambda x: x["secret"])
    return found.select(
        "doc_id", F.size("found").cast("long").alias("n_candidates"), F.size(secrets).cast("long").alias("n_secrets"),
        F.array_max(F.transform("found", lambda x: x["score"])).alias("max_score"),
        F.transform(secrets, lambda x: F.struct(x["offset"].alias("offset"), x["length"].alias("length"), x["score"].alias("score"))).alias("secrets"),
    )
