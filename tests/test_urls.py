"""Addresses are normalised by Column expressions; Python's own quoting is the reference here."""

import random
from urllib.parse import quote, unquote, urlsplit

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakestar.functions import urls

ALIASES, PAGED = {"site.test": "www.site.test"}, r"^www\.site\.test(:[0-9]+)?(/article/|/journal/[^/]+/(issues|vol)(/|$))"


def by_hand(url):
    if not url or not url.strip():
        return None
    try:
        parts = urlsplit(url.strip())
        host, port = parts.hostname, parts.port
    except ValueError:
        return None
    if not host:
        return None
    host = ALIASES.get(host, host)
    host = (f"[{host}]" if ":" in host else host) + (f":{port}" if port not in (None, 80, 443) else "")
    path = quote(unquote(parts.path).rstrip("/"), safe=urls.PATH_SAFE)
    again = lambda x: quote(unquote(x), safe=urls.QUERY_SAFE)
    query, part = "", ""
    for c in parts.query + "&":
        if c in "&;":
            key, sign, value = part.partition("=")
            query, part = query + again(key) + sign + again(value) + c, ""
        else:
            part += c
    import re

    query = "" if re.search(PAGED, host + path) else query[:-1]
    return f"https://{host}{path}" + (f"?{query}" if query else "")


KNOWN = [
    ("http://News.Site.Test/a/b", "https://news.site.test/a/b"), ("https://x.test/a//", "https://x.test/a"), ("https://x.test/a#part", "https://x.test/a"), ("https://x.test:443/a", "https://x.test/a"),
    ("http://x.test:8080/a", "https://x.test:8080/a"), ("https://x.test/x%20y?z=a%20b", "https://x.test/x%20y?z=a%20b"), ("https://x.test/%7Ez/%62", "https://x.test/~z/b"), ("https://x.test/%2541", "https://x.test/%2541"),
    ("https://x.test/?q=1%262", "https://x.test?q=1%262"), ("https://x.test/?q=1&2", "https://x.test?q=1&2"), ("http://[2001:DB8::2]:80/p/", "https://[2001:db8::2]/p"), ("https://site.test/journal/a/issues?page=3", "https://www.site.test/journal/a/issues"),
    ("http://site.test/article/1?via%3Dx&y=z", "https://www.site.test/article/1"), ("  https://x.test/a%2Fb  ", "https://x.test/a/b"), ("https://x.test/%3Fq/%23f", "https://x.test/%3Fq/%23f"), ("https://u:p@x.test/a", "https://x.test/a"),
    ("https://x.test/é ü", "https://x.test/%C3%A9%20%C3%BC"), ("https://x.test/100%", "https://x.test/100%25"), ("//x.test/a", "https://x.test/a"), ("https://x.test?a=b=c", "https://x.test?a=b%3Dc"), ("https://x.test/a+b?c+d", "https://x.test/a+b?c+d"),
    (None, None), ("", None), ("   ", None), ("relative/path", None), ("https:///only/path", None), ("https://x.test:99999/", None), ("https://x.test:port/", None),
]


def normalised(spark, values, **options):
    df = spark.createDataFrame(list(enumerate(values)), "i int, url string")
    return [r.u for r in df.select("i", urls.normalize_url(F.col("url"), ALIASES, PAGED, **options).alias("u")).orderBy("i").collect()]


def test_known_addresses_and_idempotence(spark):
    got = normalised(spark, [u for u, _ in KNOWN])
    assert got == [w for _, w in KNOWN] == [by_hand(u) for u, _ in KNOWN]
    assert normalised(spark, got) == got


def test_random_addresses_against_the_standard_library(spark):
    rng = random.Random(5)
    piece = lambda: "".join(rng.choice(["a", "Z", "7", "-", ".", "_", "~", "/", ":", "@", "!", "$", "&", "'", "(", ")", "*", "+", ",", ";", "=", "%", "%41", "%2F", "%2f", "%26", "%3D", "%25", "%C3%A9", "%E2%82", "é", "😀", " ", "|", '"', "<", "\\", "^", "%7e"]) for _ in range(rng.randrange(0, 8)))
    values = [f"{rng.choice(('http', 'HTTPS', 'ftp'))}://{rng.choice(('x.test', 'Site.Test', 'a.b:81', 'me@x.test:443', 'x.test:'))}/{piece()}{rng.choice(('', '?'))}{piece()}{rng.choice(('', '#f'))}" for _ in range(1500)]
    assert normalised(spark, values) == [by_hand(u) for u in values]


def test_no_python_in_the_plan_and_strict_addresses(spark):
    df = spark.createDataFrame([("https://x.test/%41",), ("nowhere",)], "url string")
    plan = df.select(urls.normalize_url(F.col("url")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    with pytest.raises(PySparkException, match="not an address: nowhere"):
        df.select(urls.normalize_url(F.col("url"), strict=True)).collect()
