import itertools
import math
import re
from collections import Counter

from lakestar.llm import queries, urlfilter


def test_segmentation_is_the_likeliest():
    m = urlfilter.train()

    def brute(label):
        best = -1e99
        for cuts in itertools.product((0, 1), repeat=len(label) - 1):
            parts, last = [], 0
            for i, c in enumerate(cuts, 1):
                if c:
                    parts.append(label[last:i])
                    last = i
            parts.append(label[last:])
            best = max(best, cost(parts))
        return best

    def cost(words):
        return sum(m.unigram[w] if w in m.unigram else m.enter + m.unknown * len(w) for w in words)

    for label in ("cheappills", "newsblog", "thexyshop", "zzz", "spamfarm", "onlinebet", "therer", "xfreezbets", "qshopq", "a"):
        assert abs(cost(m.segment(label)) - brute(label)) < 1e-9
    assert m.segment("cheappills") == ["cheap", "pills"] and m.segment("spamfarm") == ["spam", "farm"]
    assert m.segment("therer") == ["the", "rer"] and m.segment("cheapxqpills") == ["cheap", "xq", "pills"] and m.segment("") == []


def test_rules_and_splitting(spark):
    rows = [
        ("https://A.Org/x", "a.org", "/x", "org/", "allow"), ("http://example.org/es/1", "example.org", "/es/1", "example.org/es/", "block"), ("http://b.example.org/en/12?q#f", "b.example.org", "/en/12", "example.org/en/1", "block"),
        ("http://example.org/en/2", "example.org", "/en/2", "org/", "allow"), ("http://x.com/de/", "x.com", "/de/", "com/de/", "block"), ("http://x.com/fr/9", "x.com", "/fr/9", "com/fr/", "allow"), ("http://com/de/9", "com", "/de/9", "com/de/", "block"),
        ("http://notorg/x", "notorg", "/x", None, "allow"), ("http://a.org", "a.org", "", None, "allow"), ("http://a.org:80/x", "a.org:80", "/x", None, "allow"), (None, "", "", None, "allow"), ("a.org/x", "", "", None, "allow"), ("", "", "", None, "allow"),
        ("https://www.cheap-pills.example.com/en/680", "www.cheap-pills.example.com", "/en/680", None, "block"), ("https://spam-farm.example.net/en/1", "spam-farm.example.net", "/en/1", None, "block"), ("https://blog.thernd.example.net/de/6", "blog.thernd.example.net", "/de/6", None, "allow"),
        ("http://É.org/Ü", "É.org", "/Ü", "org/", "allow"), ("http://x.com/a\nb?c", "x.com", "/a\nb", None, "allow"),
    ]
    df = spark.createDataFrame([(i, r[0], "v") for i, r in enumerate(rows)], "page_id long, url string, verdict string")
    got = {r.page_id: r for r in urlfilter.judge(df, queries.URL_RULES).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(rows):
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict), rows[i]
    assert urlfilter.judge(df.limit(0), queries.URL_RULES).collect() == []


def test_query(spark, sf_dir):
    df = queries.op10_url_filter(spark, sf_dir)
    assert df.columns[:5] == ["page_id", "host", "path", "rule", "verdict"] and {r.verdict for r in df.collect()} == {"allow", "block"}


def test_dictionary_bounds_and_words_beyond_ascii(spark):
    pages = spark.createDataFrame([(None, "Élève élève große straße x " + "y" * 30), (None, "élève niño 7abc_def")], "url string, html string")
    assert urlfilter.vocabulary(pages) == {"élève": 3, "große": 1, "straße": 1, "niño": 1, "abc": 1, "def": 1}
    # Words of one count are in or out together.
    assert urlfilter.vocabulary(pages, max_words=5) == {"élève": 3} and len(urlfilter.vocabulary(pages, max_words=6)) == 6 and urlfilter.vocabulary(pages, max_words=0) == {}
    many = spark.createDataFrame([(None, " ".join(["aa"] * 5000 + ["bb"] * 5001 + ["cc"] * 9000 + ["dd"] * 4096 + ["ee"] * 4097))], "url string, html string")
    assert urlfilter.vocabulary(many) == {"aa": 5000, "bb": 5001, "cc": 9000, "dd": 4096, "ee": 4097}
    assert [set(urlfilter.vocabulary(many, max_words=k)) for k in (1, 2, 3, 4)] == [{"cc"}, {"cc"}, {"aa", "bb", "cc"}, {"aa", "bb", "cc", "ee"}]
    assert urlfilter.vocabulary(pages, shortest=1, longest=30) == urlfilter.vocabulary(pages) | {"x": 1, "y" * 30: 1}


def test_query_against_brute_force(spark, sf_dir):
    """Every page's host, path, rule and verdict again, with the dictionary counted and the odds summed in plain Python."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    counts = Counter()
    for r in pages:
        text = re.sub(r"^[^:/?#]*://[^/?#]*", " ", r.url or "") + " " + re.sub("<[^<>]*>", " ", r.html or "")
        counts.update(w for w in re.findall(r"[^\W\d_]+", text.lower()) if 2 <= len(w) <= 24)
    assert len(counts) <= 50_000  # else words of one count would be in or out together
    m = urlfilter.train(word_counts=urlfilter.mixed(counts))
    got, verdicts = {r.page_id: r for r in queries.op10_url_filter(spark, sf_dir).collect()}, Counter()
    for r in pages:
        rest = (r.url or "").partition("://")
        host = re.split("[/?#]", rest[2])[0]
        path = re.split("[?#]", rest[2][len(host) :])[0]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        fits = sorted(((len(h + p), h + p, v) for v, h, p in queries.URL_RULES if f".{host}".endswith(f".{h}") and path.startswith(p)), reverse=True)
        odds = m.prior["block"] - m.prior["allow"]
        for label in [x for x in re.split("[^a-z0-9]", host) if x] + [x for x in re.split("[^a-z]", path.lower()) if x]:
            for w in m.segment(label):
                if any(w in m.likelihood[v] for v in m.likelihood):
                    odds += m.likelihood["block"].get(w, m.unseen["block"]) - m.likelihood["allow"].get(w, m.unseen["allow"])
        want = (host, path, fits[0][1] if fits else None, fits[0][2] if fits else "block" if odds > 1e-12 else "allow")
        found = got[r.page_id]
        assert (found.host, found.path, found.rule, found.verdict) == want and abs(found.log_odds - odds) < 1e-9, r.url
        verdicts[want[2] is None, want[3]] += 1
    assert len(got) == len(pages) and len(verdicts) == 4


def test_verdict_is_the_multinomial_bayes():
    labelled = [("spamwin.x/casino", "block"), ("casinowin.x/a/b", "block"), ("blog.y/news", "allow"), ("newsblog.z/casino", "allow"), ("blog.w/", "allow")]
    words = {"spam": 5, "win": 5, "casino": 5, "blog": 5, "news": 5}
    m = urlfilter.train(labelled, words)
    seen = {v: [w for u, x in labelled if x == v for w in m.tokens(u.partition("/")[0], u.partition("/")[2])] for v in ("block", "allow")}
    every = set(seen["block"]) | set(seen["allow"])

    def log(v, tokens):
        total = math.log((sum(x == v for _, x in labelled) + 1) / (len(labelled) + 2))
        return total + sum(math.log((seen[v].count(w) + 1) / (len(seen[v]) + len(every) + 1)) for w in tokens if w in every)

    for host, path in (("wincasino.q", "/news"), ("spamblog.q", ""), ("zzz.q", "/casino/casino"), ("", ""), ("newswin", "/spam")):
        tokens = m.tokens(host, path)
        assert abs(m.score(host, path) - (log("block", tokens) - log("allow", tokens))) < 1e-9


def test_long_repeated_and_tied_urls(spark):
    tied = urlfilter.train([("aa.x", "block"), ("bb.x", "allow")], {"aa": 1, "bb": 1})
    assert tied.score("cc.x", "") == 0 == tied.score("", "")
    long = "https://" + "cheappills" * 400 + ".net/" + "casino/" * 3000
    df = spark.createDataFrame([(1, long), (1, long), (None, long), (2, "https://cc.x/")], "page_id long, url string")
    got = urlfilter.judge(df, queries.URL_RULES).collect()
    assert len(got) == 4 and [r.verdict for r in got[:3]] == ["block"] * 3 and got[0].path == "/" + "casino/" * 3000
    assert urlfilter.judge(df.where("page_id = 2"), (), tied).first().verdict == "allow"


def test_dictionary_counts_the_whole_table(spark):
    pages = spark.createDataFrame([("http://hostname.x/alpha/beta-x", "<p class='no'>Gamma gamma delta</p>"), ("http://other.x/alpha", None), (None, "<b>delta</b>")], "url string, html string")
    assert urlfilter.vocabulary(pages) == {"alpha": 2, "delta": 2, "gamma": 2, "beta": 1} and urlfilter.vocabulary(pages.limit(0)) == {}
    assert set(urlfilter.mixed({"alpha": 2}, {"beta": 1})) == {"alpha", "beta"} and urlfilter.mixed({"a": 1, "b": 3}, {"a": 1}) == {"a": 0.5 * 0.25e6 + 0.5e6, "b": 0.5 * 0.75e6}
