"""URL filters: explicit rules first, then a naive Bayes verdict over segmented hosts and paths.

Host labels are split into words by a unigram Viterbi pass (the likeliest sequence of dictionary words and unknown
stretches); a multinomial naive Bayes model scores the words of host and path. The dictionary is counted over the corpus
(``vocabulary``: the words of all addresses' paths and of all pages) and mixed with a short one of words that hosts are
made of; labelled addresses are an input, with a short list as default.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no rule, and gets the verdict of
the prior (allow). Ties between verdicts allow, of segmentations the first by the rule told there. Repeated rows are
judged alike. A very long url is judged whole, in time proportional to its length. An empty table gives no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakestar.llm.common import materialize

#: Word counts for segmentation, by rough frequency in host names.
WORD_COUNTS = {
    "the": 90, "my": 60, "free": 50, "online": 50, "shop": 45, "store": 40, "news": 60, "blog": 60, "web": 50, "site": 40, "best": 40, "top": 30,
    "cheap": 30, "pills": 20, "pill": 15, "spam": 15, "farm": 25, "casino": 30, "poker": 20, "bet": 20, "bonus": 20, "win": 20, "loan": 20, "loans": 15,
    "credit": 25, "cash": 20, "money": 25, "fast": 20, "deal": 20, "deals": 20, "discount": 20, "buy": 30, "sale": 25, "viagra": 15, "pharma": 15, "pharmacy": 20,
    "drugs": 15, "xxx": 20, "sex": 20, "porn": 20, "adult": 20, "dating": 20, "cam": 15, "cams": 10, "hot": 20, "girls": 15, "crypto": 15, "forex": 15,
    "replica": 10, "watches": 10, "click": 20, "here": 20, "seo": 15, "link": 20, "links": 15, "traffic": 15, "torrent": 15, "crack": 12, "warez": 10, "keygen": 8,
    "example": 40, "www": 90, "com": 80, "net": 60, "org": 60, "en": 40, "fr": 30, "de": 30, "es": 30, "wiki": 30, "docs": 30, "doc": 20,
    "help": 25, "forum": 30, "research": 20, "university": 25, "edu": 25, "school": 20, "library": 20, "book": 20, "books": 20, "science": 20, "art": 20, "music": 25,
    "health": 20, "city": 20, "home": 30, "garden": 15, "travel": 20, "food": 20, "recipes": 12, "sport": 20, "sports": 15, "tech": 25, "data": 20, "code": 20,
    "open": 20, "source": 20, "project": 20, "media": 20, "photo": 20, "video": 25, "tv": 20, "radio": 15, "press": 15, "journal": 15, "daily": 20, "times": 20,
    "world": 20, "local": 15, "kids": 15, "family": 15, "church": 10, "history": 15, "museum": 12, "garage": 8, "mail": 20, "mobile": 15, "support": 15, "about": 20,
}
#: Labelled urls (host and path) that the default model is trained on.
BLOCKED = (
    "pills-direct.example/buy", "discountpills.example/order", "free-casino.example/bonus", "onlinepoker.example/win", "linkspam.example/links", "articlefarm.example/seo",
    "bestviagra.example/pharmacy", "pharma-discount.example/pills", "xxx-cams.example/adult", "hotgirls.example/sex", "freeporn.example/xxx", "adult-dating.example/sex",
    "fastcash-loans.example/credit", "cheap-replica-watches.example/sale", "crackwarez.example/keygen", "torrent-crack.example/warez", "cryptobonus.example/click", "forex-money.example/win",
    "seo-links.example/traffic", "buy-cheap-traffic.example/seo", "casinobonus.example/bet", "bet-win.example/casino", "cheapdrugs.example/pharmacy", "click-here-spam.example/deal",
    "adult-cams.example/xxx", "ad-tracker.example/ads", "popupads.example/click", "adultgirls.example/cams",
)
ALLOWED = (
    "news.example/world", "dailytimes.example/news", "blog.example/travel", "university.example/research", "library.example/books", "wiki.example/history",
    "docs.opensource.example/help", "forum.example/garden", "mymusic.example/radio", "science-journal.example/data", "museum.example/art", "school.example/kids",
    "recipes.example/food", "sports.example/tv", "mobile.example/support", "about.example/help", "openscience.example/press", "cityjournal.example/daily", "familyhome.example/recipes",
    "photo.example/family", "tech.example/code", "healthcity.example/support", "church.example/local", "press.example/media", "home.example/garden",
    "project.example/docs", "localnews.example/video", "bookstore.example/book", "cityhealth.example/help",
)

#: Counts up to this are levels of their own.
EXACT = 4096

_URL = re.compile(r"\A.*?://([^/?#]*)([^?#]*)", re.S)
_UPPER = {i: i + 32 for i in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path."""
    found = _URL.match(url) if url is not None else None
    return (found[1].translate(_UPPER), found[2]) if found else ("", "")


def matching_rule(host: str, path: str, rules: Iterable[tuple[str, str, str]]) -> tuple[str | None, str | None]:
    """The longest fitting rule and its verdict; rules are (verdict, host, path)."""
    fits = [(len(h) + len(p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


@dataclass(frozen=True)
class UrlModel:
    """Unigram log probabilities and naive Bayes log likelihoods; both of a fixed, small vocabulary."""

    unigram: dict[str, float]
    enter: float
    unknown: float
    longest: int
    prior: dict[str, float]
    likelihood: dict[str, dict[str, float]]
    unseen: dict[str, float]

    def segment(self, label: str) -> list[str]:
        """The likeliest split of a concatenated name into dictionary words and unknown stretches.

        An unknown stretch costs ``enter`` and ``unknown`` for each of its characters, so a short word inside of an
        unknown name doesn't split it. Equal splits go to the fewer unknown characters at the end.
        """
        longest = self.longest
        # For each end: the best split that ends in a word (or begins), and in an unknown stretch; with what came before.
        word: list[tuple[float, int, int]] = [(0.0, 0, 0)]
        stray: list[tuple[float, int, int]] = [(-math.inf, 0, 0)]
        for end in range(1, len(label) + 1):
            options = [(-math.inf, 0, 0)]
            for start in range(max(0, end - longest), end):
                p = self.unigram.get(label[start:end])
                if p is not None:
                    options += [(word[start][0] + p, start, 0), (stray[start][0] + p, start, 1)]
            word.append(max(options))
            stray.append(max((word[end - 1][0] + self.enter + self.unknown, end - 1, 0), (stray[end - 1][0] + self.unknown, end - 1, 1)))
        out: list[str] = []
        end, state = len(label), int(stray[-1][0] > word[-1][0])
        while end:
            _, start, before = (word, stray)[state][end]
            while state and before:  # the whole stretch
                _, start, before = stray[start]
            out.append(label[start:end])
            end, state = start, before
        return out[::-1]

    def tokens(self, host: str, path: str) -> list[str]:
        return [w for label in re.split(r"[^a-z0-9]+", host) if label for w in self.segment(label)] + [w for part in re.split(r"[^a-z]+", path.lower()) if part for w in self.segment(part)]

    def score(self, host: str, path: str) -> float:
        """Log odds of block against allow; words that training never saw say nothing of either."""
        total = self.prior["block"] - self.prior["allow"]
        for w in self.tokens(host, path):
            if w in self.likelihood["block"] or w in self.likelihood["allow"]:
                total += self.likelihood["block"].get(w, self.unseen["block"]) - self.likelihood["allow"].get(w, self.unseen["allow"])
        return total


def vocabulary(pages: DataFrame, columns: tuple[str, ...] = ("url", "html"), max_words: int = 50_000, shortest: int = 2, longest: int = 24) -> dict[str, int]:
    """Counts of the corpus's words (runs of ``shortest`` to ``longest`` letters of any script, lower case) over all rows.

    Kept are the most frequent, ``max_words`` at most, which bounds the model whatever the corpus: words of one count (or,
    past EXACT, of one sixty-fourth of a doubling) are in or out together. A histogram of the counts tells from which on, so
    no more than what is kept comes to the driver. Hosts are left out of addresses: they are what is to be split.
    """
    text = F.concat_ws(" ", *(F.regexp_replace(F.col(c), r"^[^:/?#]*://[^/?#]*", " ") if c == "url" else F.regexp_replace(F.col(c), r"<[^<>]*>", " ") for c in columns))
    words = pages.select(F.explode(F.split(F.lower(text), "\\P{L}+")).alias("w")).where(F.length("w").between(shortest, longest))
    n = F.col("n")
    level = F.when(n <= EXACT, n).otherwise(EXACT + 1 + F.floor(64 * F.log2(n / EXACT))).cast("int")
    found = materialize(words.groupBy("w").agg(F.count("*").alias("n")).withColumn("level", level), "vocabulary")
    kept, least = 0, None
    for r in found.groupBy("level").agg(F.count("*").alias("words")).orderBy(F.desc("level")).collect():
        kept += r.words
        if kept > max_words:
            break
        least = r.level
    return {r.w: r.n for r in found.where(F.col("level") >= least).collect()} if least is not None else {}


def mixed(corpus: dict[str, int], seeds: dict[str, int] | None = None, share: float = 0.5) -> dict[str, float]:
    """One dictionary of corpus counts and seeds: each makes up its share of all."""
    seeds = seeds or WORD_COUNTS
    a, b = max(sum(corpus.values()), 1), max(sum(seeds.values()), 1)
    return {w: (1 - share) * corpus.get(w, 0) / a * 1e6 + share * seeds.get(w, 0) / b * 1e6 for w in {*corpus, *seeds}}


def train(labelled: Iterable[tuple[str, str]] | None = None, word_counts: dict[str, float] | None = None, max_rows: int = 100_000) -> UrlModel:
    """Fits the model to (url without scheme, verdict) rows, at most ``max_rows`` of them; defaults to the lists above."""
    counts = word_counts or WORD_COUNTS
    total = sum(counts.values())
    unigram = {w: math.log(n / total) for w, n in counts.items()}
    # An unknown word of n letters has the probability 10 / (total * 10^n).
    enter, unknown = math.log(10 / max(total, 1)), -math.log(10)
    longest = max(map(len, unigram), default=1)
    blank = UrlModel(unigram, enter, unknown, longest, {}, {}, {})
    rows = list(labelled) if labelled is not None else [(u, "block") for u in BLOCKED] + [(u, "allow") for u in ALLOWED]
    seen: dict[str, Counter] = {"block": Counter(), "allow": Counter()}
    n = Counter()
    for url, verdict in rows[:max_rows]:
        host, _, path = url.partition("/")
        seen[verdict].update(blank.tokens(host, path))
        n[verdict] += 1
    words = set(seen["block"]) | set(seen["allow"])
    prior = {v: math.log((n[v] + 1) / (sum(n.values()) + 2)) for v in seen}
    size = {v: sum(seen[v].values()) + len(words) + 1 for v in seen}
    return UrlModel(unigram, enter, unknown, longest, prior, {v: {w: math.log((seen[v][w] + 1) / size[v]) for w in words} for v in seen}, {v: math.log(1 / size[v]) for v in seen})


def judge(pages: DataFrame, rules: Iterable[tuple[str, str, str]], model: UrlModel | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, log_odds (of block, by the model). No shuffle; the model and rules are small."""
    rules = list(rules)
    shared = pages.sparkSession.sparkContext.broadcast(model or train())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        score = lru_cache(1 << 16)(m.score)  # addresses share hosts and paths
        for batch in batches:
            split = [split_url(u) for u in batch.column("url").to_pylist()]
            found = [matching_rule(h, p, rules) for h, p in split]
            odds = [score(h, p) for h, p in split]
            verdicts = [v or ("block" if o > 0 else "allow") for (_, v), o in zip(found, odds, strict=True)]
            text = lambda x: pa.array(x, pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), text([h for h, _ in split]), text([p for _, p in split]), text([r for r, _ in found]), text(verdicts), pa.array(odds, pa.float64())], names=["page_id", "host", "path", "rule", "verdict", "log_odds"])

    rows = pages.select("page_id", F.col("url").cast("string").alias("url"))
    schema = rows.drop("url").schema
    for c in ("host", "path", "rule", "verdict"):
        schema = schema.add(c, "string")
    return rows.mapInArrow(run, schema.add("log_odds", "double"))
