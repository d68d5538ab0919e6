"""HTML extraction: one parse of each page with the standard parser, all fields as one struct."""

from __future__ import annotations

import re
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

PAGE = "title string, heading string, doi string, licence_url string, copyright_year int, reference_count int, keywords string, abstract string, paragraphs int, links int, items int, runs array<struct<text:string,bold:boolean,italic:boolean,superscript:boolean,subscript:boolean>>"
_VOID = {"br", "img", "hr", "meta", "link", "input", "area", "base", "col", "embed", "source", "track", "wbr"}
_STYLE = {"b": 0, "strong": 0, "i": 1, "em": 1, "sup": 2, "sub": 3}
_BLOCKED = ("access denied", "are you a robot", "just a moment", "captcha")


class _Page(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, dict]] = []
        self.title, self.heading, self.section = [], [], ""
        self.counts = {"p": 0, "a": 0, "li": 0}
        self.links: list[str] = []
        self.metas: list[str] = []
        self.runs: list[tuple] = []
        self.parts: dict[str, list[str]] = {}
        self.section_head: list[str] = []

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs)
        if tag in self.counts:
            self.counts[tag] += 1
        if tag == "a" and attrs.get("href"):
            self.links.append(attrs["href"])
        if tag == "meta" and attrs.get("content"):
            self.metas.append(attrs["content"])
        if tag == "h2":
            self.section_head = []
        if tag not in _VOID:
            self.stack.append((tag, attrs))

    def handle_endtag(self, tag):
        if tag == "h2":
            self.section = " ".join(self.section_head).strip().lower()
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                break

    def handle_data(self, data):
        tags = [t for t, _ in self.stack]
        if "script" in tags or "style" in tags:
            return
        if "title" in tags:
            self.title.append(data)
        elif "h2" in tags:
            self.section_head.append(data)
        else:
            self.parts.setdefault(self.section, []).append(data)
        if "h1" in tags:
            self.heading.append(data)
            if data.strip():
                flags = [any(_STYLE.get(t) == k for t in tags) for k in range(4)]
                self.runs.append((data, *flags))


def _tidy(parts: list[str]) -> str | None:
    return re.sub(r"\s+", " ", "".join(parts)).strip() or None


def extract(html: str | None) -> dict:
    """All fields of one page; what a page lacks is null, and broken markup gives what could be read."""
    page = _Page()
    page.feed(html or "")
    page.close()
    every = " ".join(" ".join(v) for v in page.parts.values())
    doi = next((re.sub(r"^https?://(dx\.)?doi\.org/", "", h) for h in page.links if re.match(r"https?://(dx\.)?doi\.org/10\.", h)), None)
    licence = next((x for x in page.links + page.metas if "creativecommons.org/licenses/" in x), None)
    year = re.search(r"(?:copyright|©)\D{0,20}((?:19|20)\d\d)", every, re.I)
    references = next((re.search(r"\((\d+)\)", s) for s in page.parts if s.startswith("references")), None)
    words = next((page.parts[s] for s in page.parts if s in ("keywords", "key words")), None)
    styled = any(any(r[1:]) for r in page.runs)
    return {
        "title": _tidy(page.title), "heading": _tidy(page.heading), "doi": doi, "licence_url": licence, "copyright_year": int(year[1]) if year else None,
        "reference_count": int(references[1]) if references else None, "keywords": "|".join(w.strip() for w in words if w.strip()) if words else None,
        "abstract": _tidy(page.parts["abstract"]) if "abstract" in page.parts else None, "paragraphs": page.counts["p"], "links": page.counts["a"], "items": page.counts["li"],
        "runs": [dict(zip(("text", "bold", "italic", "superscript", "subscript"), r, strict=True)) for r in page.runs] if styled else [],
    }


def page_fields(html: Column, references: tuple[str, ...] | None = None) -> Column:
    """Struct of all fields of a page, parsed once per row in Arrow batches.

    ``references``: names of the character references to decode, where they end with a semicolon; all others stay as they are
    written. By default every one is decoded that the standard has, with or without a semicolon.
    """
    if references is not None:
        html = F.regexp_replace(html, f"&(?!(?:{'|'.join(references)});)", "&amp;")

    @F.pandas_udf(PAGE)
    def run(pages: pd.Series) -> pd.DataFrame:
        names = re.findall(r"([a-z_]+) (?:string|int|array)", PAGE)
        return pd.DataFrame([extract(h) for h in pages], columns=names).astype({c: "Int32" for c in ("copyright_year", "reference_count", "paragraphs", "links", "items")})

    return run(html)


def is_blocked(title: Column) -> Column:
    """Whether a page's title is that of a robot check."""
    return F.coalesce(F.lower(title).rlike("|".join(_BLOCKED)), F.lit(False))


def flatten(runs: Column) -> Column:
    """Plain text of rich-text runs."""
    return F.array_join(F.transform(runs, lambda r: r["text"]), "")
