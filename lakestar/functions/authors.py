"""Contributors from nested JSON author trees, as one struct per document.

A document holds ``affiliations`` (id to node) and ``content``, whose first entry is the tree's root. A node is
{"#name": kind, "$": attributes, "$$": children, "_": text}. Affiliations are joined to people by the ids that their
cross references name; if nobody refers to any and there is just one, it is everybody's.
"""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Iterable, Iterator
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_CONTACTS = "array<struct<name:string,affiliation:string,email:string>>"
PEOPLE = f"authors {_CONTACTS}, corporate {_CONTACTS}, token string"
_TOKEN_DEPTH = 6
#: Nodes that authors may be nested in.
_GROUPS = ("author-group", "writing-group", "collaboration")


def _children(node: object, *kinds: str) -> list[dict]:
    below = node.get("$$") if isinstance(node, dict) else node
    return [c for c in below or () if isinstance(c, dict) and (not kinds or c.get("#name") in kinds)]


def _text(node: dict) -> str:
    return str(node.get("_") or "").strip()


def authors_below(items: Iterable) -> Iterator[dict]:
    """Author nodes, also those inside of groups."""
    for item in _children(items):
        if item.get("#name") == "author":
            yield item
        elif item.get("#name") in _GROUPS:
            yield from authors_below(_children(item))


def tidy_affiliation(value: str) -> str:
    """Slashes and runs of commas become blanks, blanks one blank."""
    return re.sub(r"\s+", " ", re.sub(r",\s*,+", " ", re.sub(r"\s*/\s*", " ", value))).strip()


def decode_email(value: str | None) -> str:
    """The address in a base64 token of url-encoded JSON: its text, else its mailto link; anything unreadable is empty."""
    try:
        body = json.loads(unquote(base64.b64decode(value + "=" * (-len(value) % 4)).decode()))
        link = body.get("$", {}).get("href", "")
        return body.get("_", "").strip() or (link.removeprefix("mailto:").strip() if link.startswith("mailto:") else "")
    except (ValueError, TypeError, AttributeError):
        return ""


def find_token(tree: object, key: str = "authorToken", depth: int = _TOKEN_DEPTH) -> str | None:
    """The first non-empty text under ``key``, depth first."""
    if depth < 0 or not isinstance(tree, (dict, list)):
        return None
    for name, child in tree.items() if isinstance(tree, dict) else enumerate(tree):
        if name == key and isinstance(child, str) and child:
            return child
        if found := find_token(child, key, depth - 1):
            return found
    return None


def _affiliations(tree: dict, root: list[dict]) -> dict[str, str]:
    """Id to tidy text, from the document's table and from nodes at the root, the table's first."""
    table = tree.get("affiliations")
    nodes = [*(table.items() if isinstance(table, dict) else ()), *((n.get("$", {}).get("id"), n) for n in _children(root, "affiliation"))]
    out: dict[str, str] = {}
    for key, node in nodes:
        text = next((tidy_affiliation(_text(t)) for t in _children(node, "textfn")), "")
        if key and text:
            out.setdefault(key, text)
    return out


def is_affiliation_ref(ref: str, known: dict[str, str]) -> bool:
    """A known id, or one written like an affiliation's: correspondence and other references aren't."""
    return bool(ref) and (ref in known or re.match(r"^aff?\d+$", ref) is not None)


def _email(node: dict) -> str:
    return next((found for c in reversed(_children(node, "encoded-e-address")) if c.get("__encoded") and (found := decode_email(c["__encoded"]))), "")


def contributors(text: str | None) -> dict:
    """authors, corporate authors and token of one document's JSON; unreadable JSON has none."""
    try:
        tree = json.loads(text or "")
    except ValueError:
        tree = None
    out: dict = {"authors": [], "corporate": [], "token": find_token(tree)}
    if not isinstance(tree, dict):
        return out
    content = tree.get("content")
    root = _children(content[0]) if isinstance(content, list) and content else []
    known = _affiliations(tree, root)
    people = list(authors_below(root))
    refs_of = lambda n: [r for c in _children(n, "cross-ref") if is_affiliation_ref(r := c.get("$", {}).get("refid", ""), known)]
    joined = lambda refs: "\\".join(filter(None, (known.get(r, f"[MISSING:{r}]") for r in refs)))
    shared = list(known) if len(known) == 1 and not any(map(refs_of, people)) else []
    for person in people:
        parts = {k: next((_text(c) for c in reversed(_children(person, k))), "") for k in ("given-name", "surname")}
        out["authors"].append({"name": " ".join(parts.values()).strip(), "affiliation": joined(shared or refs_of(person)), "email": _email(person)})
    for group in _children(root, "collaboration"):
        name = next((_text(c) for c in reversed(_children(group, "text"))), "")
        if name:
            out["corporate"].append({"name": name, "affiliation": joined(refs_of(group)), "email": _email(group)})
    return out


def people(document: Column) -> Column:
    """``contributors`` of a JSON column, in Arrow batches."""

    @F.pandas_udf(PEOPLE)
    def run(documents: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([contributors(d) for d in documents], columns=["authors", "corporate", "token"])

    return run(document)
