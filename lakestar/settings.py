"""Strict settings: an INI file for what an operator chooses, environment variables for secrets; anything unknown or missing raises."""

from __future__ import annotations

import configparser
from collections.abc import Mapping
from dataclasses import dataclass

#: Sections and keys of the file, with the type of each.
KEYS = {
    "paths": {"lake": str, "landing": str, "output": str},
    "writer": {"bronze_flush": int, "manifest_flush": int},
    "refresh": {"article_days": int, "journal_days": int, "issue_days": int},
}
SECRETS = ("LAKESTAR_WAREHOUSE_URL",)


@dataclass(frozen=True)
class Settings:
    lake: str
    landing: str
    output: str
    bronze_flush: int
    manifest_flush: int
    article_days: int
    journal_days: int
    issue_days: int
    warehouse_url: str


def load(text: str, environment: Mapping[str, str]) -> Settings:
    """Settings of an INI text; a number that isn't one, or a negative one, raises too."""
    parser = configparser.ConfigParser(interpolation=None, strict=True)
    parser.read_string(text)
    unknown = [f"{s}.{k}" for s in parser.sections() for k in parser[s] if k not in KEYS.get(s, {})] + [s for s in parser.sections() if s not in KEYS]
    missing = [f"{s}.{k}" for s, keys in KEYS.items() for k in keys if not parser.get(s, k, fallback="").strip()] + [k for k in SECRETS if not environment.get(k)]
    if unknown or missing:
        raise ValueError(f"unknown settings {unknown}, missing settings {missing}")
    values = {}
    for section, keys in KEYS.items():
        for key, kind in keys.items():
            values[key] = kind(parser.get(section, key).strip())
            if kind is int and values[key] < 0:
                raise ValueError(f"{section}.{key} is negative")
    return Settings(**values, warehouse_url=environment["LAKESTAR_WAREHOUSE_URL"])
