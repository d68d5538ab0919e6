"""Mutual exclusion through a lock file that only one holder can create."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from lakestar.sources.files import Files


class LockHeld(RuntimeError):
    """Another holder has the lock."""


@contextmanager
def lock(spark: SparkSession, path: str, owner: str = "") -> Iterator[str]:
    """Holds ``path`` while the block runs; raises LockHeld at once if somebody else does."""
    files, token = Files(spark, path), uuid.uuid4().hex
    try:
        files.create(path, json.dumps({"owner": owner, "token": token, "since": time.time()}))
    except Exception as e:
        if files.exists(path):
            raise LockHeld(f"{path} is held: {files.read(path)}") from e
        raise
    try:
        yield token
    finally:
        if files.exists(path) and json.loads(files.read(path))["token"] == token:
            files.delete(path)
