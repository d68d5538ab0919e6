"""Versioned Parquet tables: an ordered commit log over immutable files, with time travel and planned merges.

Layout: ``<root>/data/<partitions>/*.parquet`` and ``<root>/_log/<version>.json``. A write stages its files, moves
them into ``data`` and commits by creating the next log file, which fails if another writer was first.
"""

from __future__ import annotations

import json
import re
import time
import uuid
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.sources.files import Files


#: The mark of rows that a merge carries over as they are, where others have their clause's place.
CARRIED = -2
#: The whole state is written beside every so many versions of the log.
CHECKPOINT = 10


class CommitConflict(RuntimeError):
    """Another writer committed this version first."""


class MergeMismatch(RuntimeError):
    """What a merge wrote isn't what was planned; nothing of it was committed."""


@dataclass(frozen=True)
class MergeCounts:
    """Rows inserted, updated and deleted."""

    inserted: int = 0
    updated: int = 0
    deleted: int = 0

    def __post_init__(self):
        if min(self.inserted, self.updated, self.deleted) < 0:
            raise ValueError("planned counts must not be negative")


@dataclass(frozen=True)
class MergeResult:
    """What a merge did, as counted while it was written; ``version`` is unchanged if it did nothing.

    ``planned``: what the classified rows, or the caller, said it would do. ``carried``: rows of rewritten files that
    stayed as they were; ``by_clause``: written rows of each clause but deletes, by its place in the list.
    """

    inserted: int
    updated: int
    deleted: int
    version: int
    skipped: bool
    planned: MergeCounts = MergeCounts()
    carried: int = 0
    by_clause: dict[int, int] = field(default_factory=dict)


@dataclass(frozen=True)
class Clause:
    """One ordered clause of a merge. ``condition`` is SQL over ``target.*`` and ``source.*``; ``values`` maps columns to SQL."""

    action: str
    when: str = "matched"
    condition: str = "true"
    values: dict[str, str] = field(default_factory=dict)


class VersionedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.files = spark, root.rstrip("/"), Files(spark, root)

    # -- log -----------------------------------------------------------------
    def exists(self) -> bool:
        return self.files.exists(f"{self.root}/_log/{0:020d}.json")

    def version(self) -> int:
        names = [n for n in self.files.names(f"{self.root}/_log") if n.endswith(".json") and "." not in n[:-5]]
        if not names:
            raise FileNotFoundError(f"no table at {self.root}")
        return int(names[-1].split(".")[0])

    def _entry(self, version: int) -> dict:
        return json.loads(self.files.read(f"{self.root}/_log/{version:020d}.json"))

    def _state(self, version: int | None = None) -> dict:
        """Live files, schema, partitioning and properties at a version."""
        last = self.version() if version is None else version
        if last > self.version() or last < 0:
            raise ValueError(f"no version {last} of {self.root}")
        live: dict[str, int] = {}
        state: dict = {"version": last}
        first = 0
        for v in range(last - last % CHECKPOINT, 0, -CHECKPOINT):
            path = f"{self.root}/_log/{v:020d}.checkpoint.json"
            if self.files.exists(path):
                state = json.loads(self.files.read(path)) | {"version": last}
                live, first = state.pop("files"), v + 1
                break
        for v in range(first, last + 1):
            entry = self._entry(v)
            for path in entry["remove"]:
                live.pop(path, None)
            live |= dict(entry["add"])
            state |= {k: entry[k] for k in ("schema", "partition_by", "properties") if k in entry}
        return state | {"files": live}

    def _commit(self, version: int, operation: str, metrics: dict, add: list, remove: list, **more) -> int:
        entry = {"version": version, "timestamp": int(time.time() * 1000), "operation": operation, "metrics": metrics, "add": add, "remove": remove} | more
        path = f"{self.root}/_log/{version:020d}.json"
        try:
            self.files.create(path, json.dumps(entry))
        except Exception as e:
            if self.files.exists(path) and self.files.read(path) != json.dumps(entry):
                raise CommitConflict(f"version {version} of {self.root} exists already") from e
            raise
        if version and version % CHECKPOINT == 0:
            # A reader may find it half written only before anybody knows of it: it is moved into place.
            state = self._state(version)
            self.files.create(f"{self.root}/_log/.{version}.tmp", json.dumps(state), overwrite=True)
            self.files.move(f"{self.root}/_log/.{version}.tmp", f"{self.root}/_log/{version:020d}.checkpoint.json")
        return version

    def _write(self, df: DataFrame, partition_by: list[str]) -> list[tuple[str, int]]:
        staging, tag = f"{self.root}/_staging/{uuid.uuid4().hex}", uuid.uuid4().hex[:12]
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(staging)
        out = []
        for path, length in self.files.tree(staging):
            inside = path.split(staging.split("://")[-1].rstrip("/"), 1)[1].lstrip("/")
            if inside.endswith(".parquet"):
                *folder, name = inside.split("/")
                target = "/".join([*folder, f"{tag}-{name}"])
                self.files.move(path, f"{self.root}/data/{target}")
                out.append((target, length))
        self.files.delete(staging)
        return out

    # -- reads ---------------------------------------------------------------
    def read(self, version: int | None = None) -> DataFrame:
        """A snapshot; the latest by default."""
        state = self._state(version)
        schema = T.StructType.fromJson(state["schema"])
        if not state["files"]:
            return self.spark.createDataFrame([], schema)
        self.files.make(f"{self.root}/data")
        return self._scan(schema, sorted(state["files"]))

    def _scan(self, schema: T.StructType, files: list[str]) -> DataFrame:
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*(f"{self.root}/data/{p}" for p in files)).select(*schema.names)

    def history(self) -> DataFrame:
        rows = [(e["version"], e["timestamp"], e["operation"], json.dumps(e["metrics"], sort_keys=True)) for e in map(self._entry, range(self.version() + 1))]
        return self.spark.createDataFrame(rows, "version long, timestamp long, operation string, metrics string")

    def detail(self) -> dict:
        state = self._state()
        return {"version": state["version"], "files": len(state["files"]), "bytes": sum(state["files"].values()), "partition_by": state["partition_by"], "properties": state["properties"]}

    # -- writes --------------------------------------------------------------
    def create(self, schema: T.StructType | str, partition_by: tuple[str, ...] = (), properties: dict | None = None) -> VersionedTable:
        """Creates the table if it isn't there."""
        if not self.exists():
            schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
            # What one batch never lacks, a later one may.
            nullable = json.loads(re.sub(r'("nullable"|"containsNull"|"valueContainsNull"): false', r"\1: true", json.dumps(schema.jsonValue())))
            self._commit(0, "CREATE TABLE", {}, [], [], schema=nullable, partition_by=list(partition_by), properties=properties or {})
        return self

    def _aligned(self, df: DataFrame, state: dict) -> DataFrame:
        schema = T.StructType.fromJson(state["schema"])
        return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema))

    def append(self, df: DataFrame, files: int | None = None) -> int:
        """Appends rows; ``files``: coalesced to so many, for small batches."""
        state = self._state()
        df = self._aligned(df, state)
        add = self._write(df.coalesce(files) if files else df, state["partition_by"])
        return self._commit(state["version"] + 1, "WRITE", {"mode": "append", "numFiles": len(add)}, add, [])

    def overwrite(self, df: DataFrame) -> int:
        state = self._state()
        self._may_change(state)
        add = self._write(self._aligned(df, state), state["partition_by"])
        return self._commit(state["version"] + 1, "WRITE", {"mode": "overwrite", "numFiles": len(add)}, add, list(state["files"]))

    def replace_where(self, df: DataFrame, condition: str) -> int:
        """Replaces the rows that ``condition`` holds for by ``df``, in one commit; only files with such rows are written anew."""
        state = self._state()
        self._may_change(state)
        schema = T.StructType.fromJson(state["schema"])
        rows, inside = self._aligned(df, state), []
        if state["files"]:
            touched = [r._file for r in self.read().withColumn("_file", F.input_file_name()).where(condition).select("_file").distinct().collect()]
            places = {name: p for p in state["files"] for name in (p, _quoted(p))}
            inside = sorted({places[t.split("/data/", 1)[1]] for t in touched})
            if inside:
                rows = rows.unionByName(self._scan(schema, inside).where(~F.coalesce(F.expr(condition), F.lit(False))))
        add = self._write(rows, state["partition_by"])
        return self._commit(state["version"] + 1, "WRITE", {"mode": "replace", "numFiles": len(add)}, add, inside)

    def _may_change(self, state: dict) -> None:
        if str(state["properties"].get("appendOnly", "false")).lower() == "true":
            raise ValueError(f"{self.root} is append-only")

    def _observed_write(self, rows: DataFrame, state: dict, clauses: list[Clause], inside: list[str]) -> tuple[list, MergeResult]:
        """Writes rows (with ``_clause``, CARRIED for those carried over) and counts them by clause while they are written.

        The count is taken in the stage that writes, behind every shuffle, where a task that runs twice counts once.
        What was deleted is what the rewritten files' footers hold more than was carried over and updated.
        """
        seen = Observation()
        kinds = {f"clause_{i}": i for i, c in enumerate(clauses) if c.action != "delete"} | {"carried": CARRIED}
        counted = rows.observe(seen, *(F.count_if(F.col("_clause") == i).alias(name) for name, i in kinds.items()))
        add = self._write(counted.drop("_clause"), state["partition_by"])
        found = seen.get
        of = lambda action: sum(found[name] for name, i in kinds.items() if i >= 0 and clauses[i].action == action)
        before = self._scan(T.StructType.fromJson(state["schema"]), inside).count() if inside else 0
        deleted = before - found["carried"] - of("update")
        return add, MergeResult(of("insert"), of("update"), deleted, state["version"], False, carried=found["carried"], by_clause={i: found[name] for name, i in kinds.items() if i >= 0})

    def merge(self, source: DataFrame, keys: list[str], clauses: list[Clause], planned: MergeCounts | None = None) -> MergeResult:
        """Merges ``source`` by equal keys; the first clause whose condition holds decides a row.

        Actions: ``update`` and ``delete`` (when matched, or not_matched_by_source), ``insert`` (when not_matched).
        Source rows with a null key match nothing. The classified rows are the plan, unless the caller has one
        (``planned``); a plan without changes reads, writes and commits nothing more, and only files that hold changed rows
        are written anew. Rows are counted again as they are written: a merge whose counts aren't the plan's raises
        ``MergeMismatch`` and commits nothing.
        """
        state = self._state()
        if planned == MergeCounts():
            return MergeResult(0, 0, 0, state["version"], True)
        schema = T.StructType.fromJson(state["schema"])
        names = schema.names
        target = self.read().withColumn("_file", F.input_file_name()) if state["files"] else self.read().withColumn("_file", F.lit(""))
        source = source.select(F.struct(*(c for c in source.columns)).alias("source"), F.lit(True).alias("_in_source"))
        target = target.select(F.struct(*names).alias("target"), "_file", F.lit(True).alias("_in_target"))
        on = [F.col(f"source.{k}") == F.col(f"target.{k}") for k in keys]
        if state["files"] and any(c.action != "insert" and c.when == "matched" for c in clauses):
            # Only keys that the source itself holds twice can match a target row twice.
            doubled = source.groupBy(*(F.col(f"source.{k}").alias(k) for k in keys)).agg(F.count("*").alias("n")).where("n > 1")
            doubled = doubled.limit(1).collect() and doubled.join(self.read().select(*keys), keys, "left_semi").limit(5).collect()
            if doubled:
                raise ValueError(f"several source rows match one target row: {[r.asDict() for r in doubled]}")
        # Target rows that no source row matches are only joined where a clause is about them.
        whole = any(c.when == "not_matched_by_source" for c in clauses)
        joined = target.join(source, on, "full_outer" if whole else "right_outer")
        both = F.col("_in_source").isNotNull() & F.col("_in_target").isNotNull()
        state_of = F.when(both, "matched").when(F.col("_in_source").isNotNull(), "not_matched").otherwise("not_matched_by_source")
        action: Column = F
        for i, c in enumerate(clauses):
            action = action.when((state_of == c.when) & F.coalesce(F.expr(c.condition), F.lit(False)), F.lit(i))
        joined = joined.withColumn("_clause", action.otherwise(F.lit(-1))).persist()
        try:
            counts = {r["_clause"]: r.n for r in joined.groupBy("_clause").agg(F.count("*").alias("n")).collect()}
            done = {a: sum(counts.get(i, 0) for i, c in enumerate(clauses) if c.action == a) for a in ("insert", "update", "delete")}
            plan = planned or MergeCounts(done["insert"], done["update"], done["delete"])
            if not any(done.values()) and plan == MergeCounts():
                return MergeResult(0, 0, 0, state["version"], True)
            if done["update"] or done["delete"]:
                self._may_change(state)
            acting = [i for i, c in enumerate(clauses) if c.action in ("update", "delete")]
            # _file is read where the row was scanned; a rewritten file's other rows are carried over.
            touched = [r["_file"] for r in joined.where(F.col("_clause").isin(acting)).select("_file").distinct().collect()] if acting else []

            def value(f: T.StructField) -> Column:
                out = F.col(f"target.{f.name}")
                for i, c in enumerate(clauses):
                    if c.action in ("insert", "update"):
                        new = F.expr(c.values[f.name]) if f.name in c.values else F.col(f"source.{f.name}") if not c.values else F.col(f"target.{f.name}")
                        out = F.when(F.col("_clause") == i, new.cast(f.dataType)).otherwise(out)
                return out.alias(f.name)

            places = {name: p for p in state["files"] for name in (p, _quoted(p))}
            inside = sorted({places[t.split("/data/", 1)[1]] for t in touched})
            rows = joined.where(F.col("_clause").isin([i for i, c in enumerate(clauses) if c.action != "delete"])).select(*(value(f) for f in schema), "_clause")
            if inside:
                acted = joined.where(F.col("_clause").isin(acting)).select(*(F.col(f"target.{k}").alias(k) for k in keys))
                others = self._scan(schema, inside)
                same = [others[k].eqNullSafe(acted[k]) for k in keys]
                rows = rows.unionByName(others.join(acted, same, "left_anti").withColumn("_clause", F.lit(CARRIED)))
            add, seen = self._observed_write(rows, state, clauses, inside)
        finally:
            joined.unpersist()
        if (seen.inserted, seen.updated, seen.deleted) != (plan.inserted, plan.updated, plan.deleted):
            for path, _ in add:
                self.files.delete(f"{self.root}/data/{path}")
            raise MergeMismatch(f"the merge disagrees with its plan: planned {plan.inserted} inserts, {plan.updated} updates, {plan.deleted} deletes; wrote {seen.inserted}, {seen.updated}, {seen.deleted}")
        metrics = {"numTargetRowsInserted": seen.inserted, "numTargetRowsUpdated": seen.updated, "numTargetRowsDeleted": seen.deleted, "numTargetRowsCopied": seen.carried, "numTargetFilesAdded": len(add), "numFilesRemoved": len(inside)}
        version = self._commit(state["version"] + 1, "MERGE", metrics, add, inside)
        return replace(seen, version=version, planned=plan)

    # -- maintenance ---------------------------------------------------------
    def optimize(self, threshold: int = 32 << 20) -> bool:
        """Rewrites into fewer files if there are several of a small average size; rows must stay the same, else it raises."""
        from lakestar.functions.hashing import fingerprint

        state = self._state()
        n, size = len(state["files"]), sum(state["files"].values())
        folders = {p.rpartition("/")[0] for p in state["files"]}
        if n <= len(folders) or size / n >= threshold:
            return False
        before = fingerprint(self.read()).first()
        rows = self.read().repartition(max(1, -(-size // (4 * threshold))), *state["partition_by"]) if state["partition_by"] else self.read().coalesce(max(1, -(-size // (4 * threshold))))
        add = self._write(rows, state["partition_by"])
        if fingerprint(self.spark.read.schema(T.StructType.fromJson(state["schema"])).option("basePath", f"{self.root}/data").parquet(*(f"{self.root}/data/{p}" for p, _ in add))).first() != before:
            raise RuntimeError("compaction changed the data")
        self._commit(state["version"] + 1, "OPTIMIZE", {"numFilesAdded": len(add), "numFilesRemoved": n}, add, list(state["files"]))
        return True

    def vacuum(self, hours: float = 168) -> int:
        """Deletes files that no version of the last ``hours`` (168 at least) needs; returns how many."""
        if hours < 168:
            raise ValueError("files are kept for 168 hours at least")
        since = time.time() * 1000 - hours * 3_600_000
        entries = [self._entry(v) for v in range(self.version() + 1)]
        needed = set(self._state()["files"])
        for e in entries:
            if e["timestamp"] >= since:
                needed |= set(self._state(e["version"])["files"]) | set(e["remove"])
        gone = 0
        for path, _ in self.files.tree(f"{self.root}/data"):
            inside = path.split("/data/", 1)[1] if "/data/" in path else path
            if inside not in needed and self.files.modified(path) < since:
                self.files.delete(path)
                gone += 1
        return gone


def _quoted(path: str) -> str:
    from urllib.parse import quote

    return quote(path, safe="/=")


def insert_only() -> list[Clause]:
    return [Clause("insert", "not_matched")]


def upsert(changed: str, values: dict[str, str] | None = None) -> list[Clause]:
    """Updates rows for which ``changed`` holds, inserts new ones."""
    return [Clause("update", "matched", changed, values or {}), Clause("insert", "not_matched")]


def self_healing(business: list[str], stored: str = "_row_hash") -> list[Clause]:
    """Updates rows whose stored hash differs, and rows whose stored hash is right but whose values aren't; inserts new ones.

    The target's hash is computed anew from its business columns, as ``functions.hashing.row_hash`` does.
    """
    struct = ", ".join(f"'{c}', target.{c}" for c in business)
    anew = f"sha2(to_json(named_struct({struct}), map('ignoreNullFields', 'false')), 256)"
    return [
        Clause("update", "matched", f"not (target.{stored} <=> source.{stored})"),
        Clause("update", "matched", f"not ({anew} <=> source.{stored})"),
        Clause("insert", "not_matched"),
    ]
