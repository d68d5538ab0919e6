"""Publication of version-pinned snapshots: plan by tracked versions, stage through JDBC, swap in one transaction."""

from __future__ import annotations

import json
import os
import re
import tempfile
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestar.session import shared_folder
from lakestar.sources.files import Files
from lakestar.sources.lock import lock
from lakestar.sources.table import VersionedTable

#: Warehouse types.
SQL_TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR(32672)", "boolean": "BOOLEAN", "double": "DOUBLE", "date": "DATE", "timestamp": "TIMESTAMP"}


@dataclass(frozen=True)
class Publication:
    versions: dict[str, int]
    rows: dict[str, int]
    skipped: bool


def plan(tables: dict[str, VersionedTable], last: dict[str, int] | None, force: bool = False) -> dict[str, int] | None:
    """Versions to publish; None if nothing moved since the last success."""
    now = {name: t.version() for name, t in tables.items()}
    return None if now == last and not force else now


def identifier(name: str) -> str:
    if not re.fullmatch(r"[a-z_][a-z0-9_]*", name):
        raise ValueError(f"bad identifier {name!r}")
    return name


def column(name: str) -> str:
    """A column's name quoted, so that it may be a word that the database keeps for itself; in upper case, as unquoted ones are."""
    return f'"{identifier(name).upper()}"'


def ddl(name: str, schema: T.StructType, key: list[str] = (), text: str | None = None) -> str:
    """CREATE TABLE of a schema; a type without a warehouse type raises. ``text``: another type for texts that aren't keys."""
    columns = []
    for f in schema:
        kind = SQL_TYPES.get(f.dataType.simpleString())
        if text and f.name not in key and isinstance(f.dataType, T.StringType):
            kind = text
        if kind is None:
            raise ValueError(f"no warehouse type for {f.name} {f.dataType.simpleString()}")
        columns.append(f"{column(f.name)} {kind}" + " NOT NULL" * (f.name in key))
    return f"CREATE TABLE {identifier(name)} ({', '.join(columns)}" + (f", PRIMARY KEY ({', '.join(map(column, key))})" if key else "") + ")"


def added_ddl(name: str, schema: T.StructType, there: list[str]) -> list[str]:
    """ALTER TABLE of each column of the schema that a live table doesn't have yet; old rows have null in it."""
    lacking = [f for f in schema if f.name not in there]
    for f in lacking:
        if f.dataType.simpleString() not in SQL_TYPES:
            raise ValueError(f"no warehouse type for {f.name} {f.dataType.simpleString()}")
    return [f"ALTER TABLE {identifier(name)} ADD COLUMN {column(f.name)} {SQL_TYPES[f.dataType.simpleString()]}" for f in lacking]


def text_literal(value: str) -> str:
    """A text in SQL."""
    return "'" + value.replace("'", "''") + "'"


def index_ddl(name: str, columns: list[str]) -> list[str]:
    """CREATE INDEX of each column."""
    return [f"CREATE INDEX idx_{identifier(name)}_{identifier(c)} ON {identifier(name)} ({column(c)})" for c in columns]


LAYER_STATUS = "CREATE TABLE layer_status (table_name VARCHAR(200) NOT NULL PRIMARY KEY, table_version BIGINT NOT NULL, row_count BIGINT NOT NULL, published_at TIMESTAMP NOT NULL)"


class Transaction:
    """Statements on one connection; nothing of them is seen until the transaction ends well."""

    def __init__(self, connection):
        self._statement = connection.createStatement()

    def execute(self, sql: str) -> None:
        self._statement.execute(sql)

    def value(self, sql: str) -> int:
        found = self._statement.executeQuery(sql)
        found.next()
        return found.getLong(1)


class Warehouse:
    """A JDBC database reached through the driver's java.sql; the data itself goes from the executors.

    An embedded database lives in the driver's process, where executors elsewhere can't reach it. They write its rows as files in
    the shared folder, which the database loads by its own bulk import, a file at a time, and what is read of it goes the other way.
    """

    def __init__(self, spark: SparkSession, url: str, driver: str = "org.apache.derby.iapi.jdbc.AutoloadedDriver"):
        self.spark, self.url, self.driver = spark, url, driver
        self._jvm = spark.sparkContext._jvm
        self.embedded = url.startswith("jdbc:derby:") and not url.startswith("jdbc:derby://")
        #: What Spark's writer takes a text for where it is null, if the database won't have that in a column of SQL_TYPES.
        self.stage_text = "CLOB" if "derby" in driver else None

    def connect(self):
        self._jvm.java.lang.Class.forName(self.driver)
        return self._jvm.java.sql.DriverManager.getConnection(self.url)

    @contextmanager
    def transaction(self) -> Iterator[Transaction]:
        c = self.connect()
        try:
            c.setAutoCommit(False)
            yield Transaction(c)
            c.commit()
        except BaseException:
            c.rollback()
            raise
        finally:
            c.close()

    def execute(self, *statements: str, transaction: bool = False) -> None:
        """Runs statements; as a transaction all of them take effect, or none."""
        if transaction:
            with self.transaction() as t:
                for sql in statements:
                    t.execute(sql)
            return
        c = self.connect()
        try:
            for sql in statements:
                c.createStatement().execute(sql)
        finally:
            c.close()

    def has(self, name: str) -> bool:
        c = self.connect()
        try:
            return c.getMetaData().getTables(None, None, name.upper(), None).next()
        finally:
            c.close()

    def columns(self, name: str) -> list[str]:
        """A table's columns, in lower case."""
        c, out = self.connect(), []
        try:
            found = c.getMetaData().getColumns(None, None, name.upper(), None)
            while found.next():
                out.append(found.getString("COLUMN_NAME").lower())
            return out
        finally:
            c.close()

    def stage(self, df: DataFrame, name: str, key: list[str]) -> str:
        """Writes rows to stage_<name>, made anew; returns the select list that gives them in the live table's types."""
        if self.has(f"stage_{name}"):
            self.execute(f"DROP TABLE stage_{identifier(name)}")
        self.execute(ddl(f"stage_{name}", df.schema, key, self.stage_text))
        self.write(df, f"stage_{name}")
        is_text = lambda f: self.stage_text and f.name not in key and isinstance(f.dataType, T.StringType)
        return ", ".join(f"CAST({column(f.name)} AS {SQL_TYPES['string']})" if is_text(f) else column(f.name) for f in df.schema)

    def write(self, df: DataFrame, name: str, partitions: int = 4) -> None:
        """Replaces a table's rows."""
        if self.embedded:
            return self._load(df, name)
        df.coalesce(partitions).write.format("jdbc").option("url", self.url).option("driver", self.driver).option("dbtable", name).option("truncate", "true").option("batchsize", 1000).mode("overwrite").save()

    def read(self, name: str) -> DataFrame:
        """A table's rows; those of an embedded database as they are at the call."""
        rows = self.spark.read.format("jdbc").option("url", self.url).option("driver", self.driver).option("dbtable", name).load()
        return self._unloaded(name, rows.schema) if self.embedded else rows

    def count(self, name: str) -> int:
        """How many rows a table has, counted by the database."""
        with self.transaction() as t:
            return t.value(f"SELECT COUNT(*) FROM {identifier(name)}")

    def _load(self, df: DataFrame, name: str) -> None:
        """Rows by way of the shared folder: quoted fields with quotes doubled; a null is a field without quotes."""
        folder = f"{shared_folder(self.spark)}/load-{uuid.uuid4().hex}"
        fields = [F.coalesce(F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"')), F.lit("")) for c in df.columns]
        df.select(F.concat_ws(",", *fields).alias("value")).write.text(folder)
        files, columns = Files(self.spark, folder), ",".join(identifier(c).upper() for c in df.columns)
        self.execute(f"TRUNCATE TABLE {identifier(name)}")
        with tempfile.TemporaryDirectory(prefix="lakestar-") as local:
            for path, size in files.tree(folder):
                if size and path.endswith(".txt"):
                    part = f"{local}/part.csv"
                    files.fetch(path, part)
                    self.execute(f"CALL SYSCS_UTIL.SYSCS_IMPORT_DATA(NULL, {text_literal(name.upper())}, {text_literal(columns)}, NULL, {text_literal(part)}, ',', '\"', 'UTF-8', 0)")
                    os.remove(part)
        files.delete(folder)

    def _unloaded(self, name: str, schema: T.StructType) -> DataFrame:
        """A table written out by the database, in the shared folder."""
        target = f"{shared_folder(self.spark)}/unload-{uuid.uuid4().hex}.csv"
        with tempfile.TemporaryDirectory(prefix="lakestar-") as local:
            self.execute(f"CALL SYSCS_UTIL.SYSCS_EXPORT_TABLE(NULL, {text_literal(identifier(name).upper())}, {text_literal(f'{local}/table.csv')}, ',', '\"', 'UTF-8')")
            Files(self.spark, target).copy(f"file://{local}/table.csv", target)
        texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
        options = {"quote": '"', "escape": '"', "multiLine": "true", "lineSep": "\n", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "mode": "FAILFAST", "maxCharsPerColumn": "-1", "nullValue": "\0null\0", "emptyValue": ""}
        return self.spark.read.schema(texts).options(**options).csv(target).select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema))


#: Foreign keys to verify: table to {column: (parent table, key)}.
Foreign = dict[str, dict[str, tuple[str, str]]]


def verify(t: Transaction, rows: dict[str, int], foreign: Foreign) -> None:
    """Raises if a live table's count isn't the pinned one, or a foreign key has orphans."""
    for name, n in rows.items():
        found = t.value(f"SELECT COUNT(*) FROM {identifier(name)}")
        if found != n:
            raise RuntimeError(f"{name}: the warehouse holds {found} rows, not {n}")
    for child, keys in foreign.items():
        for foreign_key, (parent, key) in keys.items():
            c, p = column(foreign_key), column(key)
            n = t.value(f"SELECT COUNT(*) FROM {identifier(child)} c LEFT JOIN {identifier(parent)} p ON c.{c} = p.{p} WHERE c.{c} IS NOT NULL AND p.{p} IS NULL")
            if n:
                raise RuntimeError(f"{child}.{foreign_key} has {n} orphans")


def publish(warehouse: Warehouse, tables: dict[str, VersionedTable], keys: dict[str, list[str]], last: dict[str, int] | None = None, force: bool = False, dry_run: bool = False, foreign: Foreign | None = None, before_swap: Callable[[], None] | None = None) -> Publication:
    """Stages pinned snapshots, then replaces all live tables and the layer status in one transaction.

    Counts and foreign keys are verified inside the transaction, so what doesn't hold is never live, and once more after.
    ``before_swap`` is called between staging and swap.
    """
    versions = plan(tables, last, force)
    if versions is None or dry_run:
        return Publication(versions or dict(last or {}), {}, True)
    foreign = foreign or {}
    rows, columns, staged = {}, {}, {}
    if not warehouse.has("layer_status"):
        warehouse.execute(LAYER_STATUS)
    for name, table in tables.items():
        df = table.read(versions[name])
        columns[name] = ", ".join(map(column, df.columns))
        is_text = lambda f, name=name: warehouse.stage_text and f.name not in keys.get(name, []) and isinstance(f.dataType, T.StringType)
        staged[name] = ", ".join(f"CAST({column(f.name)} AS {SQL_TYPES['string']})" if is_text(f) else column(f.name) for f in df.schema)
        if not warehouse.has(name):
            warehouse.execute(ddl(name, df.schema, keys.get(name, [])), *index_ddl(name, [c for c in foreign.get(name, {}) if c not in keys.get(name, [])[:1]]))
        if not warehouse.has(f"stage_{name}"):
            warehouse.execute(ddl(f"stage_{name}", df.schema, keys.get(name, []), warehouse.stage_text))
        warehouse.write(df, f"stage_{name}")
        rows[name] = df.count()
    if before_swap is not None:
        before_swap()
    with warehouse.transaction() as t:
        for name in tables:
            t.execute(f"DELETE FROM {identifier(name)}")
            t.execute(f"INSERT INTO {identifier(name)} ({columns[name]}) SELECT {staged[name]} FROM stage_{identifier(name)}")
        t.execute("DELETE FROM layer_status")
        for name in tables:
            t.execute(f"INSERT INTO layer_status VALUES ('{identifier(name)}', {versions[name]}, {rows[name]}, CURRENT_TIMESTAMP)")
        verify(t, rows, foreign)
    with warehouse.transaction() as t:
        verify(t, rows, foreign)
    return Publication(versions, rows, False)


LOG = "started_at timestamp, finished_at timestamp, status string, versions string, rows string, error string"


def latest_success(log: VersionedTable) -> dict[str, int] | None:
    """The versions that the last successful publication had."""
    if not log.exists():
        return None
    last = log.read().where("status = 'success'").agg(F.max_by("versions", "finished_at").alias("v")).first()
    return json.loads(last.v) if last and last.v else None


def publish_logged(warehouse: Warehouse, tables: dict[str, VersionedTable], keys: dict[str, list[str]], log: VersionedTable, force: bool = False, dry_run: bool = False, foreign: Foreign | None = None, **options) -> Publication:
    """``publish`` against the last success in ``log``, one publication at a time; success or failure is appended.

    A failure is raised again, with a note if it couldn't be logged. Skipped and dry runs write nothing.
    """
    with lock(warehouse.spark, f"{log.root}.lock", "publish"):
        log.create(LOG, properties={"appendOnly": "true"})
        began, done = time.time(), None
        try:
            done = publish(warehouse, tables, keys, latest_success(log), force, dry_run, foreign, **options)
            if not done.skipped:
                _log(warehouse.spark, log, began, "success", done.versions, done.rows, None)
            return done
        except Exception as e:
            try:
                _log(warehouse.spark, log, began, "failed", {}, {}, str(e)[:2000])
            except Exception as more:
                e.add_note(f"the failure couldn't be logged: {more}")
            raise


def _log(spark: SparkSession, log: VersionedTable, began: float, status: str, versions: dict, rows: dict, error: str | None) -> None:
    row = (began, time.time(), status, json.dumps(versions), json.dumps(rows), error)
    found = spark.createDataFrame([row], "started_at double, finished_at double, status string, versions string, rows string, error string")
    log.append(found.withColumns({c: F.col(c).cast("timestamp") for c in ("started_at", "finished_at")}))
