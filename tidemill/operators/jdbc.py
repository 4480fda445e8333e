"""Targets in a relational database: tasks fill a stage table, and one transaction of the database merges it."""

from __future__ import annotations

import uuid
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import nest
from .merge import DAY, ContractError, ReplaceDay, Upsert, WriteResult, Writer, conform, new_columns, survivors

#: Column types by database, where Spark's own choice can't be compared or indexed (fixed values).
TEXT = {"derby": "VARCHAR(32672)", "sqlserver": "NVARCHAR(4000)"}


@dataclass(frozen=True)
class JdbcWriter:
    """Replace days or upsert into tables of a JDBC database, with child tables for lists.

    A load that fails leaves the tables as they were; one that runs again gives the same rows.
    """

    url: str
    merge: ReplaceDay | Upsert = field(default_factory=ReplaceDay)
    max_nesting: int | None = None
    properties: dict[str, str] = field(default_factory=dict)

    def kind(self) -> str:
        return self.url.split(":")[1]

    def current(self, spark: SparkSession, root: str, name: str) -> DataFrame | None:
        with self.connection(spark) as c:
            if not self.has(c, name):
                return None
        return spark.read.jdbc(self.url, self.quoted(name), properties=self.properties)

    @contextmanager
    def connection(self, spark: SparkSession):
        jvm = spark._jvm
        held = jvm.java.util.Properties()
        for k, v in self.properties.items():
            held.setProperty(k, v)
        if "driver" in self.properties:
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(self.properties["driver"])
        c = jvm.java.sql.DriverManager.getConnection(self.url, held)
        try:
            c.setAutoCommit(False)
            yield c
            c.commit()
        except BaseException:
            c.rollback()
            raise
        finally:
            c.close()

    @staticmethod
    def quoted(name: str) -> str:
        return '"' + name.replace('"', '""') + '"'

    def has(self, c, name: str) -> bool:
        found = c.getMetaData().getTables(None, None, name, None)
        try:
            return found.next()
        finally:
            found.close()

    @staticmethod
    def run(c, sql: str) -> int:
        s = c.createStatement()
        try:
            return s.executeUpdate(sql)
        finally:
            s.close()

    def create(self, df: DataFrame, name: str) -> None:
        """An empty table for the columns of ``df``."""
        kinds = ", ".join(f"`{f.name}` {TEXT[self.kind()]}" for f in df.schema if isinstance(f.dataType, T.StringType) and self.kind() in TEXT)
        writer = df.limit(0).write.option("createTableColumnTypes", kinds) if kinds else df.limit(0).write
        writer.jdbc(self.url, self.quoted(name), "ignore", self.properties)

    def write(self, rows: DataFrame, root: str, name: str, committed: T.StructType | None = None, metadata: tuple[str, ...] = ()) -> WriteResult:
        spark = rows.sparkSession
        tables = nest.denest(rows, name, self.max_nesting, carried=tuple(m for m in metadata if m in rows.columns))
        if committed is not None:
            tables[name] = conform(tables[name], committed)
        stages: dict[str, tuple[str, list[str]]] = {}
        kept: dict[str, DataFrame] = {}
        n = 0
        try:
            for t, df in tables.items():  # parents come first
                if isinstance(self.merge, Upsert) and t == name:
                    df = survivors(df, self.merge.keys, tuple(c for c in ("_source_file", "_position") if c in df.columns))
                elif isinstance(self.merge, Upsert):  # lists of the rows that stay
                    df = df.join(kept[nest.parent_of(t, kept)].select(F.col(nest.ROW_ID).alias(nest.PARENT_KEY)), nest.PARENT_KEY, "left_semi")
                kept[t] = df = df.drop("_position").persist()
                n += df.count()
                stage = f"{t}__{uuid.uuid4().hex[:8]}"
                stages[t] = (stage, df.columns)
                self.create(df, stage)
                self.create(df, t)
                df.write.jdbc(self.url, self.quoted(stage), "append", self.properties)
            with self.connection(spark) as c:
                for t, (stage, columns) in stages.items():
                    self.evolve(spark, c, t, stage)
                for t in reversed(list(stages)):  # children first: their condition reads their parents' stage
                    self.run(c, self.delete_sql(t, name, stages))
                for t, (stage, columns) in stages.items():
                    names = ", ".join(map(self.quoted, columns))
                    self.run(c, f"INSERT INTO {self.quoted(t)} ({names}) SELECT {names} FROM {self.quoted(stage)}")
        finally:
            for df in kept.values():
                df.unpersist()
            with self.connection(spark) as c:
                for stage, _ in stages.values():
                    if self.has(c, stage):
                        self.run(c, f"DROP TABLE {self.quoted(stage)}")
        details = {}
        if committed is not None and (new := new_columns(tables[name].columns, committed.names, [*metadata, "_position", nest.ROW_ID])):
            details["new_columns"] = new
        return WriteResult(n, details)

    def delete_sql(self, t: str, name: str, stages: dict[str, tuple[str, list[str]]]) -> str:
        target, top = self.quoted(t), self.quoted(stages[name][0])
        if isinstance(self.merge, ReplaceDay):  # child rows have the day too
            return f"DELETE FROM {target} WHERE {self.quoted(DAY)} IN (SELECT {self.quoted(DAY)} FROM {top})"
        if t != name:  # rows of parents that are replaced now
            parent = nest.parent_of(t, stages)
            keyed = f"SELECT p.{self.quoted(nest.ROW_ID)} FROM {self.quoted(parent)} p" + (f" WHERE {self.same_keys('p', top)}" if parent == name else f" WHERE p.{self.quoted(nest.PARENT_KEY)} IN (SELECT {self.quoted(nest.PARENT_KEY)} FROM {self.quoted(stages[parent][0])})")
            return f"DELETE FROM {target} WHERE {self.quoted(nest.PARENT_KEY)} IN ({keyed})"
        return f"DELETE FROM {target} WHERE {self.same_keys(target, top)}"

    def same_keys(self, target: str, stage: str) -> str:
        equal = " AND ".join(f"s.{self.quoted(k)} = {target}.{self.quoted(k)}" for k in self.merge.keys)
        return f"EXISTS (SELECT 1 FROM {stage} s WHERE {equal})"

    def columns(self, c, name: str) -> dict[str, str]:
        found = c.getMetaData().getColumns(None, None, name, None)
        out = {}
        while found.next():
            size = f"({found.getInt('COLUMN_SIZE')})" if "CHAR" in found.getString("TYPE_NAME").upper() else f"({found.getInt('COLUMN_SIZE')},{found.getInt('DECIMAL_DIGITS')})" if found.getString("TYPE_NAME").upper() in ("DECIMAL", "NUMERIC") else ""
            out[found.getString("COLUMN_NAME")] = found.getString("TYPE_NAME") + size
        found.close()
        return out

    def evolve(self, spark, c, name: str, stage: str) -> None:
        """Add new columns to the table; another type is an error."""
        held, new = self.columns(c, name), self.columns(c, stage)
        if changed := [f"{k}: {held[k]} became {v}" for k, v in new.items() if k in held and held[k] != v]:
            raise ContractError("; ".join(changed))
        for k, v in new.items():
            if k not in held:
                self.run(c, f"ALTER TABLE {self.quoted(name)} ADD COLUMN {self.quoted(k)} {v}")


def writer_to(destination: str, writer: Writer) -> Writer | JdbcWriter:
    """The writer for where tables go: a database, if it is a JDBC address, else Parquet tables below a folder.

    Writers of one's own stay as they are.
    """
    if type(writer) is Writer and destination.startswith("jdbc:"):
        return JdbcWriter(destination, writer.merge, writer.max_nesting)
    return writer
