"""Merging loads into targets under an evolving schema, and the writers that do it."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import nest

DAY = "_business_date"


class ContractError(ValueError):
    """A load has another type for a column than the target."""


def with_metadata(rows: DataFrame, metadata: dict[str, Column]) -> DataFrame:
    """Rows with metadata columns; metadata wins where a name clashes."""
    return rows.withColumns(metadata)


def replace_day(target: DataFrame, incoming: DataFrame, day: str = DAY) -> DataFrame:
    """All rows of the days that come in are replaced."""
    days = incoming.select(day).distinct()
    return target.join(days, day, "left_anti").select(*target.columns).unionByName(incoming, allowMissingColumns=True)


def survivors(incoming: DataFrame, keys: tuple[str, ...], order: tuple[str, ...]) -> DataFrame:
    """One row of each key: the one that comes last by ``order``."""
    last = W.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    return incoming.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def upsert(target: DataFrame, incoming: DataFrame, keys: tuple[str, ...], order: tuple[str, ...] = ("_source_file", "_position")) -> DataFrame:
    """Rows of the keys that come in are replaced; one row of each key comes in. Null keys equal each other."""
    new = survivors(incoming, keys, tuple(c for c in order if c in incoming.columns) or tuple(keys)).drop("_position")
    named = new.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    return target.join(named, same_keys(target, keys), "left_anti").unionByName(new, allowMissingColumns=True)


def check_contract(target: T.StructType, incoming: T.StructType) -> list[str]:
    """Names of new columns; an error if a common column has another type."""
    known = {f.name: f.dataType for f in target}
    changed = [f"{f.name}: {known[f.name].simpleString()} became {f.dataType.simpleString()}" for f in incoming if f.name in known and known[f.name] != f.dataType]
    if changed:
        raise ContractError("; ".join(changed))
    return [f.name for f in incoming if f.name not in known]


def conform(incoming: DataFrame, committed: T.StructType) -> DataFrame:
    """Cast committed columns to their types by name (an error on values that don't fit) and keep new ones."""
    types = {f.name: f.dataType for f in committed}
    return incoming.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`") for c in incoming.columns])


def new_columns(loaded: list[str], committed: list[str], metadata: list[str]) -> list[str]:
    return sorted(set(loaded) - set(committed) - set(metadata))


@dataclass(frozen=True)
class ReplaceDay:
    """A load of a day replaces all rows of that day."""


@dataclass(frozen=True)
class Upsert:
    """Rows with the key of a row that comes in are replaced."""

    keys: tuple[str, ...]


@dataclass(frozen=True)
class WriteResult:
    rows: int
    details: dict[str, Any] = field(default_factory=dict)


@dataclass(frozen=True)
class Writer:
    """Merges into Parquet tables under ``root``: one for the rows and one for each nested list.

    A load is read and parsed once, into a stage of its own, from where all its tables are made. Replaced days are
    partitions: only these are rewritten, by dynamic partition overwrite. An upsert writes new snapshots of all tables
    next to the old ones, and then one record that names them all: the newest record that is whole counts, so readers
    see either state of all tables, and a load that fails at any point changes nothing. The snapshots of the last
    ``keep`` records stay for readers that are at it. Rows of nested lists go and come with their parents.
    ``max_nesting``: levels of lists that become tables; deeper values, and objects at level 0, stay JSON text.
    """

    merge: ReplaceDay | Upsert = field(default_factory=ReplaceDay)
    max_nesting: int | None = None
    keep: int = 2

    def write(self, rows: DataFrame, root: str, name: str, committed: T.StructType | None = None, metadata: tuple[str, ...] = ()) -> WriteResult:
        spark, version = rows.sparkSession, uuid.uuid4().hex
        stage = f"{root}/{name}/stage-{version}"
        try:
            staged = kept_at(rows, f"{stage}/rows")
            tables = nest.denest(staged, name, self.max_nesting, carried=tuple(m for m in metadata if m in staged.columns))
            if committed is not None:
                tables[name] = conform(tables[name], committed)
            before = Records(spark, root, name).newest()
            held = {t: current(spark, root, t) for t in {**tables, **before}}
            for t, df in tables.items():  # before anything is written
                if held[t] is not None:
                    check_contract(held[t].schema, df.schema)
            if isinstance(self.merge, ReplaceDay):
                n = self.replace(tables, held, root, name)
            else:
                n = self.merge_keys(tables, held, root, name, stage, version)
        finally:
            delete(spark, stage)
        details = {}
        if committed is not None and (new := new_columns(tables[name].columns, committed.names, [*metadata, "_position", nest.ROW_ID])):
            details["new_columns"] = new
        return WriteResult(n, details)

    @staticmethod
    def current(spark, root: str, name: str) -> DataFrame | None:
        return current(spark, root, name)

    def replace(self, tables: dict[str, DataFrame], held: dict[str, DataFrame | None], root: str, name: str) -> int:
        spark = tables[name].sparkSession
        days = [r[DAY] for r in tables[name].select(DAY).distinct().collect()]  # the days of one load
        Records(spark, root, name).add({t: "days" for t in held}, self.keep)
        n = 0
        for t, df in tables.items():
            df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(f"{root}/{t}/days")
            n += df.count()
        for t in held:  # days that have parents but no such lists any more
            came = {r[DAY] for r in tables[t].select(DAY).distinct().collect()} if t in tables else set()
            for day in days if held[t] is not None else []:
                if day not in came:
                    delete(spark, f"{root}/{t}/days/{DAY}={day}")
        return n

    def merge_keys(self, tables: dict[str, DataFrame], held: dict[str, DataFrame | None], root: str, name: str, stage: str, version: str) -> int:
        spark = tables[name].sparkSession
        new: dict[str, DataFrame] = {}
        gone: dict[str, DataFrame | None] = {}  # ids of rows that leave each table
        merged: dict[str, str] = {}
        for t in sorted(held, key=lambda t: (t.count("__"), t)):  # parents come first
            parent = nest.parent_of(t, new)
            old = held[t]
            if parent is None:
                order = tuple(c for c in ("_source_file", "_position") if c in tables[t].columns) or self.merge.keys
                rows = survivors(tables[t], self.merge.keys, order).drop("_position")
            elif t in tables:
                rows = tables[t].join(new[parent].select(F.col(nest.ROW_ID).alias(nest.PARENT_KEY)), nest.PARENT_KEY, "left_semi")
            else:
                rows = old.limit(0)
            new[t] = kept_at(rows, f"{stage}/{t}")
            leaving = None
            if old is not None and parent is None:
                leaving = old.join(new[t].select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.merge.keys)]), same_keys(old, self.merge.keys), "left_semi")
            elif old is not None and gone[parent] is not None:
                leaving = old.join(gone[parent], old[nest.PARENT_KEY] == gone[parent]["_gone"], "left_semi")
            gone[t] = None if leaving is None or nest.ROW_ID not in leaving.columns else leaving.select(F.col(nest.ROW_ID).alias("_gone"))
            if old is None:
                out = new[t]
            elif parent is None:
                out = upsert(old, new[t], self.merge.keys)
            else:
                stay = old if gone[parent] is None else old.join(gone[parent], old[nest.PARENT_KEY] == gone[parent]["_gone"], "left_anti")
                out = stay.unionByName(new[t], allowMissingColumns=True)
            out.write.parquet(f"{root}/{t}/snapshot-{version}")
            merged[t] = f"snapshot-{version}"
        Records(spark, root, name).add(merged, self.keep)
        return sum(df.count() for df in new.values())


def kept_at(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Records:
    """What makes up a table and its lists: records ``records/v=N`` of the folder of each, below the table's folder."""

    def __init__(self, spark, root: str, name: str):
        self.spark, self.root, self.path = spark, root, f"{root}/{name}/records"

    def versions(self) -> list[int]:
        found = []
        for child in children(self.spark, self.path):
            if child.startswith("v=") and exists(self.spark, f"{self.path}/{child}/_SUCCESS"):
                found.append(int(child[2:]))
        return sorted(found)

    def read(self, version: int) -> dict[str, str]:
        return json.loads(self.spark.read.text(f"{self.path}/v={version}").first()[0])

    def newest(self) -> dict[str, str]:
        held = self.versions()
        return self.read(held[-1]) if held else {}

    def add(self, folders: dict[str, str], keep: int) -> None:
        """A record counts once it is whole. Then what only records before the last ``keep`` name is deleted."""
        before = self.versions()
        if before and self.read(before[-1]) == folders:
            return
        at = max([0, *(int(c[2:]) for c in children(self.spark, self.path) if c.startswith("v="))]) + 1  # also beyond broken ones
        self.spark.createDataFrame([(json.dumps(folders),)], "record string").coalesce(1).write.text(f"{self.path}/v={at}")
        held = [*before, at]
        live = {(t, f) for v in held[-keep:] for t, f in self.read(v).items()}
        for v in held[:-keep]:
            for t, f in self.read(v).items():
                if (t, f) not in live and f.startswith("snapshot-"):
                    delete(self.spark, f"{self.root}/{t}/{f}")
            delete(self.spark, f"{self.path}/v={v}")


def same_keys(target: DataFrame, keys: tuple[str, ...]) -> Column:
    """Whether the keys of ``target`` are the columns _k0, _k1, ...; null keys equal each other."""
    out = F.lit(True)
    for i, k in enumerate(keys):
        out = out & target[k].eqNullSafe(F.col(f"_k{i}"))
    return out


def delete(spark, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def exists(spark, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def children(spark, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def current(spark, root: str, name: str) -> DataFrame | None:
    """The present rows of a target table, or of one of its lists."""
    parts = name.split("__")
    for n in range(len(parts), 0, -1):
        if folder := Records(spark, root, "__".join(parts[:n])).newest().get(name):
            if folder != "days":
                return spark.read.parquet(f"{root}/{name}/{folder}")
            # a load may have left no rows of a list, or was the first and failed
            held = any(c.startswith(f"{DAY}=") for c in children(spark, f"{root}/{name}/days"))
            return spark.read.option("mergeSchema", True).parquet(f"{root}/{name}/days") if held else None
    return None
