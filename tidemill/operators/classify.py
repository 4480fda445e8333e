"""Assigning files to tables, and resolving files that are logically the same."""

from __future__ import annotations

from collections.abc import Iterable
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import paths
from . import manifest as m

if TYPE_CHECKING:
    from ..config import Table


class AmbiguousMatch(ValueError):
    """Several tables want a file."""

    def __init__(self, files: dict[str, list[str]]):
        self.files = files
        super().__init__("files that several tables match: " + "; ".join(f"{p}: {', '.join(t)}" for p, t in sorted(files.items())))


def in_subsets(table: Table, subset: Column) -> Column:
    return subset.isin(list(table.subsets)) if table.subsets else F.lit(True)


def candidates(files: DataFrame, tables: Iterable[Table]) -> DataFrame:
    """The rows with ``found``: an array of (table, on_collision, business_date, attributes, identity), one for each table that matches.

    A table is a constant expression on the path, so files meet all tables in one pass without a join.
    """
    path = paths.match_path(F.col("path"))
    found = []
    for t in tables:
        got = F.when(in_subsets(t, F.col("subset")), t.source.classify(path))
        identity = F.concat(F.lit(f"{t.key}|"), got["identity"])
        found.append(F.when(got.isNotNull(), F.struct(F.lit(t.key).alias("table"), F.lit(t.source.on_collision).alias("on_collision"), got["business_date"].alias("business_date"), got["attributes"].alias("attributes"), identity.alias("identity"))))
    return files.withColumn("found", F.filter(F.array(*found), lambda x: x.isNotNull()) if found else F.expr("array()"))


def to_expand(files: DataFrame, feed: str, tables: Iterable[Table]) -> DataFrame:
    """Archives that hold several logical files of some table, and aren't expanded yet."""
    wanted = F.lit(False)
    for t in tables:
        wanted = wanted | (in_subsets(t, F.col("subset")) & t.source.expands(F.col("path")))
    return m.unclassified(files, feed, top_level=True).where(wanted)


def resolve(rows: DataFrame) -> DataFrame:
    """``rows`` (id, identity, sha256, on_collision) with the status that each ends with, by order of id within its identity.

    latest: a row with the content of the one before is a duplicate; of the others the last is active and the rest are
    superseded. first: the first row is active; later ones are duplicates of it or superseded.
    """
    by_id = W.partitionBy("identity").orderBy("id")
    whole = by_id.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    same = F.col("sha256").eqNullSafe(F.lag("sha256").over(by_id)) & (F.row_number().over(by_id) > 1)
    marked = rows.withColumn("_same", same).withColumn("_last", F.max(F.when(~F.col("_same"), F.col("id"))).over(whole)).withColumn("_first", F.first("id").over(whole)).withColumn("_first_sha", F.first("sha256").over(whole))
    latest = F.when(F.col("_same"), m.DUPLICATE).when(F.col("id") == F.col("_last"), m.DOWNLOADED).otherwise(m.SUPERSEDED)
    first = F.when(F.col("id") == F.col("_first"), m.DOWNLOADED).when(F.col("sha256").eqNullSafe(F.col("_first_sha")), m.DUPLICATE).otherwise(m.SUPERSEDED)
    return marked.withColumn("status", F.when(F.col("on_collision") == "first", first).otherwise(latest)).drop("_same", "_last", "_first", "_first_sha")


def classify(files: DataFrame, feed: str, tables: Iterable[Table]) -> tuple[DataFrame, DataFrame]:
    """(files with new assignments and collisions resolved, ambiguous rows (path, tables)). Files without a table wait."""
    tables = list(tables)
    matched = candidates(m.unclassified(files, feed), tables)
    ambiguous = matched.where(F.size("found") > 1).select("path", F.transform("found", lambda x: x["table"]).alias("tables"))
    one = matched.where(F.size("found") == 1).select("id", "sha256", F.col("found")[0].alias("f"))
    new = one.select("id", "sha256", F.col("f.table").alias("table"), "f.on_collision", "f.business_date", "f.attributes", "f.identity")
    policy = F.lit("latest")
    for t in tables:
        policy = F.when(F.col("table") == t.key, t.source.on_collision).otherwise(policy)
    twins = files.where((F.col("status") == m.DOWNLOADED) & F.col("identity").isNotNull()).join(new.select("identity").distinct(), "identity", "left_semi")
    before = twins.select("id", "sha256", "table", policy.alias("on_collision"), "business_date", "attributes", "identity")
    return m.assign(files, resolve(before.unionByName(new))), ambiguous
