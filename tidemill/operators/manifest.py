"""The manifest of files as a DataFrame, and its operators: each takes and returns DataFrames.

Rows change their status and are never removed. ``id`` is the order of arrival and breaks all ties.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOWNLOADED, SUPERSEDED, DUPLICATE, EXPANDED, IGNORED = "downloaded", "superseded", "duplicate", "expanded", "ignored"

SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("feed", T.StringType(), False),
        T.StructField("subset", T.StringType(), False),
        T.StructField("remote_path", T.StringType(), False),
        T.StructField("path", T.StringType(), False),
        T.StructField("remote_mtime", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("version", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("local_path", T.StringType()),
        T.StructField("sha256", T.StringType()),
        T.StructField("downloaded_at", T.TimestampNTZType()),
        T.StructField("parent_id", T.LongType()),
        T.StructField("member", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("business_date", T.DateType()),
        T.StructField("attributes", T.MapType(T.StringType(), T.StringType())),
        T.StructField("identity", T.StringType()),
        T.StructField("loaded_at", T.TimestampNTZType()),
        T.StructField("load_id", T.StringType()),
    ]
)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def where(files: DataFrame, condition: Column, **values: Column) -> DataFrame:
    """``values`` where the condition holds; other rows as they are."""
    return files.withColumns({c: F.when(condition, v).otherwise(F.col(c)) for c, v in values.items()})


def where_in(files: DataFrame, ids: DataFrame | Iterable[int], **values: Column) -> DataFrame:
    """``values`` for the rows with these ids, which are joined: any number of a table's (id), or some that are given."""
    if not isinstance(ids, DataFrame):
        ids = files.sparkSession.createDataFrame([(int(i),) for i in ids], "id long")
    chosen = ids.select(F.col("id").alias("_chosen")).distinct()
    marked = files.join(chosen, F.col("id") == F.col("_chosen"), "left")
    return where(marked, F.col("_chosen").isNotNull(), **values).drop("_chosen")


def numbered(rows: DataFrame, order: list[str], first_id: int) -> DataFrame:
    """Rows with ids from ``first_id`` on in an order: sorted in ranges, each of which starts where those before it end."""
    placed = rows.orderBy(*order).withColumns({"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}).persist()
    starts, at = [], first_id
    for r in sorted(placed.groupBy("_part").count().collect()):  # a row for each range
        starts.append((r["_part"], at))
        at += r["count"]
    offsets = rows.sparkSession.createDataFrame(starts, "_part int, _start long")
    return placed.join(F.broadcast(offsets), "_part").withColumn("id", F.col("_start") + F.col("_at")).drop("_part", "_at", "_start")


def active(table: str) -> Column:
    return (F.col("table") == table) & (F.col("status") == DOWNLOADED)


def window(start: date, end: date | None) -> Column:
    """[start, end); a day if there is no end."""
    return (F.col("business_date") >= day(start)) & (F.col("business_date") < day(end or start + timedelta(days=1)))


def day(d: date) -> Column:
    """A literal of any year."""
    return F.lit(d.isoformat()).cast("date")


def latest(files: DataFrame, feed: str, any_status: bool = False) -> DataFrame:
    """The newest row of each remote path; of rows that aren't superseded, unless ``any_status``."""
    rows = files.where((F.col("feed") == feed) & (F.lit(any_status) | (F.col("status") != SUPERSEDED)))
    newest = W.partitionBy("remote_path").orderBy(F.col("id").desc())
    return rows.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n")


def record(files: DataFrame, new: DataFrame) -> DataFrame:
    """Add rows; a row of a version above 1 supersedes all earlier rows of its path, and what was expanded from them."""
    replaced = new.where("version > 1").select("feed", "remote_path").distinct().withColumn("_replaced", F.lit(True))
    marked = files.join(replaced, ["feed", "remote_path"], "left")
    parents = marked.where("_replaced").select(F.col("id").alias("parent_id")).withColumn("_of_replaced", F.lit(True))
    marked = marked.join(parents, "parent_id", "left")
    marked = where(marked, F.coalesce("_replaced", "_of_replaced", F.lit(False)), status=F.lit(SUPERSEDED))
    return marked.select(*SCHEMA.names).unionByName(new.select(*SCHEMA.names))


def unclassified(files: DataFrame, feed: str, top_level: bool = False) -> DataFrame:
    rows = files.where((F.col("feed") == feed) & (F.col("status") == DOWNLOADED) & F.col("table").isNull())
    return (rows.where(F.col("parent_id").isNull()) if top_level else rows).orderBy("id")


def add_members(files: DataFrame, members: DataFrame, first_id: int) -> DataFrame:
    """A row for each of ``members`` (parent_id, member, member_size, member_sha256); the archives become expanded."""
    new = members.select(F.col("parent_id").alias("_parent"), F.col("member").alias("_member"), "member_size", "member_sha256")
    found = files.drop("parent_id", "member").join(new, F.col("id") == F.col("_parent"))
    rows = numbered(found, ["_parent", "_member"], first_id).withColumns(
        {
            "remote_path": F.concat_ws("!", "remote_path", "_member"),
            "path": F.concat_ws("!", "path", "_member"),
            "parent_id": F.col("_parent"),
            "member": F.col("_member"),
            "size": F.col("member_size"),
            "sha256": F.col("member_sha256"),
            "status": F.lit(DOWNLOADED),
            "version": F.lit(1),
            **{c: F.lit(None).cast(SCHEMA[c].dataType) for c in ("table", "business_date", "attributes", "identity", "loaded_at", "load_id")},
        }
    )
    archives = members.select(F.col("parent_id").alias("id")).distinct().withColumn("_expanded", F.lit(True))
    marked = where(files.join(archives, "id", "left"), F.coalesce("_expanded", F.lit(False)), status=F.lit(EXPANDED))
    return marked.select(*SCHEMA.names).unionByName(rows.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMA]))


def assign(files: DataFrame, decided: DataFrame) -> DataFrame:
    """Take over (table, business_date, attributes, identity, status) by id where ``decided`` has them."""
    names = ("table", "business_date", "attributes", "identity", "status")
    new = decided.select("id", *[F.col(c).alias(f"_{c}") for c in names])
    return files.join(new, "id", "left").withColumns({c: F.coalesce(f"_{c}", c) for c in names}).select(*files.columns)


def active_with_identity(files: DataFrame, identity: str, exclude_id: int) -> DataFrame:
    return files.where((F.col("identity") == identity) & (F.col("status") == DOWNLOADED) & (F.col("id") != exclude_id)).select("id", "sha256")


def set_status(files: DataFrame, ids: DataFrame | Iterable[int], status: str) -> DataFrame:
    return where_in(files, ids, status=F.lit(status))


def files_for(files: DataFrame, table: str, start: date, end: date | None = None) -> DataFrame:
    """All active files of the window, loaded or not: a reload takes all of them."""
    return files.where(active(table) & window(start, end)).orderBy("business_date", "id")


def pending_days(files: DataFrame, table: str) -> DataFrame:
    """(business_date, newest_id) of active files that aren't loaded."""
    rows = files.where(active(table) & F.col("loaded_at").isNull())
    return rows.groupBy("business_date").agg(F.max("id").alias("newest_id")).orderBy("business_date")


def mark_loaded(files: DataFrame, ids: DataFrame | Iterable[int], load_id: str, at: Column | None = None) -> DataFrame:
    now = F.localtimestamp() if at is None else at
    return where_in(files, ids, loaded_at=now, load_id=F.lit(load_id))


def file_counts(files: DataFrame, table: str, since: date) -> DataFrame:
    """(business_date, n_files) of active files from ``since``."""
    return files.where(active(table) & (F.col("business_date") >= day(since))).groupBy("business_date").agg(F.count("*").alias("n_files"))


# --- operator helpers ---


def reload(files: DataFrame, table: str, start: date, end: date | None = None) -> tuple[DataFrame, int]:
    """Forget that active files of the window are loaded; and how many these are."""
    due = active(table) & window(start, end)
    none = {c: F.lit(None).cast(SCHEMA[c].dataType) for c in ("loaded_at", "load_id")}
    return where(files, due, **none), files.where(due).count()


def ignore(files: DataFrame, ids: DataFrame | Iterable[int]) -> DataFrame:
    """Take files out of loading; data that they brought stays."""
    return set_status(files, ids, IGNORED)


def reclassify(files: DataFrame, table: str) -> tuple[DataFrame, int]:
    """Forget what was decided on the table's rows; collisions are decided anew. Earlier versions of a path stay superseded."""
    newest = W.partitionBy("feed", "remote_path")
    with_newest = files.withColumn("_newest", F.max("version").over(newest))
    due = (F.col("table") == table) & F.col("status").isin(DOWNLOADED, SUPERSEDED, DUPLICATE)
    nothing = ("table", "business_date", "attributes", "identity", "loaded_at", "load_id")
    # columns of the condition change last
    status = F.when(due & (F.col("version") == F.col("_newest")), F.lit(DOWNLOADED)).otherwise(F.col("status"))
    cleared = {c: F.when(due, F.lit(None).cast(SCHEMA[c].dataType)).otherwise(F.col(c)) for c in nothing}
    return with_newest.withColumns({"status": status} | cleared).select(*files.columns), files.where(due).count()
