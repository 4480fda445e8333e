"""Mirroring: what a listing has that the manifest doesn't, and byte-exact copies of it."""

from __future__ import annotations

import posixpath
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths
from .manifest import numbered

NEW, REVISION, UNCHANGED, IGNORED = "new", "revision", "unchanged", "ignored"


def diff(listing: DataFrame, known: DataFrame, exclude: str | None = None) -> DataFrame:
    """``listing`` (remote_path, remote_mtime, size, ...) with action and version.

    ``known`` has the newest manifest row of each path. Files whose name has ``exclude`` are ignored at first sight.
    A path that was recorded as ignored is looked at anew once the pattern doesn't cover it any more.
    """
    held = known.select("remote_path", F.col("remote_mtime").alias("_mtime"), F.col("size").alias("_size"), F.coalesce("version", F.lit(1)).alias("_version"), (F.col("status") == IGNORED).alias("_ignored"))
    joined = listing.join(held, "remote_path", "left")
    out = paths.matches(paths.basename(F.col("remote_path")), exclude) if exclude else F.lit(False)
    seen = F.col("_version").isNotNull()
    same = F.col("_mtime").eqNullSafe(F.col("remote_mtime")) & F.col("_size").eqNullSafe(F.col("size"))
    action = F.when(out, F.when(seen, UNCHANGED).otherwise(IGNORED)).when(~seen | F.col("_ignored"), NEW).when(same, UNCHANGED).otherwise(REVISION)
    version = F.when(F.col("_ignored"), 1).otherwise(F.coalesce(F.col("_version"), F.lit(0)) + 1).cast("int")
    return joined.withColumn("action", action).withColumn("version", version).drop("_mtime", "_size", "_version", "_ignored")


def inventory(spark: SparkSession, root: str, maxdepth: int | None = None) -> DataFrame:
    """(path, mtime, size) of the files below a root, sorted; contents are never opened."""
    return depth(spark, root, list_files(spark, root), maxdepth).orderBy("path")


def list_files(spark: SparkSession, root: str) -> DataFrame:
    # contents are pruned: only the file status is read; globs in names need care, roots are plain
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return rows.select(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))).alias("path"), F.date_trunc("second", "modificationTime").alias("mtime"), F.col("length").alias("size"))


def depth(spark: SparkSession, root: str, rows: DataFrame, maxdepth: int | None) -> DataFrame:
    if maxdepth is None:
        return rows
    base = spark._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath().rstrip("/")
    rel = F.expr(f"substring(path, locate({quote(base + '/')}, path) + {len(base) + 1})")
    return rows.where(F.size(F.split(rel, "/")) <= maxdepth)


def quote(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def listing(spark: SparkSession, subsets: dict[str, str], maxdepth: int | None) -> DataFrame:
    """(subset, remote_path, path, remote_mtime, size) of all subsets; the path is ``<subset>/<below the root>``."""
    out = None
    for subset, root in subsets.items():
        base = spark._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath().rstrip("/")
        rows = depth(spark, root, list_files(spark, root), maxdepth)
        below = F.expr(f"substring(path, locate({quote(base + '/')}, path) + {len(base) + 1})")
        rows = rows.select(F.lit(subset).alias("subset"), F.col("path").alias("remote_path"), F.concat(F.lit(f"{subset}/"), below).alias("path"), F.date_format("mtime", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("remote_mtime"), "size")
        out = rows if out is None else out.unionByName(rows)
    return out


def listing_by_fsspec(spark: SparkSession, protocol: str, options: dict, subsets: dict[str, str], maxdepth: int | None) -> DataFrame:
    """The same as ``listing`` for stores that only fsspec reaches; the driver lists them. Remote paths are URLs."""
    import fsspec

    store, rows = fsspec.filesystem(protocol, **options), []
    for subset, root in subsets.items():
        base = root.rstrip("/")
        for info in store.find(base, maxdepth=maxdepth, detail=True).values():
            if info.get("type") == "file":
                name = info["name"]
                rows.append((subset, f"{protocol}://{name}", f"{subset}/{posixpath.relpath(name, base)}", modification_time(info), info.get("size")))
    return spark.createDataFrame(rows, "subset string, remote_path string, path string, remote_mtime string, size long")


def landing_path(root: str, feed: str, path, version):
    """<root>/<feed>/<subset>/<path>[.vN]."""
    suffix = F.when(version > 1, F.concat(F.lit(".v"), version.cast("string"))).otherwise(F.lit(""))
    return F.concat(F.lit(f"{root.rstrip('/')}/{feed}/"), path, suffix)


def copy(pairs: DataFrame, protocol: str | None = None, options: dict | None = None) -> DataFrame:
    """``pairs`` (remote_path, local_path, ...) copied byte by byte, in the tasks: (remote_path, sha256, copied_size). An action's lazy plan.

    A file gets its name once it is whole, so a task that runs again does no harm.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import hashlib
        import uuid

        for rows in batches:
            out = []
            for source, target in zip(rows["remote_path"], rows["local_path"]):
                a, from_path = open_by_fsspec(source, protocol, options or {}) if protocol else open_path(source)
                b, to_path = open_path(target)
                b.create_dir(posixpath.dirname(to_path))
                part, digest, size = f"{to_path}.{uuid.uuid4().hex}.part", hashlib.sha256(), 0
                with a.open_input_stream(from_path, compression=None) as i, b.open_output_stream(part, compression=None) as o:
                    while block := i.read(1 << 20):
                        digest.update(block)
                        size += len(block)
                        o.write(block)
                b.move(part, to_path)
                out.append((source, digest.hexdigest(), size))
            yield pd.DataFrame(out, columns=["remote_path", "sha256", "copied_size"])

    return pairs.select("remote_path", "local_path").mapInPandas(run, "remote_path string, sha256 string, copied_size long")


def open_path(path: str):
    """A pyarrow file system and the path in it. Hadoop writes ``file:/x`` for ``file:///x``."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def open_by_fsspec(url: str, protocol: str, options: dict):
    import fsspec
    from pyarrow import fs

    return fs.PyFileSystem(fs.FSSpecHandler(fsspec.filesystem(protocol, **options))), url.removeprefix(f"{protocol}://")


def number(rows: DataFrame, first_id: int) -> DataFrame:
    """Ids for new rows, in the order of their paths. Only the rows that a run finds new are ordered."""
    return numbered(rows, ["path"], first_id)


def modification_time(info: dict) -> str | None:
    """The time of a listing entry of any store as ISO text in UTC, to the second; None if it has none."""
    from datetime import UTC, datetime

    for name in ("mtime", "LastModified", "modified"):
        if (value := info.get(name)) is not None:
            if isinstance(value, int | float):
                value = datetime.fromtimestamp(value, UTC)
            if isinstance(value, datetime):
                value = value.replace(tzinfo=UTC) if value.tzinfo is None else value.astimezone(UTC)
                return value.replace(microsecond=0).isoformat()
            return str(value)
    return None
