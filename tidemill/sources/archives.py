"""Archives and compressed files, read in place: members are streams, never extracted to disk."""

from __future__ import annotations

import bz2
import gzip
import hashlib
import io
import lzma
import re
import tarfile
import zipfile
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Name endings of archives (fixed values).
ZIP, TAR = (".zip",), (".tar", ".tar.gz", ".tgz")
VERSION = re.compile(r"\.v\d+$")


def plain_name(path: str) -> str:
    """Without the suffix of a later version."""
    return VERSION.sub("", path)


def archive_kind(path: str) -> str | None:
    name = plain_name(path).lower()
    return "zip" if name.endswith(ZIP) else "tar" if name.endswith(TAR) else None


def archive_kind_of(path: Column) -> Column:
    name = F.lower(F.regexp_replace(path, "\\.v\\d+$", ""))
    tar = F.lit(False)
    for end in TAR:
        tar = tar | name.endswith(F.lit(end))
    return F.when(name.endswith(F.lit(".zip")), "zip").when(tar, "tar")


def seekable(data: bytes | BinaryIO) -> BinaryIO:
    return io.BytesIO(data) if isinstance(data, bytes) else data


def open_members(data: bytes | BinaryIO, path: str) -> Iterator[tuple[str, io.BufferedIOBase]]:
    """(name, stream) of the files in an archive, in the order of their names."""
    kind = archive_kind(path)
    if kind == "zip":
        with zipfile.ZipFile(seekable(data)) as z:
            for name in sorted(i.filename for i in z.infolist() if not i.is_dir()):
                with z.open(name) as stream:
                    yield name, stream
    elif kind == "tar":
        with tarfile.open(fileobj=seekable(data)) as t:
            for info in sorted((i for i in t.getmembers() if i.isfile()), key=lambda i: i.name):
                yield info.name, t.extractfile(info)
    else:
        raise ValueError(f"{path} isn't an archive")


def open_streams(data: bytes | BinaryIO, path: str, member: str | None = None) -> Iterator[tuple[str | None, io.BufferedIOBase]]:
    """One member, all members of an archive, or the file itself, decompressed as its name says."""
    if archive_kind(path):
        for name, stream in open_members(data, path):
            if member is None or name == member:
                yield name, stream
        return
    name = plain_name(path).lower()
    raw = seekable(data)
    yield None, gzip.open(raw) if name.endswith(".gz") else bz2.open(raw) if name.endswith(".bz2") else lzma.open(raw) if name.endswith(".xz") else raw


def list_members(files: DataFrame, id_col: str = "id", path_col: str = "local_path") -> DataFrame:
    """(parent_id, member, member_size, member_sha256) of the archives at ``files``' paths."""
    spark = files.sparkSession
    schema = "parent_id long, member string, member_size long, member_sha256 string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            out = []
            for file_id, path in zip(rows["id"], rows["path"]):
                from ..operators.mirror import open_path

                store, at = open_path(path)
                with store.open_input_file(at) as f:
                    for name, stream in open_members(io.BufferedReader(f, 1 << 20), path):
                        digest, size = hashlib.sha256(), 0
                        while block := stream.read(1 << 20):
                            digest.update(block)
                            size += len(block)
                        out.append((file_id, name, size, digest.hexdigest()))
            yield pd.DataFrame(out, columns=["parent_id", "member", "member_size", "member_sha256"])

    del spark
    return files.select(F.col(id_col).alias("id"), F.col(path_col).alias("path")).mapInPandas(run, schema)


def contents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, content) of files; for names that Hadoop hides or patterns it would expand, tasks open them themselves."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from ..operators.mirror import open_path

        for rows in batches:
            for path in rows["path"]:
                store, at = open_path(path)
                with store.open_input_file(at) as f:
                    yield pd.DataFrame({"path": [path], "content": [f.read()]})

    return spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, min(len(paths), 1000))).mapInPandas(run, "path string, content binary")
