"""Readers: files of a load to one DataFrame.

``read(files)`` takes a DataFrame (file_id, path, member) and gives the rows of all files with ``_source_file`` and
``_position``. Plain Parquet, JSON and CSV files go through Spark's own readers, which split them, whatever their size;
other dialects, archives and names that Spark doesn't know go through tasks that stream a file each in Arrow batches.

``types``: committed types by name; "string" reads everything as text. Columns are matched by name, never by place.
``most``: rows of each file; a file is one task's work then, and is read no further.
"""

from __future__ import annotations

import csv
import inspect
import io
import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice
from typing import BinaryIO, Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema

from ..functions.paths import spark_format
from ..session import work_root
from . import archives

Types = T.StructType | str | None
#: Texts that mean null by default (fixed values).
NULLS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null")
SOURCE, POSITION = T.StructField("_source_file", T.LongType()), T.StructField("_position", T.LongType())


class Reader(Protocol):
    def read(self, files: DataFrame, types: Types = None, most: int | None = None) -> DataFrame: ...


def streams(file_id: int, path: str, member: str | None) -> Iterator[BinaryIO]:
    from ..operators.mirror import open_path

    store, at = open_path(path)
    with store.open_input_file(at) as f:
        for _, stream in archives.open_streams(io.BufferedReader(f, 1 << 20), path, member):
            yield stream


def in_tasks(files: DataFrame, batches_of: Callable[[BinaryIO], Iterator[pa.RecordBatch]], schema: T.StructType, most: int | None = None) -> DataFrame:
    """Rows of all files, or the first of each; a file is one task's work, so a lost executor costs its files only."""
    target = to_arrow_schema(T.StructType([*schema.fields, SOURCE, POSITION]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file_id, path, member in zip(*[c.to_pylist() for c in batch.columns]):
                at = 0
                for stream in streams(file_id, path, member):
                    for rows in batches_of(stream) if most is None or at < most else ():
                        rows = rows.slice(0, rows.num_rows if most is None else most - at)
                        n = rows.num_rows
                        columns = []
                        for f in target:
                            if f.name == "_source_file":
                                columns.append(pa.array([file_id] * n, f.type))
                            elif f.name == "_position":
                                columns.append(pa.array(range(at, at + n), f.type))
                            elif f.name in rows.schema.names:
                                columns.append(rows.column(f.name).cast(f.type))
                            else:
                                columns.append(pa.nulls(n, f.type))
                        at += n
                        yield pa.RecordBatch.from_arrays(columns, schema=target)
                        if most is not None and at >= most:
                            break

    n = max(1, min(files.count(), 10_000))
    return files.select("file_id", "path", "member").repartition(n).mapInArrow(run, T.StructType([*schema.fields, SOURCE, POSITION]))


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """What holds the values of both: whole numbers become doubles, dates timestamps; anything else that differs becomes text."""
    for narrow, wide in ((T.LongType(), T.DoubleType()), (T.DateType(), T.TimestampNTZType())):
        if {a, b} == {narrow, wide}:
            return wide
    return a if a == b else T.StringType()


def schemas(files: DataFrame, schema_of: Callable[[BinaryIO], pa.Schema]) -> T.StructType:
    """The columns of all files, by name, in the order in which they are met; see ``wider``. One row a different schema reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for file_id, path, member in zip(*[c.to_pylist() for c in batch.columns]):
                for stream in streams(file_id, path, member):
                    out.append((file_id, from_arrow_schema(schema_of(stream), prefer_timestamp_ntz=True).json()))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.string())], names=["file_id", "schema"])

    found = files.select("file_id", "path", "member").mapInArrow(run, "file_id long, schema string")
    kinds: dict[str, T.DataType] = {}
    for r in found.groupBy("schema").agg(F.min("file_id").alias("first")).orderBy("first").collect():
        for f in T.StructType.fromJson(json.loads(r["schema"])):
            kinds[f.name] = wider(kinds.get(f.name, f.dataType), f.dataType)
    return T.StructType([T.StructField(n, t) for n, t in kinds.items()])


@dataclass(frozen=True)
class CsvReader:
    """Delimited text in any dialect."""

    delimiter: str = ","
    encoding: str = "utf-8"
    skip_rows: int = 0
    column_names: tuple[str, ...] | None = None
    block_size: int = 1 << 24
    quote_char: str | None = '"'
    escape_char: str | None = None
    double_quote: bool = True
    newlines_in_values: bool = False
    null_values: tuple[str, ...] | None = None
    strings_can_be_null: bool = True
    date_formats: tuple[str, ...] = ()

    def batches(self, stream: BinaryIO, names: list[str]) -> Iterator[pa.RecordBatch]:
        """Every value as the text that it is."""
        from pyarrow import csv as arrow_csv

        yield from arrow_csv.open_csv(
            stream,
            read_options=arrow_csv.ReadOptions(encoding=self.encoding, skip_rows=self.skip_rows, column_names=list(self.column_names) if self.column_names else None, block_size=self.block_size),
            parse_options=arrow_csv.ParseOptions(delimiter=self.delimiter, quote_char=self.quote_char or False, escape_char=self.escape_char or False, double_quote=self.double_quote, newlines_in_values=self.newlines_in_values),
            convert_options=arrow_csv.ConvertOptions(column_types=dict.fromkeys(names, pa.string()), strings_can_be_null=False),
        )

    def header(self, stream: BinaryIO) -> list[str]:
        if self.column_names:
            return list(self.column_names)
        encoding = "utf-8-sig" if self.encoding.lower().replace("-", "") == "utf8" else self.encoding
        text = io.TextIOWrapper(stream, encoding=encoding, newline="")
        for _ in range(self.skip_rows):
            text.readline()
        return next(csv.reader([text.readline()], delimiter=self.delimiter, quotechar=self.quote_char or "\0"), [])

    def read(self, files: DataFrame, types: Types = None, most: int | None = None) -> DataFrame:
        """Text first, whichever way the file takes; then types by name, in one way."""
        plain, rest = split_plain(files, (".csv", ".txt", ".tsv", ".psv", ".dat")) if self.splits() and most is None else ([], files)
        frames = self.split_text(files, plain)
        if not frames or not rest.isEmpty():
            names = self.names(rest)
            schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
            frames.append(in_tasks(rest, lambda s: self.batches(s, names), schema, most))
        return self.typed(union(frames), types)

    def splits(self) -> bool:
        """Whether Spark's own reader, which splits files, reads the dialect alike."""
        return self.encoding.lower().replace("-", "") == "utf8" and not self.skip_rows and not self.newlines_in_values and self.double_quote and not self.escape_char

    def headers(self, files: DataFrame) -> list:
        """(file_id, names) of all files, read in tasks."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, names = [], []
                for f in zip(*[c.to_pylist() for c in batch.columns]):
                    for stream in streams(*f):
                        ids.append(f[0])
                        names.append(self.header(stream))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(names, pa.list_(pa.string()))], names=["file_id", "names"])

        return files.select("file_id", "path", "member").mapInArrow(run, "file_id long, names array<string>").orderBy("file_id").collect()

    def names(self, files: DataFrame) -> list[str]:
        return list(self.column_names) if self.column_names else list(dict.fromkeys(n for r in self.headers(files) for n in r["names"]))

    def split_text(self, files: DataFrame, plain: list) -> list[DataFrame]:
        """Plain files by as many tasks as they have splits; a frame for each different header."""
        spark = files.sparkSession
        path_of = {r["file_id"]: r for r in plain}
        heads = [(i, self.column_names) for i in path_of] if self.column_names or not plain else [(r["file_id"], tuple(r["names"])) for r in self.headers(files.where(F.col("file_id").isin(list(path_of))))]
        groups: dict[tuple[str, ...], list] = {}
        for i, names in heads:
            if names:  # an empty file has none, and no rows
                groups.setdefault(names, []).append(path_of[i])
        out = []
        for names, held in groups.items():
            # no text equals this null value: what means null is decided by ``typed``
            reader = spark.read.options(sep=self.delimiter, quote=self.quote_char or "", escape=self.quote_char or "\\", header=self.column_names is None, mode="FAILFAST", nullValue="\u0001", emptyValue="")
            out.append(by_spark(files, held, reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in names])).csv([r["path"] for r in held])))
        return out

    def typed(self, text: DataFrame, types: Types) -> DataFrame:
        names = [c for c in text.columns if c not in ("_source_file", "_position")]
        tokens = list(NULLS if self.null_values is None else self.null_values)
        value = {n: F.when(~F.col(f"`{n}`").isin(tokens), F.col(f"`{n}`")) if tokens else F.col(f"`{n}`") for n in names}
        known = {f.name: f.dataType for f in types} if isinstance(types, T.StructType) else {}
        unknown = [n for n in names if n not in known] if types != "string" else []
        if unknown:
            known = self.kinds_of(text.select(F.lit("all").alias("_file"), *[value[n].alias(n) for n in unknown]), unknown) | known
        out = []
        for n in names:
            kind = known.get(n, T.StringType())
            if isinstance(kind, T.StringType):
                out.append((value[n] if self.strings_can_be_null else F.col(f"`{n}`")).alias(n))
            elif self.date_formats and isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
                parsed = F.coalesce(*[F.try_to_timestamp(value[n], F.lit(spark_format(f))) for f in self.date_formats], value[n].cast("timestamp"))
                out.append(parsed.cast(kind).alias(n))
            else:
                out.append(value[n].cast(kind).alias(n))
        return text.select(*out, "_source_file", "_position")

    def kinds_of(self, text: DataFrame, names: list[str]) -> dict[str, T.DataType]:
        """From all values of all files: numbers keep no leading zeros, fractions are doubles."""
        from ..operators.profile import typing

        kinds = {"bigint": T.LongType(), "decimal": T.DoubleType(), "double": T.DoubleType(), "bool": T.BooleanType(), "date": T.DateType(), "timestamp": T.TimestampNTZType()}
        found = {}
        for r in typing.infer(typing.melt(text, names), self.date_formats).collect():
            zoned = r["kind"] == "timestamp" and r["zoned"]
            found[r["column"]] = T.LongType() if r["reason"] == "leading zeros" else T.TimestampType() if zoned else kinds.get(r["kind"], T.StringType())
        return found


def split_plain(files: DataFrame, endings: tuple[str, ...]) -> tuple[list, DataFrame]:
    """(rows of files that Spark reads by itself, the rest): no members, no versions, a known ending, and no name that Hadoop hides."""
    name = F.element_at(F.split("path", "/"), -1)
    plain = F.col("member").isNull() & ~name.rlike("^[_.]")
    ends = F.lit(False)
    for e in endings:
        ends = ends | F.lower(name).endswith(F.lit(e))
    return files.where(plain & ends).select("file_id", "path").collect(), files.where(~(plain & ends))


def by_spark(files: DataFrame, held: list, frame: DataFrame) -> DataFrame:
    """Rows of Spark's reader with the manifest id of their file; places are those in the file's blocks."""
    spark = files.sparkSession
    ids = spark.createDataFrame([(r["file_id"], normal(r["path"])) for r in held], "_source_file long, _path string")
    path = F.regexp_replace(F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))), "^file:/+", "/")
    rows = frame.select("*", path.alias("_path"), (F.col("_metadata.file_block_start") * 0 + F.monotonically_increasing_id()).alias("_position"))
    return rows.join(F.broadcast(ids), "_path").drop("_path")


def normal(path: str) -> str:
    return "/" + path[5:].lstrip("/") if path.startswith("file:") else path


def union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


@dataclass(frozen=True)
class ParquetReader:
    """Files keep their types."""

    batch_size: int = 1 << 16

    def read(self, files: DataFrame, types: Types = None, most: int | None = None) -> DataFrame:
        from pyarrow import parquet

        plain, rest = split_plain(files, (".parquet", ".pq")) if most is None else ([], files)
        out = []
        if plain:
            frame = files.sparkSession.read.option("mergeSchema", True).parquet(*[r["path"] for r in plain])
            out.append(by_spark(files, plain, frame))
        if not rest.isEmpty():
            read = lambda s: parquet.ParquetFile(pa.BufferReader(s.read()))
            out.append(in_tasks(rest, lambda s: read(s).iter_batches(batch_size=self.batch_size), schemas(rest, lambda s: read(s).schema_arrow), most))
        return union(out)


@dataclass(frozen=True)
class JsonReader:
    """JSON lines, or one array; types are inferred over all files."""

    def read(self, files: DataFrame, types: Types = None, most: int | None = None) -> DataFrame:
        spark = files.sparkSession
        if most is not None:
            return self.read_whole(files, most)
        plain, rest = split_plain(files, (".json", ".jsonl", ".ndjson"))
        starts = {r["path"]: r["value"].lstrip()[:1] for r in (spark.read.text([x["path"]]).where(F.trim("value") != "").limit(1).select("value", F.lit(x["path"]).alias("path")).first() for x in plain) if r} if plain else {}
        lines = [r for r in plain if starts.get(r["path"]) == "{"]
        whole = files.where(~F.col("file_id").isin([r["file_id"] for r in lines])) if lines else files
        out = []
        if lines:  # these split
            out.append(by_spark(files, lines, spark.read.option("mode", "FAILFAST").json([r["path"] for r in lines])))
        if not lines or not whole.isEmpty():
            out.append(self.read_whole(whole))
        return union(out)

    def read_whole(self, files: DataFrame, most: int | None = None) -> DataFrame:
        # a line, or an array's element, becomes a row of text: what a file has and how long it is may vary
        def values(stream: BinaryIO) -> Iterator[str]:
            for n, line in enumerate(x for x in stream if x.strip()):
                if n == 0 and line.lstrip()[:1] == b"[":
                    yield from map(json.dumps, json.loads(line + stream.read()))
                    return
                yield line.decode()

        def lines(stream: BinaryIO) -> Iterator[pa.RecordBatch]:
            rows = values(stream)
            while held := list(islice(rows, 1 << 14)):
                yield pa.RecordBatch.from_pydict({"json": held})

        text = in_tasks(files, lines, T.StructType([T.StructField("json", T.StringType())]), most)
        spark = files.sparkSession
        # the schema of all rows, found in the JVM; files are read a second time for it
        strings = getattr(text.select("json")._jdf, "as")(spark._jvm.org.apache.spark.sql.Encoders.STRING())
        schema = T.StructType.fromJson(json.loads(spark._jsparkSession.read().json(strings).schema().json()))
        return text.select(F.from_json("json", schema, {"mode": "FAILFAST"}).alias("r"), "_source_file", "_position").select("r.*", "_source_file", "_position")


def unpacked(files: DataFrame, ending: str) -> list:
    """(file_id, path) of files under names that Spark's own readers take: members and later versions are copied to the work folder."""
    plain, rest = split_plain(files, (ending,))
    if rest.isEmpty():
        return plain
    folder = f"{work_root(files.sparkSession)}/tidemill/unpacked-{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from ..operators.mirror import open_path

        for batch in batches:
            out = []
            for f in zip(*[c.to_pylist() for c in batch.columns]):
                for i, stream in enumerate(streams(*f)):
                    path = f"{folder}/{f[0]}-{i}{ending}"
                    store, at = open_path(path)
                    store.create_dir(at.rpartition("/")[0])
                    with store.open_output_stream(f"{at}.part", compression=None) as copy:
                        while block := stream.read(1 << 20):
                            copy.write(block)
                    store.move(f"{at}.part", at)  # whole, or not there
                    out.append((f[0], path))
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.string())], names=["file_id", "path"])

    copies = rest.select("file_id", "path", "member").repartition(max(1, min(rest.count(), 1000))).mapInArrow(run, "file_id long, path string")
    return [*plain, *copies.collect()]


@dataclass(frozen=True)
class AvroReader:
    """Needs Spark's Avro module on the class path."""

    batch_size: int = 1 << 16

    def read(self, files: DataFrame, types: Types = None, most: int | None = None) -> DataFrame:
        held = unpacked(files, ".avro")
        return first_of(by_spark(files, held, files.sparkSession.read.format("avro").load([r["path"] for r in held])), most)


@dataclass(frozen=True)
class XmlReader:
    """An element for each row."""

    row_tag: str

    def read(self, files: DataFrame, types: Types = None, most: int | None = None) -> DataFrame:
        held = unpacked(files, ".xml")
        reader = files.sparkSession.read.option("rowTag", self.row_tag)
        return first_of(by_spark(files, held, (reader.schema(types) if isinstance(types, T.StructType) else reader).xml([r["path"] for r in held] if len(held) > 1 else held[0]["path"])), most)


@dataclass(frozen=True)
class FunctionReader:
    """Any function of a stream that yields Arrow tables or lists of dicts."""

    fn: Callable[[BinaryIO], Iterator]

    def batches(self, stream: BinaryIO) -> Iterator[pa.RecordBatch]:
        for x in self.fn(stream):
            yield from (x if isinstance(x, pa.Table) else pa.Table.from_pylist(list(x))).to_batches()

    def read(self, files: DataFrame, types: Types = None, most: int | None = None) -> DataFrame:
        def schema_of(stream: BinaryIO) -> pa.Schema:
            kinds: dict[str, pa.DataType] = {}
            for batch in self.batches(stream):
                for f in batch.schema:
                    kinds.setdefault(f.name, pa.string() if pa.types.is_null(f.type) else f.type)
            return pa.schema(list(kinds.items()))

        return in_tasks(files, self.batches, schemas(files, schema_of), most)


def first_of(rows: DataFrame, most: int | None) -> DataFrame:
    """The first rows of each file, where the format can't stop earlier."""
    if most is None:
        return rows
    return rows.withColumn("_n", F.row_number().over(W.partitionBy("_source_file").orderBy("_position"))).where(F.col("_n") <= most).drop("_n")


def first_rows(reader: Reader, files: DataFrame, types: Types, most: int | None) -> DataFrame:
    """The first rows of each file by any reader; one that doesn't know ``most`` reads all."""
    if most is None or "most" in inspect.signature(reader.read).parameters:
        return reader.read(files, types, **({} if most is None else {"most": most}))
    return first_of(reader.read(files, types), most)
