"""Helpers that the operators share."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Runs of anything but ASCII white space; the words of all contracts.
WORD = "[^\\x20\\x09-\\x0D]+"

SPAN = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType()),
            T.StructField("start", T.LongType()),
            T.StructField("end", T.LongType()),
            T.StructField("base", T.BooleanType()),
            T.StructField("weight", T.DoubleType()),
        ]
    )
)


def small_batches(df: DataFrame) -> DataFrame:
    """Long texts: Arrow batches are cut by bytes too, so a Python worker holds 4 MB of texts at a time.

    Parquet columns are read by plain ranges: vectored reads keep buffers outside the heap until it is collected
    (450 MB an executor on whole texts), and gain nothing where a few whole columns are read.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))
    df.sparkSession.conf.set("parquet.hadoop.vectored.io.enabled", "false")
    return df


def map_batches(df: DataFrame, fn: Callable[[dict[str, list]], Iterator[dict[str, list]] | dict[str, list]], schema: T.StructType) -> DataFrame:
    """``mapInArrow`` with columns as Python lists."""
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = fn(batch.to_pydict())
            yield pa.RecordBatch.from_pydict(out, schema=target)

    return small_batches(df).mapInArrow(run, schema)


class Covered:
    """Whether a stretch of text overlaps any of some spans (start, end); logarithmic in their number."""

    def __init__(self, spans: list[tuple[int, int]]):
        spans = sorted(spans)
        self.starts = [s for s, _ in spans]
        self.ends = list(accumulate((e for _, e in spans), max))

    def __call__(self, start: int, end: int) -> bool:
        i = bisect_left(self.starts, end)
        return i > 0 and self.ends[i - 1] > start


def spans_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda s: s["base"])


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("long")


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
