"""Arrivals of files as a stream: a trigger for the engine, and windowed counts with late data.

The manifest's diff stays authoritative: a file stream doesn't see a changed file at a known path.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def watch(spark: SparkSession, root: str, checkpoint: str, on_arrival: Callable[[DataFrame, int], None], once: bool = True) -> StreamingQuery:
    """Call ``on_arrival`` with (path, mtime, size) of new files; with ``once``, for what is there now."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    stream = spark.readStream.format("binaryFile").option("recursiveFileLookup", True).schema(schema).load(root)
    files = stream.select("path", F.col("modificationTime").alias("mtime"), F.col("length").alias("size"))
    writer = files.writeStream.foreachBatch(on_arrival).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime="300 seconds")).start()


def volume_stream(events: DataFrame, time: str, keys: tuple[str, ...] = (), window: str = "1 day", late: str = "7 days") -> DataFrame:
    """(window start, *keys, n_rows) of a stream; a window closes once the watermark passes it. On a batch it gives all windows."""
    counted = events.withWatermark(time, late).groupBy(F.window(time, window), *keys).agg(F.count("*").alias("n_rows"))
    return counted.select(F.col("window.start").alias("start"), *keys, "n_rows")
