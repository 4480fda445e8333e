"""The manifest as Parquet snapshots: a new folder for each change, and the newest whole one counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import manifest as m


class ManifestStore:
    """Snapshots ``v=N`` below a root; the path being read is never overwritten, and old ones can be dropped."""

    def __init__(self, spark: SparkSession, root: str, keep: int = 5):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep

    def versions(self) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        names = [s.getPath() for s in fs.listStatus(path) if s.getPath().getName().startswith("v=")]
        return sorted(int(p.getName()[2:]) for p in names if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS")))

    def read(self) -> DataFrame:
        held = self.versions()
        return self.spark.read.schema(m.SCHEMA).parquet(f"{self.root}/v={held[-1]}") if held else m.empty(self.spark)

    def write(self, files: DataFrame) -> DataFrame:
        held = self.versions()
        files.select(*m.SCHEMA.names).write.parquet(f"{self.root}/v={(held[-1] if held else 0) + 1}")
        for old in held[: -self.keep] if len(held) > self.keep else []:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/v={old}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
        return self.read()

    def next_id(self) -> int:
        from pyspark.sql import functions as F

        return (self.read().agg(F.max("id")).first()[0] or 0) + 1
