"""Session defaults and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(name: str = "tidemill", cpus: int | str = "*", memory: str = "8g", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    settings = {
        "spark.driver.memory": memory,
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def work_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; on a local session, a folder of our own where it is unset."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = held.get() if held.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "/tmp/checkpoints/tidemill"
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def materialize(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` as Parquet in the shared folder and read it back.

    A lost executor costs nothing then, and a table that is used several times is computed once. ``by``: a column whose
    values have folders of their own, so filters on it read no more than they need.
    """
    spark = df.sparkSession
    path = f"{work_root(spark)}/tidemill/{name}-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(by) if by else df.write
    writer.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.work_path = path
    return out


def discard(df: DataFrame, part: str | None = None) -> None:
    """Delete a table that ``materialize`` has returned, or a value's folder of it, once nothing reads it any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{df.work_path}/{part}" if part else df.work_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_work(spark: SparkSession) -> None:
    """Delete what ``materialize`` has written; call it when no result that reads it is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{work_root(spark)}/tidemill")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
