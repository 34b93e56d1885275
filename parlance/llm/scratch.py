"""Tables written to the folder that driver and executors share, to cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Whether Spark deletes a query's shuffle files when it ends, and not when the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The cluster's `spark.checkpoint.dir`; a temporary folder in local mode only."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
        base = "file://" + tempfile.mkdtemp(prefix="parlance-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None, options: dict[str, str] | None = None, free: bool = False) -> DataFrame:
    """Write `df` as Parquet in the shared folder, under the writer's `options`, and return the table read back; `free`: its shuffle files go at once."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    writer = df.write.options(**(options or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    before = spark.conf.get(_CLEANUP, None)
    if free:
        spark.conf.set(_CLEANUP, "true")
    try:
        writer.parquet(path)
    finally:
        if free and before is None:
            spark.conf.unset(_CLEANUP)
        elif free:
            spark.conf.set(_CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._parlance_path = path
    return out


def discard(df: DataFrame | None) -> None:
    """Delete a table of `materialize` that no later result reads."""
    path = getattr(df, "_parlance_path", None)
    if path:
        jvm = df.sparkSession._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def clear(spark: SparkSession) -> None:
    """Delete all tables of this application in the shared folder; results that read them end with them."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
