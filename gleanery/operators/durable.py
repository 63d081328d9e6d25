"""Tables whose lineage ends: loops that read what they wrote stay short, and a lost executor costs one step."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


#: Shuffle files go with the query that wrote them, not when the driver's JVM next happens to drop its plan.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; in local mode, where none is named, one beside the warehouse."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_settled"


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, for what Spark's readers and writers don't do."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(context._jsc.hadoopConfiguration())


def settle(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read again. They go with release(), or when the session's JVM ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/settled-{uuid.uuid4().hex}"
    held = spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(SHUFFLES_GO, held) if held is not None else spark.conf.unset(SHUFFLES_GO)
    where, files = hadoop_path(spark, path)
    files.deleteOnExit(where)
    out = spark.read.schema(df.schema).parquet(path)
    out._settled_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete settled tables that nothing reads any more."""
    for df in tables:
        where, files = hadoop_path(df.sparkSession, df._settled_at)
        files.delete(where, True)
