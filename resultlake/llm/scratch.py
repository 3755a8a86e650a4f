"""Written tables that cut lineage, in the folder that every executor shares."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where the session names none (a local test session), one temporary folder per
    application is made; on a cluster the setting must be given.
    """
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="resultlake-")
    return _local[app]


def path(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/resultlake/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    The copy survives lost executors, and each later use reads it instead of running
    the plan again.
    """
    spark = df.sparkSession
    where = path(spark, name)
    schema = df.schema
    df.write.parquet(where)
    return spark.read.schema(schema).parquet(where)


def remove(spark: SparkSession, where: str) -> None:
    """Delete a folder through the file system that holds it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(where)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear(spark: SparkSession) -> None:
    """Delete every table that :func:`stored` wrote; call it once results are saved."""
    remove(spark, f"{folder(spark)}/resultlake")
