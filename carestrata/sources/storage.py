"""The shared folder for staged data, and Parquet tables kept below it."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SLOTS = 16
_SPLIT, _OPEN = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as the session's ``spark.checkpoint.dir`` names it.

    Only a single-machine session may fall back to a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="carestrata-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    app = spark.sparkContext.applicationId
    return f"{shared_root(spark)}/carestrata/{app}/{label}-{uuid.uuid4().hex}"


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


@contextmanager
def split_limit(spark: SparkSession, limit: int) -> Iterator[None]:
    """Scans that run inside read at most ``limit`` bytes of files a task.

    What a map task sorts or holds before a shuffle then follows this limit, however large the files grow.
    """
    before = spark.conf.get(_SPLIT)
    if limit < spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before):
        spark.conf.set(_SPLIT, str(limit))
    try:
        yield
    finally:
        spark.conf.set(_SPLIT, before)


@contextmanager
def open_cost(spark: SparkSession, cost: int) -> Iterator[None]:
    """Scans that run inside count a file as its bytes and at most ``cost`` more when files are dealt over tasks.

    With the default of 4 MB a task gets some thirty small packed files and writes a small file itself.
    """
    before = spark.conf.get(_OPEN)
    if cost < spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before):
        spark.conf.set(_OPEN, str(cost))
    try:
        yield
    finally:
        spark.conf.set(_OPEN, before)


def stage(
    df: DataFrame, label: str, partition_by: list[str] | None = None, path: str | None = None, **options: str
) -> DataFrame:
    """Write ``df`` to the shared folder, or to ``path``, and return a frame that reads it back.

    This cuts lineage with ordinary committed files, so a lost executor costs a re-read and not a recomputation.
    ``options`` go to the Parquet writer.
    """
    path = path or scratch_path(df.sparkSession, label)
    writer = df.write.mode("errorifexists").options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return read_table(df.sparkSession, path, df.schema).select(*df.columns)


def dealt(df: DataFrame, partition_by: list[str], key: str) -> DataFrame:
    """``df`` dealt for a write by ``partition_by``, in tasks of the adaptive advisory size.

    Such a write sorts what a task holds by partition. Dealt like this, the sort follows the advisory size and neither the
    table's nor an input split's; slots of ``key`` let a large partition go to many tasks.
    """
    slots = df.withColumn("_slot", F.pmod(F.xxhash64(key), F.lit(_SLOTS)))
    return slots.hint("rebalance", *partition_by, "_slot").drop("_slot")


def drop_staged(df: DataFrame) -> None:
    """Delete the files of a frame that :func:`stage` returned, once nothing reads it any more."""
    spark = df.sparkSession
    conf, path = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/carestrata/" in folder:
            path(folder).getFileSystem(conf).delete(path(folder), True)
