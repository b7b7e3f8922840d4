"""Catalog tables on Parquet, sinks, table detail, compaction and the metadata tables."""

from __future__ import annotations

import time
import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carestrata.schemas import EVENT_LOG, RESOURCE_CONFIG, RUN_LOG

# The resources of a run and their order.
RESOURCE_CONFIG_ROWS = [
    Row(resource_type="Patient", active_flag=True, load_order=1),
    Row(resource_type="Encounter", active_flag=True, load_order=2),
    Row(resource_type="Observation", active_flag=True, load_order=3),
    Row(resource_type="Condition", active_flag=True, load_order=4),
]
STATUSES = ("SUCCESS", "FAILED", "PARTIAL_SUCCESS")

TARGET_BYTES = 128 * 1024 * 1024
_NEXT, _PREVIOUS, _VERSION = "__next", "__prev", "__v"
#: seconds a replaced version stays for readers still on it
RETENTION_SECONDS = 24 * 3600


# --- catalog --------------------------------------------------------------------------------------------------------


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def list_tables(spark: SparkSession, prefix: str = "", database: str | None = None) -> DataFrame:
    """Tables whose name starts with ``prefix``."""
    scope = f" IN {database}" if database else ""
    return spark.sql(f"SHOW TABLES{scope}").filter(F.col("tableName").startswith(prefix)).select("tableName")


def _split(spark: SparkSession, name: str) -> tuple[str, str]:
    """(database, table) of a possibly unqualified name."""
    database, _, table = name.rpartition(".")
    return database or spark.catalog.currentDatabase(), table


def _folder(spark: SparkSession, database: str) -> str:
    return spark.catalog.getDatabase(database).locationUri.rstrip("/")


def version_path(spark: SparkSession, name: str) -> str:
    """A new folder below the database for one version of a table."""
    database, table = _split(spark, name)
    return f"{_folder(spark, database)}/{table}{_VERSION}{uuid.uuid4().hex}"


def partition_folder(spark: SparkSession, path: str, column: str, value: str) -> str:
    """Where a table whose files lie below ``path`` has one value of its partition column."""
    names = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return f"{path}/{names.getPartitionPathString(column, value)}"


def replace_table(df: DataFrame, name: str, partition_by: list[str] | None = None) -> None:
    """Full overwrite with the schema of ``df``: write a new version below the database, then swap names.

    The old version stays until the new one is complete, so ``df`` may read the table it replaces, and its files stay
    for readers still on them until :func:`drop_old_versions`.
    """
    spark = df.sparkSession
    database, table = _split(spark, name)
    fresh = f"{database}.{table}{_NEXT}"
    spark.sql(f"DROP TABLE IF EXISTS {fresh}")
    writer = df.write.format("parquet").option("path", version_path(spark, name))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.mode("errorifexists").saveAsTable(fresh)
    previous = f"{database}.{table}{_PREVIOUS}"
    if table_exists(spark, f"{database}.{table}"):
        spark.sql(f"DROP TABLE IF EXISTS {previous}")
        spark.sql(f"ALTER TABLE {database}.{table} RENAME TO {previous}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {database}.{table}")
    spark.sql(f"DROP TABLE IF EXISTS {previous}")


def finish_swap(spark: SparkSession, name: str) -> None:
    """Complete a replacement that was interrupted, so that the table exists if any version of it is complete.

    A new version enters the catalog only when all its files are written, so it is taken first; without one the old
    name comes back. Call it before a table is read or created.
    """
    database, table = _split(spark, name)
    for suffix in (_NEXT, _PREVIOUS):
        if not table_exists(spark, f"{database}.{table}") and table_exists(spark, f"{database}.{table}{suffix}"):
            spark.sql(f"ALTER TABLE {database}.{table}{suffix} RENAME TO {database}.{table}")
    spark.sql(f"DROP TABLE IF EXISTS {database}.{table}{_PREVIOUS}")


def _location(spark: SparkSession, name: str) -> str:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter("col_name = 'Location'").first()
    return described["data_type"].rstrip("/").rsplit("/", 1)[1]


def drop_old_versions(spark: SparkSession, name: str, retention_seconds: int = RETENTION_SECONDS) -> int:
    """Delete version folders that no catalog name reads and that were written before the retention time.

    Returns how many. Nothing is deleted while the table itself is missing.
    """
    database, table = _split(spark, name)
    if not table_exists(spark, f"{database}.{table}"):
        return 0
    names = [f"{database}.{table}{suffix}" for suffix in ("", _NEXT, _PREVIOUS)]
    current = {_location(spark, n) for n in names if table_exists(spark, n)}
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{_folder(spark, database)}/{table}{_VERSION}*")
    fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    oldest = (time.time() - retention_seconds) * 1000
    old = [
        status.getPath()
        for status in fs.globStatus(pattern) or []
        if status.getPath().getName() not in current and status.getModificationTime() <= oldest
    ]
    for path in old:
        fs.delete(path, True)
    return len(old)


def create_partitioned(df: DataFrame, name: str, partition_by: list[str]) -> None:
    """First load of a partitioned table, whose files lie in a version folder and outlive a change of its entry."""
    database, table = _split(df.sparkSession, name)
    writer = df.write.format("parquet").option("path", version_path(df.sparkSession, name)).partitionBy(*partition_by)
    writer.mode("errorifexists").saveAsTable(f"{database}.{table}")


def create_over(spark: SparkSession, name: str, path: str, schema: T.StructType, partition_by: list[str]) -> None:
    """First load of a partitioned table from files written below ``path`` (of :func:`version_path`) in its layout.

    Columns of the files that ``schema`` lacks are not part of the table and stay unread.
    """
    database, table = _split(spark, name)
    _create_external(spark, f"{database}.{table}", path, widened(schema, schema), partition_by)


def _create_external(spark: SparkSession, name: str, path: str, schema: T.StructType, partition_by: list[str]) -> None:
    fields = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(schema.json()).toDDL()
    by = f"PARTITIONED BY ({', '.join(partition_by)})" if partition_by else ""
    spark.sql(f"CREATE TABLE {name} ({fields}) USING parquet {by} LOCATION '{path}'")
    if partition_by:
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")


def drop_unused_version(spark: SparkSession, name: str, path: str) -> None:
    """Delete a folder of :func:`version_path` unless the table reads it."""
    if table_exists(spark, name) and _location(spark, name) == path.rsplit("/", 1)[1]:
        return
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def append_table(df: DataFrame, name: str) -> None:
    """Append, creating the table on first use."""
    df.write.format("parquet").mode("append").saveAsTable(name)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def widened(old: T.DataType, new: T.DataType, path: str = "") -> T.DataType:
    """``old`` with the fields only ``new`` has behind its own, at every depth; an error where both differ in type."""
    if isinstance(old, T.StructType) and isinstance(new, T.StructType):
        more, fields = {f.name: f for f in new.fields}, []
        for field in old.fields:
            other = more.pop(field.name, field)
            fields.append(T.StructField(field.name, widened(field.dataType, other.dataType, f"{path}.{field.name}".lstrip(".")), True))
        return T.StructType(fields + list(more.values()))
    if isinstance(old, T.ArrayType) and isinstance(new, T.ArrayType):
        return T.ArrayType(widened(old.elementType, new.elementType, f"{path}[]"), True)
    if old.simpleString() != new.simpleString():
        raise ValueError(f"{path} is {old.simpleString()} in the table and {new.simpleString()} in the batch")
    return old


def evolve_schema(spark: SparkSession, name: str, schema: T.StructType) -> None:
    """Give a table a wider schema without touching its files, which are read with null for what they lack.

    A second catalog entry over the same folder takes the table's name; :func:`finish_swap` completes an interrupted
    change. A table that owns its folder (one not written by :func:`create_partitioned` or :func:`replace_table`) is
    rewritten once instead, since dropping its entry would delete its files.
    """
    database, table = _split(spark, name)
    layout = partition_columns(spark, name)
    described = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    if described.get("Type") != "EXTERNAL":
        empty = spark.createDataFrame([], schema)
        replace_table(empty.unionByName(spark.table(name), allowMissingColumns=True), name, layout or None)
        return
    fresh, previous = f"{database}.{table}{_NEXT}", f"{database}.{table}{_PREVIOUS}"
    spark.sql(f"DROP TABLE IF EXISTS {fresh}")
    _create_external(spark, fresh, described["Location"], schema, layout)
    spark.sql(f"DROP TABLE IF EXISTS {previous}")
    spark.sql(f"ALTER TABLE {database}.{table} RENAME TO {previous}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {database}.{table}")
    spark.sql(f"DROP TABLE IF EXISTS {previous}")


def evolve_and_append(df: DataFrame, name: str) -> None:
    """Append rows whose columns or nested fields may have grown; stored files are not rewritten for it."""
    spark = df.sparkSession
    current = spark.table(name).schema
    schema = widened(current, df.schema)
    if schema.simpleString() != widened(current, current).simpleString():
        evolve_schema(spark, name, schema)
    shaped = spark.createDataFrame([], spark.table(name).schema).unionByName(df, allowMissingColumns=True)
    shaped.write.insertInto(name)


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str], fmt: str = "parquet") -> None:
    """Replace only the partitions ``df`` holds rows for, so that a rerun does not double them."""
    (
        df.write.format(fmt)
        .partitionBy(*partition_by)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .save(path)
    )


def overwrite_table_partitions(df: DataFrame, name: str) -> None:
    """Replace the partitions of a catalog table that ``df`` holds rows for.

    New files are complete before any partition changes, so ``df`` may read the table.
    """
    spark, mode = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")  # an insert takes the mode from the session only
    try:
        df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
    finally:
        spark.conf.set(mode, before)


def write_quarantine(rejected: DataFrame, root: str, resource: str, run_date: str) -> None:
    """Rejected rows as JSON below ``<root>/<resource>/ingestion_date=<run date>/source_date=<day>/batch=<batch>``.

    A rerun replaces only the source days and batches it rejects rows of, so days loaded on one run date stay apart.
    ``source_date`` is the row's own ``ingestion_date`` and ``batch`` its ``batch_id``, where it has them.
    """
    own = {"source_date": "ingestion_date", "batch": "batch_id"}
    none = F.lit(None).cast("string")
    dated = rejected.withColumns(
        {new: F.col(old).cast("string") if old in rejected.columns else none for new, old in own.items()}
    ).withColumn("ingestion_date", F.lit(run_date))
    overwrite_partitions(dated, f"{root.rstrip('/')}/{resource.lower()}", ["ingestion_date", *own], "json")


# --- table detail and compaction ------------------------------------------------------------------------------------


def table_detail(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """File count, bytes and rows of a file-backed frame, per partition if asked."""
    keys = partition_by or []
    per_file = df.groupBy(
        *keys, F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_size")
    ).agg(F.count(F.lit(1)).alias("_rows"))
    return per_file.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("num_files"),
        F.sum("_size").alias("size_in_bytes"),
        F.sum("_rows").alias("num_rows"),
    )


def _packed(
    table: DataFrame, partition_by: str, target_bytes: int, min_files: int, small_bytes: int | None = None
) -> DataFrame | None:
    """Rows of the partitions that have more files than their bytes need, dealt over the files they do need.

    Partitions whose files hold ``small_bytes`` or more on average are left as they are, if that is given.

    Rows go to ``ceil(bytes / target)`` writers by their position in their file, so one large partition is never one
    task and a retried task deals the same rows the same way. Writers are numbered through all partitions: each task
    writes one file, and two large partitions never meet in one as they would by hash.
    """
    detail = table_detail(table, [partition_by]).withColumn(
        "_files", F.ceil(F.col("size_in_bytes") / F.lit(target_bytes)).cast("int")
    )
    too_many = (F.col("num_files") > F.col("_files")) & (F.col("num_files") >= min_files)
    if small_bytes is not None:
        too_many &= F.col("size_in_bytes") < F.col("num_files") * small_bytes
    earlier = Window.orderBy(partition_by).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition to rewrite
    first = F.coalesce(F.sum("_files").over(earlier), F.lit(0)).alias("_first")
    small = detail.filter(too_many).select(partition_by, "_files", first)
    files = small.agg(F.sum("_files")).first()[0]
    if not files:
        return None
    numbered = table.select("*", F.col("_metadata.row_index").alias("_row"))
    # one row per partition to rewrite; a shuffle by partition would put a day into one task
    dealt = numbered.join(F.broadcast(small), partition_by)
    writer = (F.col("_first") + F.pmod("_row", "_files")).cast("int")
    return dealt.repartitionById(int(files), writer).select(*table.columns)


def compact(
    spark: SparkSession, path: str, schema, partition_by: str, target_bytes: int = TARGET_BYTES, min_files: int = 2
) -> None:
    """Merge small files below ``path`` where a partition has at least ``min_files``; a second call finds nothing.

    The rewrite replaces whole partitions when it commits, so a failed one leaves the old files.
    """
    packed = _packed(spark.read.schema(schema).parquet(path), partition_by, target_bytes, min_files)
    if packed is not None:
        overwrite_partitions(packed, path, [partition_by])


def compact_table(
    spark: SparkSession,
    name: str,
    partition_by: str,
    values: list[str] | None = None,
    target_bytes: int = TARGET_BYTES,
    min_files: int = 2,
    small_bytes: int | None = None,
) -> None:
    """The same for a catalog table, limited to the partitions ``values`` if given."""
    table = spark.table(name)
    if values is not None:
        table = table.filter(F.col(partition_by).isin(values))
    packed = _packed(table, partition_by, target_bytes, min_files, small_bytes)
    if packed is not None:
        overwrite_table_partitions(packed, name)


# --- metadata tables ------------------------------------------------------------------------------------------------


def resource_config(spark: SparkSession, rows: list[Row] | None = None) -> DataFrame:
    return spark.createDataFrame(rows or RESOURCE_CONFIG_ROWS, RESOURCE_CONFIG)


def stored_resource_config(spark: SparkSession, name: str) -> DataFrame:
    """The resource settings a run reads, stored with their first values if there are none yet."""
    finish_swap(spark, name)
    if not table_exists(spark, name):
        replace_table(resource_config(spark), name)
    return spark.table(name)


def active_resources(config: DataFrame) -> DataFrame:
    """Active resources in load order."""
    return config.filter("active_flag").orderBy("load_order").select("resource_type", "load_order")


def run_log_row(spark: SparkSession, **values) -> DataFrame:
    """One execution-log row; columns not given are null, and required ones are checked by the schema."""
    if values.get("status") not in STATUSES:
        raise ValueError(f"status must be one of {STATUSES}")
    return spark.createDataFrame([tuple(values.get(f.name) for f in RUN_LOG.fields)], RUN_LOG)


def event_log_rows(spark: SparkSession, events: list[tuple[datetime, str, str, dict[str, str]]]) -> DataFrame:
    """Structured log events (timestamp, level, message, context)."""
    return spark.createDataFrame(events, EVENT_LOG)


def labelled_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of each table as (tbl, cnt)."""
    counts = [df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(n).alias("tbl"), "cnt") for n, df in tables.items()]
    return reduce(DataFrame.unionAll, counts)


def tolerant_census(spark: SparkSession, names: list[str]) -> DataFrame:
    """Row count of each catalog table as (tbl, cnt), null where it does not exist; one plan over all tables."""
    held = {n: spark.table(n) for n in names if table_exists(spark, n)}
    absent = [F.struct(F.lit(n).alias("tbl"), F.lit(None).cast("bigint").alias("cnt")) for n in names if n not in held]
    missing = spark.range(1).select(F.inline(F.array(*absent))) if absent else None
    if not held:
        return missing
    return labelled_counts(held) if missing is None else labelled_counts(held).unionAll(missing)


def tolerant_counts(spark: SparkSession, names: list[str]) -> dict[str, int | None]:
    """Row count of each catalog table, None where it does not exist."""
    return {r["tbl"]: r["cnt"] for r in tolerant_census(spark, names).collect()} if names else {}
