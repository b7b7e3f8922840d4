"""Landed pages into Bronze as an incremental stream with an insert-only merge per micro-batch."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carestrata.operators.bronze import bronze_rows, explode_pages, rows_to_insert
from carestrata.schemas import page_schema, raw_page_schema
from carestrata.sources.landing import PAGE_FILES, page_integrity, read_pages, resource_root
from carestrata.streaming.complete_batches import BATCH, COMPLETE, STATUS, batch_reports, use_state_store

#: a batch that is complete by its names, but has unreadable pages or other records than its manifest says
REFUSED = "REFUSED"

#: names of a micro-batch; contents are read by complete batch, so the number of micro-batches need not grow with files
MAX_NAMES = 100_000


def page_stream(spark: SparkSession, root: str, resource: str, max_files: int = 1000) -> DataFrame:
    """New page files below the resource's landing folder as they arrive, each resource as its untouched JSON text."""
    kept = T.StructType(
        raw_page_schema().fields
        + [T.StructField("ingestion_date", T.StringType()), T.StructField("batch_id", T.StringType())]
    )
    return (
        spark.readStream.schema(kept)
        .option("maxFilesPerTrigger", max_files)
        .option("pathGlobFilter", PAGE_FILES)
        .json(resource_root(root, resource))
        .withColumn("file_name", F.col("_metadata.file_path"))
    )


def stream_bronze(
    spark: SparkSession,
    root: str,
    resource: str,
    target: str,
    checkpoint: str,
    *,
    source_system: str,
    api_url: str,
    load_ts: datetime | None = None,
    schema: T.StructType | None = None,
    max_files: int = 1000,
    date_local_batches: bool = True,
):
    """Process every page file not seen yet and stop; returns the finished query.

    A replayed micro-batch adds nothing, since the merge skips keys the target holds. With ``date_local_batches`` the
    merge reads only the target folders of the dates in the micro-batch, of which there are as many as days landed.
    A page that cannot be read stops the stream before anything of its micro-batch is written; ``schema`` is that of a
    page of the resource if it is not one of the declared ones.
    """
    pages = page_stream(spark, root, resource, max_files)
    entry = (schema or page_schema(resource))["fhir_bundle"].dataType["entry"].dataType.elementType
    data_schema = entry["resource"].dataType

    def merge(batch: DataFrame, _epoch: int) -> None:
        # one pass over the pages before the load; a batch holds as many days as were landed
        broken = F.col("_corrupt_record").isNotNull() | F.col("fhir_bundle").isNull()
        day = F.struct("ingestion_date")  # kept also where it is null
        told = batch.agg(F.min(F.when(broken, F.col("file_name"))).alias("broken"), F.collect_set(day).alias("days")).first()
        if told["broken"]:
            raise ValueError(f"unreadable page {told['broken']}")
        rows = bronze_rows(
            explode_pages(batch, "ingestion_date"),
            source_system=source_system,
            api_url=api_url,
            ingestion_date=F.col("ingestion_date"),
            load_ts=load_ts,
            schema=data_schema,
        )
        _insert_new(rows, target, [d[0] for d in told["days"]] if date_local_batches else None)

    query = (
        pages.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def stream_complete_batches(
    spark: SparkSession,
    root: str,
    resource: str,
    target: str,
    checkpoint: str,
    reports: str,
    *,
    source_system: str,
    api_url: str,
    load_ts: datetime | None = None,
    schema: T.StructType | None = None,
    max_files: int = MAX_NAMES,
    multi_line: bool = False,
):
    """Load every batch that became complete since the last call, and stop; returns the finished query.

    Names of pages and manifests stream through the state of :func:`batch_reports`, so a batch with missing or extra
    files waits however often this runs, and its pages are read once, when it is complete: with the same checks and the
    same insert-only merge as the batch load. ``max_files`` bounds the names of a micro-batch. ``reports`` holds a row for each batch reported by a micro-batch
    (partition ``epoch``); a complete batch that cannot be read in full is REFUSED there and not loaded. A micro-batch
    that runs again after a failure replaces its reports and inserts nothing twice.
    """
    use_state_store(spark)
    body = (schema or page_schema(resource))["fhir_bundle"].dataType["entry"].dataType.elementType["resource"].dataType
    kept = T.StructType.fromDDL(STATUS)

    def load(batch: DataFrame, epoch: int) -> None:
        session, path = batch.sparkSession, f"{reports}/epoch={epoch}"
        # written first, since the state behind the stream must be read once; few rows, and the state keeps its own tasks
        batch.repartition(1).write.mode("overwrite").parquet(f"{path}/of=names")
        told = session.read.schema(kept).parquet(f"{path}/of=names")
        complete = told.filter(F.col("status") == COMPLETE)
        days = [r[0] for r in complete.select("ingestion_date").distinct().collect()]
        if not days:
            return
        pages = read_pages(session, root, resource, ingestion_date=days, batches=complete, multi_line=multi_line, raw=True)
        whole = page_integrity(pages, complete).select(*BATCH, "is_whole")
        refused = complete.join(whole.filter("NOT is_whole"), BATCH, "left_semi").withColumn("status", F.lit(REFUSED))
        refused.repartition(1).write.mode("overwrite").parquet(f"{path}/of=pages")
        out = session.read.schema(kept).parquet(f"{path}/of=pages")
        loaded = complete.join(out, BATCH, "left_anti")
        if loaded.isEmpty():
            return
        pages = read_pages(session, root, resource, ingestion_date=days, batches=loaded, multi_line=multi_line, raw=True)
        rows = bronze_rows(
            explode_pages(pages, "ingestion_date"),
            source_system=source_system,
            api_url=api_url,
            ingestion_date=F.col("ingestion_date"),
            load_ts=load_ts,
            schema=body,
        )
        _insert_new(rows, target, days)

    query = (
        batch_reports(spark, root, resource, max_files)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def read_reports(spark: SparkSession, reports: str) -> DataFrame:
    """What :func:`stream_complete_batches` reported, with the micro-batch (``epoch``) that did."""
    return spark.read.schema(f"{STATUS}, epoch bigint, of string").parquet(reports).drop("of")


def _insert_new(rows: DataFrame, target: str, days: list[str] | None) -> None:
    """Append the rows whose key the target lacks; ``days`` prunes what is read of it."""
    session = rows.sparkSession
    if _has_files(session, target):
        rows = rows_to_insert(session.read.schema(rows.schema).parquet(target), rows, partition_dates=days)
    rows.write.mode("append").partitionBy("ingestion_date").parquet(target)


def _has_files(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)
