"""Which landed batches are complete, told as a stream of file names.

Page files and manifests arrive in any order and over any number of micro-batches. A keyed state for each batch holds
the names its newest manifest lists and the names found so far, never their contents; a batch is reported once, when both
sets are equal. A batch that stays incomplete waits on: a running stream reports it when its timer runs out, and
:func:`waiting_batches` reads all such batches from the stored state, also of a stream that has stopped.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from carestrata.schemas import MANIFEST_DDL
from carestrata.sources.landing import PAGE_FILES, manifest_root, resource_root

_PLACE = r"ingestion_date=([^/]+)/batch_id=([^/]+)/([^/]+)$"
BATCH = ["ingestion_date", "batch_id"]
# an arrival is (ingestion_date, batch_id, kind, file, told_at, total_records): kind is LISTED or FOUND, and told_at,
# microseconds, orders the manifests of one batch
STATUS = (
    "ingestion_date string, batch_id string, status string, files_listed bigint, files_found bigint, "
    "files_matched bigint, total_records bigint"
)
# what the state keeps; built field by field, since the worker that needs them has no session to parse text with
_NAME = T.StructType([T.StructField("file", T.StringType())])
_MARK = T.StructType([T.StructField("held", T.BooleanType())])
_COUNTS = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("told_at", "total_records", "n_listed", "n_found", "n_matched")]
    + [T.StructField("complete", T.BooleanType()), T.StructField("since", T.TimestampType())]
)
LISTED, FOUND = "listed", "found"
COMPLETE, WAITING, LATE = "COMPLETE", "WAITING", "CHANGED_AFTER_COMPLETION"
STATE_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def arrived_pages(spark: SparkSession, root: str, resource: str, max_files: int = 1000) -> DataFrame:
    """Names of new page files; the files are listed and not opened."""
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", PAGE_FILES)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", max_files)
        .load(resource_root(root, resource))
    )
    part = lambda i: F.regexp_extract("path", _PLACE, i)
    return files.select(
        part(1).alias("ingestion_date"),
        part(2).alias("batch_id"),
        F.lit(FOUND).alias("kind"),
        part(3).alias("file"),
        F.unix_micros("modificationTime").alias("told_at"),
        F.lit(None).cast("bigint").alias("total_records"),
    ).filter(F.col("batch_id") != "")


def arrived_manifests(spark: SparkSession, root: str, resource: str, max_files: int = 1000) -> DataFrame:
    """The file names new manifests list, one row each; an unreadable or empty manifest gives one row without a name."""
    read = (
        spark.readStream.schema(f"{MANIFEST_DDL}, for_date string, for_batch string")
        .option("maxFilesPerTrigger", max_files)
        .json(manifest_root(root, resource))
    )
    return read.select(
        F.col("for_date").alias("ingestion_date"),
        F.col("for_batch").alias("batch_id"),
        F.lit(LISTED).alias("kind"),
        F.explode_outer(F.array_distinct("files")).alias("file"),
        F.unix_micros("_metadata.file_modification_time").alias("told_at"),
        "total_records",
    )


class BatchState(StatefulProcessor):
    """Listed and found names of one batch, and whether it was reported complete."""

    def __init__(self, patience_ms: int | None):
        self.patience_ms = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.listed = handle.getMapState("listed", _NAME, _MARK)
        self.found = handle.getMapState("found", _NAME, _MARK)
        self.counts = handle.getValueState("counts", _COUNTS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        fresh = not self.counts.exists()
        held = (None, None, 0, 0, 0, False, datetime.now()) if fresh else self.counts.get()
        told_at, total, n_listed, n_found, n_matched, complete, since = held
        names = []
        for row in rows:  # names of a manifest are gathered: only the newest manifest of the batch counts
            if row["kind"] == FOUND:
                if not self.found.containsKey((row["file"],)):
                    self.found.updateValue((row["file"],), (True,))
                    n_found += 1
                    n_matched += self.listed.containsKey((row["file"],))
            else:
                names.append((row["told_at"], row["file"], row["total_records"]))
        if names:
            newest = max(n[0] for n in names)
            if told_at is None or newest >= told_at:
                self.listed.clear()
                told_at, n_listed, n_matched = newest, 0, 0
                for when, file, records in names:
                    if when == newest:
                        total = records
                        if file is not None and not self.listed.containsKey((file,)):
                            self.listed.updateValue((file,), (True,))
                            n_listed += 1
                            n_matched += self.found.containsKey((file,))

        whole = n_listed == n_found == n_matched > 0
        status = None
        if whole and not complete:
            status, complete = COMPLETE, True
        elif complete and not whole:
            status = LATE
        elif fresh and self.patience_ms is not None:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience_ms)
        self.counts.update((told_at, total, n_listed, n_found, n_matched, complete, since))
        if status:
            yield _report(key, status, n_listed, n_found, n_matched, total)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if not self.counts.exists():
            return
        _, total, n_listed, n_found, n_matched, complete, _ = self.counts.get()
        if not complete:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience_ms)
            yield _report(key, WAITING, n_listed, n_found, n_matched, total)

    def close(self) -> None:
        pass


def _report(key, status: str, n_listed: int, n_found: int, n_matched: int, total: int | None) -> Row:
    return Row(
        ingestion_date=key[0],
        batch_id=key[1],
        status=status,
        files_listed=n_listed,
        files_found=n_found,
        files_matched=n_matched,
        total_records=total,
    )


def batch_reports(
    spark: SparkSession, root: str, resource: str, max_files: int = 1000, patience_seconds: float | None = None
) -> DataFrame:
    """A stream of batch reports: COMPLETE once all listed files and no others are there, and CHANGED_AFTER_COMPLETION for
    files or manifests that come after a batch was complete.

    With ``patience_seconds`` a batch that is incomplete so long is reported as WAITING each time; such a stream keeps
    looking at its timers, so it is for a trigger that runs on, and not for one that stops when nothing is new. The
    session needs the RocksDB state store (:func:`use_state_store`). State grows by one name for each page file.
    """
    pages = arrived_pages(spark, root, resource, max_files)
    arrivals = pages.unionByName(arrived_manifests(spark, root, resource, max_files))
    patience = None if patience_seconds is None else int(patience_seconds * 1000)
    return arrivals.groupBy(*BATCH).transformWithState(
        statefulProcessor=BatchState(patience),
        outputStructType=T.StructType.fromDDL(STATUS),
        outputMode="append",
        timeMode="None" if patience is None else "ProcessingTime",
    )


def waiting_batches(spark: SparkSession, checkpoint: str, before: datetime | None = None) -> DataFrame:
    """Batches the stored state of a stream holds as incomplete, those first seen ``before`` a time if given."""
    state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", "counts").load()
    held = state.select("key.*", "value.*").filter(~F.col("complete"))
    if before is not None:
        held = held.filter(F.col("since") < F.lit(before))
    return held.select(
        *BATCH,
        F.lit(WAITING).alias("status"),
        F.col("n_listed").alias("files_listed"),
        F.col("n_found").alias("files_found"),
        F.col("n_matched").alias("files_matched"),
        "total_records",
        "since",
    )


def use_state_store(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_PROVIDER)
