"""Every query by name: a callable of (spark, sf_dir) over the given tables."""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.operators import bronze, checks, gold, scd2, silver
from carestrata.plans import dashboard, day_state, periods, refresh
from carestrata.plans.lakehouse import AS_OF, LAST_YEAR, LOADED_AT, SECOND_LOAD, SPLIT_BYTES, Lakehouse, open_lakehouse
from carestrata.plans.run import RunConfig, run
from carestrata.plans.views import create_views
from carestrata.plans.star import DATE, ENCOUNTER, OBSERVATION, CONDITION, PATIENT, Star, StoredStar, evaluate
from carestrata.schemas import resource_schema
from carestrata.sources import fixtures as fx
from carestrata.sources import landing, tables
from carestrata.sources.storage import dealt, scratch_path, split_limit, stage
from carestrata.streaming.bronze_stream import read_reports, stream_bronze, stream_complete_batches
from carestrata.streaming.complete_batches import waiting_batches

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_PAGES_PER_FILE = 64
_ROWS_PER_WRITER = 1_000_000


def _query(fn: Callable[[Lakehouse], DataFrame]) -> Callable[[Lakehouse], DataFrame]:
    """Register ``fn`` under its own name."""
    _QUERIES[fn.__name__] = lambda spark, sf_dir: fn(open_lakehouse(spark, sf_dir))
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def star_of(lh: Lakehouse) -> Star:
    return StoredStar(lh.table)


# --- landing and Bronze ---------------------------------------------------------------------------------------------


def _patients_of(lh: Lakehouse, batch: str) -> DataFrame:
    return fx.patient_batches(lh.spark, lh.sf_dir).filter(F.col("batch") == batch).select("resource")


def _land(
    lh: Lakehouse,
    resources: DataFrame,
    root: str,
    kind: str,
    batch_id: str,
    batch: str = "A",
    pages_per_file: int = _PAGES_PER_FILE,
    compression: str = "none",
) -> DataFrame:
    day, extracted = fx.BATCHES[batch]
    return landing.land_batch(
        resources,
        root,
        kind,
        batch_id=batch_id,
        ingestion_date=day,
        extraction_timestamp=extracted,
        api_url=fx.API_URL,
        pages_per_file=pages_per_file,
        compression=compression,
    )


@_query
def bronze_explode_pages(lh: Lakehouse) -> DataFrame:
    root, day = scratch_path(lh.spark, "raw"), fx.BATCHES["A"][0]
    manifest = _land(lh, _patients_of(lh, "A"), root, "patient", "batchA")
    files = landing.list_files(lh.spark, landing.resource_root(root, "patient"))
    valid = landing.valid_batches(manifest, files)
    pages = landing.read_pages(lh.spark, root, "patient", ingestion_date=day, batches=valid)
    rows = bronze.bronze_rows(
        bronze.explode_pages(pages),
        source_system=fx.SOURCE_SYSTEM,
        api_url=fx.API_URL,
        ingestion_date=day,
        load_ts=LOADED_AT,
    )
    return rows.select(
        *["resource_id", "full_url", "source_resource_type", "batch_id", "extraction_timestamp"],
        *["source_system", "api_url", "load_timestamp", "ingestion_date"],
        F.col("resource_data.gender").alias("gender"),
        F.col("resource_data.birthDate").alias("birth_text"),
        F.size("resource_data.name").alias("names"),
        F.get_json_object("resource_json", "$.address[0].postalCode").alias("postal_code"),
    )


@_query
def bronze_manifest_valid(lh: Lakehouse) -> DataFrame:
    """Four landed batches; only the complete one is accepted."""
    spark, root = lh.spark, scratch_path(lh.spark, "raw")
    people = stage(_patients_of(lh, "A"), "patients")
    made = {b: _land(lh, people, root, "patient", b) for b in ("complete", "missing", "extra", "unreadable")}
    one_more = F.array_append("files", F.lit("page_9999.json"))
    spoiled = {
        "missing": made["missing"].withColumn("files", one_more),
        "extra": made["extra"].withColumn("files", F.slice("files", 2, F.size("files"))),
    }
    for manifest in spoiled.values():
        landing.write_manifest(stage(manifest, "manifest"), root, "patient")
    bad = f"{landing.manifest_root(root, 'patient')}/for_date={fx.BATCHES['A'][0]}/for_batch=unreadable"
    spark.range(1).select(F.lit("{not a manifest").alias("value")).write.mode("overwrite").text(bad)

    manifests = landing.read_manifests(spark, root, "patient")
    files = landing.list_files(spark, landing.resource_root(root, "patient"))
    status = landing.batch_status(manifests, files)
    accepted = landing.valid_batches(manifests, files).select("batch_id", "page_count", "total_records")
    return status.select("batch_id", "is_valid").join(accepted, "batch_id", "left")


@_query
def raw_folder_census(lh: Lakehouse) -> DataFrame:
    """Landed day folders of two resources, with two others that have none."""
    root = scratch_path(lh.spark, "raw")
    for batch in ("A", "B"):
        _land(lh, _patients_of(lh, batch), root, "patient", f"batch{batch}", batch)
    encounters = fx.encounters(lh.spark, lh.sf_dir).select("resource")
    _land(lh, encounters, root, "encounter", "batchA")
    return landing.folder_census(lh.spark, root, silver.RESOURCES)


@_query
def bronze_lookback_pull(lh: Lakehouse) -> DataFrame:
    events = lh.spark.read.parquet(f"{lh.sf_dir}/events.parquet").withColumn("day", F.to_date("ts"))
    pulled = bronze.lookback(events, "day", date(2024, 1, 20)).filter(F.col("day") <= F.lit(date(2024, 1, 20)))
    return pulled.groupBy("day", "event_type").agg(F.count(F.lit(1)).alias("pulled"))


def _pulls(lh: Lakehouse, first: str, last: str) -> DataFrame:
    return lh.table("bronze_event").filter(F.col("ingestion_date").between(first, last))


_EVENT_COLUMNS = ["resource_id", "batch_id", "ingestion_date", "event_type", "event_value"]


def _event_view(rows: DataFrame) -> DataFrame:
    return rows.select(
        *_EVENT_COLUMNS[:3],
        F.col("resource_data.type").alias("event_type"),
        F.col("resource_data.value").alias("event_value"),
    )


@_query
def bronze_merge_insert_new(lh: Lakehouse) -> DataFrame:
    """Pulls up to the 20th, merged with pulls from the 15th on."""
    merged = bronze.merge_insert_new(_pulls(lh, "2024-01-01", "2024-01-20"), _pulls(lh, "2024-01-15", "2024-01-30"))
    return _event_view(merged)


@_query
def bronze_merge_pruned(lh: Lakehouse) -> DataFrame:
    """The same merge for one day, reading only that day's target folder: every key is there, so nothing is new."""
    day = "2024-01-20"
    fresh = bronze.rows_to_insert(lh.table("bronze_event"), _pulls(lh, day, day), partition_dates=[day])
    return fresh.agg(F.count(F.lit(1)).alias("rows_to_insert"))


@_query
def bronze_loads_per_day(lh: Lakehouse) -> DataFrame:
    return checks.loads_per_day(lh.table("bronze_event"))


@_query
def bronze_top_reingested(lh: Lakehouse) -> DataFrame:
    return checks.most_reingested(lh.table("bronze_event"))


@_query
def bronze_preview(lh: Lakehouse) -> DataFrame:
    """The first ten patients by id, with a few nested fields, to look at what landed."""
    rows = lh.table("bronze_patient").filter(F.col("resource_id").isNotNull())
    return rows.orderBy("resource_id", "batch_id").limit(10).select(
        "resource_id",
        F.get("resource_data.name.family", F.lit(0)).alias("family_name"),
        F.col("resource_data.gender").alias("gender"),
        "ingestion_date",
    )


@_query
def bronze_dup_keys(lh: Lakehouse) -> DataFrame:
    """Duplicate (id, batch) keys if the observation table had been merged without its version time."""
    return checks.duplicate_keys(lh.table("bronze_observation"))


@_query
def bronze_lineage_complete(lh: Lakehouse) -> DataFrame:
    return checks.rows_missing_lineage(lh.table("bronze_event"))


@_query
def table_detail(lh: Lakehouse) -> DataFrame:
    """Rows per partition of the event log, with at least one file and some bytes each."""
    detail = tables.table_detail(lh.table("bronze_event"), ["ingestion_date"])
    return detail.select(
        "ingestion_date",
        "num_rows",
        (F.col("num_files") > 0).alias("has_files"),
        (F.col("size_in_bytes") > 0).alias("has_bytes"),
    )


def _writers(rows: DataFrame) -> int:
    """Six tasks, or as many as keep the rows that each sorts by day few; the count comes from the files' footers."""
    return max(6, -(-rows.count() // _ROWS_PER_WRITER))


@_query
def compact_preserves(lh: Lakehouse) -> DataFrame:
    """Content per day after compacting a table written as many small files."""
    spark, path = lh.spark, scratch_path(lh.spark, "compact-events")
    rows = _event_view(lh.table("bronze_event"))
    rows.repartition(_writers(rows)).write.partitionBy("ingestion_date").parquet(path)
    before = spark.read.schema(rows.schema).parquet(path)
    files_before = tables.table_detail(before, ["ingestion_date"]).select(
        "ingestion_date", F.col("num_files").alias("_before")
    )
    files_before = stage(files_before, "files-before")
    tables.compact(spark, path, rows.schema, "ingestion_date")
    after = spark.read.schema(rows.schema).parquet(path)
    detail = tables.table_detail(after, ["ingestion_date"])
    content = after.groupBy("ingestion_date").agg(F.round(F.sum("event_value"), 2).alias("total_value"))
    return (
        content.join(detail, "ingestion_date")
        .join(files_before, "ingestion_date")
        .select("ingestion_date", "num_rows", "total_value", (F.col("num_files") < F.col("_before")).alias("fewer_files"))
    )


def _drifted(lh: Lakehouse) -> tuple[DataFrame, DataFrame]:
    """First patient batch, and the same patients with a district, a birth-rank column and no marital status."""
    rows = lh.table("bronze_patient")
    first = rows.filter(F.col("batch_id") == "batchA").select("resource_id", "batch_id", "resource_data")
    data = F.col("resource_data")
    district = F.when(F.col("resource_id").isNotNull(), F.concat(F.lit("D-"), F.substring("resource_id", -1, 1)))
    homes = F.transform(data["address"], lambda a: a.withField("district", district))
    second = first.select(
        "resource_id",
        F.lit("batchC").alias("batch_id"),
        data.withField("address", homes).dropFields("maritalStatus").alias("resource_data"),
        F.size(data["name"]).alias("name_count"),
    )
    return first, second


@_query
def schema_drift_report(lh: Lakehouse) -> DataFrame:
    return bronze.drift_report(*_drifted(lh))


@_query
def schema_evolution_merge(lh: Lakehouse) -> DataFrame:
    """Insert-only merge across the drifted batch; fields missing on one side are null."""
    merged = bronze.merge_insert_new(*_drifted(lh))
    return merged.select(
        "resource_id",
        "batch_id",
        F.get("resource_data.address.district", F.lit(0)).alias("district"),
        F.col("resource_data.maritalStatus.text").alias("marital_status"),
        "name_count",
    )


def _stored_star(lh: Lakehouse) -> str:
    """A database with the Gold tables and the Silver facts' dimensions, for queries on the catalog itself."""
    database = "star_" + scratch_path(lh.spark, "db").rsplit("-", 1)[1][:12]
    lh.spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(lh.spark, 'db')}'")
    lh.table("gold_dim_patient")  # the facts read it too; the other tables are stored once, here
    for name in ("gold_dim_patient", "gold_dim_condition", "dim_date", "fact_encounter", "fact_observation"):
        rows = lh.rows(name)
        with split_limit(lh.spark, SPLIT_BYTES):
            tables.replace_table(rows, f"{database}.{name}")
    return database


@_query
def catalog_tables(lh: Lakehouse) -> DataFrame:
    """Catalog listing by prefix, with the rows behind each name and null for a table that does not exist."""
    database = _stored_star(lh)
    listed = [r["tableName"] for r in tables.list_tables(lh.spark, "fact_", database).collect()]
    counts = tables.tolerant_census(lh.spark, [f"{database}.{n}" for n in (*listed, "fact_missing")])
    return counts.select(F.substring_index("tbl", ".", -1).alias("table_name"), F.col("cnt").alias("row_count"))


@_query
def check_partition_columns(lh: Lakehouse) -> DataFrame:
    """What stored Bronze and Silver tables are partitioned by, against what they should be."""
    database, expected = _database(lh, "layout"), {}
    for resource in ("patient", "encounter"):
        tables.create_partitioned(lh.table(f"bronze_{resource}"), f"{database}.bronze_{resource}", ["ingestion_date"])
        expected[f"{database}.bronze_{resource}"] = ["ingestion_date"]
    tables.replace_table(lh.table("silver_condition"), f"{database}.silver_condition")
    return checks.partition_layout(lh.spark, expected | {f"{database}.silver_condition": ["ingestion_date"]})


@_query
def schema_evolution_stored(lh: Lakehouse) -> DataFrame:
    """The drifted batch appended to a stored table whose entry is widened in place: the first batch's files stay."""
    name = f"{_database(lh, 'evolve')}.bronze_patient"
    first, second = _drifted(lh)
    tables.create_partitioned(first, name, ["batch_id"])
    file = F.col("_metadata.file_path")
    before = stage(lh.spark.table(name).select(file.alias("file"), F.lit(True).alias("old_file")).distinct(), "files")
    tables.evolve_and_append(bronze.rows_to_insert(lh.spark.table(name), second), name)
    rows = lh.spark.table(name).withColumn("file", file).join(before, "file", "left")
    return rows.select(
        "resource_id",
        "batch_id",
        F.get("resource_data.address.district", F.lit(0)).alias("district"),
        F.col("resource_data.maritalStatus.text").alias("marital_status"),
        "name_count",
        F.coalesce("old_file", F.lit(False)).alias("in_old_file"),
    )


@_query
def stored_views(lh: Lakehouse) -> DataFrame:
    """Rows behind the views a run stores."""
    database = _stored_star(lh)
    create_views(lh.spark, database)
    names = sorted(r["tableName"] for r in tables.list_tables(lh.spark, "vw_", database).collect())
    return checks.census({n: lh.spark.table(f"{database}.{n}") for n in names})


@_query
def stream_bronze_result(lh: Lakehouse) -> DataFrame:
    """The event log ingested as a stream in two increments, the second overlapping the first."""
    spark, root = lh.spark, scratch_path(lh.spark, "raw")
    target, state = scratch_path(spark, "bronze-stream"), scratch_path(spark, "stream-state")
    pulls = lh.table("bronze_event")
    where = landing.resource_root(root, "event")
    entry = F.struct(F.col("full_url").alias("fullUrl"), F.col("resource_data").alias("resource"))
    page_no = F.floor(F.xxhash64("resource_id") % 500).cast("int")
    envelope = F.struct(
        F.date_format("extraction_timestamp", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("extraction_timestamp"),
        "api_url",
        F.col("source_resource_type").alias("resource_type"),
        "batch_id",
        F.col("_page").alias("page_number"),
    )
    schema = None
    for first, last in (("2024-01-01", "2024-01-20"), ("2024-01-15", "2024-01-30")):
        part = pulls.filter(F.col("ingestion_date").between(first, last)).withColumn("_page", page_no)
        pages = (
            part.groupBy("ingestion_date", "batch_id", "api_url", "source_resource_type", "extraction_timestamp", "_page")
            .agg(F.collect_list(entry).alias("entry"))
            .select(
                envelope.alias("_extraction_metadata"),
                F.struct("entry").alias("fhir_bundle"),
                "ingestion_date",
                F.col("batch_id"),
            )
        )
        schema = landing.page_schema(pulls.schema["resource_data"].dataType)
        # a large day goes to several tasks and files, of the adaptive advisory size
        shared_out = dealt(pages, ["ingestion_date"], "_extraction_metadata.page_number")
        shared_out.write.mode("append").partitionBy("ingestion_date", "batch_id").json(where)
        stream_bronze(
            spark,
            root,
            "event",
            target,
            state,
            source_system=fx.SOURCE_SYSTEM,
            api_url=fx.API_URL,
            load_ts=LOADED_AT,
            schema=schema,
        )
    return _event_view(spark.read.schema(pulls.schema).parquet(target))


def _arrive(lh: Lakehouse, source: str, root: str, names: str) -> None:
    """Move landed batch folders whose path below ``source`` matches ``names`` to the same place below ``root``."""
    jvm, conf = lh.spark.sparkContext._jvm, lh.spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(source).getFileSystem(conf)
    for folders in ("*/ingestion_date=*/batch_id=*", "manifests/*/for_date=*/for_batch=*"):
        for status in fs.globStatus(path(f"{source}/{folders}")) or []:
            folder = status.getPath().toString()
            name = folder.split(source, 1)[1] + "/"
            if re.search(names, name):
                fs.mkdirs(path(f"{root}{name}").getParent())
                fs.rename(path(folder), path(f"{root}{name}"))


@_query
def stream_bronze_complete_batches(lh: Lakehouse) -> DataFrame:
    """Two patient batches streamed in three steps: pages of one and the manifest of the other, then the manifest that is
    late, then the pages that are missing.

    Bronze rows by the step that loaded them, what was reported, and what waited after each step.
    """
    spark, landed, root = lh.spark, scratch_path(lh.spark, "landed"), scratch_path(lh.spark, "raw")
    where = {name: scratch_path(spark, name) for name in ("bronze", "state", "reports")}
    for batch in ("A", "B"):
        _land(lh, _patients_of(lh, batch), landed, "patient", f"batch{batch}", batch, 1)
    arrivals = ["ingestion_date=2024-01-01/batch_id=batchA/|for_batch=batchB/", "for_batch=batchA/", "/"]
    waited = []
    for step, names in enumerate(arrivals, 1):
        _arrive(lh, landed, root, names)
        stream_complete_batches(
            *(spark, root, "patient", where["bronze"], where["state"], where["reports"]),
            source_system=fx.SOURCE_SYSTEM,
            api_url=fx.API_URL,
            load_ts=LOADED_AT,
        )
        waiting = waiting_batches(spark, where["state"]).select(F.lit(f"waiting after {step}").alias("entry"), "batch_id", F.lit(1).alias("n"))
        waited.append(stage(waiting, "waiting"))
    bronze_rows = spark.read.schema(lh.table("bronze_patient").schema).parquet(where["bronze"])
    loaded = bronze_rows.groupBy(F.concat(F.lit("loaded "), F.coalesce("resource_id", F.lit("none"))).alias("entry"), "batch_id").agg(F.count("*").alias("n"))
    reported = read_reports(spark, where["reports"]).select(
        F.concat_ws(" ", "status", F.col("files_listed") == F.col("files_found"), "total_records").alias("entry"), "batch_id", F.lit(1).alias("n")
    )
    return reduce(DataFrame.unionAll, [loaded, reported, *waited]).select("entry", "batch_id", F.col("n").cast("bigint").alias("n"))


# --- Silver ---------------------------------------------------------------------------------------------------------


@_query
def silver_patient(lh: Lakehouse) -> DataFrame:
    return lh.derive("silver_patient")


@_query
def silver_patient_stepwise(lh: Lakehouse) -> DataFrame:
    """Silver of the first day refreshed with the second day's partition: the same as reading both at once."""
    stored, day = lh.table("silver_patient_first"), fx.BATCHES["B"][0]
    return silver.refresh_silver(stored, lh.table("bronze_patient"), "patient", day, load_ts=LOADED_AT, max_year=LAST_YEAR)


def _database(lh: Lakehouse, prefix: str) -> str:
    name = f"{prefix}_" + scratch_path(lh.spark, "db").rsplit("-", 1)[1][:12]
    lh.spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(lh.spark, 'db')}'")
    return name


@_query
def silver_patient_bucketed(lh: Lakehouse) -> DataFrame:
    """Silver of the first day in key buckets, then the second day taken into the buckets it touches."""
    spark, name, day = lh.spark, f"{_database(lh, 'silver')}.silver_patient", fx.BATCHES["B"][0]
    refresh.store_silver(lh.table("silver_patient_first"), name, "patient_id", 8)
    delta = stage(silver.prepared(lh.table("bronze_patient"), "patient", day, LOADED_AT, max_year=LAST_YEAR), "delta")
    refresh.merge_buckets(spark, name, "patient_id", delta, refresh.touched_buckets(delta, "patient_id", 8))
    return refresh.read_silver(spark, name)


@_query
def fact_encounter_refreshed(lh: Lakehouse) -> DataFrame:
    """The encounter fact of a Silver table that lacks some encounters of 2021 and has others on a wrong day, refreshed by
    the months that taking the right rows in changes."""
    spark, database = lh.spark, _database(lh, "fact")
    name, fact = f"{database}.silver_encounter", f"{database}.fact_encounter"
    rows, people = lh.table("silver_encounter"), lh.table("gold_dim_patient")
    digit = F.when(F.year("period_start") == 2021, F.substring("encounter_id", -1, 1))
    wrong = rows.withColumns(
        {
            "period_start": F.when(digit == "4", F.date_add("period_start", 40)).otherwise(F.col("period_start")),
            "record_hash": F.when(digit == "4", F.lit("before")).otherwise(F.col("record_hash")),
            "extraction_timestamp": F.col("extraction_timestamp") - F.expr("INTERVAL 1 DAY"),
        }
    )
    refresh.store_silver(wrong.filter(F.coalesce(digit, F.lit("")) != "3"), name, "encounter_id", 8)
    refresh.store_fact(gold.fact_encounter(refresh.read_silver(spark, name), people), fact, "start_date_key", "encounter_id")
    delta = stage(rows.filter(digit.isin("3", "4")), "delta")
    touched = refresh.touched_buckets(delta, "encounter_id", 8)
    months = refresh.changed_months(spark, name, "encounter_id", delta, "period_start", touched)
    refresh.merge_buckets(spark, name, "encounter_id", delta, touched)
    merged = refresh.read_silver(spark, name)
    if months:
        refresh.refresh_fact(gold.fact_encounter(merged.filter(refresh.in_months("period_start", months)), people), merged, fact, months)
    old = F.expr("extraction_timestamp < TIMESTAMP '2024-01-01 06:00:00'")
    expected_old = merged.filter(old).select("encounter_id")  # rows the delta did not bring
    kept = refresh.read_fact(spark, fact)
    return kept.join(expected_old.withColumn("from_first_load", F.lit(True)), "encounter_id", "left").fillna({"from_first_load": False})


@_query
def silver_encounter(lh: Lakehouse) -> DataFrame:
    return lh.derive("silver_encounter")


@_query
def silver_observation(lh: Lakehouse) -> DataFrame:
    return lh.derive("silver_observation")


@_query
def silver_condition(lh: Lakehouse) -> DataFrame:
    return lh.derive("silver_condition")


def _flat(lh: Lakehouse, resource: str) -> DataFrame:
    return silver.flatten(lh.table(f"bronze_{resource}"), resource)


def _per_resource(lh: Lakehouse, build: Callable[[str], DataFrame]) -> DataFrame:
    parts = [build(r).select(F.lit(r).alias("resource_type"), "*") for r in silver.RESOURCES]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionAll(part)
    return out


@_query
def silver_quarantine_metrics(lh: Lakehouse) -> DataFrame:
    return _per_resource(lh, lambda r: silver.quarantine_metrics(_flat(lh, r), silver.primary_key(r)))


@_query
def quarantine_backfill(lh: Lakehouse) -> DataFrame:
    """Two source days rejected on one run date stay apart, and a rerun of one does not double it."""
    root, rows = scratch_path(lh.spark, "quarantine"), lh.table("bronze_patient").drop("resource_data")
    for batch in ("A", "B", "A"):
        rejected = rows.filter((F.col("ingestion_date") == fx.BATCHES[batch][0]) & F.col("resource_id").isNull())
        tables.write_quarantine(rejected, root, "patient", str(AS_OF))
    back = lh.spark.read.schema("batch_id string, source_date string").json(f"{root}/patient")
    return back.groupBy("batch_id", "source_date").agg(F.count("*").alias("rejected_rows"))


@_query
def bronze_unknown_fields(lh: Lakehouse) -> DataFrame:
    """Landed fields that no schema declares are in the JSON text of Bronze."""
    root, day = scratch_path(lh.spark, "raw"), fx.BATCHES["A"][0]
    number = F.concat(F.lit("T-"), F.col("resource.id"))
    more = F.col("resource").withField("telecom", F.array(F.struct(F.lit("phone").alias("system"), number.alias("value"))))
    _land(lh, _patients_of(lh, "A").select(more.withField("deceasedBoolean", F.lit(False)).alias("resource")), root, "patient", "batchA")
    pages = landing.read_pages(lh.spark, root, "patient", ingestion_date=day, raw=True)
    rows = bronze.bronze_rows(
        bronze.explode_pages(pages),
        source_system=fx.SOURCE_SYSTEM,
        api_url=fx.API_URL,
        ingestion_date=day,
        schema=resource_schema("patient"),
    )
    return rows.select(
        "resource_id",
        F.get_json_object("resource_json", "$.telecom[0].value").alias("telecom"),
        F.get_json_object("resource_json", "$.deceasedBoolean").alias("deceased"),
    )


@_query
def silver_quarantine_sink(lh: Lakehouse) -> DataFrame:
    """Rejected patients written twice for the same day and read back: the rerun does not double them."""
    root = scratch_path(lh.spark, "quarantine")
    _, rejected = silver.split_quarantine(_flat(lh, "patient"), "patient_id")
    for _ in range(2):
        tables.write_quarantine(rejected, root, "patient", str(AS_OF))
    back = lh.spark.read.schema(rejected.schema).json(f"{root}/patient")
    return back.select(
        "patient_id", "family_name", "birth_date", "batch_id", F.col("ingestion_date").cast("string").alias("ingestion_date")
    )


@_query
def silver_bad_dates(lh: Lakehouse) -> DataFrame:
    def counts(resource: str) -> DataFrame:
        keyed, _ = silver.split_quarantine(_flat(lh, resource), silver.primary_key(resource))
        return silver.bad_date_counts(keyed, max_year=LAST_YEAR)

    return _per_resource(lh, counts)


@_query
def silver_dedup_latest(lh: Lakehouse) -> DataFrame:
    lines = lh.spark.read.parquet(f"{lh.sf_dir}/lineitem.parquet")
    ties = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    order = [F.desc("l_shipdate"), *[F.asc(c) for c in ties]]
    return silver.dedup_latest(lines, ["l_orderkey", "l_linenumber"], order)


@_query
def silver_dedup_counts(lh: Lakehouse) -> DataFrame:
    """Keyed rows before and after newest-wins dedup, and how many it removes."""

    def counts(resource: str) -> DataFrame:
        pk = silver.primary_key(resource)
        keyed, _ = silver.split_quarantine(_flat(lh, resource), pk)
        n = keyed.agg(F.count(F.lit(1)).alias("rows_before"), F.count_distinct(pk).alias("rows_after"))
        return n.withColumn("duplicates_removed", F.col("rows_before") - F.col("rows_after"))

    return _per_resource(lh, counts)


# --- slowly changing dimensions -------------------------------------------------------------------------------------


@_query
def scd2_initial(lh: Lakehouse) -> DataFrame:
    return lh.derive("dim_patient_first")


@_query
def scd2_classify(lh: Lakehouse) -> DataFrame:
    found = scd2.classify(lh.table("dim_patient_first"), lh.table("silver_patient"), "patient_id")
    return found.select("patient_id", "record_hash", "change")


@_query
def scd2_change_counts(lh: Lakehouse) -> DataFrame:
    found = scd2.classify(lh.table("dim_patient_first"), lh.table("silver_patient"), "patient_id")
    return scd2.change_counts(found)


@_query
def scd2_apply(lh: Lakehouse) -> DataFrame:
    return lh.derive("dim_patient")


@_query
def scd2_rerun(lh: Lakehouse) -> DataFrame:
    """The dimension after the same source is merged once more: identical to before."""
    return scd2.apply_changes(lh.table("dim_patient"), lh.table("silver_patient"), "patient_id", SECOND_LOAD)


@_query
def scd2_invariants(lh: Lakehouse) -> DataFrame:
    patients = scd2.invariants(lh.table("dim_patient"), "patient_id").select(F.lit("dim_patient").alias("tbl"), "*")
    conditions = scd2.invariants(lh.table("dim_condition"), "condition_id").select(F.lit("dim_condition"), "*")
    return patients.unionAll(conditions)


@_query
def scd2_version_histogram(lh: Lakehouse) -> DataFrame:
    return scd2.version_histogram(lh.table("dim_patient"), "patient_id")


@_query
def scd2_current_split(lh: Lakehouse) -> DataFrame:
    patients = scd2.current_split(lh.table("dim_patient")).select(F.lit("dim_patient").alias("tbl"), "*")
    return patients.unionAll(scd2.current_split(lh.table("dim_condition")).select(F.lit("dim_condition"), "*"))


_HISTORY = ["city", "state", "record_hash", scd2.START, scd2.END, scd2.CURRENT]


@_query
def scd2_history(lh: Lakehouse) -> DataFrame:
    return scd2.history(lh.table("dim_patient"), "patient_id").select("patient_id", *_HISTORY)


@_query
def scd2_one_changed_key(lh: Lakehouse) -> DataFrame:
    return scd2.one_changed_key(lh.table("dim_patient"), "patient_id").select("patient_id", *_HISTORY)


# --- Gold -----------------------------------------------------------------------------------------------------------


@_query
def dim_date(lh: Lakehouse) -> DataFrame:
    """The calendar with the encounters that start on each day."""
    counted = lh.table("fact_encounter").groupBy(F.col("start_date_key").alias("date_key")).agg(
        F.count(F.lit(1)).alias("encounters_started")
    )
    return lh.derive("dim_date").join(counted, "date_key", "left")


@_query
def gold_dim_patient(lh: Lakehouse) -> DataFrame:
    return lh.derive("gold_dim_patient")


@_query
def gold_dim_condition(lh: Lakehouse) -> DataFrame:
    return lh.derive("gold_dim_condition")


@_query
def fact_encounter(lh: Lakehouse) -> DataFrame:
    return lh.derive("fact_encounter")


@_query
def fact_observation(lh: Lakehouse) -> DataFrame:
    return lh.derive("fact_observation")


@_query
def vw_fact_encounter(lh: Lakehouse) -> DataFrame:
    return lh.derive("vw_fact_encounter")


@_query
def vw_fact_observation(lh: Lakehouse) -> DataFrame:
    return lh.derive("vw_fact_observation")


@_query
def vw_condition_distribution(lh: Lakehouse) -> DataFrame:
    return lh.derive("vw_condition_distribution")


# --- checks ---------------------------------------------------------------------------------------------------------


@_query
def check_orphans(lh: Lakehouse) -> DataFrame:
    people = lh.table("silver_patient")
    dim = lh.table("dim_patient").select("patient_id")
    parts = {
        "silver_encounter": checks.orphans(lh.table("silver_encounter"), people, "patient_id"),
        "silver_observation": checks.orphans(lh.table("silver_observation"), people, "patient_id"),
        "dim_condition": checks.orphans(lh.table("dim_condition"), dim, "patient_id", "scd_current_flag"),
    }
    out = None
    for name, df in parts.items():
        row = df.select(F.lit(name).alias("tbl"), "orphans")
        out = row if out is None else out.unionAll(row)
    return out


@_query
def check_unmatched_facts(lh: Lakehouse) -> DataFrame:
    encounters = checks.unmatched(lh.table("fact_encounter")).select(F.lit("fact_encounter").alias("tbl"), "*")
    return encounters.unionAll(
        checks.unmatched(lh.table("fact_observation")).select(F.lit("fact_observation"), "*")
    )


@_query
def check_duplicate_keys(lh: Lakehouse) -> DataFrame:
    """Keys held twice: Silver primary keys and Gold surrogate keys, as (tbl, duplicate_keys)."""
    keys = {f"silver_{r}": silver.primary_key(r) for r in silver.RESOURCES}
    keys |= {"gold_dim_patient": "patient_sk", "gold_dim_condition": "condition_sk"}
    out = None
    for name, key in keys.items():
        found = checks.duplicate_keys(lh.table(name), [key]).agg(F.count(F.lit(1)).alias("duplicate_keys"))
        row = found.select(F.lit(name).alias("tbl"), "duplicate_keys")
        out = row if out is None else out.unionAll(row)
    return out


@_query
def check_row_census(lh: Lakehouse) -> DataFrame:
    names = [f"{layer}_{r}" for layer in ("bronze", "silver") for r in silver.RESOURCES]
    names += ["dim_date", "gold_dim_patient", "gold_dim_condition", "fact_encounter", "fact_observation"]
    return checks.census({n: lh.table(n) for n in names})


@_query
def check_bronze_silver_totals(lh: Lakehouse) -> DataFrame:
    return checks.bronze_silver_totals(lh.table("bronze_patient"), lh.table("silver_patient"))


@_query
def check_layer_totals(lh: Lakehouse) -> DataFrame:
    return checks.layer_totals(*[lh.table(t) for t in ("bronze_patient", "silver_patient", "dim_patient")])


@_query
def check_current_totals(lh: Lakehouse) -> DataFrame:
    return checks.current_totals({"patients": lh.table("dim_patient"), "conditions": lh.table("dim_condition")})


# --- measures -------------------------------------------------------------------------------------------------------

_CLASS, _STATUS = f"{ENCOUNTER}.encounter_class", f"{ENCOUNTER}.status"


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@_query
def measures_encounter(lh: Lakehouse) -> DataFrame:
    """Encounter measures by class; those with a class filter of their own repeat one value."""
    names = ["total_patients", "total_encounters", "encounters_finished", "encounters_cancelled"]
    names += ["encounters_in_progress", "encounters_arrived", "avg_los_days", "avg_los_all_classes"]
    names += ["max_los_days", "total_los_days", "encounters_per_patient"]
    out = evaluate(star_of(lh), names, [_CLASS])
    return _rounded(out, "avg_los_days", "avg_los_all_classes", "encounters_per_patient")


@_query
def measures_by_status(lh: Lakehouse) -> DataFrame:
    """A measure's status filter replaces the status it is grouped by."""
    return evaluate(star_of(lh), ["total_encounters", "encounters_finished", "encounters_arrived"], [_STATUS])


@_query
def measures_observation(lh: Lakehouse) -> DataFrame:
    names = ["total_observations", "numeric_observations", "avg_observation_value"]
    out = evaluate(star_of(lh), names, [f"{OBSERVATION}.observation_code_text"])
    return _rounded(out, "avg_observation_value")


@_query
def measures_per_patient(lh: Lakehouse) -> DataFrame:
    """Measures that cross two facts, by patient gender."""
    names = ["total_patients", "total_encounters", "total_observations", "observations_per_patient"]
    out = evaluate(star_of(lh), [*names, "encounters_per_patient"], [f"{PATIENT}.gender"])
    return _rounded(out, "observations_per_patient", "encounters_per_patient")


@_query
def measures_condition(lh: Lakehouse) -> DataFrame:
    names = ["total_conditions", "active_conditions", "patients_with_condition", "condition_resolution_rate"]
    out = evaluate(star_of(lh), names, [f"{CONDITION}.condition_text"])
    return _rounded(out, "condition_resolution_rate")


@_query
def measures_overall(lh: Lakehouse) -> DataFrame:
    """One row over all facts."""
    names = ["total_patients", "total_encounters", "total_observations", "total_conditions", "active_conditions"]
    names += ["avg_los_days", "numeric_observations", "patients_with_condition", "condition_resolution_rate"]
    out = evaluate(star_of(lh), names)
    return _rounded(out, "avg_los_days", "condition_resolution_rate")


@_query
def encounter_status_share(lh: Lakehouse) -> DataFrame:
    out = evaluate(star_of(lh), ["total_encounters", "encounter_status_pct"], [_CLASS, _STATUS])
    return _rounded(out, "encounter_status_pct")


@_query
def encounters_mtd_ytd(lh: Lakehouse) -> DataFrame:
    return periods.encounters_to_date(star_of(lh))


@_query
def encounters_mtd_ytd_by_class(lh: Lakehouse) -> DataFrame:
    return periods.encounters_to_date(star_of(lh), [_CLASS])


@_query
def encounters_mom(lh: Lakehouse) -> DataFrame:
    return _rounded(periods.encounters_by_month(star_of(lh)), "encounters_mom_pct")


@_query
def patients_mom(lh: Lakehouse) -> DataFrame:
    return _rounded(periods.patients_by_month(star_of(lh)), "patients_mom_pct")


@_query
def patients_mom_by_state(lh: Lakehouse) -> DataFrame:
    return _rounded(periods.patients_by_month(star_of(lh), [f"{PATIENT}.state"]), "patients_mom_pct")


def _stored_days(lh: Lakehouse, group_by: list[str] | None = None) -> DataFrame:
    """The state by day, first built while March 2023 was missing and had other rows in it, then refreshed for that month."""
    star, name = star_of(lh), f"{_database(lh, 'days')}.encounter_days"
    key = F.col("start_date_key")
    early = star.encounters.filter(~key.between(20230310, 20230399) | key.isNull() | (key % 2 == 0))
    day_state.store_days(star.with_encounters(early), name, group_by)
    day_state.refresh_days(star, name, [202303], group_by)
    return day_state.read_days(lh.spark, name)


@_query
def patients_mom_from_days(lh: Lakehouse) -> DataFrame:
    return _rounded(day_state.patients_by_month(star_of(lh), _stored_days(lh)), "patients_mom_pct")


@_query
def patients_mom_by_state_from_days(lh: Lakehouse) -> DataFrame:
    by = [f"{PATIENT}.state"]
    return _rounded(day_state.patients_by_month(star_of(lh), _stored_days(lh, by), by), "patients_mom_pct")


@_query
def encounters_mtd_ytd_by_class_from_days(lh: Lakehouse) -> DataFrame:
    return day_state.encounters_to_date(star_of(lh), _stored_days(lh, [_CLASS]), [_CLASS])


@_query
def totals_from_days(lh: Lakehouse) -> DataFrame:
    """Encounters and distinct patients by class, merged from all days."""
    return day_state.totals(_stored_days(lh, [_CLASS]), [_CLASS])


@_query
def los_by_discharge(lh: Lakehouse) -> DataFrame:
    out = evaluate(star_of(lh), ["avg_los_by_discharge_date"], [f"{DATE}.year", f"{DATE}.month"])
    return _rounded(out, "avg_los_by_discharge_date")


@_query
def context_labels(lh: Lakehouse) -> DataFrame:
    """Title and period texts with no slicer, with one class, and with one quarter of one year."""
    contexts = {"none": {}, "class": {_CLASS: ["IMP"]}, "quarter": {f"{DATE}.year": [2024], f"{DATE}.quarter": [1]}}
    out = None
    for name, slicers in contexts.items():
        row = periods.context_labels(star_of(lh), slicers).select(F.lit(name).alias("context"), "*")
        out = row if out is None else out.unionAll(row)
    return out


# --- dashboard ------------------------------------------------------------------------------------------------------


def _register_datasets() -> None:
    for name, build in dashboard.DATASETS.items():

        def fn(spark: SparkSession, sf_dir: str, build=build, name=name) -> DataFrame:
            out = build(star_of(open_lakehouse(spark, sf_dir)))
            return _rounded(out, "avg_los_days") if name == "cards" else out

        _QUERIES[f"dash_{name}"] = fn


_register_datasets()


@_query
def dash_slicer_lists(lh: Lakehouse) -> DataFrame:
    return dashboard.slicer_lists(star_of(lh))


@_query
def dash_date_hierarchy(lh: Lakehouse) -> DataFrame:
    return dashboard.date_hierarchy(star_of(lh))


@_query
def dash_slicer_lists_sliced(lh: Lakehouse) -> DataFrame:
    """Each list under the other slicers of the page and the year."""
    return dashboard.slicer_lists(star_of(lh), _PAGE_SLICERS)


@_query
def dash_date_hierarchy_sliced(lh: Lakehouse) -> DataFrame:
    return dashboard.date_hierarchy(star_of(lh), _PAGE_SLICERS)


_PAGE_SLICERS = {f"{PATIENT}.gender": ["MALE", "FEMALE"], _CLASS: ["IMP", "EMER"], f"{DATE}.year": [2023, 2024]}


@_query
def dash_sliced(lh: Lakehouse) -> DataFrame:
    return dashboard.status_table(star_of(lh), _PAGE_SLICERS)


@_query
def dash_sliced_cards(lh: Lakehouse) -> DataFrame:
    """Class and year slicers do not reach conditions, gender does."""
    return _rounded(dashboard.cards(star_of(lh), _PAGE_SLICERS), "avg_los_days")


@_query
def dash_sliced_codes(lh: Lakehouse) -> DataFrame:
    return dashboard.encounters_by_month_code(star_of(lh), _PAGE_SLICERS)


@_query
def dash_sliced_case(lh: Lakehouse) -> DataFrame:
    """The same slicers in another case select the same rows."""
    lower = {k: [v.lower() if isinstance(v, str) else v for v in values] for k, values in _PAGE_SLICERS.items()}
    return dashboard.status_table(star_of(lh), lower)


@_query
def measures_period_sliced(lh: Lakehouse) -> DataFrame:
    """Period comparisons beside a plain measure, by class and month of one year; January sees the December before."""
    names = ["total_encounters", "encounters_mtd", "encounters_prior_month", "encounters_mom_pct"]
    by = [f"{DATE}.year", f"{DATE}.month", _CLASS]
    return _rounded(evaluate(star_of(lh), names, by, {f"{DATE}.year": [2024], _CLASS: ["imp"]}), "encounters_mom_pct")


# --- the whole run --------------------------------------------------------------------------------------------------


@_query
def run_two_days(lh: Lakehouse) -> DataFrame:
    """The config-driven run on two landed days; rows per table afterwards, and what the run log says."""
    spark, root = lh.spark, scratch_path(lh.spark, "raw")
    database = "run_" + root.rsplit("-", 1)[1][:12]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'db')}'")
    others = {
        "encounter": fx.encounters(spark, lh.sf_dir),
        "observation": fx.observations(spark, lh.sf_dir),
        "condition": fx.conditions(spark, lh.sf_dir),
    }
    for batch in ("A", "B"):
        _land(lh, _patients_of(lh, batch), root, "patient", f"batch{batch}", batch)
        for kind, resources in others.items():
            if batch == "A":
                _land(lh, resources.select("resource"), root, kind, f"{kind}A", compression="gzip")
        day = fx.BATCHES[batch][0]
        cfg = RunConfig(
            raw_root=root,
            quarantine_root=scratch_path(spark, "quarantine"),
            as_of=date.fromisoformat(day),
            source_system=fx.SOURCE_SYSTEM,
            api_url=fx.API_URL,
            run_id=f"run{batch}",
            max_year=LAST_YEAR,
            database=database,
        )
        run(spark, cfg)
    names = [f"{layer}_patient" for layer in ("bronze", "silver", "dim")]
    names += ["silver_observation", "gold_dim_patient", "gold_dim_condition", "fact_encounter", "fact_observation"]
    counted = checks.census({n: spark.table(f"{database}.{n}") for n in names})
    log = spark.table(f"{database}.meta_pipeline_execution_log").filter("activity_name = 'FULL_PIPELINE'").select(
        F.concat_ws(":", F.lit("log"), "run_id", "status").alias("tbl"), F.lit(1).cast("bigint").alias("cnt")
    )
    return counted.unionAll(log)


@_query
def run_log_and_events(lh: Lakehouse) -> DataFrame:
    """Two days of a run whose stored settings switch all but patients off: its log by stage, and drift found in the data.

    The second day's patients carry fields that no schema declares and the first day did not have.
    """
    spark, root = lh.spark, scratch_path(lh.spark, "raw")
    database = "log_" + root.rsplit("-", 1)[1][:12]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_path(spark, 'db')}'")
    settings = tables.resource_config(spark).withColumn("active_flag", F.col("resource_type") == "Patient")
    tables.replace_table(settings, f"{database}.meta_resource_config")
    for batch in ("A", "B"):
        resource = F.col("resource")
        if batch == "B":
            phone = F.array(F.struct(F.lit("phone").alias("system")))
            resource = resource.withField("deceasedBoolean", F.lit(False)).withField("telecom", phone)
        _land(lh, _patients_of(lh, batch).select(resource.alias("resource")), root, "patient", f"batch{batch}", batch)
        cfg = RunConfig(
            raw_root=root,
            quarantine_root=scratch_path(spark, "quarantine"),
            as_of=date.fromisoformat(fx.BATCHES[batch][0]),
            source_system=fx.SOURCE_SYSTEM,
            api_url=fx.API_URL,
            run_id=f"run{batch}",
            max_year=LAST_YEAR,
            database=database,
        )
        run(spark, cfg)
    log = spark.table(f"{database}.meta_pipeline_execution_log").filter(
        "activity_name <> 'FULL_PIPELINE' AND start_time <= end_time AND duration_seconds >= 0"
    )
    steps = log.select(
        F.concat_ws(":", "run_id", "resource_type", "stage", "status").alias("entry"), F.col("records_processed").alias("cnt")
    )
    events = spark.table(f"{database}.meta_event_log").filter("message = 'SCHEMA_DRIFT_NEW_COLUMNS'")
    drift = events.select(F.concat_ws(":", "message", F.col("context.new_columns")).alias("entry"), F.lit(1).cast("bigint").alias("cnt"))
    return steps.unionAll(drift)


@_query
def lifecycle_events(lh: Lakehouse) -> DataFrame:
    """Events of two days of patients, the second of which finds a column of another type in the stored table."""
    spark, root, database = lh.spark, scratch_path(lh.spark, "raw"), _database(lh, "events")
    settings = tables.resource_config(spark).withColumn("active_flag", F.col("resource_type") == "Patient")
    tables.replace_table(settings, f"{database}.meta_resource_config")
    for batch in ("A", "B"):
        _land(lh, _patients_of(lh, batch), root, "patient", f"batch{batch}", batch)
        if batch == "B":
            changed = spark.table(f"{database}.bronze_patient").withColumn("full_url", F.length("full_url"))
            tables.replace_table(changed, f"{database}.bronze_patient", ["ingestion_date"])
        cfg = RunConfig(
            raw_root=root,
            quarantine_root=scratch_path(spark, "quarantine"),
            as_of=date.fromisoformat(fx.BATCHES[batch][0]),
            source_system=fx.SOURCE_SYSTEM,
            api_url=fx.API_URL,
            run_id=f"run{batch}",
            max_year=LAST_YEAR,
            database=database,
        )
        run(spark, cfg)
    wanted = F.col("message").isin("TABLE_CREATED", "SCHEMA_DRIFT_MERGE_FAILED")
    detail = F.coalesce(F.col("context.column_count"), F.col("context.error"))
    events = spark.table(f"{database}.meta_event_log").filter(wanted).select(
        F.concat_ws(":", "level", "message", "context.resource_type", detail).alias("entry"), F.lit(1).cast("bigint").alias("cnt")
    )
    stored = spark.table(f"{database}.bronze_patient").agg(F.count(F.lit(1)).alias("cnt"))
    return events.unionAll(stored.select(F.lit("bronze_patient").alias("entry"), "cnt"))
