"""Bronze to Silver: flatten, quarantine, date and text cleaning, newest-wins dedup, record hash."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from carestrata.functions.calendar import day_or_null, implausible
from carestrata.functions.text import business_hash, reference_id, structural_hash

# The lineage columns Silver keeps, and those the record hash leaves out.
LINEAGE = ["batch_id", "extraction_timestamp", "load_timestamp", "source_system", "ingestion_date"]
UNHASHED = ["batch_id", "extraction_timestamp", "load_timestamp", "ingestion_date"]


def _at(*steps: str | int) -> Column:
    """Value below ``resource_data``; an int step takes an array element and gives null past its end."""

    def take(value: Column, step: str | int) -> Column:
        return F.get(value, F.lit(step)) if isinstance(step, int) else value.getField(step)

    return reduce(take, steps, F.col("resource_data"))


def _patient() -> dict[str, Column]:
    home, called = ("address", 0), ("name", 0)
    return {
        "gender": _at("gender"),
        "birth_date": day_or_null(_at("birthDate")),
        "family_name": _at(*called, "family"),
        "given_name": _at(*called, "given", 0),
        "city": _at(*home, "city"),
        "state": _at(*home, "state"),
        "postal_code": _at(*home, "postalCode"),
        "country": _at(*home, "country"),
        "marital_status": _at("maritalStatus", "text"),
        "active_flag": F.coalesce(_at("active"), F.lit(True)),
    }


def _encounter() -> dict[str, Column]:
    return {
        "status": _at("status"),
        "encounter_class": _at("class", "code"),
        "encounter_type": _at("type", 0, "text"),
        "patient_id": reference_id(_at("subject", "reference"), "Patient"),
        "period_start": day_or_null(_at("period", "start")),
        "period_end": day_or_null(_at("period", "end")),
        "service_provider": _at("serviceProvider", "display"),
    }


def _observation() -> dict[str, Column]:
    coding = ("code", "coding", 0)
    return {
        "status": _at("status"),
        "observation_code_text": _at("code", "text"),
        "observation_code": _at(*coding, "code"),
        "coding_system": _at(*coding, "system"),
        "patient_id": reference_id(_at("subject", "reference"), "Patient"),
        "encounter_id": reference_id(_at("encounter", "reference"), "Encounter"),
        "value_numeric": _at("valueQuantity", "value"),
        "value_unit": _at("valueQuantity", "unit"),
        "value_string": _at("valueString"),
        "effective_date": day_or_null(_at("effectiveDateTime")),
    }


def _condition() -> dict[str, Column]:
    return {
        "clinical_status": _at("clinicalStatus", "coding", 0, "code"),
        "verification_status": _at("verificationStatus", "coding", 0, "code"),
        "condition_text": _at("code", "text"),
        "condition_code": _at("code", "coding", 0, "code"),
        "patient_id": reference_id(_at("subject", "reference"), "Patient"),
        "encounter_id": reference_id(_at("encounter", "reference"), "Encounter"),
        "onset_date": day_or_null(_at("onsetDateTime")),
        "recorded_date": day_or_null(_at("recordedDate")),
    }


_BUSINESS = {
    "patient": _patient,
    "encounter": _encounter,
    "observation": _observation,
    "condition": _condition,
}
RESOURCES = list(_BUSINESS)


def primary_key(resource: str) -> str:
    return f"{resource.lower()}_id"


def flatten(bronze: DataFrame, resource: str, ingestion_date: str | list[str] | None = None) -> DataFrame:
    """One flat row per Bronze row; ``ingestion_date`` reads only the partitions of that day or those days."""
    if isinstance(ingestion_date, str):
        bronze = bronze.filter(F.col("ingestion_date") == ingestion_date)
    elif ingestion_date is not None:
        bronze = bronze.filter(F.col("ingestion_date").isin(ingestion_date))
    business = _BUSINESS[resource.lower()]()
    return bronze.select(
        F.col("resource_id").alias(primary_key(resource)),
        *[value.alias(name) for name, value in business.items()],
        *LINEAGE,
    )


def split_quarantine(flat: DataFrame, pk: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a key, rows without)."""
    return flat.filter(F.col(pk).isNotNull()), flat.filter(F.col(pk).isNull())


def quarantine_metrics(flat: DataFrame, pk: str) -> DataFrame:
    """Total rows, rows without a key and their percentage, in one pass."""
    counted = flat.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(pk).isNull()).alias("null_primary_key_count"),
    )
    share = F.round(F.col("null_primary_key_count") / F.nullif(F.col("total_rows"), F.lit(0)) * 100, 2)
    return counted.withColumn("null_pk_pct", F.coalesce(share, F.lit(0.0)))


def date_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]


def bad_date_counts(df: DataFrame, min_year: int = 1900, max_year: int | None = None) -> DataFrame:
    """Implausible values per date column, all columns in one pass."""
    names = date_columns(df)
    counted = df.agg(*[F.count_if(implausible(F.col(c), min_year, max_year)).alias(c) for c in names])
    return counted.unpivot([], names, "column_name", "bad_row_count")


def quality_metrics(flat: DataFrame, pk: str, min_year: int = 1900, max_year: int | None = None) -> DataFrame:
    """Key counts and per-column bad dates of keyed rows together, so a run scans the flat rows once.

    One row: total_rows, null_primary_key_count, and ``bad_<column>`` for each date column.
    """
    return flat.agg(*_quality_counts(flat, pk, min_year, max_year))


def _quality_counts(flat: DataFrame, pk: str, min_year: int, max_year: int | None) -> list[Column]:
    keyed = F.col(pk).isNotNull()
    bad = {c: F.count_if(keyed & implausible(F.col(c), min_year, max_year)) for c in date_columns(flat)}
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(~keyed).alias("null_primary_key_count"),
        *[count.alias(f"bad_{c}") for c, count in bad.items()],
    ]


def clean(df: DataFrame, min_year: int = 1900, max_year: int | None = None) -> DataFrame:
    """Null implausible dates, trim text, upper-case status columns and gender, all in one projection."""

    def tidy(field: T.StructField) -> Column:
        value = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            value = F.when(~implausible(value, min_year, max_year), value)
        elif isinstance(field.dataType, T.StringType):
            value = F.trim(value)
            if "status" in field.name.lower() or field.name == "gender":
                value = F.upper(value)
        return value.alias(field.name)

    return df.select(*[tidy(f) for f in df.schema.fields])


def hashed_columns(columns: list[str]) -> list[str]:
    return [c for c in columns if c not in UNHASHED]


def with_record_hash(df: DataFrame, structural: bool = False) -> DataFrame:
    """Hash of the business columns; the structural form is safe against separator collisions."""
    make = structural_hash if structural else business_hash
    return df.withColumn("record_hash", make(hashed_columns(df.columns)))


def dedup_latest(df: DataFrame, pk: str | list[str], newest_first: list[Column]) -> DataFrame:
    """The first row per key in the given order.

    Spark keeps one row per key in each map task before the shuffle (group-limit), so a key holding most of the rows
    never gathers them in one task.
    """
    keys = [pk] if isinstance(pk, str) else pk
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first)))
    return ranked.filter("_rank = 1").drop("_rank")


def newest(df: DataFrame, pk: str) -> DataFrame:
    """Newest extraction per key; equal times fall back to batch id and record hash, so reruns agree."""
    order = [F.desc("extraction_timestamp"), F.desc("batch_id"), F.desc("record_hash")]
    return dedup_latest(df, pk, order)


def _cleaned(
    bronze: DataFrame,
    resource: str,
    ingestion_date: str | list[str] | None,
    min_year: int,
    max_year: int | None,
    observation: Observation | None,
) -> DataFrame:
    """Keyed and cleaned rows, not yet hashed."""
    flat, pk = flatten(bronze, resource, ingestion_date), primary_key(resource)
    if observation is not None:
        flat = flat.observe(observation, *_quality_counts(flat, pk, min_year, max_year))
    keyed, _ = split_quarantine(flat, pk)
    return clean(keyed, min_year, max_year)


def _stamped(cleaned: DataFrame, load_ts: datetime | None, structural: bool) -> DataFrame:
    """Cleaned rows with the load time and the record hash."""
    hashed = with_record_hash(cleaned, structural)
    loaded = F.current_timestamp() if load_ts is None else F.lit(load_ts)
    return hashed.select(*cleaned.columns, loaded.cast("timestamp").alias("silver_load_timestamp"), "record_hash")


def prepared(
    bronze: DataFrame,
    resource: str,
    ingestion_date: str | list[str] | None = None,
    load_ts: datetime | None = None,
    min_year: int = 1900,
    max_year: int | None = None,
    structural: bool = False,
    observation: Observation | None = None,
) -> DataFrame:
    """Keyed, cleaned and hashed rows before dedup.

    ``observation`` receives what :func:`quality_metrics` counts while the rows are written, so that no pass over Bronze
    is needed for it.
    """
    return _stamped(_cleaned(bronze, resource, ingestion_date, min_year, max_year, observation), load_ts, structural)


def to_silver(
    bronze: DataFrame,
    resource: str,
    *,
    ingestion_date: str | None = None,
    load_ts: datetime | None = None,
    min_year: int = 1900,
    max_year: int | None = None,
    structural: bool = False,
    observation: Observation | None = None,
) -> DataFrame:
    """The whole Silver transform as one plan with a single shuffle.

    Equal as :func:`newest` over :func:`prepared`, but rows are sorted and shuffled with the leading 60 bits of the hash
    only, which settle equal times and batches; the row that is kept gets its whole hash, and the load time, afterwards.
    Hexadecimal text does not compress and was the widest column.
    """
    pk = primary_key(resource)
    cleaned = _cleaned(bronze, resource, ingestion_date, min_year, max_year, observation)
    lead = F.conv(F.substring("record_hash", 1, 15), 16, 10).cast("bigint")
    rows = with_record_hash(cleaned, structural).select(*cleaned.columns, lead.alias("_lead"))
    order = [F.desc("extraction_timestamp"), F.desc("batch_id"), F.desc("_lead")]
    return _stamped(dedup_latest(rows, pk, order).select(*cleaned.columns), load_ts, structural)


def refresh_silver(
    existing: DataFrame,
    bronze: DataFrame,
    resource: str,
    ingestion_date: str | list[str],
    *,
    load_ts: datetime | None = None,
    min_year: int = 1900,
    max_year: int | None = None,
    structural: bool = False,
) -> DataFrame:
    """Silver after one more day (or several), from the stored Silver and those days' Bronze partitions only.

    Newest-wins can be taken in steps, so this equals the transform over all of Bronze as long as Bronze only grows
    and the rules stay the same; the cost follows the number of ids and not the length of the history.
    """
    rows = prepared(bronze, resource, ingestion_date, load_ts, min_year, max_year, structural)
    return newest(existing.unionByName(rows), primary_key(resource))
