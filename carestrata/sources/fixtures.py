"""Clinical resources derived from the commerce tables (rules in FIXTURES.md).

Customers become patients, orders encounters, line items observations, returned line items conditions, and the event
table the raw log of overlapping daily pulls. Everything is a pure function of the input rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

API_URL = "https://clinic.example/r4"
SOURCE_SYSTEM = "CLINIC_R4"
SHIFT_DAYS = 9131
BATCHES = {
    "A": ("2024-01-01", "2024-01-01T06:00:00+00:00"),
    "B": ("2024-01-02", "2024-01-02T06:00:00+00:00"),
}
LAST_PULL = "2024-01-30"

# Code texts by part type, encounter class by priority digit, encounter status by order status.
CODE_TEXT = {
    "ECONOMY": "Blood Pressure",
    "MEDIUM": "Body Weight",
    "STANDARD": "Heart rate",
    "PROMO": "Blood Glucose",
    "SMALL": "Body Height",
}
CLASS_BY_PRIORITY = {"1": "EMER", "2": "IMP", "3": "AMB", "4": "OBSENC", "5": "VR"}
STATUS_BY_ORDER = {"F": "finished", "O": "in-progress", "P": "cancelled"}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _key(prefix: str, value: str | Column) -> Column:
    return F.concat(F.lit(prefix), (F.col(value) if isinstance(value, str) else value).cast("string"))


def _lookup(value: Column, table: dict[str, str]) -> Column:
    pairs = iter(table.items())
    first, label = next(pairs)
    out = F.when(value == first, F.lit(label))
    for code, label in pairs:
        out = out.when(value == code, F.lit(label))
    return out


def _shifted(ts: str) -> Column:
    return F.date_add(F.to_date(F.col(ts)), SHIFT_DAYS)


def _text(day: Column) -> Column:
    return day.cast("string")


def patient_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patient resources of both extractions: batch (A or B) and resource."""
    people = (
        _read(spark, sf_dir, "customer")
        .join(_read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(_read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    k = F.col("c_custkey")
    own_id = F.when(k % 97 != 0, _key("p", k))

    def copy(batch: str, ident: Column, city: Column) -> Column:
        return F.struct(F.lit(batch).alias("batch"), ident.alias("id"), city.alias("city"))

    moved = F.when(k % 10 == 0, F.lit("Moved")).otherwise(F.col("n_name"))
    copies = F.array(
        copy("A", own_id, F.col("n_name")),
        F.when(k % 5 == 0, copy("B", own_id, moved)),
        F.when(k % 50 == 1, copy("B", _key("n", k), F.col("n_name"))),
    )
    each = people.withColumn("c", F.explode(F.filter(copies, lambda c: c.isNotNull())))
    born = (
        F.when(k % 53 == 0, "1850-06-15")
        .when(k % 59 == 0, "unknown")
        .when(k % 61 == 0, "1980")
        .otherwise(_text(F.date_add(F.lit("1930-01-01").cast("date"), (k * 37 % 30000).cast("int"))))
    )
    called = F.array(F.struct(F.col("c_name").alias("family"), F.array(_key("G", k % 7)).alias("given")))
    home = F.struct(
        F.col("c.city").alias("city"),
        F.col("r_name").alias("state"),
        F.lpad(k.cast("string"), 5, "0").alias("postalCode"),
        F.lit("XX").alias("country"),
    )
    gender = F.when(k % 4 == 0, " male").when(k % 4 == 1, "female ").when(k % 4 == 2, "other")
    resource = F.struct(
        F.col("c.id").alias("id"),
        gender.alias("gender"),
        born.alias("birthDate"),
        F.when(k % 41 == 0, F.slice(called, 1, 0)).otherwise(called).alias("name"),
        F.array(home).alias("address"),
        F.struct(F.lower("c_mktsegment").alias("text")).alias("maritalStatus"),
        F.when(k % 3 != 0, F.col("c_acctbal") > 0).alias("active"),
    )
    return each.select(F.col("c.batch").alias("batch"), resource.alias("resource"))


def encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    start = _shifted("o_orderdate")
    end = F.when(k % 7 != 0, F.date_add(start, (k % 45 - 2).cast("int")))
    patient = F.concat(F.lit("Patient/"), _key("p", "o_custkey"))
    subject = (
        F.when(k % 59 == 0, _key("urn:uuid:", k))
        .when(k % 71 == 0, F.concat(patient, F.lit("/_history/2")))
        .otherwise(patient)
    )
    status = F.when(k % 13 == 0, "arrived").otherwise(_lookup(F.col("o_orderstatus"), STATUS_BY_ORDER))
    resource = F.struct(
        _key("e", k).alias("id"),
        status.alias("status"),
        F.struct(_lookup(F.substring("o_orderpriority", 1, 1), CLASS_BY_PRIORITY).alias("code")).alias("class"),
        F.array(F.struct(F.col("o_orderpriority").alias("text"))).alias("type"),
        F.struct(subject.alias("reference")).alias("subject"),
        F.struct(_text(start).alias("start"), _text(end).alias("end")).alias("period"),
        F.struct(_key("Supplier#", k % 100).alias("display")).alias("serviceProvider"),
    )
    return orders.select(resource.alias("resource"), F.lit(BATCHES["A"][1]).alias("extraction_timestamp"))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = (
        _read(spark, sf_dir, "lineitem")
        .join(_read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    coding = F.array(F.struct(F.col("p_brand").alias("code"), F.lit("http://loinc.org").alias("system")))
    measured = F.col("l_linenumber") != 7
    quantity = F.struct(F.col("l_quantity").alias("value"), F.lit("u").alias("unit"))
    day = _text(_shifted("l_shipdate"))
    resource = F.struct(
        F.concat_ws("-", _key("o", "l_orderkey"), F.col("l_linenumber").cast("string")).alias("id"),
        F.lit("final").alias("status"),
        F.struct(
            _lookup(F.col("p_type"), CODE_TEXT).alias("text"),
            F.when(F.col("p_type") == "LARGE", F.slice(coding, 1, 0)).otherwise(coding).alias("coding"),
        ).alias("code"),
        F.struct(F.concat(F.lit("Patient/"), _key("p", "o_custkey")).alias("reference")).alias("subject"),
        F.struct(F.concat(F.lit("Encounter/"), _key("e", "l_orderkey")).alias("reference")).alias("encounter"),
        F.when(measured, quantity).alias("valueQuantity"),
        F.when(~measured, F.col("l_returnflag")).alias("valueString"),
        day.alias("effectiveDateTime"),
    )
    return lines.select(
        resource.alias("resource"),
        F.concat(day, F.lit("T00:00:00+00:00")).alias("extraction_timestamp"),
    )


def conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    returned = (
        _read(spark, sf_dir, "lineitem")
        .filter(F.col("l_returnflag") == "R")
        .join(_read(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(_read(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    )
    grouped = returned.groupBy("o_custkey", "p_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("l_orderkey").alias("first_order"),
        F.min(_shifted("l_shipdate")).alias("first_day"),
        F.max(_shifted("l_shipdate")).alias("last_day"),
    )
    clinical = F.when(F.col("n") % 3 == 0, "active").when(F.col("n") % 3 == 1, "resolved").otherwise("inactive")
    verified = F.when(F.col("o_custkey") % 2 == 0, "confirmed").otherwise("provisional")

    def coded(value: Column) -> Column:
        return F.struct(F.array(F.struct(value.alias("code"))).alias("coding"))

    kind = F.col("p_type")
    resource = F.struct(
        F.concat_ws("-", _key("c", "o_custkey"), kind).alias("id"),
        coded(clinical).alias("clinicalStatus"),
        coded(verified).alias("verificationStatus"),
        F.struct(kind.alias("text"), F.array(F.struct(kind.alias("code"))).alias("coding")).alias("code"),
        F.struct(F.concat(F.lit("Patient/"), _key("p", "o_custkey")).alias("reference")).alias("subject"),
        F.struct(F.concat(F.lit("Encounter/"), _key("e", "first_order")).alias("reference")).alias("encounter"),
        _text(F.col("first_day")).alias("onsetDateTime"),
        _text(F.col("last_day")).alias("recordedDate"),
    )
    return grouped.select(
        resource.alias("resource"),
        F.lit(BATCHES["A"][1]).alias("extraction_timestamp"),
    )


def event_pulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events once per daily pull that extracts them: pull day D holds the events of D-3 up to D."""
    events = _read(spark, sf_dir, "events")
    happened = F.to_date("ts")
    last = F.least(F.date_add(happened, 3), F.lit(LAST_PULL).cast("date"))
    day = F.col("pull_day")
    resource = F.struct(
        _key("ev", "event_id").alias("id"),
        F.col("event_type").alias("type"),
        F.col("value").alias("value"),
        F.col("user_id").alias("user"),
        F.col("props").alias("props"),
    )
    return events.withColumn("pull_day", F.explode(F.sequence(happened, last))).select(
        resource.alias("resource"),
        F.concat(_text(day), F.lit("T06:00:00+00:00")).alias("extraction_timestamp"),
        F.concat(F.lit("b"), _text(day)).alias("batch_id"),
        _text(day).alias("ingestion_date"),
    )


def as_entries(resources: DataFrame, kind: str, batch_id: str | Column, file_name: str = "fixture") -> DataFrame:
    """Resources in the shape the page explode gives."""
    batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    url = F.concat_ws("/", F.lit(API_URL), F.lit(kind), F.col("resource.id"))
    rest = [c for c in resources.columns if c not in ("resource", "batch_id")]
    return resources.select(
        *rest,
        F.lit(kind).alias("resource_type"),
        batch.alias("batch_id"),
        F.lit(file_name).alias("file_name"),
        F.struct(url.alias("fullUrl"), F.col("resource")).alias("entry"),
    )
