"""The stored layers over one input folder: each table is built once from its upstream and kept as Parquet."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.operators import gold, scd2, silver
from carestrata.operators.bronze import bronze_rows
from carestrata.session import configure
from carestrata.sources import fixtures as fx
from carestrata.sources.storage import dealt, split_limit, stage

AS_OF = date(2024, 6, 30)
FIRST_LOAD, SECOND_LOAD = date(2024, 1, 1), date(2024, 1, 2)
LAST_YEAR = 2026  # the bound the SQL for these layers states
LOADED_AT = datetime(2024, 1, 2, 8, 0, tzinfo=timezone.utc)

# Bytes of stored rows a task reads while a layer is built: what it sorts before a shuffle follows this.
SPLIT_BYTES = 16 * 1024 * 1024

# How stored copies are written: row groups small enough to be split, and a codec that also shortens hexadecimal text.
STORED = {"compression": "zstd", "parquet.block.size": str(2 * SPLIT_BYTES)}

# Columns the stored copy is partitioned by, and the row key it is dealt by; without one, each task writes what it reads.
PARTITIONS = {
    "bronze_patient": (["ingestion_date"], "resource_id"),
    "bronze_event": (["ingestion_date"], "resource_id"),
    "dim_patient": (["scd_current_flag"], "patient_id"),
    "dim_condition": (["scd_current_flag"], None),
}

# Facts, whose stored copy is laid out by day: the Silver table and the operator.
FACTS = {
    "fact_encounter": ("silver_encounter", gold.fact_encounter),
    "fact_observation": ("silver_observation", gold.fact_observation),
}


class Lakehouse:
    """Named tables over ``sf_dir``; :meth:`table` reads the stored copy, :meth:`derive` gives the plan that makes it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")
        self._stored: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._stored:
            layout, key = PARTITIONS.get(name, (None, None))
            rows = self.rows(name)
            with split_limit(self.spark, SPLIT_BYTES):
                self._stored[name] = stage(dealt(rows, layout, key) if key else rows, name, layout, **STORED)
        return self._stored[name]

    def rows(self, name: str) -> DataFrame:
        """The stored copy if there is one, else the plan that makes it, for a caller that stores the rows itself."""
        if name in self._stored:
            return self._stored[name]
        return self._fact(name, by_day=True) if name in FACTS else self.derive(name)

    def derive(self, name: str) -> DataFrame:
        return getattr(self, f"_{name}")()

    # Bronze

    def _bronze(self, resources: DataFrame, kind: str, batch_id, ingestion_date) -> DataFrame:
        return bronze_rows(
            fx.as_entries(resources, kind, batch_id),
            source_system=fx.SOURCE_SYSTEM,
            api_url=fx.API_URL,
            ingestion_date=ingestion_date,
            load_ts=LOADED_AT,
        )

    def _bronze_patient(self) -> DataFrame:
        in_a = F.col("batch") == "A"
        batches = fx.patient_batches(self.spark, self.sf_dir).withColumns(
            {
                "extraction_timestamp": F.when(in_a, fx.BATCHES["A"][1]).otherwise(fx.BATCHES["B"][1]),
                "day": F.when(in_a, fx.BATCHES["A"][0]).otherwise(fx.BATCHES["B"][0]),
            }
        )
        return self._bronze(batches, "Patient", F.concat(F.lit("batch"), "batch"), F.col("day"))

    def _bronze_encounter(self) -> DataFrame:
        return self._bronze(fx.encounters(self.spark, self.sf_dir), "Encounter", "batchA", fx.BATCHES["A"][0])

    def _bronze_observation(self) -> DataFrame:
        return self._bronze(fx.observations(self.spark, self.sf_dir), "Observation", "batchA", fx.BATCHES["A"][0])

    def _bronze_condition(self) -> DataFrame:
        return self._bronze(fx.conditions(self.spark, self.sf_dir), "Condition", "batchA", fx.BATCHES["A"][0])

    def _bronze_event(self) -> DataFrame:
        pulls = fx.event_pulls(self.spark, self.sf_dir)
        return self._bronze(pulls, "Event", F.col("batch_id"), F.col("ingestion_date"))

    # Silver

    def _silver(self, resource: str, ingestion_date: str | None = None) -> DataFrame:
        bronze = self.table(f"bronze_{resource}")
        return silver.to_silver(bronze, resource, ingestion_date=ingestion_date, load_ts=LOADED_AT, max_year=LAST_YEAR)

    def _silver_patient(self) -> DataFrame:
        return self._silver("patient")

    def _silver_patient_first(self) -> DataFrame:
        """Silver as it was after the first batch."""
        return self._silver("patient", fx.BATCHES["A"][0])

    def _silver_encounter(self) -> DataFrame:
        return self._silver("encounter")

    def _silver_observation(self) -> DataFrame:
        return self._silver("observation")

    def _silver_condition(self) -> DataFrame:
        return self._silver("condition")

    # Slowly changing dimensions

    def _dim_patient_first(self) -> DataFrame:
        return scd2.open_versions(self.table("silver_patient_first"), FIRST_LOAD)

    def _dim_patient(self) -> DataFrame:
        # one projection over its own stored input, so it is not stored once more for this
        first, latest = self.rows("dim_patient_first"), self.table("silver_patient")
        return scd2.apply_changes(first, latest, "patient_id", SECOND_LOAD)

    def _dim_condition(self) -> DataFrame:
        return scd2.open_versions(self.table("silver_condition"), FIRST_LOAD)

    # Gold

    def _dim_date(self) -> DataFrame:
        return gold.dim_date(self.spark)

    def _gold_dim_patient(self) -> DataFrame:
        return gold.gold_dim_patient(self.table("dim_patient"), AS_OF)

    def _gold_dim_condition(self) -> DataFrame:
        return gold.gold_dim_condition(self.rows("dim_condition"))

    def _fact(self, name: str, by_day: bool = False) -> DataFrame:
        source, build = FACTS[name]
        return build(self.table(source), self.table("gold_dim_patient"), by_day)

    def _fact_encounter(self) -> DataFrame:
        return self._fact("fact_encounter")

    def _fact_observation(self) -> DataFrame:
        return self._fact("fact_observation")

    def _vw_fact_encounter(self) -> DataFrame:
        return gold.vw_fact_encounter(*[self.table(t) for t in ("fact_encounter", "gold_dim_patient", "dim_date")])

    def _vw_fact_observation(self) -> DataFrame:
        return gold.vw_fact_observation(*[self.table(t) for t in ("fact_observation", "gold_dim_patient", "dim_date")])

    def _vw_condition_distribution(self) -> DataFrame:
        return gold.vw_condition_distribution(self.table("gold_dim_condition"), self.table("gold_dim_patient"))


_OPEN: dict[tuple[str, str], Lakehouse] = {}


def open_lakehouse(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """The lakehouse of this application over ``sf_dir``."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _OPEN:
        _OPEN[key] = Lakehouse(spark, sf_dir)
    return _OPEN[key]
