"""Data checks that return rows instead of printing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carestrata.operators.bronze import LINEAGE, MERGE_KEYS
from carestrata.sources.tables import labelled_counts, partition_columns


def duplicate_keys(df: DataFrame, keys: list[str] = MERGE_KEYS) -> DataFrame:
    """Keys with more than one row; expected to be empty."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")


def rows_missing_lineage(bronze: DataFrame, columns: list[str] = LINEAGE) -> DataFrame:
    """Rows with a null in any lineage column; expected 0."""
    missing = F.lit(False)
    for name in columns:
        missing = missing | F.col(name).isNull()
    return bronze.agg(F.count_if(missing).alias("rows_missing_metadata"))


def is_partitioned_by(spark: SparkSession, table: str, expected: list[str]) -> bool:
    return partition_columns(spark, table) == expected


def partition_layout(spark: SparkSession, expected: dict[str, list[str]]) -> DataFrame:
    """(tbl, partition_columns, as_expected, partitions) of catalog tables: what they are laid out by, and by how many."""
    rows = []
    for name, columns in expected.items():
        found = partition_columns(spark, name)
        layout = F.concat_ws(",", *map(F.lit, found)) if found else F.lit("")
        count = F.count_distinct(*found) if found else F.lit(0).cast("bigint")
        one = spark.table(name).agg(count.alias("partitions"))
        facts = [F.lit(name.rsplit(".", 1)[-1]).alias("tbl"), layout.alias("partition_columns"), F.lit(found == columns).alias("as_expected")]
        rows.append(one.select(*facts, "partitions"))
    return reduce(DataFrame.unionAll, rows)


def orphans(child: DataFrame, parent: DataFrame, key: str, where: str | None = None) -> DataFrame:
    """Child rows without a parent.

    Children are counted per key before the anti join, so a key with very many rows, null included, is one row.
    """
    rows = child.filter(where) if where else child
    per_key = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    lost = per_key.join(parent.select(key), key, "left_anti")
    return lost.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("orphans"))


def unmatched(fact: DataFrame, key: str = "patient_sk") -> DataFrame:
    """Rows of a fact and those without a dimension key."""
    return fact.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col(key).isNull()).alias("orphaned"))


def census(tables: dict[str, DataFrame]) -> DataFrame:
    return labelled_counts(tables)


def bronze_silver_totals(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Bronze rows, distinct Bronze ids and Silver rows; the last two should be equal."""
    counted = bronze.agg(
        F.count(F.lit(1)).alias("bronze_total_rows"),
        F.count_distinct("resource_id").alias("bronze_distinct_ids"),
    )
    return counted.withColumn("silver_total_rows", silver.agg(F.count(F.lit(1))).scalar())


def loads_per_day(bronze: DataFrame) -> DataFrame:
    counted = bronze.groupBy("ingestion_date").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("batch_id").alias("batch_count")
    )
    return counted.orderBy(F.desc("ingestion_date"))


def most_reingested(bronze: DataFrame, top: int = 20) -> DataFrame:
    """Ids seen in the most batches, equal counts in id order."""
    seen = bronze.groupBy("resource_id").agg(F.count_distinct("batch_id").alias("times_reingested"))
    return seen.filter("times_reingested > 1").orderBy(F.desc("times_reingested"), "resource_id").limit(top)


def layer_totals(bronze: DataFrame, silver: DataFrame, dim: DataFrame) -> DataFrame:
    """Load days, Bronze and Silver rows, and dimension versions side by side; each table is read once."""
    raw = bronze.agg(
        F.count_distinct("ingestion_date").alias("distinct_load_days"), F.count(F.lit(1)).alias("bronze_total_rows")
    )
    versions = dim.agg(
        F.struct(
            F.count(F.lit(1)).alias("total"),
            F.count_if("scd_current_flag").alias("current"),
            F.count_if(~F.col("scd_current_flag")).alias("historical"),
        )
    ).scalar()
    with_dim = raw.withColumns({"silver_current_rows": silver.agg(F.count(F.lit(1))).scalar(), "_v": versions})
    return with_dim.select(
        *["distinct_load_days", "bronze_total_rows", "silver_current_rows"],
        F.col("_v.total").alias("dim_total_versions"),
        F.col("_v.current").alias("dim_current_versions"),
        F.col("_v.historical").alias("dim_historical_versions"),
    )


def current_totals(dims: dict[str, DataFrame]) -> DataFrame:
    """Current versions of each dimension side by side, as ``current_<name>``."""
    names = iter(dims.items())
    name, first = next(names)

    def current(df: DataFrame) -> DataFrame:
        return df.filter("scd_current_flag").agg(F.count(F.lit(1)).alias("n"))

    out = current(first).withColumnRenamed("n", f"current_{name}")
    return out.withColumns({f"current_{n}": current(df).scalar() for n, df in names})
