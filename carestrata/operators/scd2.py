"""Type-2 slowly changing dimensions as one immutable plan."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END, CURRENT = "scd_effective_start_date", "scd_effective_end_date", "scd_current_flag"


def open_versions(src: DataFrame, as_of: date) -> DataFrame:
    """Source rows as current versions starting on ``as_of``; also the initial load."""
    return src.withColumns(
        {START: F.lit(as_of), END: F.lit(None).cast("date"), CURRENT: F.lit(True)}
    )


def current_rows(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col(CURRENT))


def _change(old_hash: Column, new_hash: Column) -> Column:
    return (
        F.when(old_hash.isNull(), "new").when(old_hash == new_hash, "unchanged").otherwise("changed")
    )


def classify(dim: DataFrame, src: DataFrame, pk: str, hash_col: str = "record_hash") -> DataFrame:
    """Source rows with ``change``: new, changed or unchanged against the current versions."""
    existing = current_rows(dim).select(pk, F.col(hash_col).alias("_existing_hash"))
    joined = src.join(existing, pk, "left")
    return joined.select(*src.columns, _change(F.col("_existing_hash"), F.col(hash_col)).alias("change"))


def change_counts(classified: DataFrame) -> DataFrame:
    return classified.groupBy("change").agg(F.count(F.lit(1)).alias("row_count"))


def changed_partition(
    dim: DataFrame, src: DataFrame, pk: str, as_of: date, hash_col: str = "record_hash"
) -> DataFrame:
    """Everything a merge writes: kept current rows, versions it closes, and versions it opens.

    Old and new sides meet once in a full outer join on the key, which is unique on both: one current version per key
    in the dimension, one row per key in Silver. Rows absent from the source stay current. Earlier history is not read.
    """
    fresh = open_versions(src, as_of)
    extra = [f for f in fresh.schema.fields if f.name not in dim.columns]
    kept = current_rows(dim).withColumns({f.name: F.lit(None).cast(f.dataType) for f in extra})
    lacking = [f for f in dim.schema.fields if f.name not in fresh.columns]
    fresh = fresh.withColumns({f.name: F.lit(None).cast(f.dataType) for f in lacking})
    columns = [*dim.columns, *[f.name for f in extra]]

    old = kept.select(F.col(pk).alias("_old_key"), F.struct(*columns).alias("_old"))
    new = fresh.select(F.col(pk).alias("_new_key"), F.struct(*columns).alias("_new"))
    both = old.join(new, F.col("_old_key") == F.col("_new_key"), "full")

    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()
    change = _change(F.col("_old")[hash_col], F.col("_new")[hash_col])
    closing = has_old & has_new & (change == "changed")
    closed = F.col("_old").withField(CURRENT, F.lit(False)).withField(END, F.lit(as_of))
    versions = F.array(
        F.when(closing, closed).when(has_old, F.col("_old")),
        F.when(has_new & (change != "unchanged"), F.col("_new")),
    )
    one = both.select(F.explode(versions).alias("_v")).filter(F.col("_v").isNotNull())
    return one.select("_v.*")


def apply_changes(
    dim: DataFrame, src: DataFrame, pk: str, as_of: date, hash_col: str = "record_hash"
) -> DataFrame:
    """The dimension after the merge: untouched history plus the rewritten current part."""
    history = dim.filter(~F.col(CURRENT))
    return changed_partition(dim, src, pk, as_of, hash_col).unionByName(history, allowMissingColumns=True)


def invariants(dim: DataFrame, pk: str) -> DataFrame:
    """Three rules as (check_name, bad_rows): one current version per key, closed has an end, current has none."""
    per_key = dim.groupBy(pk).agg(
        F.count_if(F.col(CURRENT)).alias("_current"),
        F.count_if(~F.col(CURRENT) & F.col(END).isNull()).alias("_open_closed"),
        F.count_if(F.col(CURRENT) & F.col(END).isNotNull()).alias("_ended_current"),
    )
    totals = per_key.agg(
        F.count_if(F.col("_current") > 1).alias("multiple_current"),
        F.coalesce(F.sum("_open_closed"), F.lit(0)).alias("closed_without_end"),
        F.coalesce(F.sum("_ended_current"), F.lit(0)).alias("current_with_end"),
    )
    return totals.unpivot([], totals.columns, "check_name", "bad_rows")


def history(dim: DataFrame, pk: str) -> DataFrame:
    """All versions in key and start order."""
    return dim.orderBy(pk, START, F.asc_nulls_last(END))


def current_split(dim: DataFrame) -> DataFrame:
    return dim.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(CURRENT)).alias("current_rows"),
        F.count_if(~F.col(CURRENT)).alias("historical_rows"),
    )


def version_histogram(dim: DataFrame, pk: str) -> DataFrame:
    """How many keys have one version, two versions, and so on."""
    per_key = dim.groupBy(pk).agg(F.count(F.lit(1)).alias("version_count"))
    return per_key.groupBy("version_count").agg(F.count(F.lit(1)).alias("key_count")).orderBy("version_count")


def one_changed_key(dim: DataFrame, pk: str) -> DataFrame:
    """Version history of the first key with more than one version."""
    many = dim.groupBy(pk).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    first = many.agg(F.min(pk)).scalar()
    return dim.filter(F.col(pk) == first).orderBy(START, F.asc_nulls_last(END))
