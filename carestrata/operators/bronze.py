"""Landed pages to Bronze rows: explode, projection, insert-only merge, schema drift."""

from __future__ import annotations

from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MERGE_KEYS = ["resource_id", "batch_id"]
LINEAGE = ["batch_id", "extraction_timestamp", "source_system", "api_url"]


def explode_pages(pages: DataFrame, *keep: str) -> DataFrame:
    """One row per bundle entry, with the page's envelope and ``keep``; a page without entries gives no row."""
    return pages.select(
        *keep, "_extraction_metadata.*", "file_name", F.explode("fhir_bundle.entry").alias("entry")
    )


def bronze_rows(
    entries: DataFrame,
    *,
    source_system: str,
    api_url: str,
    ingestion_date: str | date | Column,
    load_ts: datetime | Column | None = None,
    schema: T.StructType | None = None,
    keep: list[str] | None = None,
) -> DataFrame:
    """Bronze projection: the nested resource, its JSON text, and lineage columns, then the columns ``keep`` of ``entries``.

    Entries read as JSON text keep that text; ``schema`` then says which of its fields ``resource_data`` holds.
    """
    text = F.col("entry.resource")
    if isinstance(entries.schema["entry"].dataType["resource"].dataType, T.StringType):
        if schema is None:
            raise ValueError("entries of JSON text need the schema of the resource")
        entries = entries.withColumn("_data", F.from_json(text, schema))
        data, kept = F.col("_data"), text
    else:
        data, kept = text, F.to_json(text)
    day = ingestion_date if isinstance(ingestion_date, Column) else F.lit(str(ingestion_date))
    loaded = F.current_timestamp() if load_ts is None else load_ts if isinstance(load_ts, Column) else F.lit(load_ts)
    return entries.select(
        data.alias("resource_data"),
        F.col("entry.fullUrl").alias("full_url"),
        kept.alias("resource_json"),
        F.col("resource_type").alias("source_resource_type"),
        "batch_id",
        F.col("extraction_timestamp").try_cast("timestamp").alias("extraction_timestamp"),
        "file_name",
        F.lit(source_system).alias("source_system"),
        F.lit(api_url).alias("api_url"),
        loaded.alias("load_timestamp"),
        day.cast("string").alias("ingestion_date"),
        data["id"].alias("resource_id"),
        *(keep or []),
    )


def lookback(df: DataFrame, updated: str, as_of: date, days: int = 3) -> DataFrame:
    """Rows updated on or after ``as_of`` minus ``days``: what one daily pull extracts."""
    return df.filter(F.col(updated) >= F.date_sub(F.lit(as_of), days))


def rows_to_insert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str] = MERGE_KEYS,
    partition_dates: list[str] | None = None,
) -> DataFrame:
    """Source rows whose key is not in the target; null keys never match and are inserted.

    ``partition_dates`` prunes the target to those ``ingestion_date`` folders. Pass it when a batch id belongs to one
    date, so that no older partition can hold the key.

    The target's keys are reduced to distinct ones before they are shuffled for the join. They are reduced under one
    more column than the join uses, so that the join shuffles both sides itself: only then can the adaptive skew join
    split a key that many source rows share.
    """
    if partition_dates is not None:
        target = target.filter(F.col("ingestion_date").isin(partition_dates))
    held = target.select(*keys, F.xxhash64(*keys).alias("_h")).distinct().drop("_h")
    return source.join(held, keys, "left_anti").select(*source.columns)


def merge_insert_new(
    target: DataFrame,
    source: DataFrame,
    keys: list[str] = MERGE_KEYS,
    partition_dates: list[str] | None = None,
) -> DataFrame:
    """The target after an insert-only merge; columns on one side only are filled with null."""
    return target.unionByName(
        rows_to_insert(target, source, keys, partition_dates), allowMissingColumns=True
    )


def split_null_keys(source: DataFrame, keys: list[str] = MERGE_KEYS) -> tuple[DataFrame, DataFrame]:
    """(rows with a full key, rows to quarantine), for callers that must not re-insert null keys on a rerun."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return source.filter(~missing), source.filter(missing)


# --- schema drift ---------------------------------------------------------------------------------------------------


def leaf_paths(schema: T.DataType, prefix: str = "") -> dict[str, str]:
    """Every path below a schema with its type; ``[]`` marks an array step."""
    if isinstance(schema, T.ArrayType):
        return leaf_paths(schema.elementType, prefix + "[]")
    if not isinstance(schema, T.StructType):
        return {prefix: schema.simpleString()}
    found: dict[str, str] = {}
    for field in schema.fields:
        path = f"{prefix}.{field.name}" if prefix else field.name
        found.update(leaf_paths(field.dataType, path))
    return found


def schema_drift(existing: T.StructType, incoming: T.StructType) -> list[tuple[str, str, str]]:
    """(path, change, data_type) for every nested or top-level difference, sorted by path."""
    old, new = leaf_paths(existing), leaf_paths(incoming)
    out = [(p, "NEW", new[p]) for p in new.keys() - old.keys()]
    out += [(p, "MISSING", old[p]) for p in old.keys() - new.keys()]
    out += [(p, "TYPE_CHANGED", f"{old[p]} -> {new[p]}") for p in old.keys() & new.keys() if old[p] != new[p]]
    return sorted(out)


def observed_schema(text: str | Column) -> Column:
    """An aggregate: the common variant schema of a column of JSON objects."""
    return F.schema_of_variant_agg(F.try_parse_json(text))


def observed_paths(rows: DataFrame, text: str = "resource_json") -> list[str]:
    """Every path that occurs in a column of JSON objects, found in one aggregation."""
    return schema_paths(rows.agg(observed_schema(text).alias("s")).first()["s"])


def schema_paths(found: str | None, declared: T.StructType | None = None, held: int | None = None) -> list[str]:
    """The paths of an :func:`observed_schema`, and of the ``declared`` fields in a mask of :func:`held_fields`."""
    both = T.StructType.fromDDL("r " + found.replace("OBJECT<", "STRUCT<")).fields[0].dataType if found else T.NullType()
    if held is not None:
        there = {p for i, p in enumerate(_places(declared)) if held >> i & 1}
        both = _common(both, _held_schema(declared, there))
    return sorted(leaf_paths(both)) if isinstance(both, T.StructType) else []


def held_fields(data: str, text: str, declared: T.StructType) -> Column:
    """A mask of the ``declared`` fields that a row's JSON holds, or null if it may hold anything else.

    ``data`` is the column parsed from ``text``. If every member name stands right before its colon, and there are as many
    as the parsed value has fields that are not null, the text has no others. Such rows, most of a landed day, need no
    second parse for :func:`observed_schema`: the OR of their masks says the same.
    """
    at = {p: i for i, p in enumerate(_places(declared))}
    if len(at) > 63:
        return F.lit(None).cast("bigint")
    json, name = F.col(text), F.lit('":')
    written = (F.octet_length(json) - F.octet_length(F.replace(json, name, F.lit("")))) / 2
    loose = reduce(Column.__or__, [json.contains(f"{c}:") for c in (" ", "\t", "\n", "\r", "'")])
    plain = json.startswith("{") & json.endswith("}") & ~loose & (written == _names(F.col(data), declared))
    return F.when(plain, _mask(F.col(data), declared, at))


def _places(kind: T.DataType, path: str = "") -> list[str]:
    """Every field below a type by depth first, and every list with ``[]`` for its elements."""
    if isinstance(kind, T.ArrayType):
        return [f"{path}[]", *_places(kind.elementType, f"{path}[]")]
    if not isinstance(kind, T.StructType):
        return []
    return [p for f in kind.fields for p in (f"{path}.{f.name}", *_places(f.dataType, f"{path}.{f.name}"))]


def _mask(value: Column, kind: T.DataType, at: dict[str, int], path: str = "") -> Column:
    """A bit for each field that is there and for each list that is not empty."""
    none = F.lit(0).cast("bigint")

    def bit(place: str) -> Column:
        return F.lit(1 << at[place]).cast("bigint")

    if isinstance(kind, T.ArrayType):
        inside, one = f"{path}[]", kind.elementType
        return F.aggregate(
            value, none, lambda m, e: m.bitwiseOR(bit(inside)).bitwiseOR(_mask(e, one, at, inside))
        )
    out = none
    for f in kind.fields if isinstance(kind, T.StructType) else []:
        v, place = value.getField(f.name), f"{path}.{f.name}"
        held = bit(place).bitwiseOR(_mask(v, f.dataType, at, place))
        out = out.bitwiseOR(F.when(v.isNotNull(), held).otherwise(none))
    return out


def _held_schema(kind: T.DataType, there: set[str], path: str = "") -> T.DataType:
    """The part of a type whose places are ``there``."""
    if isinstance(kind, T.ArrayType):
        inside = f"{path}[]"
        return T.ArrayType(_held_schema(kind.elementType, there, inside) if inside in there else T.NullType())
    if not isinstance(kind, T.StructType):
        return kind
    held = [(f.name, f"{path}.{f.name}", f.dataType) for f in kind.fields if f"{path}.{f.name}" in there]
    return T.StructType([T.StructField(name, _held_schema(t, there, place)) for name, place, t in held])


def _common(one: T.DataType, other: T.DataType) -> T.DataType:
    """The type that holds both, as the common variant schema has it; a value where they are of another kind."""
    if isinstance(one, T.NullType) or isinstance(other, T.NullType):
        return other if isinstance(one, T.NullType) else one
    if isinstance(one, T.ArrayType) and isinstance(other, T.ArrayType):
        return T.ArrayType(_common(one.elementType, other.elementType))
    if isinstance(one, T.StructType) and isinstance(other, T.StructType):
        mine, theirs = ({f.name: f.dataType for f in t.fields} for t in (one, other))
        pairs = {n: (mine.get(n, T.NullType()), theirs.get(n, T.NullType())) for n in mine | theirs}
        return T.StructType([T.StructField(n, _common(*pair)) for n, pair in pairs.items()])
    return T.StringType()


_NOT_PLAIN = -(1 << 30)


def _names(value: Column, kind: T.DataType) -> Column:
    """How many member names a parsed value stands for; negative if its JSON may be of another kind than declared."""
    if isinstance(kind, T.StructType):
        parts = [(value.getField(f.name), f.dataType) for f in kind.fields]
        return sum((F.when(v.isNotNull(), F.lit(1) + _names(v, t)).otherwise(F.lit(0)) for v, t in parts), F.lit(0))
    if isinstance(kind, T.ArrayType):
        one = kind.elementType
        return F.aggregate(
            value, F.lit(0), lambda n, e: n + F.when(e.isNull(), F.lit(_NOT_PLAIN)).otherwise(_names(e, one))
        )
    if isinstance(kind, T.StringType):  # an object or a list is kept as its text
        return F.when(value.startswith("{") | value.startswith("["), F.lit(_NOT_PLAIN)).otherwise(F.lit(0))
    if isinstance(kind, T.DoubleType):  # names of values that JSON does not have
        return F.when(F.abs(value) < F.lit(float("inf")), F.lit(0)).otherwise(F.lit(_NOT_PLAIN))
    return F.lit(0)


def _present(path: str) -> Column:
    """True where a row has a value at ``path``, looking into every array element."""
    head, *rest = path.split("[].")
    value = F.col(head)
    if not rest:
        return value.isNotNull() if not head.endswith("[]") else (F.size(F.col(head[:-2])) > 0)

    def inside(element: Column, steps: list[str]) -> Column:
        name, *deeper = steps
        item = element
        for part in name.removesuffix("[]").split("."):
            item = item.getField(part)
        if deeper:
            return F.exists(item, lambda e: inside(e, deeper))
        return F.coalesce(F.size(item), F.lit(0)) > 0 if name.endswith("[]") else item.isNotNull()

    return F.exists(value, lambda e: inside(e, rest))


def drift_report(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """One row per drifted path with how many rows hold a value there, counted in one pass over each side."""
    spark: SparkSession = incoming.sparkSession
    drift = schema_drift(existing.schema, incoming.schema)
    reports = []
    for side, changes in ((incoming, ("NEW", "TYPE_CHANGED")), (existing, ("MISSING",))):
        hits = [d for d in drift if d[1] in changes]
        if not hits:
            continue
        counts = side.agg(*[F.count_if(_present(p)).alias(f"n{i}") for i, (p, _, _) in enumerate(hits)])
        lines = F.array(
            *[
                F.struct(
                    F.lit(p).alias("path"),
                    F.lit(change).alias("change"),
                    F.lit(kind).alias("data_type"),
                    F.col(f"n{i}").alias("rows_with_value"),
                )
                for i, (p, change, kind) in enumerate(hits)
            ]
        )
        reports.append(counts.select(F.inline(lines)))
    if not reports:
        return spark.createDataFrame([], "path string, change string, data_type string, rows_with_value bigint")
    out = reports[0]
    for more in reports[1:]:
        out = out.unionByName(more)
    return out


def lifecycle_events(
    table: str, resource: str, batch_id: str | None, existing: T.StructType | None, incoming: T.StructType
) -> list[tuple[str, dict[str, str]]]:
    """(event, context) records of a Bronze write: creation, or new columns in the batch."""
    context = {"table_name": table, "resource_type": resource}
    if batch_id is not None:
        context["batch_id"] = batch_id
    if existing is None:
        return [("TABLE_CREATED", {**context, "column_count": str(len(incoming.fields))})]
    drift = schema_drift(existing, incoming)
    fresh = [p for p, change, _ in drift if change == "NEW"]
    gone = [p for p, change, _ in drift if change == "MISSING"]
    events = []
    if fresh:
        events.append(("SCHEMA_DRIFT_NEW_COLUMNS", {**context, "new_columns": ",".join(fresh)}))
    if gone:
        events.append(("SCHEMA_DRIFT_MISSING_COLUMNS", {**context, "missing_columns": ",".join(gone)}))
    return events
