"""Fields found by masks of plain rows are those the common variant schema of all texts has."""

import pytest
from pyspark.sql import functions as F

from carestrata.operators.bronze import held_fields, observed_paths, observed_schema, schema_paths
from carestrata.schemas import resource_schema

PLAIN = [
    '{"id":"a","gender":"male","active":true}',
    '{"id":"b","name":[{"family":"x","given":["y","z"]},{"family":"w"}],"maritalStatus":{"text":"t"}}',
    '{"id":"c","name":[],"address":[{}],"maritalStatus":{}}',
    '{}',
    '{"id":"c","birthDate":" male: x","address":[{"city":"u"}]}',
]
OTHER = [
    '{"id":"d","telecom":[{"system":"phone"}]}',
    '{"id":5,"x" : 1}',
    '{"id":"e","gender":null}',
    '{"id":"f","gender":{}}',
    '{"id":"g","gender":["m"]}',
    '{"id":"h","gender":{"code":"m"}}',
    '{"id":"i","name":{"family":"x"}}',
    '{"id":"j","name":[null]}',
    '{"id":"k","active":"yes"}',
    '{"id":"l","maritalStatus":"single"}',
    '{"id":"m","id":"n"}',
    '{"id":"a","b\\":":1}',
    '{"id":"o","gender":"say \\":\\" x"}',
    '{"id":"p"',
    "[1]",
    '"text"',
    "null",
    "not json",
    None,
]


def found(spark, texts):
    declared = resource_schema("patient")
    rows = spark.createDataFrame([(t,) for t in texts], "resource_json string").coalesce(1)
    rows = rows.withColumn("d", F.from_json("resource_json", declared))
    rows = rows.withColumn("_held", held_fields("d", "resource_json", declared))
    rest = observed_schema(F.when(F.col("_held").isNull(), F.col("resource_json")))
    got = rows.agg(F.bit_or("_held").alias("held"), rest.alias("fields"), F.count("_held").alias("plain")).first()
    return schema_paths(got["fields"], declared, got["held"]), got["plain"], observed_paths(rows)


@pytest.mark.parametrize("texts", [PLAIN, OTHER, PLAIN + OTHER[:-6], PLAIN + OTHER, *[[t, PLAIN[1]] for t in OTHER], [PLAIN[2]]])
def test_masks_and_the_rest_give_the_fields_of_all(spark, texts):
    got, plain, expected = found(spark, texts)
    assert got == expected
    assert plain == sum(t in PLAIN for t in texts)  # the others are parsed as before


def test_a_number_that_json_lacks_is_not_plain(spark):
    declared = resource_schema("observation")
    rows = spark.createDataFrame([('{"valueQuantity":{"value":NaN}}',), ('{"valueQuantity":{"value":2}}',)], "t string")
    rows = rows.withColumn("d", F.from_json("t", declared)).withColumn("m", held_fields("d", "t", declared))
    assert [r["m"] is None for r in rows.collect()] == [True, False]
