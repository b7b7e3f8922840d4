import datetime as dt
import random

import pytest

from carestrata.operators import scd2

D = [dt.date(2024, 1, d) for d in range(1, 8)]


def src(spark, state):
    return spark.createDataFrame(
        [(k, v, f"h{v}") for k, v in state.items()] or [], "id string, v string, record_hash string"
    )


def as_set(dim):
    return sorted(((r["id"], r["v"], r[scd2.START], r[scd2.END], r[scd2.CURRENT]) for r in dim.collect()), key=repr)


def model(versions, state, day):
    """The same merge on plain lists."""
    out = []
    current = {k: v for k, v, _, _, cur in versions if cur}
    for k, v, start, end, cur in versions:
        closes = cur and k in state and state[k] != v
        out.append((k, v, start, day if closes else end, cur and not closes))
    out += [(k, v, day, None, True) for k, v in state.items() if current.get(k) != v]
    return out


@pytest.mark.parametrize("seed", range(3))
def test_random_change_sequences(spark, seed):
    rng = random.Random(seed)
    state = {f"k{i}": "0" for i in range(20)}
    dim = scd2.open_versions(src(spark, state), D[0])
    want = [(k, v, D[0], None, True) for k, v in state.items()]
    for day in D[1:4]:
        state = {k: str(rng.randint(0, 2)) for k in rng.sample([f"k{i}" for i in range(30)], 18)}
        batch = src(spark, state)
        dim = spark.createDataFrame(scd2.apply_changes(dim, batch, "id", day).collect(), dim.schema)
        want = model(want, state, day)
        assert as_set(dim) == sorted(want, key=repr)
        assert all(r["bad_rows"] == 0 for r in scd2.invariants(dim, "id").collect())
        again = scd2.apply_changes(dim, batch, "id", day)
        assert as_set(again) == as_set(dim)


def test_classify_counts(spark):
    dim = scd2.open_versions(src(spark, {"a": "1", "b": "1", "c": "1"}), D[0])
    found = scd2.classify(dim, src(spark, {"a": "1", "b": "2", "d": "1"}), "id")
    assert {r["id"]: r["change"] for r in found.collect()} == {"a": "unchanged", "b": "changed", "d": "new"}
    assert {r[0]: r[1] for r in scd2.change_counts(found).collect()} == {"unchanged": 1, "changed": 1, "new": 1}


def test_absent_keys_stay_current(spark):
    dim = scd2.open_versions(src(spark, {"a": "1", "b": "1"}), D[0])
    out = scd2.apply_changes(dim, src(spark, {"a": "1"}), "id", D[1])
    assert as_set(out) == [("a", "1", D[0], None, True), ("b", "1", D[0], None, True)]


def test_source_with_a_new_column(spark):
    dim = scd2.open_versions(src(spark, {"a": "1", "b": "1"}), D[0])
    wider = spark.createDataFrame([("a", "2", "h2", 7)], "id string, v string, record_hash string, extra int")
    got = {(r["id"], r[scd2.CURRENT]): r["extra"] for r in scd2.apply_changes(dim, wider, "id", D[1]).collect()}
    assert got == {("a", False): None, ("a", True): 7, ("b", True): None}


def test_invariants_find_planted_rows(spark):
    schema = f"id string, {scd2.START} date, {scd2.END} date, {scd2.CURRENT} boolean"
    bad = spark.createDataFrame(
        [("a", D[0], None, True), ("a", D[1], None, True), ("b", D[0], None, False), ("c", D[0], D[1], True)], schema
    )
    assert {r[0]: r[1] for r in scd2.invariants(bad, "id").collect()} == {
        "multiple_current": 1,
        "closed_without_end": 1,
        "current_with_end": 1,
    }


def test_version_reports(spark):
    dim = scd2.open_versions(src(spark, {"a": "1", "b": "1"}), D[0])
    dim = scd2.apply_changes(dim, src(spark, {"a": "2"}), "id", D[1])
    assert [tuple(r) for r in scd2.version_histogram(dim, "id").collect()] == [(1, 1), (2, 1)]
    assert tuple(scd2.current_split(dim).first()) == (3, 2, 1)
    assert [r["v"] for r in scd2.one_changed_key(dim, "id").collect()] == ["1", "2"]
    assert [(r["id"], r["v"]) for r in scd2.history(dim, "id").collect()] == [("a", "1"), ("a", "2"), ("b", "1")]
