"""The semantic layer: star joins, named measures and their filter rules.

Fields are named ``table.column``. A fact joins a dimension only when a requested field needs it. Rules kept from the
model: a measure's own filter replaces any outer filter or grouping on the same field, text compares without case,
counting no rows is blank, and a filter reaches only the facts its table is related to.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carestrata.functions.aggregates import distinct_with_blank, divide, rows

PATIENT, DATE = "gold_dim_patient", "dim_date"
ENCOUNTER, OBSERVATION, CONDITION = "fact_encounter", "fact_observation", "gold_dim_condition"

# How each fact reaches its dimensions: dimension -> (fact column, dimension column).
RELATIONS = {
    ENCOUNTER: {PATIENT: ("patient_sk", "patient_sk"), DATE: ("start_date_key", "date_key")},
    OBSERVATION: {PATIENT: ("patient_sk", "patient_sk"), DATE: ("observation_date_key", "date_key")},
    CONDITION: {PATIENT: ("patient_business_key", "patient_business_key")},
}
DISCHARGE = {ENCOUNTER: {**RELATIONS[ENCOUNTER], DATE: ("end_date_key", "date_key")}}

_FIELDS = {ENCOUNTER: "encounters", OBSERVATION: "observations", CONDITION: "conditions", PATIENT: "patients", DATE: "days"}

Slicers = dict[str, list]


def split_field(name: str) -> tuple[str, str]:
    table, column = name.split(".")
    return table, column


def internal(name: str) -> str:
    return name.replace(".", "__")


@dataclass(frozen=True)
class Star:
    """The five Gold tables."""

    encounters: DataFrame
    observations: DataFrame
    conditions: DataFrame
    patients: DataFrame
    days: DataFrame

    def source(self, table: str) -> DataFrame:
        return getattr(self, _FIELDS[table])

    def with_encounters(self, rows: DataFrame) -> Star:
        """The same star over other encounters."""
        return StoredStar(lambda table: rows if table == ENCOUNTER else self.source(table))

    def frame(self, fact: str, fields: Iterable[str], relations: dict | None = None) -> DataFrame:
        """The fact with ``fields`` as ``table__column``, joined only to the dimensions those fields come from."""
        links = (relations or RELATIONS)[fact]
        by_table: dict[str, list[str]] = {}
        for name in dict.fromkeys(fields):
            table, column = split_field(name)
            by_table.setdefault(table, []).append(column)
        own = by_table.pop(fact, [])
        joins = {t: links[t] for t in by_table}
        needed = dict.fromkeys([*own, *[fact_key for fact_key, _ in joins.values()]])
        out = self.source(fact).select(*[F.col(c).alias(f"{fact}__{c}") for c in needed])
        for table, (fact_key, dim_key) in joins.items():
            side = self.source(table).select(
                F.col(dim_key).alias(f"_{table}"), *[F.col(c).alias(f"{table}__{c}") for c in by_table[table]]
            )
            if table == DATE:  # size fixed by the calendar's bounds
                side = F.broadcast(side)
            out = out.join(side, F.col(f"{fact}__{fact_key}") == F.col(f"_{table}"), "left").drop(f"_{table}")
        return out


class StoredStar(Star):
    """A star that asks for a table by name when a query first reads it, and so for no table a query does not read."""

    def __init__(self, table: Callable[[str], DataFrame]):
        object.__setattr__(self, "_table", table)

    encounters = property(lambda self: self._table(ENCOUNTER))
    observations = property(lambda self: self._table(OBSERVATION))
    conditions = property(lambda self: self._table(CONDITION))
    patients = property(lambda self: self._table(PATIENT))
    days = property(lambda self: self._table(DATE))


def reaches(fact: str, name: str) -> bool:
    table, _ = split_field(name)
    return table == fact or table in RELATIONS[fact]


def selects(column: Column, values: list) -> Column:
    """Whether a column is among a slicer's values; a None among them selects blanks. Text compares without case."""
    given = [v for v in values if v is not None]
    if given and all(isinstance(v, str) for v in given):
        test = F.lower(column).isin([v.lower() for v in given])
    else:
        test = column.isin(given)
    return test | column.isNull() if None in values else test


def slice_condition(slicers: Slicers) -> Column:
    """Conjunction of the membership tests of all slicers."""
    return reduce(lambda a, b: a & b, [selects(F.col(internal(n)), v) for n, v in slicers.items()])


def slice_frame(star: Star, frame: DataFrame, fact: str, slicers: Slicers, relations: dict | None = None) -> DataFrame:
    """``frame`` under ``slicers``, whose fields it must hold.

    A date slicer also bounds the fact's own date key by the first and last day it selects. That range reaches the
    scan, where files clustered by day are skipped.
    """
    if not slicers:
        return frame
    on_days = {n: v for n, v in slicers.items() if split_field(n)[0] == DATE and None not in v}
    if on_days:
        fact_key, day_key = (relations or RELATIONS)[fact][DATE]
        days = star.source(DATE).select(
            F.col(day_key).alias("_key"), *[F.col(split_field(n)[1]).alias(internal(n)) for n in on_days]
        ).filter(slice_condition(on_days))
        own = F.col(f"{fact}__{fact_key}")
        first, last = days.agg(F.min("_key")).scalar(), days.agg(F.max("_key")).scalar()
        frame = frame.filter((own >= first) & (own <= last))
    return frame.filter(slice_condition(slicers))


# --- measures -------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Measure:
    """An aggregate over one fact. ``replaces`` lists the fields whose outer filter it overrides."""

    fact: str
    uses: tuple[str, ...]
    expression: Callable[[], Column]
    replaces: frozenset[str] = field(default_factory=frozenset)
    relations: str = "start"


@dataclass(frozen=True)
class Period:
    """A comparison of periods, kept in ``plans.periods``: its value is that of the context's last day or month."""

    by_day: bool
    column: str


@dataclass(frozen=True)
class Label:
    """A text about the current slicers."""


@dataclass(frozen=True)
class Derived:
    """A formula over other measures."""

    needs: tuple[str, ...]
    formula: Callable[..., Column]


def _f(table: str, column: str) -> Column:
    return F.col(f"{table}__{column}")


def _text_is(table: str, column: str, value: str) -> Column:
    return F.lower(_f(table, column)) == value.lower()


def _encounters_with(status: str) -> Measure:
    name = f"{ENCOUNTER}.status"
    return Measure(
        ENCOUNTER, (name,), lambda: rows(_text_is(ENCOUNTER, "status", status)), frozenset({name})
    )


def _conditions_with(status: str) -> Measure:
    name = f"{CONDITION}.clinical_status"
    return Measure(
        CONDITION, (name,), lambda: rows(_text_is(CONDITION, "clinical_status", status)), frozenset({name})
    )


_LOS, _CLASS = f"{ENCOUNTER}.length_of_stay_days", f"{ENCOUNTER}.encounter_class"
_INPATIENT = frozenset({_CLASS})


def _stay(aggregate: Callable[[Column], Column], inpatient: bool) -> Callable[[], Column]:
    def build() -> Column:
        days = _f(ENCOUNTER, "length_of_stay_days")
        return aggregate(F.when(_text_is(ENCOUNTER, "encounter_class", "IMP"), days) if inpatient else days)

    return build


def _ratio(alternate: float) -> Callable[[Column, Column], Column]:
    return lambda a, b: divide(a, b, F.lit(alternate))


MEASURES: dict[str, Measure | Derived | Period | Label] = {
    "total_patients": Measure(
        ENCOUNTER, (f"{ENCOUNTER}.patient_sk",), lambda: distinct_with_blank(_f(ENCOUNTER, "patient_sk"))
    ),
    "total_encounters": Measure(ENCOUNTER, (), rows),
    "total_observations": Measure(OBSERVATION, (), rows),
    "active_conditions": _conditions_with("active"),
    "total_conditions": Measure(CONDITION, (), rows),
    "encounters_finished": _encounters_with("finished"),
    "encounters_cancelled": _encounters_with("cancelled"),
    "encounters_in_progress": _encounters_with("in-progress"),
    "encounters_arrived": _encounters_with("arrived"),
    "encounters_all_statuses": Measure(ENCOUNTER, (), rows, frozenset({f"{ENCOUNTER}.status"})),
    "encounter_status_pct": Derived(("total_encounters", "encounters_all_statuses"), _ratio(0.0)),
    "avg_los_days": Measure(ENCOUNTER, (_LOS, _CLASS), _stay(F.avg, True), _INPATIENT),
    "avg_los_all_classes": Measure(ENCOUNTER, (_LOS,), _stay(F.avg, False)),
    "max_los_days": Measure(ENCOUNTER, (_LOS, _CLASS), _stay(F.max, True), _INPATIENT),
    "total_los_days": Measure(ENCOUNTER, (_LOS,), _stay(F.sum, False)),
    "avg_observation_value": Measure(
        OBSERVATION, (f"{OBSERVATION}.value_numeric",), lambda: F.avg(_f(OBSERVATION, "value_numeric"))
    ),
    "numeric_observations": Measure(
        OBSERVATION,
        (f"{OBSERVATION}.value_numeric",),
        lambda: rows(_f(OBSERVATION, "value_numeric").isNotNull()),
    ),
    "observations_per_patient": Derived(("total_observations", "total_patients"), _ratio(0.0)),
    "encounters_per_patient": Derived(("total_encounters", "total_patients"), _ratio(0.0)),
    "avg_los_by_discharge_date": Measure(
        ENCOUNTER, (_LOS, _CLASS), _stay(F.avg, True), _INPATIENT, relations="discharge"
    ),
    "patients_with_condition": Measure(
        CONDITION,
        (f"{CONDITION}.patient_business_key",),
        lambda: distinct_with_blank(_f(CONDITION, "patient_business_key")),
    ),
    "conditions_resolved": _conditions_with("resolved"),
    "condition_resolution_rate": Derived(("conditions_resolved", "total_conditions"), _ratio(0.0)),
    "encounters_mtd": Period(True, "encounters_mtd"),
    "encounters_ytd": Period(True, "encounters_ytd"),
    "encounters_prior_month": Period(False, "encounters_prior_month"),
    "encounters_mom_pct": Period(False, "encounters_mom_pct"),
    "patients_prior_month": Period(False, "patients_prior_month"),
    "patients_mom_pct": Period(False, "patients_mom_pct"),
    "page_title": Label(),
    "selected_period": Label(),
}


def _base_names(names: Iterable[str]) -> list[str]:
    out: dict[str, None] = {}
    for name in names:
        measure = MEASURES[name]
        if isinstance(measure, (Period, Label)):
            continue
        for base in measure.needs if isinstance(measure, Derived) else (name,):
            out[base] = None
    return list(out)


def evaluate(
    star: Star,
    measures: list[str],
    group_by: list[str] | None = None,
    slicers: Slicers | None = None,
) -> DataFrame:
    """Measures by the fields of ``group_by`` under ``slicers``; one row if there is no grouping.

    Measures that see the same fact and the same filter context share one aggregation. Contexts with all grouping
    fields are merged by a union and a second small aggregation, which also keeps null groups; a context that lacks
    some fields repeats its value over them. Period comparisons look outside date slicers and date groups and show the
    value of the last day or month inside; labels are the same in every row.
    """
    group_by, slicers = list(group_by or []), dict(slicers or {})
    special = [n for n in measures if isinstance(MEASURES[n], (Period, Label))]
    if special:
        from carestrata.plans.periods import with_periods

        plain = [n for n in measures if n not in special]
        helper = [] if plain else ["total_encounters"]
        base = evaluate(star, plain or helper, group_by, slicers)
        return with_periods(star, base, special, group_by, slicers).select(
            *[split_field(g)[1] for g in group_by], *measures
        )
    contexts: dict[tuple, list[str]] = {}
    for name in _base_names(measures):
        m = MEASURES[name]
        groups = tuple(g for g in group_by if reaches(m.fact, g) and g not in m.replaces)
        active = tuple(s for s in slicers if reaches(m.fact, s) and s not in m.replaces)
        contexts.setdefault((m.fact, m.relations, groups, active), []).append(name)

    full: list[tuple[DataFrame, list[str]]] = []
    partial: list[tuple[DataFrame, list[str], list[str]]] = []
    for (fact, role, groups, active), names in contexts.items():
        uses = [u for n in names for u in MEASURES[n].uses]
        relations = DISCHARGE if role == "discharge" else None
        frame = star.frame(fact, [*groups, *active, *uses], relations)
        frame = slice_frame(star, frame, fact, {s: slicers[s] for s in active}, relations)
        keys = [internal(g) for g in groups]
        result = frame.groupBy(*keys).agg(*[MEASURES[n].expression().alias(n) for n in names])
        if len(groups) == len(group_by):
            full.append((result, names))
        else:
            partial.append((result, names, keys))

    keys = [internal(g) for g in group_by]
    if not full:
        # every measure overrides a grouping field: the groups themselves come from the fact
        fact = MEASURES[_base_names(measures)[0]].fact
        if not all(reaches(fact, g) for g in group_by):
            raise ValueError(f"no requested measure can be grouped by {group_by}")
        axis = star.frame(fact, group_by).select(*keys).distinct()
    elif len(full) == 1:
        axis = full[0][0]
    else:
        stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f for f, _ in full])
        names = [n for _, ns in full for n in ns]
        axis = stacked.groupBy(*keys).agg(*[F.max(n).alias(n) for n in names])

    for result, names, own in partial:
        if own:
            side = result.select(*[F.col(k).alias(f"_{k}") for k in own], *names)
            match = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in own])
            axis = axis.join(side, match, "left").drop(*[f"_{k}" for k in own])
        else:
            # one row, read once as a scalar subquery
            axis = axis.withColumn("_all", result.select(F.struct(*names)).scalar())
            axis = axis.withColumns({n: F.col("_all")[n] for n in names}).drop("_all")

    def value(name: str) -> Column:
        m = MEASURES[name]
        return m.formula(*[F.col(n) for n in m.needs]) if isinstance(m, Derived) else F.col(name)

    return axis.select(
        *[F.col(internal(g)).alias(split_field(g)[1]) for g in group_by],
        *[value(n).alias(n) for n in measures],
    )


def slicer_values(star: Star, name: str) -> DataFrame:
    """Distinct values a slicer offers."""
    table, column = split_field(name)
    return star.source(table).select(column).distinct()
