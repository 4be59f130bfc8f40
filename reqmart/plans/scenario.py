"""Scenario settings: from the JSON payload to one row per scenario and projected year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from reqmart.functions import fixed_values as fixed
from reqmart.operators.aggregates import latest_per_key
from reqmart.operators.keys import same_key
from reqmart.operators.lookups import distinct_lookup
from reqmart.operators.reshape import unpivot_groups

# Leaves are declared as text: that is how they are compared and put out.
PAYLOAD_SCHEMA = """
    scenario struct<projected_years: array<struct<
        year: string,
        network_pricing_groups: array<struct<network_guid: string, formulary_guid: string>>,
        rebate_pricing_groups: array<struct<formulary_guid: string>>,
        specialty_pricing_groups: array<struct<
            with_ees: string, open_specialty_arrangement: string, ondansetron: string, enoxaparin: string
        >>
    >>>
"""
SPECIALTY_SETTINGS = ["with_ees", "open_specialty_arrangement", "ondansetron", "enoxaparin"]
ATTRIBUTES = ["network_guid", "formulary_guid", *SPECIALTY_SETTINGS, "col_name"]
UNPIVOT_IDS = ["opportunity_id", "uw_req_id", "scenario_id", "created_at", "load_ts"]
MEASURE_NAMES = [
    f"std_{ees}_{access}_{drugs}_id"
    for drugs in ("none", "ond", "eno", "eno_ond")
    for access in ("open", "excl")
    for ees in ("wo_ees", "w_ees")
]


def projected_years(payload: Column) -> Column:
    """All projected years of the payload, parsed once."""
    return F.from_json(payload, PAYLOAD_SCHEMA)["scenario"]["projected_years"]


def _year_number(element: Column) -> Column:
    return element["year"].try_cast("int")


def year_index(years: Column, year: int) -> Column:
    """Position, from 0, of the first element for ``year``; null if there is none."""
    place = F.array_position(F.transform(years, _year_number), F.lit(year))
    return F.nullif(place, F.lit(0).cast("bigint")).cast("int") - 1


def json_year_index(parameters: DataFrame) -> DataFrame:
    """Parameters with the position of each projected year in their payload."""
    parsed = parameters.withColumn("years", projected_years(F.col("request_payload")))
    return parsed.withColumns(
        {f"yr{y}_index": year_index(F.col("years"), y) for y in fixed.PROJECTED_YEARS}
    ).drop("years")


def measure_name(settings: dict[str, Column]) -> Column:
    """Name of the revenue column that the specialty settings select.

    Unknown settings count as without EES, exclusive, and, if one drug's is unknown, as ``ond``.
    """
    on = {name: value.try_cast("boolean") for name, value in settings.items()}
    off = {name: ~value for name, value in on.items()}
    drugs = (
        F.when(on["ondansetron"] & on["enoxaparin"], "eno_ond")
        .when(off["ondansetron"] & off["enoxaparin"], "none")
        .when(off["ondansetron"] & on["enoxaparin"], "eno")
        .otherwise("ond")
    )
    return F.concat_ws(
        "_",
        F.lit("std"),
        F.when(on["with_ees"], "w_ees").otherwise("wo_ees"),
        F.when(on["open_specialty_arrangement"], "open").otherwise("excl"),
        drugs,
        F.lit("id"),
    )


def _element_of(years: Column, year: int) -> Column:
    """The first element for ``year``; null if there is none."""
    return F.get(F.filter(years, lambda element: _year_number(element) == year), 0)


def _attributes(element: Column) -> list[Column]:
    """Attributes of one projected year, each from the first group of its kind."""
    network = F.get(element["network_pricing_groups"], 0)
    rebate = F.get(element["rebate_pricing_groups"], 0)
    specialty = F.get(element["specialty_pricing_groups"], 0)
    settings = {name: specialty[name] for name in SPECIALTY_SETTINGS}
    return [
        network["network_guid"],
        F.coalesce(network["formulary_guid"], rebate["formulary_guid"]),
        *settings.values(),
        measure_name(settings),
    ]


def scenario_attributes(parameters: DataFrame) -> DataFrame:
    """Parameters with ``yr<n>_<attribute>`` columns for the projected years 1, 2, 3 and 0.

    A missing formulary of the network group is taken from the rebate group. The payload is parsed
    once and each year looked up once: both stand in columns of their own, which Spark does not
    repeat for every use.
    """
    parsed = parameters.withColumn("years", projected_years(F.col("request_payload")))
    found = parsed.withColumns(
        {f"yr{y}": _element_of(F.col("years"), y) for y in fixed.PROJECTED_YEARS}
    )
    return found.select(
        *parameters.columns,
        *(
            value.alias(f"yr{y}_{name}")
            for y in fixed.PROJECTED_YEARS
            for name, value in zip(ATTRIBUTES, _attributes(F.col(f"yr{y}")))
        ),
    )


def latest_requests(parameters: DataFrame, params: DataFrame) -> DataFrame:
    """Parameters of each scenario's latest request that did not fail; ties all stay.

    A request joins once for each distinct load time, so equal rows of the request table (one per
    request id of a parent) do not multiply the scenario. The winners are found on narrow columns;
    payloads are fetched by one join.
    """
    loads = params.select(F.col("parent_request_id").alias("uw_req_id"), "inp_load_ts").distinct()
    usable = parameters.where(F.col("status") != fixed.FAILED)
    ids = ["uw_req_id", "scenario_id", "created_at"]
    requests = usable.select(*ids).distinct().join(loads, "uw_req_id")
    winners = latest_per_key(requests, ["scenario_id"], ["inp_load_ts", "created_at"])
    winners = winners.withColumnsRenamed({c: f"won_{c}" for c in ids})
    fetched = usable.join(winners, same_key(usable, winners, {c: f"won_{c}" for c in ids}))
    return fetched.select(*(usable[c] for c in usable.columns), "inp_load_ts")


def scenario_years(latest: DataFrame) -> DataFrame:
    """One row per scenario and projected year with its attributes."""
    groups = {str(y): [f"yr{y}_{a}" for a in ATTRIBUTES] for y in fixed.PROJECTED_YEARS}
    rows = unpivot_groups(latest, UNPIVOT_IDS, "proj_year", groups, ATTRIBUTES)
    return rows.distinct()


def scenario_settings(parameters: DataFrame, params: DataFrame) -> DataFrame:
    """From raw parameters to one row per latest request and projected year.

    The latest requests are found first, so only their payloads are parsed.
    """
    return scenario_years(scenario_attributes(latest_requests(parameters, params)))


def unreported(parameters: DataFrame, reported: DataFrame) -> DataFrame:
    """Parameters of scenarios that are not reported yet and did not fail.

    Repeated rows are left in: they fall together when the projected years are made distinct, which
    spares a shuffle of the payloads.
    """
    fresh = parameters.where(F.col("status") != fixed.FAILED)
    return fresh.join(distinct_lookup(reported, ["scenario_id"]), "scenario_id", "left_anti")
