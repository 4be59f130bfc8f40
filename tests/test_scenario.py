"""Scenario settings from payloads as they may come."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from reqmart.plans import mshare, scenario
from tests import sample
from tests.conftest import rows


def indexes(spark, payload):
    df = sample.parameters(spark, [("s", "r", "Complete", 1, payload)])
    return tuple(scenario.json_year_index(df).select("yr1_index", "yr2_index", "yr3_index", "yr0_index").first())


def years(*numbers):
    return '{"scenario": {"projected_years": [%s]}}' % ", ".join('{"year": %s}' % n for n in numbers)


@pytest.mark.parametrize(
    "payload, expected",
    [
        (years(1, 2, 3, 0), (0, 1, 2, 3)),
        (years(0, 3, 1), (2, None, 1, 0)),
        (years(2, 1, 2, 1), (1, 0, None, None)),
        (years(5, 6, 7, 8, 1), (4, None, None, None)),
        (years(4, 5, 6, 2, 1), (4, 3, None, None)),
        (years('"1"', '"x"', "null", '"0"'), (0, None, None, 3)),
        (years(), (None, None, None, None)),
        ('{"scenario": {}}', (None, None, None, None)),
        ('{"scenario": {"projected_years": null}}', (None, None, None, None)),
        ("no json", (None, None, None, None)),
        (None, (None, None, None, None)),
    ],
)
def test_year_positions(spark, payload, expected):
    assert indexes(spark, payload) == expected


@pytest.mark.parametrize("payload", [years(1, 2, 3, 0), years(3, 0), years(2, 1, 2, 1), "no json", years('"1"', 2)])
def test_year_positions_equal_json_paths(spark, payload):
    """The same by extracting each of the four slots from the text."""
    df = spark.createDataFrame([(payload,)], "p string")
    slots = [f"get_json_object(p, '$.scenario.projected_years[{i}].year')" for i in range(4)]
    by_path = tuple(
        df.selectExpr(f"coalesce({', '.join(f'if({s} = {y}, {i}, null)' for i, s in enumerate(slots))})").first()[0]
        for y in (1, 2, 3, 0)
    )
    assert indexes(spark, payload) == by_path


def test_attributes_fall_back_and_stay_text(spark):
    text = """{"scenario": {"projected_years": [
        {"year": 1, "network_pricing_groups": [{"network_guid": "N"}, {"network_guid": "other"}],
         "rebate_pricing_groups": [{"formulary_guid": "R"}], "specialty_pricing_groups": [{"with_ees": true}]},
        {"year": 2, "network_pricing_groups": [], "specialty_pricing_groups": null},
        {"year": 2, "network_pricing_groups": [{"network_guid": "second"}]}]}}"""
    df = scenario.scenario_attributes(sample.parameters(spark, [("s", "r", "Complete", 1, text)]))
    row = df.first()
    assert (row["yr1_network_guid"], row["yr1_formulary_guid"], row["yr1_with_ees"]) == ("N", "R", "true")
    assert (row["yr2_network_guid"], row["yr2_formulary_guid"], row["yr2_with_ees"]) == (None, None, None)
    assert row["yr1_col_name"] == "std_w_ees_excl_ond_id"
    assert row["yr2_col_name"] == row["yr3_col_name"] == "std_wo_ees_excl_ond_id"


def test_measure_names(spark):
    """All settings, unknown ones included, against the rule written out."""
    values = [True, False, None]
    cases = list(itertools.product(values, repeat=4))
    df = spark.createDataFrame(
        [tuple(None if v is None else str(v).lower() for v in c) for c in cases],
        "with_ees string, open_specialty_arrangement string, ondansetron string, enoxaparin string",
    )
    name = scenario.measure_name({c: F.col(c) for c in df.columns})
    got = {tuple(r[:4]): r[4] for r in df.withColumn("name", name).collect()}
    assert set(got.values()) == set(scenario.MEASURE_NAMES)
    for ees, opened, ond, eno in cases:
        drugs = {(True, True): "eno_ond", (False, False): "none", (False, True): "eno"}.get((ond, eno), "ond")
        expected = f"std_{'w' if ees else 'wo'}_ees_{'open' if opened else 'excl'}_{drugs}_id"
        key = tuple(None if v is None else str(v).lower() for v in (ees, opened, ond, eno))
        assert got[key] == expected


def test_latest_request_per_scenario(spark):
    inputs = sample.share_inputs(spark)
    latest = scenario.latest_requests(inputs.parameters, inputs.params)
    # s1 has two requests, the later load wins; s3 failed; a parent's two request rows add nothing.
    assert rows(latest, "scenario_id", "uw_req_id") == [("s1", "p1"), ("s2", "p2")]
    tied = inputs.params.withColumn("inp_load_ts", F.lit(sample.day(9)))
    same_day = inputs.parameters.withColumn("created_at", F.lit(sample.day(8)))
    both = scenario.latest_requests(same_day, tied)
    assert rows(both, "scenario_id", "uw_req_id") == [("s1", "p0"), ("s1", "p1"), ("s2", "p2")]


def test_unknown_status_counts_as_failed(spark):
    inputs = sample.share_inputs(spark)
    unknown = inputs.parameters.withColumn("status", F.lit(None).cast("string"))
    assert scenario.latest_requests(unknown, inputs.params).isEmpty()


def test_detail_equals_join_on_the_unpivoted_name(spark):
    inputs = sample.share_inputs(spark)
    sums = mshare.revenue_sums(inputs.revenue)
    settings = scenario.scenario_settings(inputs.parameters, inputs.params)
    detail = mshare.mshare_detail(sums, settings)
    long = mshare.revenue_measures(sums).withColumnRenamed("col0", "col_name")
    joined = long.join(settings.drop("opportunity_id"), [*mshare.SETTING_KEYS, "col_name"])
    expected = joined.groupBy("scenario_id", "uw_req_id", "proj_year", "with_ees").agg(F.sum("col1"))
    assert rows(detail.select("scenario_id", "uw_req_id", "proj_year", "with_ees", "rxs")) == rows(expected)
    assert len(rows(expected)) > 0


def test_claims_with_an_unknown_part_count_nothing(spark):
    inputs = sample.share_inputs(spark)
    holed = inputs.buckets.withColumn("incl_brand_claims", F.expr("if(proj_year = '1', null, 2d)"))
    claims = mshare.share_claims(holed, inputs.specialty, "HOUSE").where("pharmacy = 'PB' and scenario_id = 's2'")
    assert rows(claims, "proj_year", "rxs") == [("1", None), ("2", 15.0)]
