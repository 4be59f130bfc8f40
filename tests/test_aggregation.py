"""The reports on the star tables merge rows: a request holds many lines, and lookups are small beside the facts."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reqmart.plans import cogs, gpi
from reqmart.star import inputs as star, queries
from reqmart.star.queries import QUERIES
from tests.conftest import SF_DIR


@pytest.mark.parametrize("name", ["top_drugs", "state_counts", "preshift_monthly"])
def test_claims_reports(spark, name):
    claims = queries.tagged_claims(spark, SF_DIR).count()
    assert 0 < QUERIES[name](spark, SF_DIR).count() * 2 <= claims


def test_summary_and_distinct_counts(spark):
    summary = QUERIES["summary_metrics"](spark, SF_DIR)
    assert summary.agg(F.sum("awp_count")).first()[0] >= 2 * summary.count()
    monthly = QUERIES["preshift_monthly"](spark, SF_DIR)
    assert monthly.where("ephcnt_yr > 1 AND ephcount_month > 1 AND clmcount > 1").count() * 2 > monthly.count()


@pytest.mark.parametrize(
    "name", ["shifted_by_flag", "shifted_house", "shifted_market", "shifted_single_pass", "shifted_excl"]
)
def test_shifted_reports(spark, name):
    facts = star.shifted_claims(spark, SF_DIR)
    rows = (facts.where("origclaim <> 'P'") if name == "shifted_excl" else facts).count()
    assert 0 < QUERIES[name](spark, SF_DIR).count() * 2 <= rows


def test_shift_strategy_by_module(spark):
    rows = star.shifted_claims(spark, SF_DIR).count()
    modules = QUERIES["shift_strategy"](spark, SF_DIR).groupBy("module").count().collect()
    assert len(modules) == 5 and all(m["count"] * 2 <= rows for m in modules)


def test_launch_totals_span_rows(spark):
    launches = QUERIES["generic_launches"](spark, SF_DIR)
    groups = launches.select("parent_request_id", "req_gid", "genbrand", "dlvry_systm_cd", "report_month").distinct()
    assert groups.count() * 2 <= launches.count()


@pytest.mark.parametrize("report, claims", [(cogs.cogs_report, "sum_claims_cogs"), (gpi.gpi_report, "claims_count")])
def test_cost_reports(spark, report, claims):
    """With one claim each, the sums count the facts."""
    params = star.request_params(spark, SF_DIR)
    lookups = [
        star.formulary_list(spark, SF_DIR), star.request_network(spark, SF_DIR),
        star.request_formulary(spark, SF_DIR), star.specialty_master(spark, SF_DIR),
    ]
    if report is gpi.gpi_report:
        lookups += [star.drug_master(spark, SF_DIR), star.CUTOFF]
    facts = star.claim_output(spark, SF_DIR).withColumn("claims_count", F.lit(1.0))
    rows = report(facts, queries.delta(spark, SF_DIR, params), params, *lookups)
    found = rows.where("dataset_identifier = 'PBM'").agg(F.count("*"), F.sum(claims)).first()
    assert 0 < found[0] * 2 <= found[1]
    # The drug lookups grow with the parts, not with the facts; the request lookups with the requests.
    assert all(t.count() * 5 < facts.count() for t in lookups[:3])


@pytest.mark.parametrize("doubled", [False, True])
def test_repeated_parameters_alter_no_sum(spark, doubled):
    params = star.request_params(spark, SF_DIR)
    lookups = [f(spark, SF_DIR) for f in (star.formulary_list, star.request_network, star.request_formulary, star.specialty_master)]
    twice = params.unionAll(params) if doubled else params
    rows = cogs.cogs_report(star.claim_output(spark, SF_DIR), queries.delta(spark, SF_DIR, params), twice, *lookups)
    expected = QUERIES["cogs_report"](spark, SF_DIR).agg(F.sum("sum_awp_cogs"), F.count("*")).first()
    assert rows.agg(F.sum("sum_awp_cogs"), F.count("*")).first() == expected


def test_a_request_has_the_same_claims_alone_and_in_a_batch(spark):
    from reqmart.plans import claims

    tags, preshift = star.claims_tags(spark, SF_DIR), star.claims_preshift(spark, SF_DIR)
    delta = queries.delta(spark, SF_DIR)
    batch = claims.claims_base(tags, preshift, delta)
    one = delta.orderBy("uw_req_id", "req_gid").limit(1)
    key = one.first()
    alone = claims.claims_base(tags, preshift, one)
    same = batch.where((F.col("parent_request_id") == key["uw_req_id"]) & (F.col("req_gid") == key["req_gid"]))
    assert alone.count() > 0 and sorted(map(repr, alone.collect())) == sorted(map(repr, same.collect()))
