"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from reqmart.plans import cogs, model
from reqmart.star import inputs as star
from reqmart.star.queries import QUERIES
from tests.conftest import SF_DIR


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_pairs_no_group_in_one_task(spark, setting, name):
    """With broadcasts off, as when no side is small."""
    # Broadcasts are left to Spark; without them every join has to stand as a shuffle.
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    text = plan(QUERIES[name](spark, SF_DIR))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
        assert bad not in text, bad
    # The one window runs over a request's few aggregated summary rows.
    assert name == "summary_metrics" or "Window" not in text
    assert "SinglePartition" not in text or name in ("reconcile", "request_reconciliation", "dates_dim")


def test_cost_report_reads_facts_once_and_pruned(spark, tmp_path):
    """From a fact table: filters reach the scan, and only needed columns of one scan are read."""
    path = str(tmp_path / "facts")
    wide = star.claim_output(spark, SF_DIR).selectExpr("*", "'x' unused_one", "'y' unused_two")
    wide.write.parquet(path)
    from reqmart.star.queries import delta

    report = cogs.cogs_report(
        spark.read.parquet(path),
        delta(spark, SF_DIR),
        star.request_params(spark, SF_DIR),
        star.formulary_list(spark, SF_DIR),
        star.request_network(spark, SF_DIR),
        star.request_formulary(spark, SF_DIR),
        star.specialty_master(spark, SF_DIR),
    )
    text = report._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    scans = [s for s in re.split(r"\n\n+", text) if s.startswith("(") and "Scan parquet" in s and path in s]
    assert len(scans) == 1
    pushed = re.search(r"PushedFilters: \[(.*)\]", scans[0]).group(1)
    for column in ("cob", "cmpnd", "mc", "spec_cmk_ind", "chnl_mail_mod"):
        assert f"EqualTo({column},0)" in pushed
    for column in ("awp", "wac", "claims_count"):
        assert f"GreaterThan({column},0.0)" in pushed
    schema = re.search(r"ReadSchema: (.*)", scans[0]).group(1)
    assert "unused" not in schema and "model_drug" not in schema and "chnl_spec" not in schema


def test_only_partitions_of_new_requests_are_read(spark, store):
    """Of a fact table that is partitioned by request."""
    from reqmart.operators.keys import restrict
    from reqmart.session import materialise

    facts = spark.range(0, 400).selectExpr("id v", "concat('p', id % 40) parent_request_id", "'r' request_id")
    facts.write.partitionBy("parent_request_id", "request_id").saveAsTable(store.table("facts"))
    new = spark.createDataFrame([("p3", "r"), ("p5", "r")], "uw_req_id string, req_gid string")
    delta = materialise(new)
    kept = restrict(store.read("facts"), delta, {"parent_request_id": "uw_req_id", "request_id": "req_gid"})
    assert kept.count() == 20
    kept.collect()
    executed = kept._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in executed


def test_only_partitions_of_unseen_scenarios_are_read(spark, store):
    """Of the base report, when asking which scenarios a model report is due for."""
    from reqmart.session import materialise
    from tests import sample

    names = {"opportunity_id", "task_id", "lob", "dataset_identifier", "prop_frmly_name", "type",
             "formulary_guid", "network_guid"}
    report = spark.range(40).selectExpr("concat('p', id) parent_request_id", "timestamp'2024-01-01' submit_date_cst", *(f"'x' {n}" for n in names))
    store.append(report, "base", ["parent_request_id"])
    models = materialise(sample.models(spark, 1))
    wanted = model.matching_scenarios(models, model.unseen_scenarios(models, None), store.read("base"))
    wanted.collect()
    assert "dynamicpruning" in wanted._jdf.queryExecution().executedPlan().toString()


def test_payload_is_parsed_once(spark):
    from reqmart.plans.scenario import scenario_attributes

    source = spark.createDataFrame([("x", "{}")], "id string, request_payload string")
    optimized = scenario_attributes(source)._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("from_json(") == 1


def test_measures_are_picked_without_unpivoting(spark):
    assert "Expand" not in plan(QUERIES["mshare_detail"](spark, SF_DIR))
    combined = plan(QUERIES["mshare_combined"](spark, SF_DIR))
    # Its output holds no revenue sum, so none is computed.
    assert "std_wo_ees_open_none_id" not in combined


def test_summary_metrics_deals_rows_once(spark):
    """The tagged rows, several per prescription, are summed where they are made: no shuffle by tag and prescription."""
    from reqmart.plans import claims

    columns = "parent_request_id req_gid task_id awp wac_amt dayssply genbrand rxnum dlvry_systm_cd mc retail_ds ltc_clm"
    rows = [
        ("P1", "1", "T", 10.0, 20.0, 30, "B", "RX1", "R", "0", 30, "0"),
        ("P1", "1", "T", 30.0, 60.0, 90, "B", "RX1", "R", "1", 90, "0"),
        ("P1", "1", "T", 5.0, 10.0, 10, "G", "RX2", "M", "0", 0, "1"),
        ("P2", "1", "T", 7.0, 14.0, None, "G", "RX1", "R", "0", None, "0"),
    ]
    base = spark.createDataFrame(rows, columns.split())
    summary = claims.summary_metrics(base)
    dealt = [line for line in plan(summary).splitlines() if "Exchange hashpartitioning(" in line]
    assert dealt and not [line for line in dealt if "qc_metrics" in line and "rxnum" in line]
    got = {
        (r.parent_request_id, r.qc_metrics, r.metric, r.genbrand_new): (r.rxnumcnt, r.awp_count, r.totrxnumcnt, r.awptotal)
        for r in summary.collect()
    }
    assert got[("P1", "MAIL/RETAIL", "R", "BRAND")] == (1, 2, 2, 45.0)
    assert got[("P1", "MAIL/RETAIL", "M", "GENERIC")] == (1, 1, 2, 45.0)
    assert got[("P2", "MAIL/RETAIL", "R", "GENERIC")] == (1, 1, 1, 7.0)


def dealt_by(spark, setting, name: str) -> list[str]:
    """The keys of a query's shuffles, with broadcasts off."""
    setting(spark__sql__autoBroadcastJoinThreshold="-1")
    return [re.sub(r"#\d+", "", keys) for keys in re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(QUERIES[name](spark, SF_DIR)))]


def test_claims_are_shuffled_once(spark, setting):
    """By request; the join by claim number takes them as they lie."""
    keys = dealt_by(spark, setting, "claims_base")
    assert keys and not any("claimnbr" in k for k in keys)


def test_summary_is_summed_where_a_request_lies(spark, setting):
    keys = dealt_by(spark, setting, "summary_metrics")
    assert keys and not any("rxnum" in k or "qc_metrics" in k for k in keys)


def test_bucket_shares_are_dealt_once(spark, setting):
    """The rows that are made distinct lie as their join needs them, so only its other side is shuffled for it."""
    keys = dealt_by(spark, setting, "mshare_combined")
    assert sum(k.startswith("scenario_id, uw_req_id, proj_year, opportunity, business_type_id, ") for k in keys) == 1


def test_lines_of_a_scenario_request_are_gathered_narrow(spark):
    gathered = [line for line in plan(star.model_parameters(spark, SF_DIR)).splitlines() if "partial_collect_list" in line]
    assert gathered and not any("network_pricing_groups" in line for line in gathered)
