from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from reqmart.functions import fixed_values as fixed
from reqmart.plans import refresh as runs
from reqmart.plans.ledger import request_ledger
from reqmart.sources.store import ReportStore
from tests import sample
from tests.conftest import rows

LIVE = {"cogs", "cogs_model", "gpi", "gpi_model", "request_params", "process_time", "dates_dim"}
REQUEST = fixed.REPORT_KEYS


@pytest.fixture(scope="module")
def first_run(spark):
    """A store after its first run, for tests that only read it."""
    first = ReportStore(spark, "first_run")
    first.result = runs.refresh(first, sample.refresh_inputs(spark))
    yield first
    spark.sql("DROP DATABASE first_run CASCADE")


def contents(store, name):
    df = store.read(name)
    return rows(df.select(*sorted(c for c in df.columns if c != "current_timestamp")))


def test_first_run_writes_all_reports(first_run):
    store, result = first_run, first_run.result
    assert set(result.written) == LIVE == store.names()
    # p2 has no client, p3's task and p4's type do not belong; h1 comes from the history.
    assert rows(store.read("cogs").select(*REQUEST).distinct()) == [
        ("h1", "r1", "UW1"), ("p1", "r1", "UW1"), ("p1", "r2", "UW1"),
    ]
    assert rows(store.read("process_time"), *fixed.LEDGER_KEYS) == [
        ("h1", "r1", "UW1"), ("p1", "r1", "UW1"), ("p1", "r2", "UW1"),
    ]
    assert store.read("dates_dim").count() == 36525
    assert "current_timestamp" in store.read("cogs").columns
    source, report, matched = result.reconciliation.first()
    assert (source, report, matched) == (4, 4, True)


def test_sums_equal_the_facts(first_run):
    """Doubled lookup rows and ambiguous codes never multiply facts."""
    store = first_run
    for dataset in ("PBM", "MS"):
        report = store.read("cogs").where(F.col("dataset_identifier") == dataset)
        assert rows(report.groupBy("parent_request_id").agg(F.sum("sum_awp_cogs"), F.sum("sum_claims_cogs"))) == [
            ("h1", 70.0, 7.0), ("p1", 150.0, 15.0),
        ]
        drugs = store.read("gpi").where(F.col("dataset_identifier") == dataset)
        # The history's parameters are recent enough, too.
        assert rows(drugs.groupBy("parent_request_id").agg(F.sum("total_awp"))) == [("h1", 70.0), ("p1", 150.0)]


def test_cogs_details(first_run):
    store = first_run
    report = store.read("cogs").where("parent_request_id = 'p1'")
    pbm = rows(report.where("dataset_identifier = 'PBM'"), "req_gid", "proj_network_type", "genbrand", "ldd_flag", "sum_awp_cogs")
    assert pbm == [
        ("r1", "PRIMARY", "B", "LDD_WACCESS", 10.0),
        ("r1", "SECONDARY", "G", "LDD_WOACCESS", 30.0),
        ("r1", "TERTIARY", "B", "LDD_WACCESS", 20.0),
        ("r2", "SECONDARY", "G", "N", 50.0),
        ("r2", "TERTIARY", "G", "N", 40.0),
    ]
    first = report.first()
    assert first["client_id"] == first["super_client_id"] == "Acme"
    assert first["cogs_network_type"] == "Open Formulary // Broad Network"
    assert first["prop_ntwrk"] == "one // two"
    assert first["prop_frmly_name"] == "First"


def test_gpi_details(first_run):
    store = first_run
    drugs = store.read("gpi").where("parent_request_id = 'p1' and dataset_identifier = 'MS' and req_gid = 'r1'")
    assert rows(drugs, "gpi_class", "ldd_flag", "total_awp") == [
        (None, "LDD_WOACCESS", 30.0), ("c1", "LDD_WACCESS", 10.0), ("c1", "LDD_WACCESS", 20.0),
    ]
    row = drugs.first()
    assert (row["non_specialty"], row["specialty"], row["primary"]) == ("Standard", "Choice", "One")
    assert str(row["forecast_start_date"]) == "2024-01-01"
    assert rows(store.read("gpi").where("req_gid = 'r2'").select("client_id").distinct()) == [("",)]
    named = store.read("gpi_model").select("drug_name").distinct()
    assert rows(named) == [("UNKNOWN",)]


def test_model_networks(first_run):
    store = first_run
    got = rows(store.read("cogs_model"), "m_scenario_id", "proj_network_type", "proj_network_nm", "ldd_tbl_flag", "prop_frmly_name")
    assert got == sorted(
        [
            ("s1", "PRIMARY", "n1", "Exclude", "First"),
            ("s1", "SECONDARY", "n2", "Include", "First"),
            ("s1", "TERTIARY", "n3", "Exclude", "First"),
            ("s1", "TERTIARY", "n4", "Exclude", "First"),
            ("s1", "TERTIARY", None, "Exclude", "First"),
            ("s2", "SECONDARY", "n2", "Include", "Other"),
            ("s2", "TERTIARY", "n3", "Include", "Other"),
            ("s2", "TERTIARY", "n4", "Include", "Other"),
            ("s2", "TERTIARY", None, "Include", "Other"),
        ],
        key=lambda r: tuple((v is not None, str(v)) for v in r),
    )


def test_nothing_new_stops_the_run(spark, first_run):
    before = contents(first_run, "cogs")
    again = runs.refresh(first_run, sample.refresh_inputs(spark))
    assert again.written == [] and again.reconciliation is None
    assert contents(first_run, "cogs") == before


def test_late_request_is_added_as_in_one_run(spark, store, first_run):
    runs.refresh(store, sample.refresh_inputs(spark, 1))
    result = runs.refresh(store, sample.refresh_inputs(spark, 2))
    assert set(result.written) == LIVE - {"dates_dim"}
    before, after = contents(first_run, "cogs"), contents(store, "cogs")
    assert set(before) < set(after) and len(after) == len(before) + 2
    assert ("p5", "r1", "UW1") in rows(store.read("process_time"), *fixed.LEDGER_KEYS)
    assert "s5" in {r["m_scenario_id"] for r in store.read("cogs_model").collect()}

    whole = ReportStore(spark, store.database + "_whole")
    try:
        runs.refresh(whole, sample.refresh_inputs(spark, 2))
        for name in LIVE:
            assert contents(store, name) == contents(whole, name), name
    finally:
        spark.sql(f"DROP DATABASE {whole.database} CASCADE")


def test_new_scenario_alone_is_taken(spark, store):
    """No new request, one new scenario: only the model reports are written."""
    inputs = sample.refresh_inputs(spark, 1)
    inputs.models = inputs.models.where("scenario_id = 's2'")
    runs.refresh(store, inputs)
    inputs.models = sample.models(spark)
    assert runs.refresh(store, inputs).written == ["cogs_model", "gpi_model"]


def test_repeated_run_replaces_the_rows_of_its_keys(spark, store, first_run):
    """As after a run that failed before the ledger was stored, or a reset. A key that has no rows any
    more loses its old ones."""
    runs.refresh(store, sample.refresh_inputs(spark))
    result = runs.reset_and_refresh(store, sample.refresh_inputs(spark))
    assert "cogs" in result.written and "process_time" in result.written
    for name in LIVE:
        assert contents(store, name) == contents(first_run, name), name

    fewer = [f for f in sample.FACTS if f[1] != "r2"]
    runs.reset_and_refresh(store, sample.refresh_inputs(spark, facts=sample.facts(spark, fewer)))
    assert store.read("cogs").where("req_gid = 'r2'").isEmpty()
    assert store.read("gpi").where("req_gid = 'r2'").isEmpty()
    assert not store.read("cogs").where("req_gid = 'r1'").isEmpty()


def test_plain_append_mode(spark, store):
    runs.refresh(store, sample.refresh_inputs(spark), replace=False)
    before = len(contents(store, "cogs"))
    store.drop("process_time")
    runs.refresh(store, sample.refresh_inputs(spark), replace=False)
    assert len(contents(store, "cogs")) == 2 * before


def test_ledger_times(spark):
    ledger = request_ledger(sample.history(spark), sample.log(spark), sample.params(spark), sample.REGULAR)
    old = ledger.where("uw_req_id = 'h1'").first()
    assert (old["funcdata"], old["prcs_tot_sec"], old["prcs_time"]) == ("1-3630", 90030, "25:1:30")
    new = ledger.where("uw_req_id = 'p1' and req_gid = 'r1'").first()
    # Loaded after texts of the clock are trusted: total from the text, the rest from the times.
    assert (new["prcs_tot_sec"], new["prcs_days"], new["funcsec"]) == (3723, 2, 10800)
    assert new["modified_date"] == "2024-01-04 15:00:00"
    legacy = request_ledger(
        sample.history(spark), sample.log(spark), sample.params(spark), sample.REGULAR, legacy_12h=True
    )
    assert legacy.where("uw_req_id = 'p1'").first()["modified_date"] == "2024-01-04 03:00:00"


def test_ledger_negative_and_unknown_times(spark):
    history = sample.history(spark).withColumns(
        {"modified_date": F.lit("2020-01-01 09:59:59"), "req_id": F.lit("back")}
    ).unionByName(sample.history(spark).withColumn("modified_date", F.lit(None).cast("string")))
    ledger = request_ledger(history, sample.log(spark), sample.params(spark), sample.REGULAR)
    back = ledger.where("req_gid = 'back'").first()
    assert (back["funcdata"], back["prcs_tot_sec"], back["prcs_days"], back["funcsec"]) == ("-1-86399", -1, -1, 86399)
    unknown = ledger.where("uw_req_id = 'h1' and req_gid = 'r1'").first()
    assert (unknown["funcdata"], unknown["prcs_tot_sec"]) == (None, 9000)


def test_shares_full_and_incremental(spark, store):
    everything = sample.share_inputs(spark)
    runs.refresh_shares(store, everything)
    full = contents_of_shares(store)
    assert {(r[0], r[1]) for r in full} == {("s1", "p1"), ("s2", "p2")}
    runs.refresh_shares(store, everything)
    assert contents_of_shares(store) == full
    assert dict(store.read("market_share").dtypes)["proj_year"] == "int"

    store.drop("market_share")
    some = sample.share_inputs(spark, [p for p in sample.PARAMETERS if p[0] == "s2"])
    runs.refresh_new_shares(store, some)
    assert {(r[0], r[1]) for r in contents_of_shares(store)} == {("s2", "p2")}
    runs.refresh_new_shares(store, everything)
    assert contents_of_shares(store) == full
    runs.refresh_new_shares(store, everything)
    assert contents_of_shares(store) == full


def contents_of_shares(store):
    return rows(
        store.read("market_share"), "scenario_id", "uw_req_id", "proj_year", "pharmacy", "rxs", "with_ees",
        "ce_created_at", "load_timestamp",
    )


@pytest.fixture
def optional_inputs(spark):
    """Inputs of the reports that only run where their tables are given."""
    from reqmart.star import inputs as star
    from tests.conftest import SF_DIR

    def some(df, request="req_gid"):
        keyed = df.withColumns({"parent_request_id": F.lit("p1"), request: F.lit("r1"), "task_id": F.lit("UW1")})
        return keyed.where("prop_frmly_id = 'F1'") if "prop_frmly_id" in df.columns else keyed.where("state = 'ST3'")

    shifted = some(star.shifted_claims(spark, SF_DIR))
    tags = some(star.claims_tags(spark, SF_DIR), "request_id")
    preshift = some(star.shifted_claims(spark, SF_DIR).withColumnRenamed("req_gid", "request_id"), "request_id")
    return {
        "claims_tags": tags, "claims_preshift": preshift, "formulary_shifted": shifted, "house_shifted": shifted,
        "dispensed_shifted": shifted, "market_shifted": shifted, "generic_launches": shifted,
    }


def test_optional_reports_run_where_their_inputs_are_given(spark, store, optional_inputs):
    inputs = sample.refresh_inputs(spark, facts=None, **optional_inputs)
    result = runs.refresh(store, inputs)
    assert set(result.written) == {r.name for r in runs.REPORTS} - {"cogs", "gpi"} | {
        "request_params", "process_time", "dates_dim",
    }
    before = contents(store, "generic_launches")
    assert before
    runs.reset_and_refresh(store, inputs)
    assert contents(store, "generic_launches") == before
