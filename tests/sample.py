"""A small set of refresh inputs with known results; stages add requests as time goes on."""

from __future__ import annotations

import datetime as dt

from reqmart.plans.refresh import RefreshInputs, ShareInputs
from reqmart.plans.scenario import MEASURE_NAMES

REGULAR = "REGULAR"


def day(n, hour=12):
    return dt.datetime(2024, 1, n, hour)


# (parent, request, task, client, super client, type, load day), by stage.
PARAMS = {
    1: [
        ("p1", "r1", "UW1", "Acme", None, None, 2),
        ("p1", "r2", "UW1", "Acme", "", REGULAR, 2),
        ("p2", "r1", "UW1", None, "S", REGULAR, 3),
        ("p3", "r1", "QA1", "Beta", "S", REGULAR, 3),
        ("p4", "r1", "UW1", "Beta", "S", "TRIAL", 3),
        ("h1", "r1", "UW1", "Old", "O", REGULAR, 1),
    ],
    2: [("p5", "r1", "UW1", "Core", "C", REGULAR, 5)],
}
# (parent, request ids, task, status), by stage.
LOG = {
    1: [
        ("p1", "r1_r2_r9", "UW1", "COMPLETE"), ("p2", "r1", "UW1", "COMPLETE"), ("p3", "r1", "QA1", "COMPLETE"),
        ("p4", "r1", "UW1", "COMPLETE"), ("p5", "r1", "UW1", "RUNNING"),
    ],
    2: [("p5", "r1", "UW1", "COMPLETE")],
}
FACTS = [
    # parent, request, lob, code, days, network, flag of pbm, of mony, awp, claims
    ("p1", "r1", "STD", "d1", 44, "net", "B", "G", 10.0, 1.0),
    ("p1", "r1", "STD", "d1", 45, "net", "B", "G", 20.0, 2.0),
    ("p1", "r1", "STD", "d2", 46, "net", "G", "G", 30.0, 3.0),
    ("p1", "r2", "WRAP", "d3", 44, "a-b", "G", "B", 40.0, 4.0),
    ("p1", "r2", "WRAP", "d9", 46, "net", "G", "B", 50.0, 5.0),
    ("p2", "r1", "STD", "d1", 44, "net", "B", "B", 60.0, 6.0),
    ("h1", "r1", "STD", "d1", 44, "net", "B", "B", 70.0, 7.0),
    ("p5", "r1", "STD", "d1", 44, "net", "B", "B", 80.0, 8.0),
    ("p1", "r1", "STD", "d1", 44, "net", "B", "G", 0.0, 9.0),
]


def upto(staged, stage):
    return [row for s in range(1, stage + 1) for row in staged.get(s, [])]


def params(spark, stage=1):
    data = [
        (*r[:5], f"OPP-{r[0]}", r[5], day(r[6]), dt.date(2024, 1, 1)) for r in upto(PARAMS, stage)
    ]
    return spark.createDataFrame(
        data,
        """parent_request_id string, request_id string, task_id string, client_description string,
           super_client_id string, opportunity_id string, data_request_type string, inp_load_ts timestamp,
           project_start_year date""",
    )


def log(spark, stage=1):
    data = [(*r[:3], day(4), day(4, 15), r[3], "1:02:03.5") for r in upto(LOG, stage)]
    return spark.createDataFrame(
        data,
        """parent_req_id string, request_id string, task_id string, start_dttm timestamp, end_dttm timestamp,
           status string, elapsed_time string""",
    )


def history(spark):
    return spark.createDataFrame(
        [("Old", "h1", "r1", "UW1", "2020-01-01 10:00:00", "2020-01-02 11:00:30", "2020-01-01 10:00:00", "COMPLETE")],
        """client_description string, parent_req_id string, req_id string, task_id string, create_date string,
           modified_date string, inp_load_ts string, status string""",
    )


def facts(spark, data=FACTS):
    columns = """parent_request_id string, request_id string, lob string, ndc string, day_sply_qty int,
                 proj_network_nm string, bg_pbmmon_mod string, bg_mony_mod string, awp double, claims_count double"""
    zero = "cob cmpnd mc spec_cmk_ind chnl_mail_mod chnl_spec spec_drg spec_univ".split()
    texts = {
        "task_id": "UW1", "formulary_id": "F1", "formulary_guid": "FG", "network_guid": "NG",
        "primary_ntwrk": "one", "secondary_ntwrk": "two", "tertiary_ntwrk": "", "phmcy_chain_nm": "chain",
        "phmcy_st": "TX", "srx_shift_type": "NO SHIFT", "model_drug": "", "formulary_nm": "plan",
        "spec_lock_ees": "Y", "spec_lock_no_ees": "N",
    }
    costs = [
        f"cogs_{kind}_{way}_{data_set}".replace("cogs_fee", "cogs_dispns_fee")
        for kind in ("fee", "cost")
        for way in ("trad", "trans")
        for data_set in ("pbm", "medi")
    ]
    costs = [c.replace("cogs_cost_", "cogs_") for c in costs]
    return spark.createDataFrame(data, columns).selectExpr(
        "*",
        "concat('OPP-', parent_request_id) opportunity_id",
        "2024 prjctd_year", "1 prjctd_yr", "1 is_capped", "1 chnl_ret_mod", "awp * 2 wac",
        *(f"0 {c}" for c in zero),
        *(f"'{v}' {k}" for k, v in texts.items()),
        *(f"awp * {n + 1} {c}" for n, c in enumerate(costs)),
    )


def request_tables(spark, stage=1):
    requests = params(spark, stage).select("parent_request_id", "request_id", "task_id")
    network = requests.selectExpr(
        "*", "'broad' type", "'one' primary", "'two' secondary", "'NG' network_guid"
    )
    formulary = requests.selectExpr(
        "*", "'FG' formulary_guid", "'open' type", "'STANDARD' non_specialty", "'choice' specialty"
    )
    return network.union(network), formulary.union(formulary)


def masters(spark):
    names = spark.createDataFrame([("F1", "First"), ("F1", "First"), ("F2", "Second")], "formulary_id string, formulary_name string")
    specialty = spark.createDataFrame(
        [("d1", "Y", "N"), ("d2", "N", "Y"), ("d3", "N", "Y"), ("d3", "Y", "N"), ("d4", "N", "N")],
        "ndc11 string, ldd_waccess string, ldd_woaccess string",
    )
    drugs = spark.createDataFrame(
        [("d1", "c1", "k1", "g1"), ("d2", "c2", "k2", "g2"), ("d2", "c2", "k2", "g2")],
        "ndc11 string, gpi_class string, gpi_categ string, gpi_group string",
    )
    return names, specialty, drugs


def models(spark, stage=1):
    """One scenario for r1 facts of p1 in both datasets, and from stage 2 one for p5."""
    data = [("p1", "s1", "PBM", "STD", "First"), ("p1", "s2", "MS", "WRAP", "Other")]
    if stage > 1:
        data.append(("p5", "s5", "PBM", "STD", "First"))
    df = spark.createDataFrame(
        data,
        """data_request_id string, scenario_id string, pusedo_brand_generic_definition string,
           business_type string, formulary string""",
    )
    return df.join(
        params(spark, stage).selectExpr(
            "parent_request_id data_request_id", "from_utc_timestamp(inp_load_ts, 'America/Chicago') submit_date_cst"
        ).distinct(),
        "data_request_id",
    ).selectExpr(
        "*", "concat('OPP-', data_request_id) opportunity_id", "'UW1' task_id", "'bt' business_type_id",
        "'def' brand_generic_definition", "'FG' formulary_guid", "'NG' network_guid", "'BROAD' type",
        "'x' ldd_flag", "'LDD w/ Access Only' ldd_option", "'trad' pricing_type", "'n1' primary_network",
        "'n2' secondary_network", "'n3' network_3", "'n4' network_4", "string(null) network_5",
        "'n3' network_6", "string(null) network_7",
    )


def refresh_inputs(spark, stage=1, **changes):
    network, formulary = request_tables(spark, stage)
    names, specialty, drugs = masters(spark)
    return RefreshInputs(
        **{
            "history": history(spark),
            "log": log(spark, stage),
            "params": params(spark, stage),
            "request_type": REGULAR,
            "facts": facts(spark),
            "formulary_list": names,
            "network": network,
            "formulary": formulary,
            "specialty_master": specialty,
            "drug_master": drugs,
            "models": models(spark, stage),
            **changes,
        }
    )


def payload(*years):
    """JSON text of projected years, each (number, network guid, formulary guid, settings text)."""
    parts = (
        '{"year": %s, "network_pricing_groups": [{"network_guid": "%s", "formulary_guid": "%s"}],'
        ' "rebate_pricing_groups": [{"formulary_guid": "R"}], "specialty_pricing_groups": [{%s}]}' % y
        for y in years
    )
    return '{"scenario": {"projected_years": [%s]}}' % ", ".join(parts)


ON = '"with_ees": true, "open_specialty_arrangement": true, "ondansetron": true, "enoxaparin": true'
OFF = '"with_ees": false, "open_specialty_arrangement": false, "ondansetron": false, "enoxaparin": false'
# scenario, request, status, created day, payload
PARAMETERS = [
    ("s1", "p1", "Complete", 2, payload((1, "N1", "F1", ON), (2, "N1", "F1", OFF))),
    ("s1", "p0", "Complete", 1, payload((1, "N1", "F1", OFF))),
    ("s2", "p2", "Complete", 3, payload((1, "N1", "F1", OFF))),
    ("s3", "p4", "Failed", 3, payload((1, "N1", "F1", ON))),
]


def parameters(spark, data=PARAMETERS):
    return spark.createDataFrame(
        [(s, r, f"OPP-{s}", status, day(d), day(d + 1), p) for s, r, status, d, p in data],
        """scenario_id string, uw_req_id string, opportunity_id string, status string, created_at timestamp,
           load_ts timestamp, request_payload string""",
    )


def share_inputs(spark, data=PARAMETERS):
    requests = sorted({(s, r) for s, r, *_ in data})
    revenue = spark.createDataFrame(
        [(r, s, f"OPP-{s}", y, float(s[1:])) for s, r in requests for y in "12"],
        "uw_req_id string, scenario_id string, opportunity_id string, proj_year string, num_claims double",
    ).selectExpr(
        "*", "'chain' pharmacy_group", "'PB' pharmacy_bucket", "'G' srx_pricing_group_id", "'N1' network_guid",
        "'F1' formulary_guid", "'bt' business_type_id",
        *(f"{'string(null)' if n % 3 == 2 else repr('SPECIALTY')} {m}" for n, m in enumerate(MEASURE_NAMES)),
    )
    keys = ["scenario_id", "uw_req_id", "proj_year", "opportunity_id", "business_type_id"]
    buckets = revenue.selectExpr(
        *keys, "'PB' pharmacy_bucket", "'SRx at retail' channel_group", "1d excl_brand_claims", "2d incl_brand_claims",
        "3d excl_generic_claims", "4d incl_generic_claims", "5d incl_nonmac_claims",
    )
    specialty = revenue.selectExpr(*keys, "num_claims * 10 total_claims")
    loads = spark.createDataFrame(
        [(r, f"r{n}", day(5 if r == "p1" else 4)) for _, r in requests for n in (1, 2)],
        "parent_request_id string, request_id string, inp_load_ts timestamp",
    )
    return ShareInputs(parameters(spark, data), loads, revenue, buckets, specialty, "HOUSE")
