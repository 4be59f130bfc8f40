"""Report inputs made from the star-schema tables, whole tables each.

A request is made of the order lines of one supplier with one line number: parent = supplier, request =
line number, task by line number. So requests grow in number with the data, not in size. Line 7 has a
task that the log leaves out. Scenario settings belong to orders. Money is in cents and percent, so that
sums are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reqmart.plans.scenario import MEASURE_NAMES

CUTOFF = "1998-01-01"
LATE = "1998-06-01"
CLOCK_FROM = "1999-01-01 00:00:00"
REGULAR = "STANDARD"
SPECIALTY_LABEL = "Specialty"
SPECIALTY_BUCKET = "SPECIALTY"
DRUG_CODES = [f"D{n}" for n in range(8)]
PHARMACIES = [f"P{n}" for n in range(12)]


SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": """p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,
               p_retailprice double""",
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,
                 o_orderdate timestamp_ntz, o_orderpriority string""",
    "lineitem": """l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,
                   l_extendedprice double, l_discount double, l_tax double, l_returnflag string,
                   l_linestatus string, l_shipdate timestamp_ntz""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table by its declared schema, so that no file has to be opened to plan a query."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def tagged(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), text(number))


def bit(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def task_of(line: Column) -> Column:
    return F.when(line == 7, "QA7").when(line <= 3, "UW1").otherwise("UW2")


def price() -> Column:
    """Price in cents."""
    return F.round(F.col("l_extendedprice") * 100)


def discount() -> Column:
    """Discount in percent, 0 to 10."""
    return F.round(F.col("l_discount") * 100)


def tax() -> Column:
    """Tax in percent, 0 to 8."""
    return F.round(F.col("l_tax") * 100)


def request(request_name: str = "request_id") -> dict[str, Column]:
    return {
        "parent_request_id": text("l_suppkey"),
        request_name: text("l_linenumber"),
        "task_id": task_of(F.col("l_linenumber")),
    }


def loaded(supplier: Column) -> Column:
    """When a supplier's requests were loaded: spread over six years."""
    start = F.lit("1995-01-01 00:00:00").cast("timestamp")
    return F.timestamp_add("DAY", (supplier * 997 % 2300).cast("int"), start)


def drug_code(part: Column) -> Column:
    """Two of three neighbouring parts share a code."""
    return tagged("N", part - bit(part % 3 == 1))


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return table(spark, sf_dir, "supplier").withColumns(
        {
            "day": loaded(F.col("s_suppkey")),
            "segment": F.element_at(F.array(*map(F.lit, names)), F.col("s_nationkey") % 5 + 1),
        }
    )


def scenario() -> Column:
    """Ten neighbouring orders share a scenario."""
    return tagged("S", F.floor(F.col("l_orderkey") / 10))


def _select(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    return df.select(*(c.alias(n) for n, c in columns.items()))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem")


def request_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = lines(spark, sf_dir).select("l_suppkey", "l_linenumber").distinct()
    segment = F.col("segment")
    joined = requests.join(suppliers(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
    return _select(
        joined,
        {
            **request(),
            "client_description": F.when(F.col("s_nationkey") != 24, F.col("s_name")),
            "super_client_id": F.when(segment == "MACHINERY", "").when(
                segment != "BUILDING", F.concat(F.lit("SC-"), segment)
            ),
            "opportunity_id": tagged("OPP", F.col("l_suppkey")),
            "data_request_type": F.when(segment == "HOUSEHOLD", "TRIAL").when(segment != "BUILDING", REGULAR),
            "inp_load_ts": F.col("day"),
            "project_start_year": F.trunc(F.col("day").cast("date"), "year"),
        },
    )


def scenario_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests of the orders, which scenario settings belong to."""
    return _select(
        table(spark, sf_dir, "orders"),
        {"parent_request_id": text("o_orderkey"), "inp_load_ts": F.col("o_orderdate").cast("timestamp")},
    )


def activity_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first requests of suppliers loaded early, as an earlier system logged them."""
    day, stamp = F.col("day"), "yyyy-MM-dd HH:mm:ss"
    later = F.timestamp_add("HOUR", (F.col("s_suppkey") % 90).cast("int"), day)
    return _select(
        suppliers(spark, sf_dir).where(day < F.lit(CUTOFF).cast("timestamp")),
        {
            "client_description": tagged("Client ", F.col("s_suppkey")),
            "parent_req_id": text("s_suppkey"),
            "req_id": F.lit("1"),
            "task_id": F.lit("UW1"),
            "create_date": F.date_format(day, stamp),
            "modified_date": F.when(F.col("s_nationkey") % 3 != 0, F.date_format(later, stamp)),
            "inp_load_ts": F.date_format(day, stamp),
            "status": F.lit("COMPLETE"),
        },
    )


def activity_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log row per supplier and task, its line numbers in one text. The later tasks end before they start.

    At most seven line numbers exist, so the collected set stays small however many lines there are.
    """
    shipped = F.col("l_shipdate").cast("timestamp")
    by_task = (
        lines(spark, sf_dir)
        .groupBy("l_suppkey", task_of(F.col("l_linenumber")).alias("task_id"))
        .agg(
            F.array_join(F.sort_array(F.collect_set(text("l_linenumber"))), "_").alias("request_id"),
            F.max(shipped).alias("last"),
            F.min(shipped).alias("first"),
        )
    )
    joined = by_task.join(suppliers(spark, sf_dir), F.col("l_suppkey") == F.col("s_suppkey"))
    end = F.when(F.col("task_id") == "UW1", F.col("last")).otherwise(F.col("first"))
    return _select(
        joined,
        {
            "parent_req_id": text("l_suppkey"),
            "request_id": F.col("request_id"),
            "task_id": F.col("task_id"),
            "start_dttm": F.col("day"),
            "end_dttm": F.timestamp_add("MINUTE", (F.col("l_suppkey") * 7).cast("int"), end),
            "status": F.when(F.col("s_nationkey") % 8 == 0, "RUNNING").otherwise("COMPLETE"),
            "elapsed_time": F.concat(text(F.col("l_suppkey") % 30), F.lit(":30:15.250")),
        },
    )


def claim_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The claim-level fact: a projection of the order lines."""
    line, part, supplier = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    quantity, status, flag = F.col("l_quantity"), F.col("l_linestatus"), F.col("l_returnflag")
    mail = (status == "F") & (discount() == 0)
    return _select(
        lines(spark, sf_dir),
        {
            **request(),
            "lob": F.when(flag == "R", "WRAP").otherwise("STD"),
            "formulary_id": tagged("F", supplier % 10),
            "formulary_guid": F.concat(F.lit("FG-"), flag),
            "network_guid": F.concat(F.lit("NG-"), status),
            "primary_ntwrk": F.when(status == "O", "national").otherwise("select"),
            "secondary_ntwrk": F.concat(F.lit("retail "), flag),
            "tertiary_ntwrk": F.when(flag == "N", "").when(flag == "R", "club"),
            "proj_network_nm": F.concat(F.when(line >= 6, "mix-").otherwise("net "), status),
            "bg_pbmmon_mod": flag,
            "bg_mony_mod": status,
            "phmcy_chain_nm": tagged("CHAIN", supplier % 20),
            "phmcy_st": tagged("ST", supplier % 25),
            "srx_shift_type": F.when(tax() > 4, "NO SHIFT").otherwise("OPEN TO EXCLUSIVE"),
            "opportunity_id": tagged("OPP", supplier),
            "ndc": drug_code(part),
            "model_drug": F.when(supplier % 7 == 0, "").otherwise(tagged("DRUG", supplier % 50)),
            "formulary_nm": tagged("Plan ", supplier % 10),
            "prjctd_year": 2000 + line % 4,
            "prjctd_yr": line % 4,
            "day_sply_qty": quantity.cast("int"),
            "is_capped": bit(discount() > 8),
            "spec_univ": bit(tax() > 4),
            "cob": bit(discount() == 10),
            "cmpnd": bit(tax() == 8),
            "mc": bit(quantity == 50),
            "spec_cmk_ind": bit(tax() == 8),
            "chnl_mail_mod": bit(mail),
            "chnl_ret_mod": bit(~mail),
            "chnl_spec": bit(tax() == 7),
            "spec_drg": bit(tax() > 4),
            "spec_lock_ees": F.when(supplier % 2 == 0, "Y").otherwise("N"),
            "spec_lock_no_ees": F.when(supplier % 4 == 0, "Y").otherwise("N"),
            "awp": price(),
            "wac": price() * (100 - discount()),
            "claims_count": quantity,
            "cogs_trad_pbm": price() * tax(),
            "cogs_trans_pbm": price() * (100 + tax()),
            "cogs_trad_medi": price() * discount(),
            "cogs_trans_medi": price() * 2,
            "cogs_dispns_fee_trad_pbm": quantity * tax(),
            "cogs_dispns_fee_trans_pbm": quantity * discount(),
            "cogs_dispns_fee_trad_medi": quantity * 3,
            "cogs_dispns_fee_trans_medi": quantity * 5,
        },
    )


def formulary_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and names, many times over."""
    group = F.col("p_partkey") % 10
    return _select(
        table(spark, sf_dir, "part"),
        {"formulary_id": tagged("F", group), "formulary_name": tagged("Formulary ", group)},
    )


def request_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Networks of the requests, but not for flag N; each pair is listed under two types."""
    status, flag = F.col("l_linestatus"), F.col("l_returnflag")
    types = F.when(status == "O", F.array(F.lit("broad"), F.lit("BROAD"))).otherwise(
        F.array(F.lit("narrow"), F.lit("limited"))
    )
    pairs = lines(spark, sf_dir).where(flag != "N").select("l_suppkey", "l_linenumber", "l_linestatus", "l_returnflag")
    return _select(
        pairs.distinct().withColumn("network_type", F.explode(types)),
        {
            **request(),
            "type": F.col("network_type"),
            "primary": F.when(status == "O", "national").otherwise("select"),
            "secondary": F.concat(F.lit("retail "), flag),
            "network_guid": F.concat(F.lit("NG-"), status),
        },
    )


def request_formulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    listed = lines(spark, sf_dir).where(~((flag == "N") & (F.col("l_linestatus") == "F")))
    return _select(
        listed.select("l_suppkey", "l_linenumber", "l_returnflag").distinct(),
        {
            **request(),
            "formulary_guid": F.concat(F.lit("FG-"), flag),
            "type": F.when(flag == "A", "open").otherwise("CLOSED"),
            "non_specialty": F.when(flag == "A", "standard").otherwise("PREMIUM"),
            "specialty": F.when(flag == "R", "exclusive").otherwise("choice"),
        },
    )


def specialty_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per part; codes listed more than once are ambiguous."""
    part = F.col("p_partkey")
    sixth = F.floor(part / 3) % 6
    return _select(
        table(spark, sf_dir, "part"),
        {
            "ndc11": drug_code(part),
            "ldd_waccess": F.when(sixth == 0, "Y").otherwise("N"),
            "ldd_woaccess": F.when(sixth == 1, "Y").otherwise("N"),
        },
    )


def drug_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = F.col("p_partkey")
    half = F.floor(part / 3) % 2
    return _select(
        table(spark, sf_dir, "part"),
        {
            "ndc11": drug_code(part),
            "gpi_class": tagged("class ", half),
            "gpi_categ": tagged("category ", half),
            "gpi_group": tagged("group ", half),
        },
    )


def scenario_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight scenarios per supplier: two tasks by two datasets by two formularies."""
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    rows = suppliers(spark, sf_dir)
    for name, values in {"task": ["UW1", "UW2"], "dataset": ["PBM", "MS"], "guid": ["FG-A", "FG-R"]}.items():
        rows = rows.withColumn(name, F.explode(F.array(*map(F.lit, values))))
    urgent, low = nation % 5 == 0, nation % 5 == 1
    return _select(
        rows,
        {
            "opportunity_id": tagged("OPP", key),
            "data_request_id": text(key),
            "task_id": F.col("task"),
            "scenario_id": F.concat(tagged("M", key % 100), F.lit("-"), F.col("task")),
            "business_type_id": F.concat(F.lit("BT-"), F.col("guid")),
            "business_type": F.when(F.col("guid") == "FG-R", "WRAP").otherwise("STD"),
            "brand_generic_definition": F.when(urgent, "1-URGENT").when(low, "5-LOW").otherwise("3-MEDIUM"),
            "pusedo_brand_generic_definition": F.col("dataset"),
            "formulary": tagged("Formulary ", key % 10),
            "formulary_guid": F.col("guid"),
            "network_guid": F.lit("NG-O"),
            "type": F.lit("Broad"),
            "ldd_flag": text(key % 3),
            "ldd_option": F.when(key % 3 == 0, "LDD w/ Access Only")
            .when(urgent, "LDD w/o Access Only")
            .when(key % 3 == 1, "Broad (w/ Access + w/o Access)")
            .when(low, "All_Included"),
            "pricing_type": F.lit("traditional"),
            "primary_network": tagged("main ", key % 3),
            "secondary_network": tagged("second ", key % 4),
            "network_3": tagged("net ", key % 5),
            "network_4": tagged("net ", key % 6),
            "network_5": F.when(key % 2 == 0, tagged("net ", key % 7)),
            "network_6": F.lit(None).cast("string"),
            "network_7": tagged("net ", key % 5),
            "submit_date_cst": F.from_utc_timestamp(F.col("day"), "America/Chicago"),
        },
    )


def claims_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, part, supplier = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    status, flag = F.col("l_linestatus"), F.col("l_returnflag")
    filled = F.date_add(F.lit("1999-01-10").cast("date"), (part % 40).cast("int"))
    return _select(
        lines(spark, sf_dir),
        {
            **request(),
            "superclient_id": tagged("SC", supplier % 10),
            "client_id": tagged("C", supplier % 50),
            "client_nm": tagged("Client ", supplier % 50),
            "dofii": filled,
            "medd_stus_cd": status,
            "buyup_class": flag,
            "genbrand": F.when(flag == "A", "B").when(flag == "N", "G").otherwise("X"),
            "model_drug": tagged("DRUG", part % 2),
            "pmcy": tagged("P", supplier % 40),
            "currawp": price(),
            "currwac": price() * 2,
            "ltc_clm": text(bit(tax() == 3)),
            "claims": F.col("l_quantity"),
            "state": tagged("ST", supplier % 25),
            "claimnbr": text("l_orderkey"),
            "lob_biz_type": F.when(line > 3, "GROUP").otherwise("INDIVIDUAL"),
            "carrier": tagged("CA", supplier % 3),
            "account": tagged("AC", supplier % 5),
            "group": tagged("GR", part % 2),
            "speclock": F.when(tax() == 5, "Y").otherwise("N"),
            "drugname": tagged("DRUG", part % 2),
            "srx_drug_flg": F.when(tax() > 5, "Y").otherwise("N"),
            "awp": price(),
            "lob": F.when(flag == "R", "WRAP").otherwise("STD"),
            "dlvry_systm_cd": F.when(status == "F", "M").otherwise("R"),
            "year": F.year(filled),
            "month": F.month(filled),
            "mbr_gid": tagged("MB", part % 100),
            "tot_mbr": tagged("TM", part % 30),
            "orgnl_ingrd_cost": price() * tax(),
            "clcfee": F.col("l_quantity") * discount(),
            "wac_amt": price() * 2,
            "mc": text(bit(discount() == 4)),
            "rxnum": tagged("RX", part),
        },
    )


def claims_preshift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of supply per request and claim, but not for flag R; repeated where a request has several lines."""
    return _select(
        lines(spark, sf_dir).where(F.col("l_returnflag") != "R"),
        {
            **request(),
            "claimnbr": text("l_orderkey"),
            "dayssply": ((F.col("l_orderkey") + F.col("l_linenumber")) % 100).cast("int"),
        },
    )


def shifted_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shifted claims with the origin flags of all modules."""
    line, part, supplier = F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    status, flag, quantity = F.col("l_linestatus"), F.col("l_returnflag"), F.col("l_quantity")
    origin = F.when(flag == "A", "Y").when(flag == "R", "P").otherwise("N")
    return _select(
        lines(spark, sf_dir),
        {
            **request("req_gid"),
            "prop_frmly_id": tagged("F", supplier % 10),
            "prop_frmly_name": tagged("Formulary ", supplier % 10),
            "curr_frmly_id": tagged("F", supplier % 4),
            "prop_ntwrk": F.when(supplier % 11 != 0, tagged("NW", supplier % 5)),
            "lob": F.when(flag == "R", "WRAP").otherwise("STD"),
            "origclaim": F.when(discount() != 9, origin),
            "hg_origclaim": F.when(tax() == 1, "Z").otherwise(origin),
            "daw9_origclaim": F.when(status == "F", "P").otherwise(origin),
            "mkt_shift_ind": F.when(tax() < 4, "Y").when(tax() < 8, "N"),
            "claimnbr": tagged("C", part),
            "gpi": tagged("D", part % 2 * 8),
            "b_gpi": tagged("D", part % 2),
            "drugname": tagged("DRUG", part % 2),
            "pmcy": tagged("P", supplier % 40),
            "speclock": F.when(tax() == 5, "Y").otherwise("N"),
            "dlvry_systm_cd": F.when(status == "F", "M").when(line != 2, "R"),
            "genbrand": F.when(flag == "A", "B").otherwise("G"),
            "year": F.lit(1999),
            "month": (part % 2 + 1).cast("int"),
            "claims": quantity,
            "dayssply": quantity * 2,
            "decqty": quantity * 3,
            "currawp": price(),
            "currwac": price() * 2,
            "currnadac": price() * discount(),
            "adjawp": price() * tax(),
            "adjwac": price() * 3,
            "shiftaway": discount(),
            "sfactor": tax(),
            "low_awpunit": discount(),
            "low_wacunit": tax(),
            **{f"claims_{n}": quantity * n for n in (1, 2, 3)},
            **{f"ds_sfted_{n}": quantity * discount() * n for n in (1, 2, 3)},
            **{f"gsrrate_{n}": tax() + n for n in (1, 2, 3)},
        },
    )


def model_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scenario request per order with lines; its settings as JSON, one projected year per line.

    Lines are gathered by their own columns, and a year's settings made of them afterwards.
    """
    percent, rate = discount().cast("int"), tax().cast("int")

    def year(line: Column) -> Column:
        status, flag, percent, rate = (line[c] for c in ("l_linestatus", "l_returnflag", "percent", "rate"))
        return F.struct(
            (line["l_linenumber"] % 4).alias("year"),
            F.array(
                F.struct(
                    F.concat(F.lit("NG-"), status).alias("network_guid"),
                    F.when(flag != "N", F.concat(F.lit("FG-"), flag)).alias("formulary_guid"),
                )
            ).alias("network_pricing_groups"),
            F.array(F.struct(F.concat(F.lit("FG-"), flag).alias("formulary_guid"))).alias("rebate_pricing_groups"),
            F.array(
                F.struct(
                    F.when(percent > 0, percent > 5).alias("with_ees"),
                    F.when(rate > 0, rate > 4).alias("open_specialty_arrangement"),
                    (line["l_partkey"] % 2 == 0).alias("ondansetron"),
                    F.when(percent != 10, line["l_suppkey"] % 2 == 0).alias("enoxaparin"),
                )
            ).alias("specialty_pricing_groups"),
        )

    place = F.struct(
        "l_linenumber", "l_partkey", "l_suppkey", percent.alias("percent"), rate.alias("rate"), "l_returnflag",
        "l_linestatus",
    )
    ordered = F.sort_array(F.collect_list(place))
    years = (
        lines(spark, sf_dir)
        .groupBy("l_orderkey")
        .agg(F.transform(ordered, year).alias("projected_years"))
    )
    payload = F.to_json(F.struct(F.struct("projected_years").alias("scenario")))
    joined = years.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    day = F.col("o_orderdate").cast("timestamp")
    return _select(
        joined,
        {
            "scenario_id": scenario(),
            "uw_req_id": text("l_orderkey"),
            "opportunity_id": tagged("OPP", F.col("l_orderkey")),
            "status": F.when(F.col("o_orderstatus") == "P", "Failed").otherwise("Complete"),
            "created_at": day,
            "load_ts": F.timestamp_add("DAY", F.lit(1), day),
            "request_payload": payload,
        },
    )


def revenue_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")

    def category(number: Column) -> Column:
        choice = number % 4
        return (
            F.when(choice == 0, "SPECIALTY").when(choice == 1, "SRX AT RETAIL").when(choice == 2, "MAIL")
        )

    return _select(
        lines(spark, sf_dir),
        {
            "uw_req_id": text("l_orderkey"),
            "scenario_id": scenario(),
            "opportunity_id": tagged("OPP", F.col("l_orderkey")),
            "pharmacy_group": tagged("PG", supplier % 5),
            "pharmacy_bucket": tagged("PB", supplier % 3),
            "srx_pricing_group_id": tagged("SP", part % 4),
            "proj_year": text(F.col("l_linenumber") % 4),
            "network_guid": F.concat(F.lit("NG-"), F.col("l_linestatus")),
            "formulary_guid": F.concat(F.lit("FG-"), F.col("l_returnflag")),
            "business_type_id": tagged("BT", F.col("l_linenumber") % 2),
            "num_claims": F.col("l_quantity"),
            **{name: category(part + n) for n, name in enumerate(MEASURE_NAMES)},
        },
    )


def pharmacy_pnl(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity")
    return _select(
        lines(spark, sf_dir),
        {
            "scenario_id": scenario(),
            "uw_req_id": text("l_orderkey"),
            "proj_year": text(F.col("l_linenumber") % 4),
            "pharmacy_bucket": tagged("PB", F.col("l_suppkey") % 3),
            "opportunity_id": tagged("OPP", F.col("l_orderkey")),
            "business_type_id": tagged("BT", F.col("l_linenumber") % 2),
            "channel_group": F.when(F.col("l_returnflag") != "A", "SRx at retail").otherwise("Mail"),
            "excl_brand_claims": F.when(tax() != 0, quantity),
            "incl_brand_claims": quantity * 2,
            "excl_generic_claims": discount(),
            "incl_generic_claims": tax(),
            "incl_nonmac_claims": quantity,
        },
    )


def specialty_pnl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(
        lines(spark, sf_dir),
        {
            "scenario_id": scenario(),
            "uw_req_id": text("l_orderkey"),
            "proj_year": text(F.col("l_linenumber") % 4),
            "opportunity_id": tagged("OPP", F.col("l_orderkey")),
            "business_type_id": tagged("BT", F.col("l_linenumber") % 2),
            "total_claims": F.col("l_quantity"),
        },
    )
