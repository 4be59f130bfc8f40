"""Queries on the star-schema data set: one per report or operator, each over whole tables.

Timestamps and dates go out as text and whole numbers as bigint, so that other engines' results can
be compared as they are. Load-time audit columns are left out.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from reqmart.functions import fixed_values as fixed, labels, times
from reqmart.operators import aggregates, checks, keys, lookups, reshape
from reqmart.plans import claims, cogs, dates, gpi, ledger, model, mshare, refresh, scenario, shifted
from reqmart.session import configure, materialise
from reqmart.sources.store import ReportStore
from reqmart.star import inputs as star

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Timestamps, dates and booleans as text, whole numbers as bigint."""

    def column(name: str, kind: str):
        c = F.col(f"`{name}`")
        if kind.startswith("timestamp"):
            return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(name)
        if kind in ("date", "boolean"):
            return c.cast("string").alias(name)
        if kind in ("int", "smallint", "tinyint"):
            return c.cast("bigint").alias(name)
        return c

    return df.select(*(column(name, kind) for name, kind in df.dtypes))


def query(function: Query) -> Query:
    """Register the function under its name; it runs with the library's session settings."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(function(configure(spark), sf_dir))

    QUERIES[function.__name__] = run
    return run


def current_requests(params: DataFrame) -> DataFrame:
    """Requests of known clients, under the ledger's key names."""
    known = params.where(F.col("client_description").isNotNull())
    return keys.rename(known, fixed.REQUEST_KEYS, fixed.LEDGER_KEYS)


def seen_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = star.activity_history(spark, sf_dir)
    return keys.rename(history, ["parent_req_id", "req_id", "task_id"], fixed.LEDGER_KEYS)


def delta(spark: SparkSession, sf_dir: str, params: DataFrame | None = None) -> DataFrame:
    current = current_requests(star.request_params(spark, sf_dir) if params is None else params)
    return keys.new_keys(current, seen_requests(spark, sf_dir), fixed.LEDGER_KEYS)


def ledger_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.request_ledger(
        star.activity_history(spark, sf_dir),
        star.activity_log(spark, sf_dir),
        star.request_params(spark, sf_dir),
        star.REGULAR,
        star.CLOCK_FROM,
    )


@query
def request_ledger(spark, sf_dir):
    return ledger_of(spark, sf_dir)


@query
def process_time_state(spark, sf_dir):
    state = ledger.process_time_state(ledger_of(spark, sf_dir))
    return state.groupBy("cpt_id", "status").agg(
        F.count("*").alias("requests"), F.sum("prcs_tot_sec").alias("seconds")
    )


@query
def delta_keys(spark, sf_dir):
    current = ledger.reportable(ledger_of(spark, sf_dir))
    return keys.new_keys(current, seen_requests(spark, sf_dir), fixed.LEDGER_KEYS)


@query
def request_params(spark, sf_dir):
    return ledger.request_params(star.request_params(spark, sf_dir), ledger_of(spark, sf_dir))


@query
def reconcile(spark, sf_dir):
    orders = star.table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_key"))
    lines = star.lines(spark, sf_dir).select(F.col("l_orderkey").alias("order_key"))
    return checks.reconcile(orders, lines, ["order_key"])


@query
def request_reconciliation(spark, sf_dir):
    params = star.request_params(spark, sf_dir)
    report = ledger.request_params(params, ledger_of(spark, sf_dir))
    history, log = star.activity_history(spark, sf_dir), star.activity_log(spark, sf_dir)
    return ledger.request_reconciliation(history, log, params, report, star.REGULAR)


def cost_report(spark, sf_dir):
    params = star.request_params(spark, sf_dir)
    return cogs.cogs_report(
        star.claim_output(spark, sf_dir),
        delta(spark, sf_dir, params),
        params,
        star.formulary_list(spark, sf_dir),
        star.request_network(spark, sf_dir),
        star.request_formulary(spark, sf_dir),
        star.specialty_master(spark, sf_dir),
    )


def drug_mix_report(spark, sf_dir):
    params = star.request_params(spark, sf_dir)
    return gpi.gpi_report(
        star.claim_output(spark, sf_dir),
        delta(spark, sf_dir, params),
        params,
        star.formulary_list(spark, sf_dir),
        star.request_network(spark, sf_dir),
        star.request_formulary(spark, sf_dir),
        star.specialty_master(spark, sf_dir),
        star.drug_master(spark, sf_dir),
        star.CUTOFF,
    )


@query
def cogs_report(spark, sf_dir):
    return cost_report(spark, sf_dir)


@query
def gpi_report(spark, sf_dir):
    return drug_mix_report(spark, sf_dir)


def reported_scenarios(spark, sf_dir):
    """Scenarios of urgent orders, as a model report would hold them."""
    done = star.scenario_models(spark, sf_dir).where(F.col("brand_generic_definition") == "1-URGENT")
    return keys.rename(done.select(*fixed.SCENARIO_KEYS), fixed.SCENARIO_KEYS, model.MODEL_KEYS)


@query
def scenario_delta(spark, sf_dir):
    models = star.scenario_models(spark, sf_dir)
    return model.scenario_delta(models, cost_report(spark, sf_dir), reported_scenarios(spark, sf_dir))


@query
def scenario_delta_drug_mix(spark, sf_dir):
    models = star.scenario_models(spark, sf_dir)
    report, seen = drug_mix_report(spark, sf_dir), reported_scenarios(spark, sf_dir)
    return model.scenario_delta(models, report, seen, match_guids=False)


@query
def cogs_model(spark, sf_dir):
    models = star.scenario_models(spark, sf_dir)
    return model.cogs_model(
        cost_report(spark, sf_dir), models, model.scenario_delta(models, None, reported_scenarios(spark, sf_dir))
    )


@query
def gpi_model(spark, sf_dir):
    models = star.scenario_models(spark, sf_dir)
    return model.gpi_model(
        drug_mix_report(spark, sf_dir), models, model.scenario_delta(models, None, reported_scenarios(spark, sf_dir))
    )


def tagged_claims(spark, sf_dir):
    return claims.claims_base(
        star.claims_tags(spark, sf_dir), star.claims_preshift(spark, sf_dir), delta(spark, sf_dir)
    )


@query
def claims_base(spark, sf_dir):
    return tagged_claims(spark, sf_dir)


@query
def top_drugs(spark, sf_dir):
    return claims.top_drugs(tagged_claims(spark, sf_dir))


@query
def state_counts(spark, sf_dir):
    return claims.state_counts(tagged_claims(spark, sf_dir))


@query
def preshift_monthly(spark, sf_dir):
    return claims.preshift_monthly(tagged_claims(spark, sf_dir))


@query
def summary_metrics(spark, sf_dir):
    return claims.summary_metrics(tagged_claims(spark, sf_dir))


@query
def shifted_by_flag(spark, sf_dir):
    return shifted.shifted_by_flag(star.shifted_claims(spark, sf_dir), "origclaim")


@query
def shifted_house(spark, sf_dir):
    return shifted.shifted_by_flag(star.shifted_claims(spark, sf_dir), "hg_origclaim", "hgorigclaim")


@query
def shifted_market(spark, sf_dir):
    return shifted.shifted_by_flag(
        star.shifted_claims(spark, sf_dir), "daw9_origclaim", "pcsk9_origclaim", "origclaim"
    )


@query
def shifted_single_pass(spark, sf_dir):
    return shifted.shifted_single_pass(star.shifted_claims(spark, sf_dir), "daw9_origclaim")


@query
def shifted_excl(spark, sf_dir):
    return shifted.shifted_excluding(star.shifted_claims(spark, sf_dir))


@query
def generic_launches(spark, sf_dir):
    return shifted.generic_launches(star.shifted_claims(spark, sf_dir))


@query
def shift_strategy(spark, sf_dir):
    facts = star.shifted_claims(spark, sf_dir)
    preshift = facts.withColumnRenamed("req_gid", "request_id")
    modules = shifted.shift_modules(preshift, facts, facts, facts, facts)
    return shifted.shift_strategy(
        modules, star.SPECIALTY_LABEL, drugs=star.DRUG_CODES, pharmacies=star.PHARMACIES
    )


@query
def unique_lookup(spark, sf_dir):
    codes = star.lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "l_returnflag")
    modes = [
        lookups.unique_lookup(codes, ["l_orderkey", "l_linenumber"], ["l_returnflag"], by).withColumn(
            "mode", F.lit(by)
        )
        for by in ("key", "entry")
    ]
    return aggregates.union_all(modes)


@query
def lookup_joins(spark, sf_dir):
    """Fact against a deduplicated lookup (left), one with one row per key (left), and a filter (inner)."""
    lines = star.lines(spark, sf_dir)
    part = star.table(spark, sf_dir, "part")
    names = lookups.distinct_lookup(
        part.select((F.col("p_partkey") % 150).alias("part_group"), (F.col("p_partkey") % 15).alias("family")),
        ["part_group", "family"],
    )
    first_supplier = lookups.one_per_key(
        lines.where(F.col("l_returnflag") == "A"), ["l_orderkey"], ["l_suppkey", "l_partkey"]
    ).withColumnsRenamed({"l_suppkey": "first_supplier", "l_partkey": "first_part"})
    open_orders = star.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == "O")
    return (
        keys.restrict(lines, open_orders, {"l_orderkey": "o_orderkey"})
        .withColumn("part_group", F.col("l_partkey") % 150)
        .join(names, "part_group", "left")
        .join(first_supplier, "l_orderkey", "left")
        .groupBy("family", "first_supplier")
        .agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))
    )


CONDITIONS = [f"{f.lower()}_{s.lower()}" for f in "ANR" for s in "FO"]


def supplier_sums(spark, sf_dir):
    lines = star.lines(spark, sf_dir)
    kind = F.lower(F.concat_ws("_", "l_returnflag", "l_linestatus"))
    flags = lines.select(
        "l_suppkey", star.price().alias("cents"), *(F.when(kind == c, "in").otherwise("out").alias(c) for c in CONDITIONS)
    )
    return reshape.conditional_sums(flags, ["l_suppkey"], "cents", CONDITIONS, ["in"])


@query
def conditional_sums(spark, sf_dir):
    return supplier_sums(spark, sf_dir)


@query
def measure_unpivot(spark, sf_dir):
    return reshape.unpivot_measures(supplier_sums(spark, sf_dir), ["l_suppkey"], CONDITIONS, "name", "value")


@query
def latest_per_key(spark, sf_dir):
    orders = star.table(spark, sf_dir, "orders").where(F.col("o_orderstatus") != "P")
    latest = aggregates.latest_per_key(orders, ["o_custkey"], ["o_orderdate"])
    return latest.select("o_custkey", "o_orderkey", "o_orderdate")


@query
def explode_list(spark, sf_dir):
    exploded = reshape.explode_list(star.activity_log(spark, sf_dir), "request_id")
    return exploded.groupBy("request_id", "task_id", "status").agg(F.count("*").alias("log_rows"))


@query
def dates_dim(spark, sf_dir):
    """Calendar from the first order to the last shipment, with the lines shipped on each day."""
    lines = star.lines(spark, sf_dir).select(F.col("l_shipdate").cast("date").alias("calendar_date"))
    ordered = star.table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("calendar_date"))
    bounds = lines.union(ordered).agg(
        F.min("calendar_date").alias("first"), F.max("calendar_date").alias("last")
    )
    shipped = lines.groupBy("calendar_date").agg(F.count("*").alias("lines_shipped"))
    days = bounds.first()
    return (
        dates.dates_dim(spark, str(days["first"]), str(days["last"]))
        .join(shipped, "calendar_date", "left")
        .fillna(0, ["lines_shipped"])
    )


@query
def newest_requests(spark, sf_dir):
    """The hundred requests loaded last, of the parameters sorted as they are stored."""
    params = star.request_params(spark, sf_dir)
    return ledger.newest_first(ledger.request_params(params, ledger_of(spark, sf_dir))).limit(100)


@query
def store_tables(spark, sf_dir):
    """Tables written in each way there is: replaced in full, declared, inserted by position, emptied, written once.

    Every run stores them in a database of its own and returns what they hold in the end.
    """
    store = ReportStore(spark, f"tables_{uuid.uuid4().hex}")
    orders = star.table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), "o_totalprice"
    )
    counted = orders.groupBy("status", "priority").agg(F.count("*").alias("orders"), F.max("o_totalprice").alias("price"))
    urgent = counted.where("priority = '1-URGENT'")

    def grown(name: str) -> DataFrame:
        """What the table holds, but for one status, and one order more of each kind."""
        return store.read(name).where("status <> 'P'").withColumn("orders", F.col("orders") + 1)

    store.append(counted, "plain")
    store.full_replace(grown("plain"), "plain")
    store.append(counted, "parted", ["status"])
    store.full_replace(grown("parted"), "parted", ["status"])
    store.full_replace(grown("parted").drop("price"), "parted", ["status"])

    for _ in range(2):
        store.create_declared("declared", "priority string, price double, orders bigint, status string", ["status"])
        store.insert_declared(urgent.select("status", "orders", "price", "priority"), "declared")
    declared = urgent.select("priority", "status", F.lit(7).alias("orders"), F.lit("12.5").alias("price"))
    store.replace_declared(declared, "refreshed", "orders bigint, price double, priority string, status string", ["status"])

    store.append(counted, "emptied")
    store.delete_rows("emptied")
    store.append(urgent, "emptied")
    store.append(counted, "dropped")
    store.drop("dropped")
    store.write_once(urgent, "once")
    store.write_once(counted, "once")

    columns = ["status", "priority", "orders", "price"]
    return aggregates.union_all(
        [store.read(name).select(F.lit(name).alias("stored"), *columns) for name in sorted(store.names())]
    )


@query
def refresh_steps(spark, sf_dir):
    """Rows and requests of the stored reports after each of four runs, and whether the run wrote them.

    The first run knows the requests loaded before a day, the second all; for the third nothing is due; before the
    fourth, what was seen is forgotten. Every query stores them in a database of its own, which it drops.
    """
    store = ReportStore(spark, f"refreshed_{uuid.uuid4().hex}")
    shifted_claims, params = star.shifted_claims(spark, sf_dir), star.request_params(spark, sf_dir)
    history, log = star.activity_history(spark, sf_dir), star.activity_log(spark, sf_dir)

    def inputs(known: DataFrame) -> refresh.RefreshInputs:
        return refresh.RefreshInputs(
            history, log, known, star.REGULAR, formulary_shifted=shifted_claims, generic_launches=shifted_claims,
            clock_from=star.CLOCK_FROM,
        )

    early = inputs(params.where(F.col("inp_load_ts") < F.lit(star.LATE).cast("timestamp")))
    runs = {
        "1 first": lambda: refresh.refresh(store, early),
        "2 grown": lambda: refresh.refresh(store, inputs(params)),
        "3 quiet": lambda: refresh.refresh(store, inputs(params)),
        "4 reset": lambda: refresh.reset_and_refresh(store, inputs(params)),
    }
    steps = []
    for step, run in runs.items():
        written = run().written
        for name in sorted(store.names() - {refresh.DATES}):
            report = store.read(name)
            request = [c for own in (fixed.REPORT_KEYS, fixed.REQUEST_KEYS, fixed.LEDGER_KEYS) for c in own]
            named = [c for c in dict.fromkeys(request) if c in report.columns]
            counts = report.agg(F.count("*").alias("stored_rows"), F.count_distinct(*named).alias("requests"))
            steps.append(
                materialise(counts.select(F.lit(step).alias("step"), F.lit(name).alias("report"), F.lit(name in written).alias("written"), "*"))
            )
    spark.sql(f"DROP DATABASE {store.database} CASCADE")
    return aggregates.union_all(steps)


@query
def replace_keys(spark, sf_dir):
    """A stored report whose late customers' rows give way to new ones, with a column it lacked; one status is dropped.

    Every run stores it in a database of its own: written, replaced twice, and read back.
    """
    store = ReportStore(spark, f"replaced_{uuid.uuid4().hex}")
    layout = ["status", "segment"]
    orders = star.table(spark, sf_dir, "orders").join(
        star.table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    # Blank and missing segments are one partition of each status.
    segment = F.when(F.col("c_mktsegment") == "MACHINERY", "").when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment"))
    rows = orders.select(F.col("o_orderstatus").alias("status"), segment.alias("segment"), "o_orderkey", "o_totalprice")
    stored = rows.groupBy(*layout).agg(F.count("*").alias("orders"), F.max("o_totalprice").alias("price"))
    store.append(stored, "report", layout)

    late = spark.createDataFrame([("O",), ("P",)], "key string")
    lines = star.lines(spark, sf_dir).select(F.col("l_orderkey").alias("o_orderkey"), "l_quantity")
    new = rows.where("status = 'O'").join(lines, "o_orderkey").groupBy(*layout).agg(F.sum("l_quantity").alias("quantity"))
    store.replace_keys(new, "report", late, {"status": "key"}, layout)
    again = new.where("segment IS NULL OR segment = ''").withColumn("quantity", F.col("quantity") + 1)
    store.replace_keys(again, "report", spark.createDataFrame([("O", "")], "a string, b string"), {"status": "a", "segment": "b"}, layout)
    return store.read("report")


@query
def scalar_functions(spark, sf_dir):
    """The text, time and label functions over all order lines, counted by their results."""
    facts = star.claim_output(spark, sf_dir)
    part_of_day = F.timestamp_add("MINUTE", (F.col("claims_count") * 29).cast("int"), F.col("day"))
    shipped = star.lines(spark, sf_dir).select(
        F.col("l_shipdate").cast("timestamp").alias("day"),
        F.col("l_quantity").alias("claims_count"),
        star.discount().alias("percent"),
        "l_linenumber",
    )
    moment = part_of_day
    seconds = times.elapsed_seconds(moment, F.col("day"))
    clock = F.concat_ws(":", F.col("l_linenumber").cast("string"), F.lit("05"), F.col("percent").cast("int").cast("string"))
    timed = shipped.select(
        F.lit("times").alias("family"),
        F.concat_ws(
            "|",
            times.timestamp_text(moment, "hh").substr(12, 8),
            times.whole_days(seconds),
            times.second_of_day(seconds),
            times.clock_seconds(F.concat(clock, F.lit(".75"))),
            F.hour(times.local_time(moment)),
            times.forecast_start(F.col("day"), F.col("l_linenumber")).cast("string"),
        ).alias("result"),
    )
    labelled = facts.select(
        F.lit("labels").alias("family"),
        F.concat_ws(
            "|",
            labels.network_tier(F.col("day_sply_qty"), F.col("proj_network_nm")),
            labels.joined_networks(F.col("primary_ntwrk"), F.col("secondary_ntwrk"), F.col("tertiary_ntwrk")),
            labels.network_label(F.col("primary_ntwrk"), F.col("bg_mony_mod")),
            labels.yes_unless_zero(F.col("spec_univ")),
            labels.blank_to(F.col("model_drug"), F.lit("none")),
            labels.access_flag(F.col("spec_lock_ees"), F.col("spec_lock_no_ees")),
            labels.shift_type(F.col("bg_pbmmon_mod"), ["N"], ["A"]),
        ).alias("result"),
    )
    return timed.unionByName(labelled).groupBy("family", "result").agg(F.count("*").alias("lines"))


@query
def json_year_index(spark, sf_dir):
    return scenario.json_year_index(star.model_parameters(spark, sf_dir)).drop("request_payload")


@query
def scenario_attrs(spark, sf_dir):
    return scenario.scenario_attributes(star.model_parameters(spark, sf_dir)).drop("request_payload")


@query
def latest_requests(spark, sf_dir):
    parameters, params = star.model_parameters(spark, sf_dir), star.scenario_requests(spark, sf_dir)
    return scenario.latest_requests(parameters, params).drop("request_payload")


def settings(spark, sf_dir):
    return scenario.scenario_settings(star.model_parameters(spark, sf_dir), star.scenario_requests(spark, sf_dir))


@query
def scenario_unpivot(spark, sf_dir):
    return settings(spark, sf_dir)


@query
def revenue_measures(spark, sf_dir):
    return mshare.revenue_measures(mshare.revenue_sums(star.revenue_summary(spark, sf_dir)))


@query
def mshare_detail(spark, sf_dir):
    sums = mshare.revenue_sums(star.revenue_summary(spark, sf_dir))
    return mshare.mshare_detail(sums, settings(spark, sf_dir))


def share_inputs(spark, sf_dir):
    return (
        star.model_parameters(spark, sf_dir),
        star.scenario_requests(spark, sf_dir),
        star.revenue_summary(spark, sf_dir),
        star.pharmacy_pnl(spark, sf_dir),
        star.specialty_pnl(spark, sf_dir),
        star.SPECIALTY_BUCKET,
    )


@query
def mshare_combined(spark, sf_dir):
    return mshare.mshare_full(*share_inputs(spark, sf_dir))


def early_scenarios(spark, sf_dir):
    """Scenarios some of whose orders came before 1996."""
    orders = star.table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    early = orders.where(F.col("o_orderdate") < F.lit("1996-01-01").cast("timestamp"))
    return early.select(star.scenario().alias("scenario_id"))


@query
def mshare_increment(spark, sf_dir):
    """Shares of the scenarios none of whose orders came early."""
    return mshare.mshare_increment(*share_inputs(spark, sf_dir), early_scenarios(spark, sf_dir))


@query
def mshare_in_two_steps(spark, sf_dir):
    """Shares of the early scenarios, then of those that are not reported yet: together all shares."""
    parameters, *others = share_inputs(spark, sf_dir)
    early = keys.distinct_keys(early_scenarios(spark, sf_dir), ["scenario_id"])
    first = materialise(mshare.mshare_full(keys.restrict(parameters, early, ["scenario_id"]), *others))
    return first.unionByName(mshare.mshare_increment(parameters, *others, first))
