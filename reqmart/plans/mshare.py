"""Market-share reports: scenario settings against revenue and claims."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from reqmart.functions import fixed_values as fixed
from reqmart.functions.times import local_time
from reqmart.operators.aggregates import union_distinct
from reqmart.operators.keys import restrict
from reqmart.operators.lookups import distinct_lookup
from reqmart.operators.reshape import conditional_sums, pick_by_name, unpivot_measures
from reqmart.plans.scenario import MEASURE_NAMES, SPECIALTY_SETTINGS, scenario_settings, unreported
from reqmart.session import materialise

REVENUE_KEYS = {
    "uw_req_id": "uw_req_id",
    "scenario_id": "scenario_id",
    "opportunity_id": "opportunity",
    "pharmacy_group": "pharmacy_chain",
    "pharmacy_bucket": "pharmacy",
    "srx_pricing_group_id": "srx_pricing_group_id",
    "proj_year": "proj_year",
    "network_guid": "network_guid",
    "formulary_guid": "formulary_guid",
    "business_type_id": "business_type_id",
}
SETTING_KEYS = ["scenario_id", "uw_req_id", "network_guid", "formulary_guid", "proj_year"]
CLAIM_KEYS = ["scenario_id", "uw_req_id", "proj_year", "opportunity_id", "business_type_id"]

SHARE_SCHEMA = """
    uw_req_id string, scenario_id string, opportunity string, pharmacy string, rxs double,
    srx_pricing_group_id string, with_ees string, open_specialty_arrangement string,
    ondansetron string, enoxaparin string, proj_year int, ce_created_at string,
    load_timestamp timestamp, updated_at timestamp
"""
SHARE_PARTITIONS = ["ce_created_at", "opportunity", "uw_req_id", "scenario_id", "proj_year"]


def revenue_sums(revenue: DataFrame) -> DataFrame:
    """Specialty claims per request, pharmacy, group and year, by each of the sixteen categories."""
    keys = [F.col(source).alias(name) for source, name in REVENUE_KEYS.items()]
    return conditional_sums(revenue, keys, "num_claims", MEASURE_NAMES, fixed.SHARE_CATEGORIES)


def revenue_measures(sums: DataFrame) -> DataFrame:
    """The sums as rows of measure name (``col0``) and value (``col1``)."""
    return unpivot_measures(sums, list(REVENUE_KEYS.values()), MEASURE_NAMES)


def mshare_detail(sums: DataFrame, settings: DataFrame) -> DataFrame:
    """Claims of the measure that each scenario year's settings select.

    The measure is picked from the joined row by its name. That equals a join of the unpivoted sums
    on the name, without turning every row into sixteen first.
    """
    joined = sums.join(settings.drop("opportunity_id"), SETTING_KEYS)
    return (
        joined.withColumn("rxs", pick_by_name(F.col("col_name"), MEASURE_NAMES))
        .withColumn("ce_created_at", F.to_date("created_at"))
        .withColumnRenamed("load_ts", "load_timestamp")
        .groupBy(
            "uw_req_id", "scenario_id", "opportunity", "pharmacy_chain", "pharmacy",
            "srx_pricing_group_id", "business_type_id", *SPECIALTY_SETTINGS, "proj_year",
            "ce_created_at", "load_timestamp",
        )
        .agg(F.sum("rxs").alias("rxs"))
    )


def share_claims(buckets: DataFrame, specialty: DataFrame, specialty_bucket: str) -> DataFrame:
    """Claims per scenario year and pharmacy bucket: retail buckets and the specialty one.

    A bucket row with an unknown part counts nothing. ``specialty_bucket`` names the bucket under
    which specialty claims are put out. A scenario year has a row per bucket, so its rows are dealt by
    the year's keys, which the shares are joined by.
    """
    parts = [
        "excl_brand_claims", "incl_brand_claims", "excl_generic_claims", "incl_generic_claims",
        "incl_nonmac_claims",
    ]
    every_part = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    retail = (
        buckets.where(F.col("channel_group") == fixed.RETAIL_CHANNEL)
        .groupBy(*CLAIM_KEYS, F.col("pharmacy_bucket").alias("pharmacy"))
        .agg(F.sum(every_part).alias("rxs"))
    )
    special = (
        specialty.groupBy(*CLAIM_KEYS)
        .agg(F.sum("total_claims").alias("rxs"))
        .withColumn("pharmacy", F.lit(specialty_bucket))
    )
    return union_distinct([retail, special], CLAIM_KEYS)


def mshare_combined(detail: DataFrame, claims: DataFrame) -> DataFrame:
    """Distinct scenario years of the detail beside the claims of each pharmacy bucket.

    The detail's own sum and pharmacy are not put out; its rows are made distinct before the join.
    """
    keys = [
        "uw_req_id", "scenario_id", "opportunity", "srx_pricing_group_id", *SPECIALTY_SETTINGS,
        "proj_year", "ce_created_at", "load_timestamp",
    ]
    years = detail.select(*keys, "business_type_id").distinct()
    named = claims.withColumnRenamed("opportunity_id", "opportunity")
    on = ["scenario_id", "uw_req_id", "proj_year", "opportunity", "business_type_id"]
    return years.join(named, on).select(*keys, "pharmacy", "rxs").distinct()


def mshare_full(
    parameters: DataFrame,
    params: DataFrame,
    revenue: DataFrame,
    buckets: DataFrame,
    specialty: DataFrame,
    specialty_bucket: str,
) -> DataFrame:
    """Market share of every scenario."""
    settings = scenario_settings(parameters, params)
    detail = mshare_detail(revenue_sums(revenue), settings)
    return mshare_combined(detail, share_claims(buckets, specialty, specialty_bucket))


def mshare_increment(
    parameters: DataFrame,
    params: DataFrame,
    revenue: DataFrame,
    buckets: DataFrame,
    specialty: DataFrame,
    specialty_bucket: str,
    reported: DataFrame,
) -> DataFrame:
    """Market share of the scenarios that ``reported`` lacks.

    Which those are is asked once and stored, a row per scenario. Payloads and revenue are then read by
    them alone, and the settings that the payloads give are stored as well, before revenue meets them.
    """
    scenarios = materialise(distinct_lookup(unreported(parameters, reported), ["scenario_id"]))
    fresh = restrict(parameters.where(F.col("status") != fixed.FAILED), scenarios, ["scenario_id"])
    settings = materialise(scenario_settings(fresh, params))
    revenue, buckets, specialty = (
        restrict(table, scenarios, ["scenario_id"]) for table in (revenue, buckets, specialty)
    )
    detail = mshare_detail(revenue_sums(revenue), settings)
    return mshare_combined(detail, share_claims(buckets, specialty, specialty_bucket))


def declared_share_rows(combined: DataFrame) -> DataFrame:
    """Rows for the declared table: its types, and the time of the update in local time."""
    return combined.withColumns(
        {
            "proj_year": F.col("proj_year").try_cast("int"),
            "ce_created_at": F.col("ce_created_at").cast("string"),
            "rxs": F.col("rxs").cast("double"),
            "updated_at": local_time(F.current_timestamp()),
        }
    )
