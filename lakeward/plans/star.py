"""Dimensions and facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.functions import days_between, null_safe_sum
from lakeward.functions.times import as_of_date
from lakeward.operators.dedup import one_per_key, upsert
from lakeward.operators.keys import enrich

DIM_CUSTOMERS = [
    "CustomerID", "Region", "State", "City", "Job", "Marital", "Education", "Default", "Balance",
    "HHInsurance", "CarLoan",
]
DIM_POLICY = [
    "policy_number", "policy_bind_date", "policy_state", "policy_csl", "policy_deductable",
    "policy_annual_premium", "umbrella_limit", "car_id", "customer_id",
]
DIM_CARS = [
    "car_id", "name", "model", "km_driven", "fuel", "transmission", "mileage", "engine",
    "max_power", "torque", "seats",
]
# Fact column names that differ from their source.
CLAIM_RENAMES = {
    "policy_id": "policy_number",
    "injury": "injury_amount",
    "property": "property_amount",
    "vehicle": "vehicle_amount",
}
FACT_CLAIMS = [
    "claim_id", "policy_number", "customer_id", "incident_date", "incident_state",
    "incident_city", "incident_location", "incident_type", "collision_type",
    "incident_severity", "authorities_contacted", "number_of_vehicles_involved",
    "property_damage", "bodily_injuries", "witnesses", "police_report_available",
    "injury_amount", "property_amount", "vehicle_amount", "claim_rejected", "claim_logged_on",
    "claim_processed_on", "processing_days", "rejected_flag", "total_claim_amount",
]
FACT_SALES = [
    "sales_id", "car_id", "customer_id", "ad_placed_on", "sold_on", "original_selling_price",
    "region", "state", "city", "seller_type", "owner", "unsold_flag", "days_listed",
]
REJECTED_VALUES = ["yes", "y"]


LOADED = "insert_timestamp"


def build_dim(
    df: DataFrame,
    key: str,
    columns: list[str],
    order_by: list[Column],
    previous: DataFrame | None = None,
) -> DataFrame:
    """Latest row per key, added to the previous snapshot when there is one.

    Rows with ``insert_timestamp`` are compared by it first, and the dimension carries it;
    ``order_by`` decides between rows of one load.  Differs from an appended DISTINCT: a key
    never repeats, later rows replace earlier ones.
    """
    fresh = df.where(F.col(key).isNotNull())
    if LOADED in df.columns:
        columns, order_by = [*columns, LOADED], [F.desc(LOADED), *order_by]
    if previous is not None:
        return upsert(previous, fresh, key, order_by).select(*columns)
    return one_per_key(fresh, key, order_by).select(*columns)


def dim_customers(customers: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    order_by = [F.asc(c) for c in DIM_CUSTOMERS[1:]]
    return build_dim(customers, "CustomerID", DIM_CUSTOMERS, order_by, previous)


def dim_policy(policy: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    latest = [F.desc("policy_bind_date"), *[F.asc(c) for c in DIM_POLICY[2:]]]
    return build_dim(policy, "policy_number", DIM_POLICY, latest, previous)


def dim_cars(cars: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    return build_dim(cars, "car_id", DIM_CARS, [F.asc(c) for c in DIM_CARS[1:]], previous)


def _loaded(df: DataFrame) -> list[str]:
    return [LOADED] if LOADED in df.columns else []


def fact_claims(
    claims: DataFrame, policy: DataFrame, counted: DataFrame | None = None
) -> DataFrame:
    """One row per claim, with the customer of its policy and the derived measures.

    ``counted`` is the stored input where ``claims`` is a stream.  A fact carries the
    ``insert_timestamp`` of its claim, if there is one.
    """
    latest = [F.desc("policy_bind_date"), F.asc("customer_id")]
    owned = enrich(
        claims.where(F.col("claim_id").isNotNull()),
        policy,
        "policy_id",
        ["customer_id"],
        lookup_key="policy_number",
        order_by=latest,
        counted=counted,
    )
    rejected = F.when(F.lower("claim_rejected").isin(REJECTED_VALUES), 1).otherwise(0)
    measures = owned.withColumns(
        {
            "processing_days": days_between(F.col("claim_processed_on"), F.col("claim_logged_on")),
            "rejected_flag": rejected,
            "total_claim_amount": null_safe_sum(F.col("injury"), F.col("property"), F.col("vehicle")),
        }
    )
    return measures.withColumnsRenamed(CLAIM_RENAMES).select(*FACT_CLAIMS, *_loaded(claims))


def fact_sales(sales: DataFrame, policy: DataFrame, as_of: str) -> DataFrame:
    """One row per sale; several policies on one car do not multiply it.

    The lookup is the policy with the latest bind date, then the smallest number.
    """
    owned = enrich(
        sales.where(F.col("sales_id").isNotNull()),
        policy.where(F.col("car_id").isNotNull()),
        "car_id",
        ["customer_id"],
        order_by=[F.desc("policy_bind_date"), F.asc("policy_number")],
    )
    end = F.coalesce(F.col("sold_on").cast("date"), as_of_date(as_of))
    return owned.withColumns(
        {
            "unsold_flag": F.when(F.col("sold_on").isNull(), 1).otherwise(0),
            "days_listed": days_between(end, F.col("ad_placed_on")),
        }
    ).select(*FACT_SALES, *_loaded(sales))
