"""KPI views over the star schema.

Facts are summed per foreign key before they meet a dimension: the join then sees
one row per key instead of every event, which also flattens hot keys, and the
final grouping adds up the partial sums.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.operators.keys import star_join


def claim_rejection_rate(
    fact_claims: DataFrame, dim_policy: DataFrame, dim_customers: DataFrame
) -> DataFrame:
    """Claims, rejections and rejection percentage per customer state and policy type.

    ``customer_region`` holds the state, a name kept for compatibility.
    """
    per_key = fact_claims.groupBy("policy_number", "customer_id").agg(
        F.count(F.lit(1)).alias("_claims"), F.sum("rejected_flag").alias("_rejected")
    )
    joined = star_join(
        per_key,
        [
            (dim_policy, "policy_number", "policy_number", ["policy_csl"]),
            (dim_customers, "customer_id", "CustomerID", ["State"]),
        ],
    )
    totals = joined.groupBy(
        F.col("State").alias("customer_region"), F.col("policy_csl").alias("policy_type")
    ).agg(F.sum("_claims").alias("total_claims"), F.sum("_rejected").alias("rejected_claims"))
    rate = F.round(F.col("rejected_claims") * 100.0 / F.col("total_claims"), 2)
    return totals.withColumn("rejection_rate_pct", rate.cast("double"))


def avg_processing_time(fact_claims: DataFrame, dim_customers: DataFrame) -> DataFrame:
    """Average days from logging to processing per customer state."""
    per_key = (
        fact_claims.where(F.col("processing_days").isNotNull())
        .groupBy("customer_id")
        .agg(F.sum("processing_days").alias("_days"), F.count(F.lit(1)).alias("_claims"))
    )
    joined = star_join(per_key, [(dim_customers, "customer_id", "CustomerID", ["State"])])
    average = F.sum("_days").cast("double") / F.sum("_claims")
    return joined.groupBy(F.col("State").alias("customer_region")).agg(
        F.round(average, 2).alias("avg_processing_days")
    )


def unsold_cars(fact_sales: DataFrame, dim_cars: DataFrame) -> DataFrame:
    """Unsold listings with average and longest time listed per state, name and model."""
    per_key = (
        fact_sales.where(F.col("unsold_flag") == 1)
        .groupBy(F.coalesce("state", F.lit("Unknown")).alias("customer_region"), "car_id")
        .agg(
            F.count(F.lit(1)).alias("_cars"),
            F.sum("days_listed").alias("_days"),
            F.count("days_listed").alias("_known"),
            F.max("days_listed").alias("_longest"),
        )
    )
    joined = star_join(per_key, [(dim_cars, "car_id", "car_id", ["name", "model"])])
    average = F.try_divide(F.sum("_days").cast("double"), F.sum("_known"))
    return joined.groupBy(
        "customer_region", F.col("name").alias("car_name"), F.col("model").alias("car_model")
    ).agg(
        F.sum("_cars").alias("unsold_cars_count"),
        F.round(average, 2).alias("avg_days_unsold"),
        F.max("_longest").alias("max_days_unsold"),
    )


def customer_kpis(dim_customers: DataFrame) -> DataFrame:
    return dim_customers.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.avg("Balance").alias("avg_balance"),
        F.countDistinct("Region").alias("region_count"),
        F.sum("HHInsurance").alias("hh_insurance_count"),
        F.sum("CarLoan").alias("car_loan_count"),
    )


def policy_kpis(dim_policy: DataFrame) -> DataFrame:
    return dim_policy.agg(
        F.count(F.lit(1)).alias("total_policies"),
        F.avg("policy_annual_premium").alias("avg_premium"),
        F.avg("policy_deductable").alias("avg_deductible"),
        F.avg("umbrella_limit").alias("avg_umbrella_limit"),
    )


def claims_kpis(fact_claims: DataFrame) -> DataFrame:
    """The claims counterpart of the other two (defined here, only named at the source)."""
    return fact_claims.agg(
        F.count(F.lit(1)).alias("total_claims"),
        F.avg("total_claim_amount").alias("avg_claim_amount"),
        F.avg("rejected_flag").alias("rejection_rate"),
        F.avg("processing_days").alias("avg_processing_days"),
    )
