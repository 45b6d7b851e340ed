"""The five entities: cleaning, rules, reference checks and duplicate keys.

Each cleaner turns a raw all-text frame into typed columns and also carries the
raw text that rules must see (``_raw_*``).  Every entity is then run the same way:
clean, flag references, evaluate rules once, drop duplicates among the rows kept.
Rules come before duplicate removal, so an invalid copy never displaces a valid one.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.functions import (
    blank_to_null,
    days_between,
    expand_code,
    first_number,
    first_of,
    letters_only,
    parse_date,
    parse_timestamp,
    repair_timestamp,
    swap_misfiled,
    title,
    to_double,
    to_int,
    to_long,
    unless_placeholder,
    yes_no,
)
from lakeward.functions.times import as_of_date
from lakeward.operators.dedup import dedup_against, dedup_within, first_version_wins
from lakeward.operators.keys import flag_orphans
from lakeward.operators.rules import (
    QUARANTINE,
    VALID,
    Rule,
    all_reasons,
    differs,
    divert,
    in_domain,
    keep,
    matches,
    not_null,
    parses,
    route,
)

# Domains of the input.
FUELS = ["Petrol", "Diesel", "Cng", "Lpg"]
TRANSMISSIONS = ["Manual", "Automatic"]
MARITAL_VALUES = ["Single", "Married", "Divorced", "Na"]
EDUCATION_VALUES = ["Primary", "Secondary", "Tertiary", "Terto", "Na"]
FLAG_VALUES = ["YES", "NO", "UNKNOWN"]
NOT_LETTERS = "[^a-zA-Z ]"


# --- cleaners ---------------------------------------------------------------------------


def _carried(df: DataFrame) -> list[str]:
    """Lineage columns pass through when the input has them."""
    return [c for c in ("_source_file", "_load_ts", "_rescued_data") if c in df.columns]


def clean_cars(df: DataFrame) -> DataFrame:
    return df.select(
        blank_to_null(F.col("car_id")).alias("car_id"),
        title(F.col("name")).alias("name"),
        to_int(F.col("km_driven")).alias("km_driven"),
        title(F.col("fuel")).alias("fuel"),
        title(F.col("transmission")).alias("transmission"),
        first_number(F.col("mileage")).alias("mileage"),
        first_number(F.col("engine"), "int").alias("engine"),
        first_number(F.col("max_power")).alias("max_power"),
        F.trim("torque").alias("torque"),
        to_int(F.col("seats")).alias("seats"),
        title(F.col("model")).alias("model"),
        *_carried(df),
    )


def clean_customers(df: DataFrame) -> DataFrame:
    """Header aliases become one column each; misfiled marital / education values swap back."""
    cleaned = df.select(
        blank_to_null(first_of(df, "CustomerID", "Customer_ID", "cust_id")).alias("CustomerID"),
        expand_code(first_of(df, "Region", "Reg")).alias("Region"),
        letters_only(first_of(df, "State")).alias("State"),
        letters_only(first_of(df, "City", "City_in_state")).alias("City"),
        title(first_of(df, "Marital_status", "Marital")).alias("Marital"),
        title(first_of(df, "Education", "Edu")).alias("Education"),
        letters_only(first_of(df, "Job")).alias("Job"),
        to_double(first_of(df, "Balance")).alias("Balance"),
        to_int(first_of(df, "HHInsurance")).alias("HHInsurance"),
        to_int(first_of(df, "CarLoan")).alias("CarLoan"),
        to_int(first_of(df, "Default")).alias("Default"),
        F.trim(first_of(df, "State")).alias("_raw_state"),
        F.trim(first_of(df, "City", "City_in_state")).alias("_raw_city"),
        *_carried(df),
    )
    return swap_misfiled(cleaned, "Marital", "Education", MARITAL_VALUES, EDUCATION_VALUES)


def clean_policy(df: DataFrame) -> DataFrame:
    return df.select(
        blank_to_null(F.col("policy_number")).alias("policy_number"),
        parse_date(F.col("policy_bind_date")).alias("policy_bind_date"),
        unless_placeholder(F.col("policy_state"), F.upper(F.trim("policy_state"))).alias(
            "policy_state"
        ),
        unless_placeholder(F.col("policy_csl"), F.trim("policy_csl")).alias("policy_csl"),
        to_int(F.col("policy_deductable")).alias("policy_deductable"),
        to_double(F.col("policy_annual_premium")).alias("policy_annual_premium"),
        to_long(F.col("umbrella_limit")).alias("umbrella_limit"),
        blank_to_null(F.col("car_id")).alias("car_id"),
        blank_to_null(F.col("customer_id")).alias("customer_id"),
        *_carried(df),
    )


def clean_sales(df: DataFrame) -> DataFrame:
    """Sale dates stay timestamps (not formatted text), so later day counts are real."""
    return df.select(
        blank_to_null(F.col("sales_id")).alias("sales_id"),
        blank_to_null(F.col("car_id")).alias("car_id"),
        to_double(F.col("original_selling_price")).alias("original_selling_price"),
        parse_timestamp(F.col("ad_placed_on")).alias("ad_placed_on"),
        parse_timestamp(F.col("sold_on")).alias("sold_on"),
        expand_code(F.col("Region")).alias("region"),
        letters_only(F.col("State")).alias("state"),
        letters_only(F.col("City")).alias("city"),
        title(F.col("seller_type")).alias("seller_type"),
        title(F.col("owner")).alias("owner"),
        F.col("ad_placed_on").alias("_raw_ad_placed_on"),
        F.col("sold_on").alias("_raw_sold_on"),
        *_carried(df),
    )


def clean_claims(df: DataFrame) -> DataFrame:
    cleaned = df.select(
        blank_to_null(F.col("ClaimID")).alias("claim_id"),
        blank_to_null(F.col("PolicyID")).alias("policy_id"),
        repair_timestamp(F.col("incident_date")).alias("incident_date"),
        F.upper(F.trim("incident_state")).alias("incident_state"),
        title(F.col("incident_city")).alias("incident_city"),
        F.trim("incident_location").alias("incident_location"),
        title(F.col("incident_type")).alias("incident_type"),
        title(F.col("incident_severity")).alias("incident_severity"),
        to_double(F.col("injury")).alias("injury"),
        to_double(F.col("property")).alias("property"),
        to_double(F.col("vehicle")).alias("vehicle"),
        F.coalesce(title(F.col("authorities_contacted")), F.lit("Unknown")).alias(
            "authorities_contacted"
        ),
        to_int(F.col("number_of_vehicles_involved")).alias("number_of_vehicles_involved"),
        unless_placeholder(F.col("property_damage"), F.upper(F.trim("property_damage"))).alias(
            "property_damage"
        ),
        unless_placeholder(F.col("collision_type"), title(F.col("collision_type"))).alias(
            "collision_type"
        ),
        to_int(F.col("bodily_injuries")).alias("bodily_injuries"),
        to_int(F.col("witnesses")).alias("witnesses"),
        unless_placeholder(
            F.col("police_report_available"), F.upper(F.trim("police_report_available"))
        ).alias("police_report_available"),
        yes_no(F.col("Claim_Rejected")).alias("claim_rejected"),
        repair_timestamp(F.col("Claim_Logged_On")).alias("claim_logged_on"),
        repair_timestamp(F.col("Claim_Processed_On")).alias("claim_processed_on"),
        *_carried(df),
    )
    status = (
        F.when(F.col("claim_processed_on").isNotNull(), F.lit("PROCESSED"))
        .when(F.col("claim_logged_on").isNotNull(), F.lit("OPEN"))
        .otherwise(F.lit("UNKNOWN"))
    )
    days = days_between(F.col("claim_processed_on"), F.col("claim_logged_on"))
    return cleaned.withColumns({"claim_status": status, "claim_processing_days": days})


# --- rules, in reason order --------------------------------------------------------------
# Rule conditions, names and reason texts.

CAR_RULES = [
    Rule("valid_car_id", not_null("car_id"), "car_id is null"),
    Rule("valid_km", "km_driven > 0", "invalid km_driven"),
    Rule("valid_fuel", in_domain("fuel", FUELS), "invalid fuel"),
    Rule("valid_transmission", in_domain("transmission", TRANSMISSIONS), "invalid transmission"),
    Rule("valid_seats", "seats > 0", "invalid seats"),
]
# The two character rules look at the raw text (the cleaned one cannot fail) and only warn.
CUSTOMER_RULES = [
    Rule("valid_customer_id", not_null("CustomerID"), "customer_id is null"),
    Rule("valid_balance", "Balance >= 0", "negative balance"),
    Rule("valid_state", f"NOT {matches('_raw_state', NOT_LETTERS)}", "invalid state", action="warn"),
    Rule("valid_city", f"NOT {matches('_raw_city', NOT_LETTERS)}", "invalid city", action="warn"),
    Rule(
        "distinct_marital_education",
        differs("Marital", "Education"),
        "duplicate marital_education values",
    ),
]
POLICY_RULES = [
    Rule("valid_policy_number", not_null("policy_number"), "policy_number is null"),
    Rule("valid_bind_date", not_null("policy_bind_date"), "invalid policy_bind_date"),
    Rule("valid_premium", "policy_annual_premium > 0", "invalid premium"),
    Rule("valid_deductible", "policy_deductable >= 0", "invalid deductible"),
    Rule("known_car", "_has_car", "invalid car_id", on_null="fail"),
    Rule("known_customer", "_has_customer", "invalid customer_id", on_null="fail"),
    Rule("valid_umbrella_limit", "umbrella_limit >= 0", "other issue"),
]
SALES_RULES = [
    Rule("valid_sales_id", not_null("sales_id"), "sales_id is null"),
    Rule("valid_price", "original_selling_price >= 0", "negative price"),
    Rule("valid_car_id", not_null("car_id"), "car_id is null"),
    Rule("known_car", "_has_car", "car_id not found", on_null="fail"),
    Rule("valid_ad_placed_on", parses("_raw_ad_placed_on", "ad_placed_on"), "invalid ad_placed_on"),
    Rule("valid_sold_on", parses("_raw_sold_on", "sold_on", optional=True), "invalid sold_on"),
]
CLAIM_RULES = [
    Rule("valid_claim_id", not_null("claim_id"), "Missing Claim ID"),
    Rule("valid_policy_id", not_null("policy_id"), "Missing Policy ID"),
    Rule("valid_injury", "injury >= 0", "Invalid Injury Amount"),
    Rule("valid_property", "property >= 0", "Invalid Property Amount"),
    Rule("valid_vehicle", "vehicle >= 0", "Invalid Vehicle Amount"),
    Rule("valid_bodily_injuries", "bodily_injuries >= 0", "Invalid Bodily Injuries"),
    Rule("valid_witnesses", "witnesses >= 0", "Invalid Witness Count"),
    Rule(
        "valid_claim_rejected",
        in_domain("claim_rejected", FLAG_VALUES),
        "Invalid Claim Rejected Flag",
    ),
    Rule(
        "known_policy", "_has_policy", "policy_id not found in policy table", on_null="fail"
    ),
]
# Fields the reader could not place are reported, never dropped.
RESCUE_RULE = Rule("rescued_fields", "_rescued_data IS NULL", "rescued fields", action="warn")


# --- specification -----------------------------------------------------------------------


@dataclass(frozen=True)
class Reference:
    """A foreign key: the row's ``key`` must exist in ``table`` under ``ref_key``.

    ``unique`` states that the referenced table has one row per key.
    """

    table: str
    key: str
    ref_key: str
    flag: str
    unique: bool = False


@dataclass(frozen=True)
class Entity:
    name: str
    clean: Callable[[DataFrame], DataFrame]
    rules: list[Rule]
    columns: list[str]
    dedup_columns: list[str]
    key: str
    quarantine_columns: list[str]
    references: list[Reference] = field(default_factory=list)
    first_version_wins: bool = False


_CAR_COLUMNS = [
    "name", "km_driven", "fuel", "transmission", "mileage", "engine", "max_power", "torque",
    "seats", "model",
]
_CUSTOMER_COLUMNS = [
    "Region", "State", "City", "Marital", "Education", "Job", "Balance", "HHInsurance",
    "CarLoan", "Default",
]
_POLICY_COLUMNS = [
    "policy_number", "policy_bind_date", "policy_state", "policy_csl", "policy_deductable",
    "policy_annual_premium", "umbrella_limit", "car_id", "customer_id",
]
_SALES_COLUMNS = [
    "sales_id", "car_id", "original_selling_price", "ad_placed_on", "sold_on", "region", "state",
    "city", "seller_type", "owner",
]
_CLAIM_CONTENT = [
    "policy_id", "incident_date", "incident_state", "incident_city", "incident_location",
    "incident_type", "incident_severity", "injury", "property", "vehicle",
    "authorities_contacted", "number_of_vehicles_involved", "property_damage", "collision_type",
    "bodily_injuries", "witnesses", "police_report_available", "claim_rejected",
    "claim_logged_on", "claim_processed_on",
]

CARS = Entity(
    name="cars",
    clean=clean_cars,
    rules=CAR_RULES,
    columns=["car_id", *_CAR_COLUMNS],
    dedup_columns=_CAR_COLUMNS,
    key="car_id",
    quarantine_columns=["car_id", "name", "km_driven", "fuel", "transmission", "seats"],
)
CUSTOMERS = Entity(
    name="customers",
    clean=clean_customers,
    rules=CUSTOMER_RULES,
    columns=["CustomerID", *_CUSTOMER_COLUMNS],
    dedup_columns=_CUSTOMER_COLUMNS,
    key="CustomerID",
    quarantine_columns=["CustomerID", "Balance", "State", "City", "Marital", "Education"],
)
POLICY = Entity(
    name="policy",
    clean=clean_policy,
    rules=POLICY_RULES,
    columns=_POLICY_COLUMNS,
    dedup_columns=_POLICY_COLUMNS,
    key="policy_number",
    quarantine_columns=_POLICY_COLUMNS,
    references=[
        Reference("cars", "car_id", "car_id", "_has_car"),
        Reference("customers", "customer_id", "CustomerID", "_has_customer"),
    ],
    first_version_wins=True,
)
SALES = Entity(
    name="sales",
    clean=clean_sales,
    rules=SALES_RULES,
    columns=_SALES_COLUMNS,
    dedup_columns=_SALES_COLUMNS,
    key="sales_id",
    quarantine_columns=[
        "sales_id", "original_selling_price", "car_id", "_raw_ad_placed_on", "_raw_sold_on",
    ],
    references=[Reference("cars", "car_id", "car_id", "_has_car")],
)
CLAIMS = Entity(
    name="claims",
    clean=clean_claims,
    rules=CLAIM_RULES,
    columns=["claim_id", *_CLAIM_CONTENT, "claim_status", "claim_processing_days"],
    dedup_columns=_CLAIM_CONTENT,
    key="claim_id",
    quarantine_columns=[
        "claim_id", "policy_id", "injury", "property", "vehicle", "bodily_injuries", "witnesses",
        "claim_rejected",
    ],
    references=[Reference("policy", "policy_id", "policy_number", "_has_policy")],
)
ENTITIES = {e.name: e for e in (CARS, CUSTOMERS, POLICY, SALES, CLAIMS)}


def checked(
    entity: Entity,
    raw: DataFrame,
    refs: dict[str, DataFrame] | None = None,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Cleaned rows with one existence flag per reference.

    Where ``raw`` is a stream, ``stored`` are the rows it is about to bring, as a table: their
    hot keys are spread over many tasks.

    A referenced table that does not exist yet (first run) is left out of ``refs``
    and its check passes, decided here by the caller and not by a failing read.
    """
    df = entity.clean(raw)
    counted = None if stored is None else entity.clean(stored)
    for ref in entity.references:
        if refs is None or ref.table not in refs:
            df = df.withColumn(ref.flag, F.lit(True))
        else:
            df = flag_orphans(
                df,
                refs[ref.table],
                ref.key,
                ref.flag,
                ref.ref_key,
                ref.unique,
                spread_by=entity.quarantine_columns,
                counted=counted,
            )
    return df


def valid(
    entity: Entity,
    raw: DataFrame,
    refs: dict[str, DataFrame] | None = None,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Rows to keep: clean, no drop rule broken, one per set of business columns, not stored yet."""
    kept = keep(checked(entity, raw, refs), entity.rules).select(*entity.columns)
    unique = dedup_within(kept, entity.dedup_columns, entity.key)
    if existing is None:
        return unique
    if entity.first_version_wins:
        return first_version_wins(unique, existing, entity.key)
    return dedup_against(unique, existing, entity.columns)


def routed(
    entity: Entity, raw: DataFrame, refs: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Every row once, with ``_route``, its first reason and all of them: for one stored pass."""
    rows = route(checked(entity, raw, refs), entity.rules)
    drops = [rule for rule in entity.rules if rule.action == "drop"]
    reasons = F.when(F.col("_route") == QUARANTINE, all_reasons(drops))
    columns = dict.fromkeys([*entity.columns, *entity.quarantine_columns])
    return rows.select(*columns, "error_reason", reasons.alias("error_reasons"), "_route")


def unique(entity: Entity, routed_rows: DataFrame) -> DataFrame:
    """The valid rows of a routed table, one per set of business columns."""
    kept = routed_rows.where(F.col("_route") == VALID).select(*entity.columns)
    return dedup_within(kept, entity.dedup_columns, entity.key)


def quarantined(
    entity: Entity, raw: DataFrame, refs: dict[str, DataFrame] | None = None
) -> DataFrame:
    """Rows that break a drop rule: a few columns, the first reason and all reasons."""
    df = checked(entity, raw, refs)
    carried = [c for c in ("_load_ts",) if c in df.columns]
    return divert(df, entity.rules).select(
        *entity.quarantine_columns, "error_reason", "error_reasons", *carried
    )


def with_policy_age(policy: DataFrame, as_of: str) -> DataFrame:
    age = days_between(as_of_date(as_of), F.col("policy_bind_date"))
    return policy.withColumn("policy_age_days", age)
