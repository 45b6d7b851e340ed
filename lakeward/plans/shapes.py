"""The TPC-H-like tables of the test data, shaped as raw entity inputs.

Every frame is all text, as a CSV reader would deliver it, with header aliases,
padding, codes, placeholders and broken values on rows picked by their own keys.
All rows of every table take part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


SPREAD = {"customer", "part", "orders", "lineitem", "events", "documents"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; a file too small to split is spread over the cores.

    The tables are single row groups, which one task reads alone.  A table with as
    many splits as cores, as any large one has, is left where it is.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    slots = spark.sparkContext.defaultParallelism
    if name in SPREAD and df.rdd.getNumPartitions() < slots:
        return df.repartition(slots)
    return df


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _pick(index: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _region_code(name: Column) -> Column:
    return (
        F.when(name == "AFRICA", F.lit("w"))
        .when(name == "AMERICA", F.lit("C "))
        .when(name == "ASIA", F.lit("E"))
        .when(name == "EUROPE", F.lit(" s"))
        .otherwise(F.lower(name))
    )


def _state(name: Column, key: Column) -> Column:
    """``NATION_12`` as letters, followed by junk that cleaning must drop."""
    return F.concat(F.translate(name, "0123456789", "abcdefghij"), F.lit("#"), _text(key))


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name"
    )


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three header variants: which alias column a row fills depends on its key."""
    joined = table(spark, sf_dir, "customer").join(
        _nations(spark, sf_dir), F.col("c_nationkey") == F.col("n_nationkey")
    )
    key = F.col("c_custkey")
    third = key % 3
    ident = F.when(key % 97 == 5, F.lit("  ")).otherwise(F.concat(F.lit(" C"), _text(key)))
    region = _region_code(F.col("r_name"))
    city = F.concat(F.lit(" city-"), F.lower("c_mktsegment"), _text("n_nationkey"))
    marital = _pick(key % 4, ["single", " MARRIED", "divorced ", "NA"])
    education = _pick(key % 5, ["primary", "SECONDARY ", " tertiary", "terto", "na"])
    swapped = key % 7 == 3
    first, second = (
        F.when(swapped, education).otherwise(marital),
        F.when(swapped, marital).otherwise(education),
    )
    return joined.select(
        F.when(third == 0, ident).alias("CustomerID"),
        F.when(third == 1, ident).alias("Customer_ID"),
        F.when(third == 2, ident).alias("cust_id"),
        F.when(third == 0, region).alias("Region"),
        F.when(third != 0, region).alias("Reg"),
        _state(F.col("n_name"), F.col("n_nationkey")).alias("State"),
        F.when(third != 1, city).alias("City"),
        F.when(third == 1, city).alias("City_in_state"),
        F.when(third == 2, first).alias("Marital_status"),
        F.when(third != 2, first).alias("Marital"),
        F.when(third == 1, second).alias("Education"),
        F.when(third != 1, second).alias("Edu"),
        F.concat(F.lower("c_mktsegment"), F.lit(". ")).alias("Job"),
        F.when(key % 101 == 7, F.lit("n/a")).otherwise(_text("c_acctbal")).alias("Balance"),
        _text(key % 2).alias("HHInsurance"),
        F.when(key % 3 == 1, F.lit(" 1")).otherwise(F.lit("0")).alias("CarLoan"),
        F.when(key % 11 == 0, F.lit("")).otherwise(_text(key % 13)).alias("Default"),
    )


def raw_cars(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    size = F.col("p_size")
    fuel = (
        F.when(F.col("p_type") == "ECONOMY", F.lit("petrol"))
        .when(F.col("p_type") == "SMALL", F.lit("Petrol "))
        .when(F.col("p_type") == "LARGE", F.lit(" DIESEL"))
        .when(F.col("p_type") == "MEDIUM", F.lit("CNG"))
        .when(F.col("p_type") == "STANDARD", F.lit("lpg"))
        .when(size % 9 == 4, F.lit("steam"))
    )
    transmission = (
        F.when(size == 37, F.lit("cvt"))
        .when(size % 2 == 0, F.lit("manual "))
        .otherwise(F.lit("AUTOMATIC"))
    )
    return part.select(
        F.concat(F.lit("K"), _text("p_partkey"), F.lit(" ")).alias("car_id"),
        F.concat(F.lit(" "), F.upper("p_name")).alias("name"),
        F.when(size == 25, F.lit("0"))
        .when(size % 10 == 3, F.concat(_text(size * 1000), F.lit(".5")))
        .otherwise(_text(size * 1000))
        .alias("km_driven"),
        fuel.alias("fuel"),
        transmission.alias("transmission"),
        F.concat(_text(10 + size), F.lit("."), _text(size % 10), F.lit(" kmpl")).alias("mileage"),
        F.concat(_text(800 + size * 20), F.lit(" CC")).alias("engine"),
        F.when(size % 13 == 0, F.lit("")).otherwise(F.concat(_text(50 + size), F.lit(".5 bhp"))).alias(
            "max_power"
        ),
        F.concat(F.lit(" "), _text(size), F.lit("Nm@ 2000rpm")).alias("torque"),
        F.when(size % 11 == 0, F.lit("")).otherwise(_text(size % 8)).alias("seats"),
        F.concat(F.lower("p_brand"), F.lit(" ")).alias("model"),
    )


def raw_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One policy per order, on the car of its smallest part key."""
    cars = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min("l_partkey").alias("_partkey"))
    )
    orders = table(spark, sf_dir, "orders").join(
        cars, F.col("o_orderkey") == F.col("l_orderkey"), "left"
    )
    key = F.col("o_orderkey")
    return orders.select(
        F.when(key % 211 == 7, F.lit(" "))
        .otherwise(F.concat(F.lit(" P"), _text(key)))
        .alias("policy_number"),
        F.when(key % 53 == 1, F.date_format("o_orderdate", "dd/MM/yyyy"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
        .alias("policy_bind_date"),
        F.when(F.col("o_orderstatus") == "P", F.lit(" ?"))
        .otherwise(F.lower("o_orderstatus"))
        .alias("policy_state"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit("?"))
        .otherwise(F.concat(F.col("o_orderpriority"), F.lit(" ")))
        .alias("policy_csl"),
        F.when(key % 89 == 2, F.lit("-1")).otherwise(_text(key % 5 * 250)).alias("policy_deductable"),
        F.when(key % 71 == 3, F.lit("0")).otherwise(_text("o_totalprice")).alias(
            "policy_annual_premium"
        ),
        F.when(key % 83 == 4, F.lit("-5")).otherwise(_text(key % 10 * 1000000)).alias(
            "umbrella_limit"
        ),
        F.coalesce(F.concat(F.lit(" K"), _text("_partkey")), F.lit(" ")).alias("car_id"),
        F.concat(F.lit("C"), _text("o_custkey")).alias("customer_id"),
    )


_TIME = "yyyy-MM-dd HH:mm:ss"


def _line_key() -> Column:
    return F.concat_ws("-", *[_text(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])


def _orders_of_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    return table(spark, sf_dir, "lineitem").join(
        orders, F.col("l_orderkey") == F.col("o_orderkey")
    )


def raw_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One claim per line item; lines at the highest discount arrive twice under two ids."""
    lines = _orders_of_lines(spark, sf_dir)
    copies = F.when(F.col("l_discount") >= 0.1, F.array(F.lit(""), F.lit("R"))).otherwise(
        F.array(F.lit(""))
    )
    claims = lines.withColumn("_copy", F.explode(copies))
    number = F.col("l_linenumber")
    logged = F.date_add(F.col("o_orderdate").cast("date"), number)
    price = F.col("l_extendedprice")
    return claims.select(
        F.concat(F.lit(" "), _line_key(), F.col("_copy")).alias("ClaimID"),
        F.concat(F.lit("P"), _text("l_orderkey"), F.lit(" ")).alias("PolicyID"),
        F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit(" 14:30:00.0")).alias(
            "incident_date"
        ),
        F.concat(F.lit(" "), F.lower("o_orderstatus")).alias("incident_state"),
        F.concat(F.lit("CITY "), F.lower("l_returnflag")).alias("incident_city"),
        F.concat(_text("l_suppkey"), F.lit(" Main St ")).alias("incident_location"),
        _pick(number % 3, ["single vehicle COLLISION", " parked car", "VEHICLE theft"]).alias(
            "incident_type"
        ),
        F.when(F.col("l_discount") < 0.02, F.lit("trivial damage"))
        .when(F.col("l_discount") < 0.06, F.lit("MINOR damage "))
        .otherwise(F.lit("total loss"))
        .alias("incident_severity"),
        F.when(F.col("l_quantity") == 50, F.lit("-1"))
        .otherwise(_text(F.col("l_tax") * price))
        .alias("injury"),
        F.when(F.col("l_quantity") == 13, F.lit("unknown")).otherwise(_text(price)).alias("property"),
        _text(F.col("l_discount") * price).alias("vehicle"),
        F.when(number % 4 != 0, _pick(number % 4, ["", "police", "FIRE ", "ambulance"])).alias(
            "authorities_contacted"
        ),
        _text(number % 3 + 1).alias("number_of_vehicles_involved"),
        F.when(F.col("l_quantity") < 10, F.lit("?")).otherwise(F.lit("yes")).alias("property_damage"),
        F.when(number == 5, F.lit("?")).otherwise(F.lit(" rear collision")).alias("collision_type"),
        _text(number % 3).alias("bodily_injuries"),
        F.when(F.col("l_suppkey") % 53 == 0, F.lit("-2")).otherwise(_text(number - 1)).alias(
            "witnesses"
        ),
        F.when(F.col("l_quantity") < 3, F.lit("?"))
        .when(F.col("l_linestatus") == "O", F.lit("no"))
        .otherwise(F.lit("YES"))
        .alias("police_report_available"),
        F.when(F.col("l_returnflag") == "R", F.lit("Y"))
        .when(F.col("l_returnflag") == "A", F.lit("n "))
        .otherwise(F.lit("?"))
        .alias("Claim_Rejected"),
        F.date_format(logged, _TIME).alias("Claim_Logged_On"),
        F.when(F.col("l_linestatus") == "O", F.lit("-"))
        .otherwise(F.date_format("l_shipdate", _TIME))
        .alias("Claim_Processed_On"),
    )


def raw_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One sale per line item in its supplier's region; lines at the highest tax arrive twice."""
    suppliers = table(spark, sf_dir, "supplier").join(
        _nations(spark, sf_dir), F.col("s_nationkey") == F.col("n_nationkey")
    )
    lines = _orders_of_lines(spark, sf_dir).join(
        suppliers.select("s_suppkey", "n_nationkey", "n_name", "r_name"),
        F.col("l_suppkey") == F.col("s_suppkey"),
    )
    copies = F.when(F.col("l_tax") >= 0.08, F.sequence(F.lit(1), F.lit(2))).otherwise(
        F.sequence(F.lit(1), F.lit(1))
    )
    number = F.col("l_linenumber")
    return lines.withColumn("_copy", F.explode(copies)).select(
        F.concat(F.lit("S"), _line_key(), F.lit(" ")).alias("sales_id"),
        F.when(F.col("l_suppkey") % 31 == 3, F.date_format("o_orderdate", "yyyy/MM/dd"))
        .otherwise(F.date_format("o_orderdate", "dd-MM-yyyy HH:mm"))
        .alias("ad_placed_on"),
        F.when(F.col("l_linestatus") == "O", F.when(number % 2 == 0, F.lit("")))
        .when(F.col("l_suppkey") % 37 == 4, F.lit("soon"))
        .otherwise(F.date_format("l_shipdate", "dd-MM-yyyy HH:mm"))
        .alias("sold_on"),
        F.when(F.col("l_quantity") == 49, F.concat(F.lit("-"), _text("l_extendedprice")))
        .otherwise(_text("l_extendedprice"))
        .alias("original_selling_price"),
        _region_code(F.col("r_name")).alias("Region"),
        _state(F.col("n_name"), F.col("n_nationkey")).alias("State"),
        F.concat(F.lit("town "), _text("l_suppkey")).alias("City"),
        F.when(number % 2 == 0, F.lit("dealer")).otherwise(F.lit(" INDIVIDUAL")).alias("seller_type"),
        _pick(number % 3, ["first OWNER", "second owner ", "third owner"]).alias("owner"),
        F.when(number == 7, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(" K"), _text("l_partkey")))
        .alias("car_id"),
    )


# How an event's number maps to a run state.
_STATUSES = ["STARTING", "RUNNING", "COMPLETED", "FAILED"]


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run log with one event per row of ``events``: a user is a run, a type is a dataset."""
    events = table(spark, sf_dir, "events")
    number = F.col("event_id")
    rows = F.get_json_object("props", "$.k").cast("bigint")
    expectation = F.struct(
        F.concat(F.lit("valid_"), F.col("event_type")).alias("name"),
        F.col("event_type").alias("dataset"),
        (rows * 2).alias("passed_records"),
        (number % 7).alias("failed_records"),
    )
    progress = F.struct(
        F.when(number % 10 != 9, _pick(number % 4, _STATUSES)).alias("status"),
        F.when(
            number % 3 != 0,
            F.struct(
                rows.alias("num_output_rows"),
                F.when(number % 2 == 0, number % 5).alias("num_upserted_rows"),
                (number % 2).alias("num_deleted_rows"),
            ),
        ).alias("metrics"),
        F.when(
            number % 4 == 2,
            F.struct(
                (number % 11).alias("dropped_records"),
                F.when(number % 8 == 2, F.array(expectation)).alias("expectations"),
            ),
        ).alias("data_quality"),
    )
    return events.select(
        F.struct(
            F.concat(F.lit("p"), _text(F.col("user_id") % 3)).alias("pipeline_id"),
            F.concat(F.lit("pipeline "), _text(F.col("user_id") % 3)).alias("pipeline_name"),
            F.concat(F.lit("u"), _text("user_id")).alias("update_id"),
            F.when(number % 29 == 0, F.lit("pipelines.flowTimeMetrics.missingFlowName"))
            .when(number % 31 != 0, F.col("event_type"))
            .alias("flow_name"),
        ).alias("origin"),
        F.when(number % 23 == 0, F.lit("user_action"))
        .otherwise(F.lit("flow_progress"))
        .alias("event_type"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.to_json(F.struct(progress.alias("flow_progress"))).alias("details"),
    )
