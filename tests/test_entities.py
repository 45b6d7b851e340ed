import datetime as dt

from pyspark.sql import functions as F

from lakeward.plans import entities as ent
from lakeward.plans import star

CAR = ["car_id", "name", "km_driven", "fuel", "transmission", "mileage", "engine", "max_power",
       "torque", "seats", "model"]


def cars(spark, *rows):
    base = {
        "car_id": "K1", "name": "swift", "km_driven": "100", "fuel": "Petrol",
        "transmission": "Manual", "mileage": "18.9 kmpl", "engine": "1197 CC",
        "max_power": "88.7 bhp", "torque": "t", "seats": "5", "model": "m",
    }
    filled = [tuple({**base, **row}[c] for c in CAR) for row in rows]
    return spark.createDataFrame(filled, ", ".join(f"{c} string" for c in CAR))


def test_cars_edges(spark):
    raw = cars(
        spark,
        {"car_id": " K1 "},
        {"car_id": " ", "name": "a"},
        {"car_id": "K3", "km_driven": "0"},
        {"car_id": "K4", "fuel": "Steam"},
        {"car_id": "K5", "fuel": "cng", "km_driven": "12.5", "seats": "", "mileage": ""},
        {"car_id": "K6", "transmission": "cvt", "seats": "0"},
        {"car_id": "K0"},
    )
    kept = {r["car_id"]: r for r in ent.valid(ent.CARS, raw).collect()}
    assert set(kept) == {"K0", "K5"}  # K0 and K1 differ by id only
    assert kept["K5"]["km_driven"] == 12 and kept["K5"]["mileage"] is None
    assert (kept["K0"]["mileage"], kept["K0"]["engine"], kept["K0"]["max_power"]) == (18.9, 1197, 88.7)
    reasons = {r["car_id"]: r["error_reason"] for r in ent.quarantined(ent.CARS, raw).collect()}
    assert reasons == {
        None: "car_id is null",
        "K3": "invalid km_driven",
        "K4": "invalid fuel",
        "K6": "invalid transmission",
    }


def test_invalid_copy_does_not_displace_a_valid_one(spark):
    raw = cars(spark, {"car_id": None}, {"car_id": "K9"})
    assert [r["car_id"] for r in ent.valid(ent.CARS, raw).collect()] == ["K9"]


def test_repeat_with_null_column_in_a_later_batch_is_dropped(spark):
    raw = cars(spark, {"car_id": "K1", "seats": None})
    stored = ent.valid(ent.CARS, raw)
    assert ent.valid(ent.CARS, raw, existing=stored).count() == 0


def test_customers_repair_and_aliases(spark):
    raw = spark.createDataFrame(
        [("c1", "w", "New-York123", "Secondary", "Married", "abc"), ("c2", "x", "a", "Single", "Single", "-1")],
        "cust_id string, Reg string, State string, Marital string, Edu string, Balance string",
    )
    cleaned = {r["CustomerID"]: r for r in ent.clean_customers(raw).collect()}
    assert cleaned["c1"]["Region"] == "West" and cleaned["c1"]["State"] == "Newyork"
    assert (cleaned["c1"]["Marital"], cleaned["c1"]["Education"]) == ("Married", "Secondary")
    assert cleaned["c1"]["Balance"] is None and cleaned["c1"]["City"] is None
    bad = ent.quarantined(ent.CUSTOMERS, raw).collect()
    assert [(r["CustomerID"], r["error_reason"]) for r in bad] == [("c2", "negative balance")]
    assert bad[0]["error_reasons"] == ["negative balance", "duplicate marital_education values"]


POLICY = ["policy_number", "policy_bind_date", "policy_state", "policy_csl", "policy_deductable",
          "policy_annual_premium", "umbrella_limit", "car_id", "customer_id"]


def policies(spark, *rows):
    base = dict(zip(POLICY, ["P1", "2021-01-15", "ca", "100/300", "500", "10.5", "0", "K1", "C1"], strict=True))
    filled = [tuple({**base, **row}[c] for c in POLICY) for row in rows]
    return spark.createDataFrame(filled, ", ".join(f"{c} string" for c in POLICY))


def refs(spark):
    return {
        "cars": spark.createDataFrame([("K1",), ("K1",)], "car_id string"),
        "customers": spark.createDataFrame([("C1",)], "CustomerID string"),
    }


def test_policy_edges(spark):
    raw = policies(
        spark,
        {"policy_state": "?", "customer_id": " C1 "},
        {"policy_number": "P2", "policy_bind_date": "15/01/2021"},
        {"policy_number": "P3", "policy_annual_premium": "0"},
        {"policy_number": "P4", "policy_deductable": "-1"},
        {"policy_number": "P5", "umbrella_limit": "-1"},
        {"policy_number": "P6", "car_id": " "},
        {"policy_number": "P7", "customer_id": "C9"},
    )
    kept = ent.valid(ent.POLICY, raw, refs(spark)).collect()
    assert [(r["policy_number"], r["policy_state"]) for r in kept] == [("P1", "UNKNOWN")]
    assert kept[0]["policy_bind_date"] == dt.date(2021, 1, 15)
    reasons = {
        r["policy_number"]: r["error_reason"]
        for r in ent.quarantined(ent.POLICY, raw, refs(spark)).collect()
    }
    assert reasons == {
        "P2": "invalid policy_bind_date",
        "P3": "invalid premium",
        "P4": "invalid deductible",
        "P5": "other issue",
        "P6": "invalid car_id",
        "P7": "invalid customer_id",
    }
    # First run: the referenced tables are not there yet.
    assert ent.valid(ent.POLICY, raw).count() == 3


def test_policy_first_version_wins_and_age(spark):
    stored = ent.valid(ent.POLICY, policies(spark, {}), refs(spark))
    later = policies(spark, {"policy_annual_premium": "99"}, {"policy_number": "P8"})
    fresh = ent.valid(ent.POLICY, later, refs(spark), existing=stored)
    assert [r["policy_number"] for r in fresh.collect()] == ["P8"]
    assert ent.with_policy_age(fresh, "2021-01-20").first()["policy_age_days"] == 5


def sales(spark, *rows):
    names = ["sales_id", "ad_placed_on", "sold_on", "original_selling_price", "Region", "State",
             "City", "seller_type", "owner", "car_id"]
    base = dict(zip(names, ["S1", "15-01-2021 14:30", None, "10", "S", "x", "y", "z", "w", "K1"], strict=True))
    filled = [tuple({**base, **row}[c] for c in names) for row in rows]
    return spark.createDataFrame(filled, ", ".join(f"{c} string" for c in names))


def test_sales_edges_and_fact(spark):
    raw = sales(
        spark,
        {},
        {"sales_id": "S2", "sold_on": " "},
        {"sales_id": "S3", "sold_on": "20-01-2021 00:00"},
        {"sales_id": "S4", "sold_on": "soon"},
        {"sales_id": "S5", "ad_placed_on": "2021-01-15"},
        {"sales_id": "S6", "original_selling_price": "-1", "car_id": None},
        {"sales_id": "S7", "car_id": None},
        {"sales_id": "S8", "car_id": "K9"},
    )
    kept = ent.valid(ent.SALES, raw, refs(spark))
    reasons = {r["sales_id"]: r["error_reason"] for r in ent.quarantined(ent.SALES, raw, refs(spark)).collect()}
    assert reasons == {
        "S4": "invalid sold_on",
        "S5": "invalid ad_placed_on",
        "S6": "negative price",
        "S7": "car_id is null",
        "S8": "car_id not found",
    }
    two = ent.valid(
        ent.POLICY,
        policies(spark, {"policy_number": "P2"}, {"policy_number": "P3", "policy_bind_date": "2022-01-01"}),
        refs(spark),
    )
    facts = {r["sales_id"]: r for r in star.fact_sales(kept, two, "2021-02-01").collect()}
    assert len(facts) == 3 and facts["S1"]["customer_id"] == "C1"
    assert (facts["S1"]["unsold_flag"], facts["S1"]["days_listed"]) == (1, 17)
    assert (facts["S3"]["unsold_flag"], facts["S3"]["days_listed"]) == (0, 5)
    assert facts["S1"]["region"] == "South"


CLAIM_RAW = ["ClaimID", "PolicyID", "incident_date", "incident_state", "incident_city",
             "incident_location", "incident_type", "incident_severity", "injury", "property",
             "vehicle", "authorities_contacted", "number_of_vehicles_involved", "property_damage",
             "collision_type", "bodily_injuries", "witnesses", "police_report_available",
             "Claim_Rejected", "Claim_Logged_On", "Claim_Processed_On"]


def claims(spark, *rows):
    base = dict.fromkeys(CLAIM_RAW, None) | {
        "ClaimID": "c1", "PolicyID": "P1", "incident_date": "2021-01-15 14:30:00.0",
        "injury": "1", "property": "2", "vehicle": "3", "property_damage": "?",
        "Claim_Rejected": "Y", "Claim_Logged_On": "2021-01-16 00:00:00",
    }
    filled = [tuple({**base, **row}[c] for c in CLAIM_RAW) for row in rows]
    return spark.createDataFrame(filled, ", ".join(f"{c} string" for c in CLAIM_RAW))


def test_claims_edges_and_fact(spark):
    policy = spark.createDataFrame(
        [("P1", dt.date(2020, 1, 1), "C1"), ("P1", dt.date(2021, 1, 1), "C2")],
        "policy_number string, policy_bind_date date, customer_id string",
    )
    raw = claims(
        spark,
        {"ClaimID": "c2"},
        {},
        {"ClaimID": "c3", "injury": "-1", "witnesses": "-1"},
        {"ClaimID": "c4", "PolicyID": "P9"},
        {"ClaimID": "c5", "PolicyID": " "},
        {"ClaimID": "c6", "injury": None, "Claim_Rejected": "no", "Claim_Processed_On": "2021-01-20 00:00:00"},
    )
    kept = ent.valid(ent.CLAIMS, raw, {"policy": policy})
    rows = {r["claim_id"]: r for r in kept.collect()}
    assert set(rows) == {"c1", "c6"}  # c1 and c2 differ by id only
    assert rows["c1"]["claim_status"] == "OPEN" and rows["c6"]["claim_processing_days"] == 4
    assert rows["c1"]["property_damage"] == "UNKNOWN" and rows["c1"]["authorities_contacted"] == "Unknown"
    bad = {r["claim_id"]: r["error_reason"] for r in ent.quarantined(ent.CLAIMS, raw, {"policy": policy}).collect()}
    assert bad == {
        "c3": "Invalid Injury Amount",
        "c4": "policy_id not found in policy table",
        "c5": "Missing Policy ID",
    }
    facts = {r["claim_id"]: r for r in star.fact_claims(kept, policy).collect()}
    assert facts["c1"]["customer_id"] == "C2" and facts["c1"]["rejected_flag"] == 1
    assert facts["c6"]["total_claim_amount"] == 5.0 and facts["c6"]["rejected_flag"] == 0


def test_every_entity_splits_its_input(spark):
    for entity, raw in ((ent.CARS, cars(spark, {}, {"seats": "0"})), (ent.POLICY, policies(spark, {}, {"car_id": ""}))):
        known = refs(spark)
        checked = ent.checked(entity, raw, known)
        from lakeward.operators.rules import divert, keep

        assert keep(checked, entity.rules).count() + divert(checked, entity.rules).count() == raw.count()


def test_dim_keeps_latest_per_key(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 2), ("b", 1)], "k string, v int")
    dim = star.build_dim(new, "k", ["k", "v"], [F.desc("v")], previous=old)
    assert sorted(tuple(r) for r in dim.collect()) == [("a", 2), ("b", 1)]


def test_dim_keeps_the_later_load(spark):
    columns = "car_id string, name string, km_driven int, insert_timestamp string"
    rows = [("k", "Zeta", 20, "2024-01-02"), ("k", "Audi", 10, "2024-01-01")]
    missing = [F.lit(None).cast("string").alias(c) for c in star.DIM_CARS[3:] if c != "km_driven"]
    cars = spark.createDataFrame(rows, columns).select("*", F.lit("m").alias("model"), *missing)
    assert [r["name"] for r in star.dim_cars(cars).collect()] == ["Zeta"]
    later, first = (cars.where(F.col("name") == n) for n in ("Zeta", "Audi"))
    assert [r["name"] for r in star.dim_cars(later, star.dim_cars(first)).collect()] == ["Zeta"]
    assert [r["name"] for r in star.dim_cars(first, star.dim_cars(later)).collect()] == ["Zeta"]
