import json

import pytest
from pyspark.sql import functions as F

from lakeward.operators import audit, rules
from lakeward.plans import entities as ent
from lakeward.sources import files, tables
from lakeward.streaming import steps


def ts():
    return F.lit("2024-01-31 00:00:00").cast("timestamp")


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_csv_headers_bind_by_name(spark, tmp_path):
    landing, bronze = tmp_path / "in", str(tmp_path / "bronze")
    write(landing / "Customers1.csv", 'CustomerID,Reg,Balance\n001,W,1.50\n2,"a,b",x\n')
    write(landing / "deep" / "customers_2.csv", "Balance,cust_id,Region,New\n5,3,E,n\n6,4\n7,5,S,m,EXTRA\n")
    write(landing / "sales.csv", "CustomerID\n9\n")
    loads = lambda: files.ingest_csv(
        spark, str(landing), files.FILE_GLOBS["customers"], bronze, ts(), path_word="customers"
    )
    assert loads() == 2 and loads() == 0
    rows = files.read_bronze(spark, bronze).collect()
    assert len(rows) == 5
    by_id = {r["CustomerID"] or r["cust_id"]: r for r in rows}
    assert by_id["001"]["Balance"] == "1.50" and by_id["2"]["Reg"] == "a,b"
    assert by_id["3"]["Region"] == "E" and by_id["3"]["Reg"] is None and by_id["3"]["New"] == "n"
    assert by_id["3"]["_rescued_data"] is None and by_id["4"]["_rescued_data"] == "6,4"
    assert by_id["5"]["_rescued_data"] == "7,5,S,m,EXTRA"
    assert by_id["3"]["_source_file"].endswith("deep/customers_2.csv")
    warned = rules.warnings(files.read_bronze(spark, bronze), [ent.RESCUE_RULE])
    assert warned.where(F.size("_warnings") > 0).count() == 2
    write(landing / "customers_3.csv", "cust_id\n8\n")
    assert loads() == 1 and files.read_bronze(spark, bronze).count() == 6


def test_loads_of_bounded_size_take_everything(spark, tmp_path):
    for n in range(5):
        write(tmp_path / "in" / f"cars_{n}.csv", "car_id\n" + ("" if n == 0 else f"K{n}\n"))
    bronze = str(tmp_path / "bronze")
    loaded = files.ingest_csv(
        spark, str(tmp_path / "in"), files.FILE_GLOBS["cars"], bronze, ts(), files_per_load=2
    )
    assert loaded == 5
    assert sorted(r["car_id"] for r in files.read_bronze(spark, bronze).collect()) == ["K1", "K2", "K3", "K4"]


def test_repeated_header_names_stay_apart():
    assert files.header_schema('id,"a,b",ID,').names == ["id", "a,b", "ID_2", "_c3", "_rescued_data"]


def test_json_rescue(spark, tmp_path):
    landing, bronze = tmp_path / "in", str(tmp_path / "bronze")
    write(landing / "Claims1.json", '[{"ClaimID": "a", "injury": 5000.0},\n {"ClaimID": "b", "more": {"z": 2}}]')
    write(landing / "claims2.json", '{"ClaimID": "c",\n "injury": "q"}')
    write(landing / "claims3.json", '{"ClaimID": ')
    loaded = files.ingest_json(
        spark, str(landing), files.FILE_GLOBS["claims"], bronze, ["ClaimID", "injury", "vehicle"], ts()
    )
    rows = {r["ClaimID"]: r for r in files.read_bronze(spark, bronze).collect()}
    assert loaded == 3 and set(rows) == {"a", "b", "c", None}
    assert rows["a"]["injury"] == "5000.0" and rows["a"]["vehicle"] is None
    assert json.loads(rows["b"]["_rescued_data"]) == {"more": {"z": 2}}
    assert "ClaimID" in rows[None]["_rescued_data"]


def test_sinks(spark, tmp_path):
    df = spark.range(3)
    path = str(tmp_path / "t")
    assert tables.optional_path(spark, path) is None and tables.optional_table(spark, "no_such") is None
    tables.append_batch(df, path, 1)
    tables.append_batch(df, path, 2)
    tables.append_batch(df, path, 2)
    assert spark.read.parquet(path).count() == 6
    tables.refresh(df, path + "2")
    tables.refresh(df, path + "2")
    assert tables.optional_path(spark, path + "2").count() == 3
    tables.overwrite(df, "t_over")
    tables.append(df, "t_over")
    tables.describe_table(spark, "t_over", "what's in it", {"quality": "silver"})
    assert tables.optional_table(spark, "t_over").count() == 6
    shown = {r[0]: r[1] for r in spark.sql("SHOW TBLPROPERTIES t_over").collect()}
    assert shown["quality"] == "silver"
    assert any(r[1] == "what's in it" for r in spark.sql("DESCRIBE EXTENDED t_over").collect())
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        tables.query(spark, "SELECT 1 / id AS x FROM {d}", d=df).collect()


def test_snapshot_can_be_computed_from_itself(spark):
    tables.publish_snapshot(spark.range(2), "dim_x", 1)
    tables.publish_snapshot(spark.table("dim_x").union(spark.range(5, 6)), "dim_x", 2)
    assert sorted(r[0] for r in spark.table("dim_x").collect()) == [0, 1, 5]


CARS = "car_id string, fuel string, seats string"


def car_stream(landing):
    def build(spark):
        raw = steps.stream_json(spark, landing, CARS, "*.json", ts(), multi_line=False)
        wanted = "name km_driven transmission mileage engine max_power torque model".split()
        return raw.withColumns({c: F.lit(None).cast("string") for c in wanted})

    return build


def test_stream_split_equals_batch_and_replays_nothing(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "cars")
    build = car_stream(str(landing))
    step = steps.Step(
        "cars", lambda s: rules.observed(steps.split_stream(ent.CARS, build(s), None), ent.CAR_RULES, "cars"),
        out, ["_route"],
    )
    assert steps.valid_side(spark, out) is None
    write(landing / "a.json", '{"car_id": "K1", "fuel": "cng", "seats": "4"}\n{"car_id": " ", "seats": "0"}')
    progress = steps.run_step(spark, step, str(tmp_path / "ck"))
    steps.run_step(spark, step, str(tmp_path / "ck"))
    write(landing / "b.json", '{"car_id": "K2", "fuel": "Steam"}\nbroken')
    steps.run_step(spark, step, str(tmp_path / "ck"))
    assert [r["car_id"] for r in steps.valid_side(spark, out).collect()] == ["K1"]
    bad = {r["car_id"]: r["error_reason"] for r in steps.quarantine_side(spark, out).select("car_id", "error_reason").collect()}
    assert bad == {None: "car_id is null", "K2": "invalid fuel"}
    assert steps.routed_table(spark, out, "quarantine").count() == 3
    run = audit.audit_metrics(steps.run_log(spark, "cars", progress), ts()).first()
    assert run["dataset_name"] == "cars" and run["final_status"] == "COMPLETED"
    counts = {e["name"]: (e["passed_records"], e["failed_records"]) for e in run["expectations"]}
    assert counts["valid_car_id"] == (1, 1) and counts["valid_km"] == (2, 0)


def test_watermark_drops_late_rows_one_batch_later(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")
    step = steps.Step(
        "dedup",
        lambda s: steps.dedup_stream(
            s.readStream.schema("id string, t timestamp").json(str(landing)), "t", "1 day", ["id", "t"]
        ),
        out,
    )
    batches = [
        ['{"id": "a", "t": "2024-01-10T00:00:00"}', '{"id": "a", "t": "2024-01-10T00:00:00"}'],
        ['{"id": "b", "t": "2024-01-12T00:00:00"}', '{"id": "a", "t": "2024-01-10T00:00:00"}'],
        ['{"id": "late", "t": "2024-01-10T00:00:00"}', '{"id": "null"}'],
        ['{"id": "late2", "t": "2024-01-10T00:00:00"}'],
    ]
    for n, lines in enumerate(batches):
        write(landing / f"{n}.json", "\n".join(lines))
        steps.run_step(spark, step, str(tmp_path / "ck"))
    assert sorted(r["id"] for r in spark.read.parquet(out).collect()) == ["a", "b", "null"]


def test_dedup_across_runs(spark, tmp_path):
    landing, out = tmp_path / "in", str(tmp_path / "out")

    def step(day):
        stamp = F.lit(f"2024-01-{day:02d}").cast("timestamp")
        return steps.Step(
            "cars",
            lambda s: steps.dedup_across_runs(
                s.readStream.schema("k string, v int").option("maxFilesPerTrigger", 1)
                .json(str(landing)).withColumn("_load_ts", stamp),
                tables.optional_path(s, out), ["k", "v"], ["k", "v"],
            ),
            out,
        )

    write(landing / "1.json", '{"k": "a"}\n{"k": "a"}\n{"k": "b", "v": 1}')
    write(landing / "2.json", '{"k": "a"}\n{"k": "c"}')
    steps.run_step(spark, step(1), str(tmp_path / "ck"))
    for day in (2, 3, 4):
        write(landing / f"{day + 1}.json", f'{{"k": "a"}}\n{{"k": "c"}}\n{{"k": "d{day}"}}')
        steps.run_step(spark, step(day), str(tmp_path / "ck"))
    assert sorted(r["k"] for r in spark.read.parquet(out).collect()) == ["a", "b", "c", "d2", "d3", "d4"]


def test_steps_run_in_order_and_log(spark, tmp_path):
    landing = tmp_path / "in"
    write(landing / "a.csv", "k,v\nx,1\ny\n")
    bronze, silver, log = (str(tmp_path / n) for n in ("bronze", "silver", "log"))
    plan = [
        steps.Step("bronze", lambda s: steps.stream_csv(s, str(landing), "k string, v string", "*.csv", ts()), bronze),
        steps.Step("silver", lambda s: steps.stream_table(s, bronze).where("_rescued_data IS NULL"), silver),
    ]
    steps.run_steps(spark, plan, str(tmp_path / "ck"), log)
    assert [r["k"] for r in spark.read.parquet(silver).collect()] == ["x"]
    assert spark.read.parquet(bronze).count() == 2
    runs = audit.audit_metrics(spark.read.parquet(log), ts()).collect()
    assert {r["dataset_name"] for r in runs} == {"bronze", "silver"}
    counts = {
        r["origin"]["flow_name"]: json.loads(r["details"])["flow_progress"]
        for r in spark.read.parquet(log).collect()
    }
    assert counts["bronze"]["metrics"]["num_output_rows"] == 2
    assert counts["silver"]["metrics"]["num_output_rows"] == 1
    assert counts["silver"]["data_quality"]["dropped_records"] == 1

    broken = steps.Step(
        "broken",
        lambda s: steps.stream_table(s, bronze).select(F.raise_error(F.lit("no")).alias("x")),
        str(tmp_path / "broken"),
    )
    with pytest.raises(Exception):
        steps.run_steps(spark, [broken], str(tmp_path / "ck"), log)
    last = [r for r in spark.read.parquet(log).collect() if r["origin"]["flow_name"] == "broken"]
    assert [json.loads(r["details"])["flow_progress"]["status"] for r in last] == ["FAILED"]


def test_blank_first_lines_and_empty_files_are_read_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "cars_1.csv").write_text("\n  \ncar_id,name\n1,a\n2,b\n")
    (source / "cars_2.csv").write_text("car_id,name\n")
    (source / "cars_3.csv").write_text("\n")
    glob, ts = files.FILE_GLOBS["cars"], F.lit("2024-01-01 00:00:00").cast("timestamp")
    bronze = str(tmp_path / "bronze")
    assert files.ingest_csv(spark, str(source), glob, bronze, ts) == 3
    rows = files.read_bronze(spark, bronze).orderBy("car_id").collect()
    assert [(r["car_id"], r["name"]) for r in rows] == [("1", "a"), ("2", "b")]
    assert rows[0]["_source_file"].endswith("cars_1.csv")
    assert files.ingest_csv(spark, str(source), glob, bronze, ts) == 0
