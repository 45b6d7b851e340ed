"""What streams and landed files leave on disk, and that rows stay told apart."""

import random
from pathlib import Path

from pyspark.sql import functions as F

from lakeward.plans import exercises
from lakeward.streaming import steps

SCHEMA = "text string, t timestamp, x double, parts array<timestamp>"


def bytes_below(folder):
    return sum(p.stat().st_size for p in Path(folder).rglob("*") if p.is_file())


def deduped(spark, root, rows, columns):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{root}/in")
    step = steps.Step(
        "dedup",
        lambda s: steps.dedup_stream(steps.stream_table(s, f"{root}/in"), "t", "1 day", columns),
        f"{root}/out",
    )
    steps.run_step(spark, step, f"{root}/checkpoints")
    return spark.read.parquet(f"{root}/out").collect()


def instant(spark, text):
    return spark.sql(f"SELECT timestamp '{text}' AS t").first()[0]


def test_the_width_of_rows_does_not_go_into_state(spark, tmp_path):
    letters, day = random.Random(1), instant(spark, "2024-01-01")
    wide = ["".join(letters.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=4_000)) for _ in range(200)]
    rows = [(text, day, 0.5, None) for text in wide] * 2
    found = deduped(spark, tmp_path, rows, ["text", "t", "x", "parts"])
    assert sorted(r["text"] for r in found) == sorted(wide)
    assert bytes_below(tmp_path / "checkpoints") < 300_000


def test_rows_that_differ_a_little_stay_apart(spark, tmp_path):
    day, later = instant(spark, "2024-01-01"), instant(spark, "2024-01-01 00:00:00.000001")
    rows = [
        ("a", day, 1.0, None),
        ("a", later, 1.0, None),
        ("a", day, None, None),
        (None, day, 1.0, None),
        ("null", day, 1.0, None),
        ("a", day, 1.0, [day]),
        ("a", day, 1.0, [later]),
        ("a", day, 1.0, [None]),
        ("a", None, 1.0, None),
    ]
    found = deduped(spark, tmp_path, rows * 2, ["text", "t", "x", "parts"])
    key = lambda r: str(tuple(r))
    assert sorted(map(key, found)) == sorted(map(key, rows))


def claims(spark, number):
    values = {
        "ClaimID": F.concat(F.lit("C"), F.col("id").cast("string")),
        "PolicyID": F.lit("P1"),
        "incident_date": F.concat(F.date_add(F.lit("1995-05-01").cast("date"), (F.col("id") % 90).cast("int")), F.lit(" 14:30:00.0")),
        "number_of_vehicles_involved": (F.col("id") % 3 + 1).cast("string"),
        "bodily_injuries": (F.col("id") % 2).cast("string"),
        "incident_location": (F.col("id") % 9).cast("string"),
        "property_damage": F.lit("?"),
        "witnesses": (F.col("id") % 4).cast("string"),
    }
    rest = ["incident_state", "incident_city", "incident_type", "incident_severity", "injury",
            "property", "vehicle", "authorities_contacted", "collision_type",
            "police_report_available", "Claim_Rejected", "Claim_Logged_On", "Claim_Processed_On"]
    return spark.range(number).select(
        *[v.alias(n) for n, v in values.items()], *[F.lit(None).cast("string").alias(n) for n in rest]
    )


def landed(spark, monkeypatch, tmp_path, build):
    """The files that ``build`` has landed."""
    monkeypatch.setattr(exercises, "shared_folder", lambda s: str(tmp_path))
    build()
    files = [p for p in tmp_path.rglob("part-*") if "landing" in str(p)]
    assert files
    return [p.name for p in files]


def test_landed_claims_are_packed(spark, monkeypatch, tmp_path):
    rows = claims(spark, 400)
    names = landed(spark, monkeypatch, tmp_path, lambda: exercises.stream_dedup_table(spark, rows))
    assert len(names) == 3 * exercises.FILES_PER_ARRIVAL
    assert all(n.endswith(".json.gz") for n in names)


def test_documents_are_packed_and_bounded(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(exercises, "ROWS_PER_DOCUMENT", 70)
    rows, kept = claims(spark, 400), []
    names = landed(
        spark, monkeypatch, tmp_path,
        lambda: kept.extend(exercises.json_table(spark, rows).select("ClaimID").collect()),
    )
    assert sorted(r["ClaimID"] for r in kept) == sorted(f"C{i}" for i in range(400))
    assert all(n.endswith(".txt.gz") for n in names) and len(names) > 400 // 70


def test_packed_files_are_many(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(exercises, "LANDED_ROWS", 30)
    rows, policy = claims(spark, 400), spark.createDataFrame([("P1",)], "policy_number string")
    names = landed(
        spark, monkeypatch, tmp_path, lambda: exercises.stream_references(spark, rows, policy).count()
    )
    assert all(n.endswith(".json.gz") for n in names) and len(names) >= 400 // 30
