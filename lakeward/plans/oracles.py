"""The catalogue in DuckDB SQL, written from the expected values, not from the Spark plans."""

from __future__ import annotations

AS_OF = "2003-01-01"
RUN_TS = "2024-01-31 00:00:00"
MODEL = "rules"


def _title(x: str) -> str:
    words = f"string_split(lower(trim({x})), ' ')"
    return (
        f"array_to_string(list_transform({words}, "
        "lambda w: upper(substr(w, 1, 1)) || substr(w, 2)), ' ')"
    )


def _ts(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def _day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def _list(names: list[str], prefix: str = "") -> str:
    return ", ".join(prefix + n for n in names)


def _with(*ctes: str) -> str:
    """WITH clause of the named blocks and everything they need, in order of definition."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for needed in NEEDS.get(name, []):
            add(needed)
        if name not in wanted:
            wanted.append(name)

    for name in ctes:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS (\n{BLOCKS[n]}\n)" for n in wanted) + "\n"


REGION = """CASE r_name WHEN 'AFRICA' THEN 'West' WHEN 'AMERICA' THEN 'Central'
  WHEN 'ASIA' THEN 'East' WHEN 'EUROPE' THEN 'South' ELSE 'Middle East' END"""
REGION_RAW = """CASE r_name WHEN 'AFRICA' THEN 'w' WHEN 'AMERICA' THEN 'C '
  WHEN 'ASIA' THEN 'E' WHEN 'EUROPE' THEN ' s' ELSE 'middle east' END"""
STATE = "'Nation' || translate(n_nationkey::VARCHAR, '0123456789', 'abcdefghij')"
LINE = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"

CUSTOMER = ["CustomerID", "Region", "State", "City", "Marital", "Education", "Job", "Balance",
            "HHInsurance", "CarLoan", '"Default"']
CAR = ["car_id", "name", "km_driven", "fuel", "transmission", "mileage", "engine", "max_power",
       "torque", "seats", "model"]
POLICY = ["policy_number", "policy_bind_date", "policy_state", "policy_csl", "policy_deductable",
          "policy_annual_premium", "umbrella_limit", "car_id", "customer_id"]
SALE = ["sales_id", "car_id", "original_selling_price", "ad_placed_on", "sold_on", "region",
        "state", "city", "seller_type", "owner"]
CLAIM = ["policy_id", "incident_date", "incident_state", "incident_city", "incident_location",
         "incident_type", "incident_severity", "injury", "property", "vehicle",
         "authorities_contacted", "number_of_vehicles_involved", "property_damage",
         "collision_type", "bodily_injuries", "witnesses", "police_report_available",
         "claim_rejected", "claim_logged_on", "claim_processed_on"]
CLAIM_ALL = ["claim_id", *CLAIM, "claim_status", "claim_processing_days"]
CLAIM_TIMES = ["incident_date", "claim_logged_on", "claim_processed_on"]


def _shown(names: list[str], times: list[str] = (), days: list[str] = ()) -> str:
    shown = []
    for n in names:
        bare = n.split(".")[-1]
        if bare in times:
            shown.append(f"{_ts(n)} AS {bare}")
        elif bare in days:
            shown.append(f"{_day(n)} AS {bare}")
        else:
            shown.append(n)
    return ", ".join(shown)


def _unique(source: str, columns: list[str], by: list[str], key: str) -> str:
    return f"""SELECT {_list(columns)} FROM (
  SELECT *, row_number() OVER (PARTITION BY {_list(by)} ORDER BY {key}) AS rn FROM {source}
) WHERE rn = 1"""


def _reason(cases: list[tuple[str, str]]) -> str:
    whens = " ".join(f"WHEN {cond} THEN '{reason}'" for cond, reason in cases)
    return f"CASE {whens} END"


def _counted(names: list[str], cases: list[tuple[str, str]]) -> str:
    """JSON of the rows that pass and fail each rule, separated by commas."""
    parts = [
        f"""'{{"name":"{name}","dataset":"silver","passed_records":' ||
  count(*) FILTER (NOT coalesce({cond}, false)) || ',"failed_records":' ||
  count(*) FILTER ({cond}) || '}}'"""
        for name, (cond, _) in zip(names, cases, strict=True)
    ]
    return "concat_ws(',', " + ", ".join(parts) + ")"


def _reasons(cases: list[tuple[str, str]]) -> str:
    parts = ", ".join(f"CASE WHEN {cond} THEN '{reason}' END" for cond, reason in cases)
    return f"concat_ws('; ', {parts})"


CUSTOMER_BAD = [
    ("CustomerID IS NULL", "customer_id is null"),
    ("Balance < 0", "negative balance"),
    ("Marital = Education", "duplicate marital_education values"),
]
CAR_BAD = [
    ("car_id IS NULL", "car_id is null"),
    ("km_driven <= 0", "invalid km_driven"),
    ("fuel NOT IN ('Petrol', 'Diesel', 'Cng', 'Lpg')", "invalid fuel"),
    ("transmission NOT IN ('Manual', 'Automatic')", "invalid transmission"),
    ("seats <= 0", "invalid seats"),
]
CAR_RULES = ["valid_car_id", "valid_km", "valid_fuel", "valid_transmission", "valid_seats"]
POLICY_BAD = [
    ("policy_number IS NULL", "policy_number is null"),
    ("policy_bind_date IS NULL", "invalid policy_bind_date"),
    ("policy_annual_premium <= 0", "invalid premium"),
    ("policy_deductable < 0", "invalid deductible"),
    ("NOT has_car", "invalid car_id"),
    ("NOT has_customer", "invalid customer_id"),
    ("umbrella_limit < 0", "other issue"),
]
SALE_BAD = [
    ("sales_id IS NULL", "sales_id is null"),
    ("original_selling_price < 0", "negative price"),
    ("car_id IS NULL", "car_id is null"),
    ("NOT has_car", "car_id not found"),
    ("ad_placed_on IS NULL", "invalid ad_placed_on"),
    ("sold_on IS NULL AND trim(raw_sold_on) <> ''", "invalid sold_on"),
]
CLAIM_BAD = [
    ("claim_id IS NULL", "Missing Claim ID"),
    ("policy_id IS NULL", "Missing Policy ID"),
    ("injury < 0", "Invalid Injury Amount"),
    ("property < 0", "Invalid Property Amount"),
    ("vehicle < 0", "Invalid Vehicle Amount"),
    ("bodily_injuries < 0", "Invalid Bodily Injuries"),
    ("witnesses < 0", "Invalid Witness Count"),
    ("claim_rejected NOT IN ('YES', 'NO', 'UNKNOWN')", "Invalid Claim Rejected Flag"),
    ("NOT has_policy", "policy_id not found in policy table"),
]

BLOCKS = {
    "customers_clean": f"""SELECT
  CASE WHEN k % 97 <> 5 THEN 'C' || k END AS CustomerID, {REGION} AS Region, {STATE} AS State,
  'City' || lower(c_mktsegment) AS City,
  CASE WHEN crossed THEN e ELSE m END AS Marital, CASE WHEN crossed THEN m ELSE e END AS Education,
  upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS Job,
  CASE WHEN k % 101 <> 7 THEN c_acctbal END AS Balance,
  (k % 2)::INTEGER AS HHInsurance, (k % 3 = 1)::INTEGER AS CarLoan,
  CASE WHEN k % 11 <> 0 THEN (k % 13)::INTEGER END AS "Default",
  k, c_mktsegment, n_nationkey, n_name
FROM (
  SELECT *, k % 7 = 3 AND (m = 'Na' OR e = 'Na') AS crossed FROM (
    SELECT *, c_custkey AS k,
      ['Single', 'Married', 'Divorced', 'Na'][c_custkey % 4 + 1] AS m,
      ['Primary', 'Secondary', 'Tertiary', 'Terto', 'Na'][c_custkey % 5 + 1] AS e
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  )
)""",
    "customers_checked": f"SELECT *, {_reason(CUSTOMER_BAD)} AS error_reason FROM customers_clean",
    "customers_kept": "SELECT * FROM customers_checked WHERE error_reason IS NULL",
    "customers_valid": _unique("customers_kept", CUSTOMER, CUSTOMER[1:], "CustomerID"),
    "cars_clean": f"""SELECT 'K' || p_partkey AS car_id, {_title('p_name')} AS name,
  CASE WHEN s = 25 THEN 0 ELSE s * 1000 END AS km_driven,
  CASE WHEN p_type IN ('ECONOMY', 'SMALL') THEN 'Petrol' WHEN p_type = 'LARGE' THEN 'Diesel'
    WHEN p_type = 'MEDIUM' THEN 'Cng' WHEN p_type = 'STANDARD' THEN 'Lpg'
    WHEN s % 9 = 4 THEN 'Steam' END AS fuel,
  CASE WHEN s = 37 THEN 'Cvt' WHEN s % 2 = 0 THEN 'Manual' ELSE 'Automatic' END AS transmission,
  ((10 + s) || '.' || (s % 10))::DOUBLE AS mileage, 800 + s * 20 AS engine,
  CASE WHEN s % 13 <> 0 THEN 50 + s + 0.5::DOUBLE END AS max_power, s || 'Nm@ 2000rpm' AS torque,
  CASE WHEN s % 11 <> 0 THEN s % 8 END AS seats, p_brand AS model
FROM (SELECT *, p_size AS s FROM part)""",
    "cars_checked": f"SELECT *, {_reason(CAR_BAD)} AS error_reason FROM cars_clean",
    "cars_kept": "SELECT * FROM cars_checked WHERE error_reason IS NULL",
    "cars_valid": _unique("cars_kept", CAR, CAR[1:], "car_id"),
    "policy_clean": """SELECT CASE WHEN k % 211 <> 7 THEN 'P' || k END AS policy_number,
  CASE WHEN k % 53 <> 1 THEN o_orderdate::DATE END AS policy_bind_date,
  CASE o_orderstatus WHEN 'P' THEN 'UNKNOWN' ELSE o_orderstatus END AS policy_state,
  CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'UNKNOWN' ELSE o_orderpriority END AS policy_csl,
  CASE WHEN k % 89 = 2 THEN -1 ELSE (k % 5 * 250)::INTEGER END AS policy_deductable,
  CASE WHEN k % 71 = 3 THEN 0.0::DOUBLE ELSE o_totalprice END AS policy_annual_premium,
  CASE WHEN k % 83 = 4 THEN -5 ELSE k % 10 * 1000000 END AS umbrella_limit,
  'K' || first_part AS car_id, 'C' || o_custkey AS customer_id
FROM (
  SELECT *, o_orderkey AS k FROM orders LEFT JOIN (
    SELECT l_orderkey, min(l_partkey) AS first_part FROM lineitem GROUP BY l_orderkey
  ) ON o_orderkey = l_orderkey
)""",
    "policy_checked": f"""SELECT *, {_reason(POLICY_BAD)} AS error_reason FROM (
  SELECT *, coalesce(car_id IN (SELECT car_id FROM cars_valid), false) AS has_car,
    coalesce(customer_id IN (SELECT CustomerID FROM customers_valid), false) AS has_customer
  FROM policy_clean
)""",
    "policy_kept": "SELECT * FROM policy_checked WHERE error_reason IS NULL",
    "policy_valid": _unique("policy_kept", POLICY, POLICY, "policy_number"),
    "claims_clean": f"""SELECT {LINE} || copy AS claim_id, 'P' || l_orderkey AS policy_id,
  o_orderdate + INTERVAL '14 hours 30 minutes' AS incident_date,
  o_orderstatus AS incident_state, 'City ' || l_returnflag AS incident_city,
  l_suppkey || ' Main St' AS incident_location,
  ['Single Vehicle Collision', 'Parked Car', 'Vehicle Theft'][l_linenumber % 3 + 1] AS incident_type,
  CASE WHEN l_discount < 0.02 THEN 'Trivial Damage' WHEN l_discount < 0.06 THEN 'Minor Damage'
    ELSE 'Total Loss' END AS incident_severity,
  CASE WHEN l_quantity = 50 THEN -1 ELSE l_tax * l_extendedprice END AS injury,
  CASE WHEN l_quantity <> 13 THEN l_extendedprice END AS property,
  l_discount * l_extendedprice AS vehicle,
  ['Unknown', 'Police', 'Fire', 'Ambulance'][l_linenumber % 4 + 1] AS authorities_contacted,
  l_linenumber % 3 + 1 AS number_of_vehicles_involved,
  CASE WHEN l_quantity < 10 THEN 'UNKNOWN' ELSE 'YES' END AS property_damage,
  CASE WHEN l_linenumber = 5 THEN 'UNKNOWN' ELSE 'Rear Collision' END AS collision_type,
  l_linenumber % 3 AS bodily_injuries,
  CASE WHEN l_suppkey % 53 = 0 THEN -2 ELSE l_linenumber - 1 END AS witnesses,
  CASE WHEN l_quantity < 3 THEN 'UNKNOWN' WHEN l_linestatus = 'O' THEN 'NO' ELSE 'YES' END
    AS police_report_available,
  CASE l_returnflag WHEN 'R' THEN 'YES' WHEN 'A' THEN 'NO' ELSE 'UNKNOWN' END AS claim_rejected,
  o_orderdate + to_days(l_linenumber) AS claim_logged_on,
  CASE WHEN l_linestatus <> 'O' THEN l_shipdate END AS claim_processed_on,
  CASE WHEN l_linestatus <> 'O' THEN 'PROCESSED' ELSE 'OPEN' END AS claim_status,
  CASE WHEN l_linestatus <> 'O' THEN
    date_diff('day', o_orderdate, l_shipdate)::INTEGER - l_linenumber END AS claim_processing_days,
  l_linenumber AS report_delay_days
FROM (
  SELECT *, unnest(CASE WHEN l_discount >= 0.1 THEN ['', 'R'] ELSE [''] END) AS copy
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)""",
    "claims_checked": f"""SELECT *, {_reason(CLAIM_BAD)} AS error_reason FROM (
  SELECT *, policy_id IN (SELECT policy_number FROM policy_valid) AS has_policy FROM claims_clean
)""",
    "claims_kept": "SELECT * FROM claims_checked WHERE error_reason IS NULL",
    "claims_valid": _unique(
        "claims_kept", [*CLAIM_ALL, "report_delay_days"], CLAIM, "claim_id"
    ),
    "sales_clean": f"""SELECT 'S' || {LINE} AS sales_id,
  CASE WHEN l_linenumber <> 7 THEN 'K' || l_partkey END AS car_id,
  CASE WHEN l_quantity = 49 THEN -l_extendedprice ELSE l_extendedprice END AS original_selling_price,
  CASE WHEN l_suppkey % 31 <> 3 THEN o_orderdate END AS ad_placed_on,
  CASE WHEN l_linestatus <> 'O' AND l_suppkey % 37 <> 4 THEN l_shipdate END AS sold_on,
  CASE WHEN l_linestatus = 'O' THEN '' WHEN l_suppkey % 37 = 4 THEN 'soon' ELSE 'date' END
    AS raw_sold_on,
  {REGION} AS region, {STATE} AS state, 'Town ' AS city,
  CASE WHEN l_linenumber % 2 = 0 THEN 'Dealer' ELSE 'Individual' END AS seller_type,
  ['First Owner', 'Second Owner', 'Third Owner'][l_linenumber % 3 + 1] AS owner,
  l_linenumber, l_linestatus, l_suppkey, o_orderdate, l_shipdate
FROM (
  SELECT *, unnest(range(CASE WHEN l_tax >= 0.08 THEN 2 ELSE 1 END)) AS copy
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey
    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
)""",
    "sales_checked": f"""SELECT *, {_reason(SALE_BAD)} AS error_reason FROM (
  SELECT *, coalesce(car_id IN (SELECT car_id FROM cars_valid), false) AS has_car FROM sales_clean
)""",
    "sales_kept": "SELECT * FROM sales_checked WHERE error_reason IS NULL",
    "sales_valid": _unique("sales_kept", SALE, SALE, "sales_id"),
    "fact_claims": """SELECT c.*, p.customer_id,
  CASE WHEN claim_rejected = 'YES' THEN 1 ELSE 0 END AS rejected_flag,
  coalesce(injury, 0) + coalesce(property, 0) + coalesce(vehicle, 0) AS total_claim_amount
FROM claims_valid c LEFT JOIN policy_valid p ON c.policy_id = p.policy_number""",
    "car_owner": """SELECT car_id, customer_id FROM (
  SELECT *, row_number() OVER (
    PARTITION BY car_id ORDER BY policy_bind_date DESC, policy_number) AS rn FROM policy_valid
) WHERE rn = 1""",
    "fact_sales": f"""SELECT s.*, o.customer_id,
  CASE WHEN sold_on IS NULL THEN 1 ELSE 0 END AS unsold_flag,
  date_diff('day', ad_placed_on::DATE, coalesce(sold_on::DATE, DATE '{AS_OF}'))::INTEGER
    AS days_listed
FROM sales_valid s LEFT JOIN car_owner o ON s.car_id = o.car_id""",
    "issues": "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS table_name, error_reason AS rule_name, count(*) AS affected_records
FROM {name}_checked WHERE error_reason IS NOT NULL GROUP BY error_reason"""
        for name in ("cars", "customers", "policy", "sales", "claims")
    ),
    "issues_rated": """SELECT *, CASE WHEN affected_records > 100 THEN 'HIGH'
  WHEN affected_records > 10 THEN 'MEDIUM' ELSE 'LOW' END AS severity FROM issues""",
    "scored": """SELECT *,
  (z * 0.25 + r2 * 0.25 + r3 * 0.20 + r4 * 0.15 + r5 * 0.15) * 100 AS score,
  concat_ws(',', CASE WHEN z > 0 THEN 'R1' END, CASE WHEN r2 = 1 THEN 'R2' END,
    CASE WHEN r3 = 1 THEN 'R3' END, CASE WHEN r4 = 1 THEN 'R4' END,
    CASE WHEN r5 = 1 THEN 'R5' END) AS rules
FROM (
  SELECT *, abs((property - avg(property) OVER ()) / stddev_samp(property) OVER ()) AS z,
    CASE WHEN incident_severity = 'Trivial Damage' AND property > 5000 THEN 1 ELSE 0 END AS r2,
    count(claim_id) OVER (PARTITION BY policy_id) AS policy_count,
    CASE WHEN count(claim_id) OVER (PARTITION BY policy_id) > 2 THEN 1 ELSE 0 END AS r3,
    CASE WHEN report_delay_days > 3 THEN 1 ELSE 0 END AS r4,
    CASE WHEN police_report_available = 'NO' AND witnesses = 0 THEN 1 ELSE 0 END AS r5
  FROM claims_valid
)""",
    "tiered": """SELECT *, CASE WHEN score >= 70 THEN 'HIGH' WHEN score >= 45 THEN 'MEDIUM'
  WHEN score >= 40 THEN 'LOW' ELSE 'NORMAL' END AS tier FROM scored""",
    "flow_events": """SELECT 'p' || (user_id % 3) AS pipeline_id,
  'pipeline ' || (user_id % 3) AS pipeline_name, 'u' || user_id AS update_id,
  event_type AS dataset_name, ts, n,
  CASE WHEN n % 10 <> 9 THEN ['STARTING', 'RUNNING', 'COMPLETED', 'FAILED'][n % 4 + 1] END AS status,
  CASE WHEN n % 3 <> 0 THEN k ELSE 0 END AS out_rows,
  CASE WHEN n % 3 <> 0 AND n % 2 = 0 THEN n % 5 ELSE 0 END AS up_rows,
  CASE WHEN n % 3 <> 0 THEN n % 2 ELSE 0 END AS del_rows,
  CASE WHEN n % 4 = 2 THEN n % 11 ELSE 0 END AS dropped,
  CASE WHEN n % 8 = 2 THEN k * 2 END AS passed, CASE WHEN n % 8 = 2 THEN n % 7 END AS failed
FROM (SELECT *, event_id AS n, json_extract_string(props, '$.k')::BIGINT AS k FROM events)
WHERE n % 23 <> 0 AND n % 29 <> 0 AND n % 31 <> 0""",
    "runs": """SELECT pipeline_id, pipeline_name, update_id, dataset_name,
  min(ts) FILTER (status IS NOT NULL) AS start_ts, max(ts) FILTER (status IS NOT NULL) AS end_ts,
  arg_max(status, ts) FILTER (status IS NOT NULL) AS final_status,
  sum(out_rows)::BIGINT AS total_output_rows, sum(up_rows)::BIGINT AS total_upserted_rows,
  sum(del_rows)::BIGINT AS total_deleted_rows, max(dropped) AS total_dropped_rows,
  arg_max(passed, ts) FILTER (passed IS NOT NULL) AS passed,
  arg_max(failed, ts) FILTER (passed IS NOT NULL) AS failed
FROM flow_events GROUP BY ALL""",
    "centroids": """SELECT label, list(mean ORDER BY pos) AS q FROM (
  SELECT label, pos, avg(v) AS mean FROM (
    SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS pos
    FROM embeddings
  ) GROUP BY label, pos
) GROUP BY label""",
    "questions": """SELECT label, list_transform(q, lambda x: x / norm) AS q FROM (
  SELECT label, q, sqrt(list_sum(list_transform(q, lambda x: x * x))) AS norm FROM centroids)""",
    "vectors": """SELECT vec_id, list_transform(e, lambda x: x / norm) AS e FROM (
  SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm
  FROM (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings))""",
    "policy_docs": """SELECT policy_number, chr(10) || 'Policy Number: ' || policy_number || chr(10)
  || 'State: ' || policy_state || chr(10) || 'CSL Coverage: ' || policy_csl || chr(10)
  || 'Deductible: ' || policy_deductable || chr(10)
  || 'Annual Premium: ' || policy_annual_premium || chr(10)
  || 'Umbrella Limit: ' || umbrella_limit || chr(10) || 'Vehicle ID: ' || car_id || chr(10)
  || 'Customer ID: ' || customer_id || chr(10) AS text FROM policy_valid""",
    "policy_ranked": """SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, policy_number || '_0') AS rank
  FROM (
    SELECT label, policy_number, text, round(list_inner_product(q, e), 9) AS score
    FROM questions, vectors JOIN policy_docs
      ON CAST(substr(policy_number, 2) AS BIGINT) % (SELECT count(*) FROM embeddings) = vec_id
  )
) WHERE rank <= 4""",
    "chunks": """SELECT doc_id || '_' || i AS chunk_id, doc_id, substr(text, i * 320 + 1, 400) AS text
FROM (
  SELECT doc_id, text, unnest(range(greatest(1, ceil((length(text) - 80) / 320.0)::BIGINT))) AS i
  FROM documents WHERE length(text) > 0
)""",
    "words": """SELECT id, ('0x' || md5(lower(w))[1:8])::BIGINT % 384 AS bucket, count(*) AS n
FROM (
  SELECT chunk_id AS id, unnest(regexp_extract_all(text, '[A-Za-z0-9]+')) AS w FROM chunks
  UNION ALL SELECT 'q' || item_id, unnest(regexp_extract_all(text, '[A-Za-z0-9]+')) FROM benchmark
) GROUP BY ALL""",
    "rarity": """SELECT bucket, ln(((SELECT count(*) FROM chunks) + 1) / (count(*) + 1)) AS weight
FROM words WHERE id[1] <> 'q' GROUP BY bucket""",
    "weighed": """SELECT id, bucket,
  n * coalesce(weight, (SELECT ln(count(*) + 1) FROM chunks)) AS x FROM words LEFT JOIN rarity USING (bucket)""",
    "lengths": "SELECT id, sqrt(sum(x * x)) AS length FROM weighed GROUP BY id",
    "products": """SELECT q.id AS question, c.id AS chunk_id, sum(q.x * c.x) AS product
FROM weighed q JOIN weighed c USING (bucket) WHERE q.id[1] = 'q' AND c.id[1] <> 'q' GROUP BY ALL""",
    "passages": """SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, chunk_id) AS rank FROM (
    SELECT item_id AS question_id, c.chunk_id, doc_id, c.text,
      round(coalesce(product / (a.length * b.length), 0), 9) AS score
    FROM benchmark q CROSS JOIN chunks c
      LEFT JOIN products p ON p.question = 'q' || item_id AND p.chunk_id = c.chunk_id
      LEFT JOIN lengths a ON a.id = 'q' || item_id LEFT JOIN lengths b ON b.id = c.chunk_id
  )
) WHERE rank <= 4""",
    "asked": """SELECT question_id, any_value(b.text) AS question,
  string_agg(chr(10) || 'Policy ' || doc_id || ':' || chr(10) || p.text || chr(10), '' ORDER BY rank)
    AS context,
  array_to_string(list_sort(list(DISTINCT doc_id::VARCHAR)), '; ') AS source_policies,
  round(avg(score), 6) AS confidence_score
FROM passages p JOIN benchmark b ON question_id = item_id GROUP BY question_id""",
    "kpi_customer": """SELECT count(*) AS total_customers, round(avg(Balance), 2) AS avg_balance,
  count(DISTINCT Region) AS region_count, sum(HHInsurance)::BIGINT AS hh_insurance_count,
  sum(CarLoan)::BIGINT AS car_loan_count FROM customers_valid""",
    "kpi_policy": """SELECT count(*) AS total_policies,
  round(avg(policy_annual_premium), 2) AS avg_premium,
  round(avg(policy_deductable), 2) AS avg_deductible,
  round(avg(umbrella_limit), 2) AS avg_umbrella_limit FROM policy_valid""",
    "kpi_claims": """SELECT count(*) AS total_claims,
  round(avg(total_claim_amount), 2) AS avg_claim_amount,
  round(avg(rejected_flag), 2) AS rejection_rate,
  round(avg(claim_processing_days), 2) AS avg_processing_days FROM fact_claims""",
}

NEEDS = {
    "customers_checked": ["customers_clean"],
    "customers_kept": ["customers_checked"],
    "customers_valid": ["customers_kept"],
    "cars_checked": ["cars_clean"],
    "cars_kept": ["cars_checked"],
    "cars_valid": ["cars_kept"],
    "policy_checked": ["policy_clean", "cars_valid", "customers_valid"],
    "policy_kept": ["policy_checked"],
    "policy_valid": ["policy_kept"],
    "claims_checked": ["claims_clean", "policy_valid"],
    "claims_kept": ["claims_checked"],
    "claims_valid": ["claims_kept"],
    "sales_checked": ["sales_clean", "cars_valid"],
    "sales_kept": ["sales_checked"],
    "sales_valid": ["sales_kept"],
    "fact_claims": ["claims_valid", "policy_valid"],
    "car_owner": ["policy_valid"],
    "fact_sales": ["sales_valid", "car_owner"],
    "issues": ["cars_checked", "customers_checked", "policy_checked", "sales_checked",
               "claims_checked"],
    "issues_rated": ["issues"],
    "scored": ["claims_valid"],
    "tiered": ["scored"],
    "runs": ["flow_events"],
    "questions": ["centroids"],
    "policy_docs": ["policy_valid"],
    "policy_ranked": ["questions", "vectors", "policy_docs"],
    "words": ["chunks"],
    "rarity": ["words"],
    "weighed": ["rarity"],
    "lengths": ["weighed"],
    "products": ["weighed"],
    "passages": ["products", "lengths"],
    "asked": ["passages"],
    "kpi_customer": ["customers_valid"],
    "kpi_policy": ["policy_valid"],
    "kpi_claims": ["fact_claims"],
}

_CUSTOMER_OUT = _list(CUSTOMER)
_CAR_OUT = _list(CAR)
_RENAMED = "CASE WHEN lower(fuel) = 'petrol' THEN '~' || name ELSE name END AS name"
_POLICY_OUT = _shown(POLICY, days=["policy_bind_date"])
_SALE_OUT = _shown(SALE, times=["ad_placed_on", "sold_on"])
_CLAIM_OUT = _shown(CLAIM_ALL, times=CLAIM_TIMES)
_STAMP = f"'{RUN_TS}' AS insert_timestamp"
_REPORT = """claim_id, property, incident_severity, incident_type, round(score, 6) AS anomaly_score,
  tier AS priority_tier, rules AS triggered_rules"""
_RUN_KEYS = "pipeline_id, pipeline_name, update_id, dataset_name"


_BRIEF = """'Claim ' || claim_id || ': ' || incident_type || ', ' || incident_severity
  || ', amount ' || coalesce(printf('%.2f', property), 'None') || ', reported after '
  || report_delay_days || ' days, rules ' || rules || '. What should be looked into?'"""
_ISSUE = """affected_records || ' rows of ' || table_name || ' are in quarantine for ''' || rule_name
  || ''' (' || severity || '). What may have caused this?'"""
_CHECKS = """'To do: ' || coalesce(nullif(concat_ws('; ',
    if(contains(rules, 'R1'), 'compare the amount with other claims', NULL),
    if(contains(rules, 'R2'), 'have the damage inspected', NULL),
    if(contains(rules, 'R3'), 'read the earlier claims of the policy', NULL),
    if(contains(rules, 'R4'), 'ask why it was reported late', NULL),
    if(contains(rules, 'R5'), 'ask for a police report or a witness', NULL)), ''), 'nothing') || '.'"""
_CAUSES = """'Likely cause: ' || coalesce(nullif(concat_ws('; ',
    if(rule_name ILIKE '%null%', 'the source left the value out', NULL),
    if(rule_name ILIKE '%not found%', 'the row referred to is missing or in quarantine itself', NULL),
    if(rule_name ILIKE '%duplicate%', 'one value was entered twice', NULL),
    if(rule_name ILIKE '%negative%', 'a sign is wrong', NULL),
    if(rule_name ILIKE '%invalid%', 'the value is outside its domain or of another format', NULL)),
  ''), 'not known') || '.'"""
_STATE = f"'{MODEL}' AS model_name, 'SUCCESS' AS"
_IN_WORDS = """domain || ': ' || replace(replace(replace(replace(trim(kpi_json, '{}'),
  '"', ''), ',', ', '), ':', ' '), '_', ' ') || '.'"""


def _domain(name: str, block: str) -> str:
    return f"""SELECT '{name}' AS domain, to_json({block})::VARCHAR AS kpi_json FROM {block}"""


ORACLES: dict[str, str] = {
    # --- ingest ---
    "ingest_csv_header_drift": _with("customers_clean")
    + f"""SELECT {_CUSTOMER_OUT}, '{RUN_TS}' AS load_ts, CASE k % 3 WHEN 0 THEN 'customers%20a'
  WHEN 1 THEN 'customers%2520b' ELSE 'customers%23c%20é' END AS source_folder
FROM customers_clean""",
    "ingest_json_multiline": _with("claims_clean")
    + f"""SELECT {_CLAIM_OUT}, '{{' || nullif(concat_ws(',',
  '"adjuster":"' || adjuster || '"', '"Notes":' || if(early, notes, '"' || notes || '"')), '')
  || '}}' AS _rescued_data, notes, if(early, notes::INTEGER, NULL) AS notes_length, adjuster
FROM (
  SELECT *, bodily_injuries = 0 AS early, CASE WHEN witnesses = 0 THEN
      if(bodily_injuries = 0, '9', 'none seen') END AS notes,
    CASE WHEN property_damage = 'UNKNOWN' THEN 'CITY ' || lower(incident_city[6:]) END AS adjuster
  FROM claims_clean
)""",
    "ingest_incremental_replay": _with("cars_clean") + f"SELECT {_CAR_OUT} FROM cars_clean",
    # --- column functions ---
    "clean_text_columns": f"""SELECT doc_id, md5(trim(text, ' ')) AS trimmed_md5,
  length(trim(text, ' ')) AS trimmed_length, upper(lang) AS lang_upper,
  ' ' || lower(source) AS source_lower, {_title("'  ' || source || ' of ' || lang")} AS source_title,
  upper(l[1]) || lower(l[2:]) AS source_letters, CASE WHEN lang <> 'en' THEN lang END AS lang_or_null
FROM (SELECT *, regexp_replace(source || lang, '[^a-zA-Z ]', '', 'g') AS l FROM documents)""",
    "extract_number_from_text": """SELECT p_partkey,
  regexp_extract(p_brand, '[0-9]+')::INTEGER AS brand_number, p_retailprice AS price,
  NULL::DOUBLE AS no_number FROM part""",
    "code_expansion": f"""SELECT {REGION_RAW} AS code, {REGION} AS region, count(*) AS customers
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ALL""",
    "first_of_aliases": f"""SELECT CASE WHEN c_custkey % 97 = 5 THEN '' ELSE 'C' || c_custkey END
    AS customer_id, {REGION_RAW} AS region,
  ' city-' || lower(c_mktsegment) || n_nationkey AS city, NULL::VARCHAR AS absent
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "null_if_placeholder": _with("policy_clean")
    + """SELECT coalesce(policy_number, '') AS policy_number, policy_state AS state,
  policy_csl AS csl, car_id FROM policy_clean""",
    "flag_normalisation": _with("claims_clean")
    + """SELECT claim_rejected AS rejected, police_report_available AS report, count(*) AS claims
FROM claims_clean GROUP BY ALL""",
    "swap_misfiled_fields": _with("customers_clean")
    + "SELECT CustomerID, Marital, Education FROM customers_clean",
    "repair_timestamp": _with("claims_clean")
    + f"""SELECT claim_id, {_ts('incident_date')} AS incident_date,
  {_ts('claim_processed_on')} AS processed_on FROM claims_clean""",
    "parse_date_formats": _with("sales_clean")
    + f"""SELECT sales_id, {_ts('ad_placed_on')} AS ad_placed_on, {_ts('sold_on')} AS sold_on,
  CASE WHEN ad_placed_on IS NULL THEN {_day('o_orderdate')} END AS other_format FROM sales_clean""",
    "derived_delays_and_status": _with("claims_clean")
    + "SELECT claim_id, claim_status, claim_processing_days, report_delay_days FROM claims_clean",
    "policy_age": _with("policy_valid")
    + f"""SELECT policy_number, {_day('policy_bind_date')} AS policy_bind_date,
  date_diff('day', policy_bind_date, DATE '{AS_OF}')::INTEGER AS policy_age_days FROM policy_valid""",
    # --- entities ---
    "cars_cleaned": _with("cars_clean") + f"SELECT {_CAR_OUT} FROM cars_clean",
    "cars_valid": _with("cars_valid") + f"SELECT {_CAR_OUT}, {_STAMP} FROM cars_valid",
    "cars_quarantine": _with("cars_checked")
    + f"""SELECT car_id, name, km_driven, fuel, transmission, seats, error_reason,
  {_reasons(CAR_BAD)} AS error_reasons, {_STAMP} FROM cars_checked WHERE error_reason IS NOT NULL""",
    "customers_cleaned": _with("customers_clean") + f"SELECT {_CUSTOMER_OUT} FROM customers_clean",
    "customers_valid": _with("customers_valid")
    + f"SELECT {_CUSTOMER_OUT}, {_STAMP} FROM customers_valid",
    "customers_quarantine": _with("customers_checked")
    + f"""SELECT CustomerID, Balance, State, City, Marital, Education, error_reason,
  {_reasons(CUSTOMER_BAD)} AS error_reasons, {_STAMP} FROM customers_checked WHERE error_reason IS NOT NULL""",
    "policy_cleaned": _with("policy_clean") + f"SELECT {_POLICY_OUT} FROM policy_clean",
    "policy_valid": _with("policy_valid")
    + f"""SELECT {_POLICY_OUT}, {_STAMP}, date_diff('day', policy_bind_date, DATE '{AS_OF}')::INTEGER
  AS policy_age_days FROM policy_valid""",
    "policy_quarantine": _with("policy_checked")
    + f"""SELECT {_POLICY_OUT}, error_reason, {_reasons(POLICY_BAD)} AS error_reasons, {_STAMP}
FROM policy_checked WHERE error_reason IS NOT NULL""",
    "sales_cleaned": _with("sales_clean") + f"SELECT {_SALE_OUT} FROM sales_clean",
    "sales_valid": _with("sales_valid") + f"SELECT {_SALE_OUT}, {_STAMP} FROM sales_valid",
    "sales_quarantine": _with("sales_checked")
    + f"""SELECT sales_id, original_selling_price, car_id,
  CASE WHEN l_suppkey % 31 = 3 THEN strftime(o_orderdate, '%Y/%m/%d')
    ELSE strftime(o_orderdate, '%d-%m-%Y %H:%M') END AS _raw_ad_placed_on,
  CASE WHEN l_linestatus = 'O' THEN CASE WHEN l_linenumber % 2 = 0 THEN '' END
    WHEN l_suppkey % 37 = 4 THEN 'soon'
    ELSE strftime(l_shipdate, '%d-%m-%Y %H:%M') END AS _raw_sold_on,
  error_reason, {_reasons(SALE_BAD)} AS error_reasons, {_STAMP}
FROM sales_checked WHERE error_reason IS NOT NULL""",
    "claims_cleaned": _with("claims_clean") + f"SELECT {_CLAIM_OUT} FROM claims_clean",
    "claims_valid": _with("claims_valid") + f"SELECT {_CLAIM_OUT}, {_STAMP} FROM claims_valid",
    "claims_quarantine": _with("claims_checked")
    + f"""SELECT claim_id, policy_id, injury, property, vehicle, bodily_injuries, witnesses,
  claim_rejected, error_reason, {_reasons(CLAIM_BAD)} AS error_reasons, {_STAMP}
FROM claims_checked WHERE error_reason IS NOT NULL""",
    # --- rules ---
    "rule_counts": _with("claims_checked")
    + "\nUNION ALL\n".join(
        f"""SELECT '{name}' AS rule_name, count(*) FILTER (NOT coalesce({bad}, false)) AS passed_records,
  count(*) FILTER ({bad}) AS failed_records FROM claims_checked"""
        for name, (bad, _) in zip(
            ["valid_claim_id", "valid_policy_id", "valid_injury", "valid_property",
             "valid_vehicle", "valid_bodily_injuries", "valid_witnesses", "valid_claim_rejected",
             "known_policy"],
            CLAIM_BAD,
            strict=True,
        )
    ),
    "rule_warnings": _with("customers_clean")
    + "SELECT CustomerID, State, City, 'invalid state; invalid city' AS _warnings FROM customers_clean",
    "rule_routes": _with("sales_checked")
    + """SELECT CASE WHEN error_reason IS NULL THEN 'valid' ELSE 'quarantine' END AS route,
  error_reason, count(*) AS sales FROM sales_checked GROUP BY ALL""",
    # --- references ---
    "fk_valid": _with("policy_clean", "customers_valid")
    + """SELECT policy_number, customer_id FROM policy_clean p
WHERE EXISTS (SELECT 1 FROM customers_valid c WHERE c.CustomerID = p.customer_id)""",
    "fk_orphans": _with("policy_clean", "customers_valid")
    + """SELECT policy_number, customer_id FROM policy_clean p
WHERE NOT EXISTS (SELECT 1 FROM customers_valid c WHERE c.CustomerID = p.customer_id)""",
    "fk_flagged": _with("policy_checked")
    + "SELECT policy_number, car_id, customer_id, has_car, has_customer FROM policy_checked",
    # --- duplicates ---
    "dedup_business_cols": _with("cars_clean") + _unique("cars_clean", CAR, CAR[1:], "car_id"),
    "dedup_claims": _with("claims_clean")
    + f"SELECT {_CLAIM_OUT} FROM ({_unique('claims_clean', CLAIM_ALL, CLAIM, 'claim_id')})",
    "dedup_documents": """SELECT doc_id, lang, source, n_chars FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents
) WHERE rn = 1""",
    "dedup_against_existing_nullsafe": _with("cars_clean", "cars_valid")
    + f"""SELECT {_CAR_OUT} FROM cars_clean n WHERE NOT EXISTS (SELECT 1 FROM cars_valid o WHERE
  {' AND '.join(f'n.{c} IS NOT DISTINCT FROM o.{c}' for c in CAR)})""",
    "dedup_first_version_wins": _with("policy_clean", "policy_valid")
    + f"""SELECT {_POLICY_OUT} FROM policy_clean n WHERE NOT EXISTS (
  SELECT 1 FROM policy_valid o WHERE n.policy_number IS NOT DISTINCT FROM o.policy_number)""",
    # --- dimensions, facts, KPIs ---
    "dim_upsert_latest": f"""SELECT customer, {_ts('updated_at')} AS updated_at, amount FROM (
  SELECT *, row_number() OVER (PARTITION BY customer ORDER BY updated_at DESC, amount DESC) AS rn
  FROM (
    SELECT c_custkey AS customer, TIMESTAMP '1990-01-01' AS updated_at, c_acctbal AS amount
    FROM customer UNION ALL SELECT o_custkey, o_orderdate, o_totalprice FROM orders
  )
) WHERE rn = 1""",
    "dim_customers": _with("customers_valid")
    + f"SELECT {_CUSTOMER_OUT}, {_STAMP} FROM customers_valid",
    "dim_policy": _with("policy_valid") + f"SELECT {_POLICY_OUT}, {_STAMP} FROM policy_valid",
    "dim_cars": _with("cars_valid") + f"SELECT {_CAR_OUT}, {_STAMP} FROM cars_valid",
    "dim_cars_two_batches": _with("cars_valid")
    + f"""SELECT {', '.join(_RENAMED if c == 'name' else c for c in CAR)},
  {_ts("CASE WHEN lower(fuel) = 'petrol' THEN TIMESTAMP '2024-01-02' ELSE TIMESTAMP '2024-01-01' END")}
    AS insert_timestamp
FROM cars_valid""",
    "fact_claims": _with("fact_claims")
    + f"""SELECT claim_id, policy_id AS policy_number, customer_id,
  {_shown(CLAIM_TIMES, times=CLAIM_TIMES)}, incident_state, incident_city, incident_location,
  incident_type, collision_type, incident_severity, authorities_contacted,
  number_of_vehicles_involved, property_damage, bodily_injuries, witnesses,
  police_report_available, injury AS injury_amount, property AS property_amount,
  vehicle AS vehicle_amount, claim_rejected, claim_processing_days AS processing_days,
  rejected_flag, total_claim_amount, {_STAMP} FROM fact_claims""",
    "fact_sales": _with("fact_sales")
    + f"SELECT {_SALE_OUT}, customer_id, unsold_flag, days_listed, {_STAMP} FROM fact_sales",
    "claim_rejection_rate_by_region_policy": _with("fact_claims", "customers_valid")
    + """SELECT State AS customer_region, policy_csl AS policy_type, count(*) AS total_claims,
  sum(rejected_flag)::BIGINT AS rejected_claims,
  round(sum(rejected_flag) * 100.0::DOUBLE / count(*), 2) AS rejection_rate_pct
FROM fact_claims f LEFT JOIN policy_valid p ON f.policy_id = p.policy_number
  LEFT JOIN customers_valid c ON f.customer_id = c.CustomerID GROUP BY ALL""",
    "avg_claim_processing_time_by_region": _with("fact_claims", "customers_valid")
    + """SELECT State AS customer_region, round(avg(claim_processing_days), 2) AS avg_processing_days
FROM fact_claims f LEFT JOIN customers_valid c ON f.customer_id = c.CustomerID
WHERE claim_processing_days IS NOT NULL GROUP BY ALL""",
    "unsold_cars_by_model_region": _with("fact_sales", "cars_valid")
    + """SELECT coalesce(state, 'Unknown') AS customer_region, name AS car_name, model AS car_model,
  count(*) AS unsold_cars_count, round(avg(days_listed), 2) AS avg_days_unsold,
  max(days_listed) AS max_days_unsold
FROM fact_sales f LEFT JOIN cars_valid c ON f.car_id = c.car_id WHERE unsold_flag = 1 GROUP BY ALL""",
    "customer_kpis": _with("kpi_customer") + "SELECT * FROM kpi_customer",
    "policy_kpis": _with("kpi_policy") + "SELECT * FROM kpi_policy",
    "claims_kpis": _with("kpi_claims") + "SELECT * FROM kpi_claims",
    # --- quality and audit ---
    "dq_issues_by_rule": _with("issues_rated") + "SELECT * FROM issues_rated",
    "audit_metrics": _with("runs")
    + f"""SELECT {_RUN_KEYS}, {_ts('start_ts')} AS start_time, {_ts('end_ts')} AS end_time,
  (epoch(date_trunc('second', end_ts)) - epoch(date_trunc('second', start_ts))) AS duration_seconds,
  final_status, total_output_rows, total_upserted_rows, total_deleted_rows, total_dropped_rows,
  CASE WHEN passed IS NOT NULL THEN '[{{"name":"valid_' || dataset_name || '","dataset":"'
    || dataset_name || '","passed_records":' || passed || ',"failed_records":' || failed || '}}]' END
    AS expectations, '{RUN_TS}' AS audit_timestamp FROM runs""",
    "audit_expectations": _with("runs")
    + f"""SELECT {_RUN_KEYS}, 'valid_' || dataset_name AS expectation_name,
  dataset_name AS expectation_dataset, passed::INTEGER AS passed_records,
  failed::INTEGER AS failed_records, final_status, '{RUN_TS}' AS audit_timestamp
FROM runs WHERE passed IS NOT NULL""",
    # --- anomaly ---
    "anomaly_zscore": _with("claims_clean")
    + """SELECT claim_id, round(abs((property - avg(property) OVER ()) / stddev_samp(property) OVER ()), 6)
  AS z FROM claims_clean""",
    "anomaly_rules": _with("scored")
    + """SELECT claim_id, report_delay_days, policy_count, r2 AS r2_severity_mismatch,
  r3 AS r3_repeat_claimant, r4 AS r4_reporting_delay, r5 AS r5_missing_docs FROM scored""",
    "anomaly_scored": _with("tiered")
    + """SELECT claim_id, round(score, 6) AS anomaly_score, tier AS priority_tier,
  rules AS triggered_rules FROM tiered""",
    "anomaly_report": _with("tiered") + f"SELECT {_REPORT} FROM tiered WHERE tier <> 'NORMAL'",
    "anomaly_top": _with("tiered")
    + f"SELECT {_REPORT} FROM tiered WHERE tier = 'HIGH' ORDER BY anomaly_score DESC",
    # --- text and vectors ---
    "history_latest": f"""SELECT event_id, {_ts('ts')} AS ts, event_type FROM events
ORDER BY events.ts DESC, event_id LIMIT 10""",
    "policy_text": _with("policy_docs") + "SELECT policy_number, text FROM policy_docs",
    "document_chunks": """SELECT doc_id || '_' || i AS chunk_id, doc_id,
  substr(text, i * 320 + 1, 400) AS text
FROM (
  SELECT doc_id, text, unnest(range(greatest(1, ceil((length(text) - 80) / 320.0)::BIGINT))) AS i
  FROM documents WHERE length(text) > 0
)""",
    "text_vector_topk": _with("passages")
    + "SELECT question_id, chunk_id, rank::INTEGER AS rank, round(score, 6) AS score FROM passages",
    "question_answers": _with("asked")
    + """SELECT question_id, question, confidence_score, source_policies,
  md5(context || chr(10) || 'Answer from these passages alone: ' || question) AS prompt FROM asked""",
    "history_two_batches": _with("asked")
    + """SELECT question_id, confidence_score, source_policies,
  if(question_id % 2 = 1, '2024-01-31', '2024-01-30') || ' 00:00:00' AS timestamp FROM asked
ORDER BY timestamp DESC, question_id LIMIT 10""",
    "vector_topk": _with("questions", "vectors")
    + """SELECT label AS question_id, vec_id, rank::INTEGER AS rank, round(score, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY label ORDER BY score DESC, vec_id) AS rank FROM (
    SELECT label, vec_id, round(list_inner_product(q, e), 9) AS score FROM questions, vectors
  )
) WHERE rank <= 4""",
    "retrieval_context": _with("policy_ranked")
    + """SELECT label AS question_id,
  string_agg(chr(10) || 'Policy ' || policy_number || ':' || chr(10) || text || chr(10), ''
    ORDER BY rank) AS context,
  array_to_string(list_sort(list(DISTINCT policy_number)), '; ') AS source_policies,
  round(avg(score), 6) AS confidence_score FROM policy_ranked GROUP BY label""",
    "prompt_fill": _with("customers_clean")
    + """SELECT CustomerID, 'Customer ' || coalesce(CustomerID, 'None') || ' works as ' || Job
  || ' in ' || City || ', ' || Region || '; default flag ' || coalesce("Default"::VARCHAR, 'None')
  || '.' AS prompt FROM customers_clean""",
    "response_text_extract": """SELECT conv_id, turn,
  CASE WHEN role IN ('user', 'assistant') THEN coalesce(text, '') ELSE '' END AS answer
FROM conversations""",
    # --- generated text (answers by rules) ---
    "generated_briefs": _with("tiered")
    + f"""SELECT {_REPORT}, {_CHECKS} AS investigation_brief, {_BRIEF} AS prompt FROM tiered
WHERE tier <> 'NORMAL'""",
    "dq_explanations": _with("issues_rated")
    + f"""SELECT (row_number() OVER (ORDER BY table_name, rule_name))::VARCHAR AS issue_id,
  table_name, rule_name, severity, affected_records, {_CAUSES} AS ai_explanation,
  {_STATE} generation_status, '{RUN_TS}' AS generated_timestamp, {_ISSUE} AS prompt
FROM issues_rated""",
    "domain_summaries": _with("kpi_customer", "kpi_policy", "kpi_claims")
    + f"""SELECT domain, {_IN_WORDS} AS executive_summary, kpi_json, '{RUN_TS}' AS created_at,
  {_STATE} status, domain || ', in figures: ' || kpi_json || ' Which of them stand out?' AS prompt
FROM ({_domain('Customer Profile', 'kpi_customer')} UNION ALL
  {_domain('Policy Portfolio', 'kpi_policy')} UNION ALL
  {_domain('Claims Performance', 'kpi_claims')})""",
    # --- streaming ---
    "stream_dedup_watermark": _with("claims_clean")
    + f"""SELECT DISTINCT {_shown(CLAIM, times=CLAIM_TIMES)} FROM claims_clean
WHERE NOT (incident_date < DATE '1995-06-01' AND number_of_vehicles_involved = 3)""",
    "stream_fact_claims": _with("fact_claims")
    + f"""SELECT claim_id, policy_id AS policy_number, customer_id,
  {_shown(CLAIM_TIMES, times=CLAIM_TIMES)}, incident_state, incident_city, incident_location,
  incident_type, collision_type, incident_severity, authorities_contacted,
  number_of_vehicles_involved, property_damage, bodily_injuries, witnesses,
  police_report_available, injury AS injury_amount, property AS property_amount,
  vehicle AS vehicle_amount, claim_rejected, claim_processing_days AS processing_days,
  rejected_flag, total_claim_amount FROM fact_claims""",
    "stream_claims_references": _with("claims_clean", "policy_valid")
    + f"""SELECT claim_id, CASE WHEN error_reason IS NULL THEN 'valid' ELSE 'quarantine' END AS route,
  error_reason
FROM (SELECT *, {_reason(CLAIM_BAD)} AS error_reason FROM (
  SELECT *, policy_id IN (SELECT policy_number FROM policy_valid) AND
    (bodily_injuries <> 0 OR policy_id[2:]::BIGINT % 2 = 0) AS has_policy FROM claims_clean
))""",
    "audit_stream_runs": _with("cars_checked")
    + f"""SELECT 'bronze' AS dataset_name, 'COMPLETED' AS final_status,
  count(*)::BIGINT AS total_output_rows, 0::BIGINT AS total_dropped_rows, '[]' AS expectations
FROM cars_clean
UNION ALL SELECT 'silver', 'COMPLETED', count(*) FILTER (error_reason IS NULL),
  count(*) FILTER (error_reason IS NOT NULL), '[' || {_counted(CAR_RULES, CAR_BAD)} || ']'
FROM cars_checked
UNION ALL SELECT 'broken', 'FAILED', 0, 0, NULL""",
    "stream_valid_quarantine": _with("cars_checked")
    + """SELECT car_id, CASE WHEN error_reason IS NULL THEN 'valid' ELSE 'quarantine' END AS route,
  error_reason FROM cars_checked""",
}
