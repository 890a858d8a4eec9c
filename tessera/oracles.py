"""The same results as plain SQL for DuckDB over the same tables, written without the library."""

from __future__ import annotations

from tessera.fixtures import with_views

ORACLES: dict[str, str] = {}


def _add(name: str, views: str, body: str) -> None:
    ORACLES[name] = f"{with_views(*views.split())}\n{body.strip()}" if views else body.strip()


# Sources and sinks
_add("scan_table", "", "SELECT * FROM customer")
_add("csv_roundtrip", "notes", "SELECT doc_id, text, remark FROM notes")
_add(
    "json_lines_scan",
    "readings",
    "SELECT gps_unit_number, gps_lat, cesium_137_unit, cesium_137_level, gps_calibration_timestamp FROM readings",
)
_add("model_table", "model_source", "SELECT id FROM model_source")
_add("model_view", "model_source", "SELECT id FROM model_source WHERE id = 1")

# Projections, filters
_add("project", "", "SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment FROM customer")
_add(
    "score_components",
    "",
    """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount, l_tax,
       round(l_extendedprice * (1 - l_discount), 5) AS net,
       round(l_extendedprice * (1 - l_discount) * (1 + l_tax), 7) AS gross
FROM lineitem""",
)
_add(
    "threshold_classify",
    "",
    """
SELECT l_orderkey, l_linenumber, l_quantity,
       CASE WHEN l_quantity < 10 THEN 'small' WHEN l_quantity < 30 THEN 'medium' ELSE 'large' END AS size_class
FROM lineitem""",
)
_add("filter_compare", "", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity >= 45 AND l_linestatus <> 'O'")
_add("filter_in", "", "SELECT o_orderkey, o_orderpriority FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
_add("filter_null", "donations", "SELECT donation_id, category FROM donations WHERE phone IS NULL AND category IS NOT NULL")
_add(
    "filter_compound",
    "",
    """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE (l_quantity > 40 AND l_discount < 0.03::DOUBLE) OR (l_returnflag = 'R' AND l_tax > 0.06::DOUBLE)""",
)
_add(
    "struct_field_extract",
    "",
    """
SELECT event_id, TRY_CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k,
       TRY_CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k_by_path
FROM events""",
)

# Joins
_add("join_inner", "", "SELECT o_orderkey, c_name, o_totalprice FROM orders JOIN customer ON o_custkey = c_custkey")
_add(
    "join_chain",
    "",
    """
SELECT l_orderkey AS orderkey, l_linenumber, l_quantity, c_name, n_name
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
)
_add("join_using", "visits patients", "SELECT patient_id, visit_id, provider_id, visit_date, patient_name FROM visits JOIN patients USING (patient_id)")
_add(
    "join_left",
    "retail_customers retail_orders",
    "SELECT c.customer_id, name, order_id, amount FROM retail_customers c LEFT JOIN retail_orders o ON c.customer_id = o.customer_id",
)
_add(
    "join_right",
    "visits providers",
    "SELECT p.provider_id, specialty, visit_id, visit_date FROM visits v RIGHT JOIN providers p ON v.provider_id = p.provider_id",
)
_add(
    "join_anti",
    "batches deviations",
    "SELECT b.batch_id FROM batches b LEFT JOIN deviations d ON b.batch_id = d.batch_id WHERE d.deviation_id IS NULL",
)
_add(
    "join_anti_detail",
    "quality_tests deviations",
    "SELECT * FROM quality_tests q WHERE NOT EXISTS (SELECT 1 FROM deviations d WHERE d.batch_id = q.batch_id)",
)
_add(
    "join_flag",
    "retail_orders retail_returns",
    """
SELECT o.order_id, o.customer_id, o.amount, r.order_id IS NOT NULL AS was_returned
FROM retail_orders o LEFT JOIN retail_returns r ON o.order_id = r.order_id""",
)
_add(
    "join_semi_both",
    "batches quality_tests deviations",
    """
SELECT DISTINCT b.batch_id FROM batches b JOIN quality_tests q ON b.batch_id = q.batch_id JOIN deviations d ON b.batch_id = d.batch_id
WHERE q.result_type = 'Pass'""",
)

_RETAIL, _CARE = "retail_customers retail_orders retail_returns", "visits patients providers"
_MAKING, _MARKETING = "batches quality_tests deviations", "mkt_customers campaign_sends clicks"
_add("qa1", _RETAIL, "SELECT name, order_id, amount FROM retail_customers c JOIN retail_orders o ON c.customer_id = o.customer_id")
_add("qa2", _RETAIL, "SELECT order_id, name FROM retail_orders o RIGHT JOIN retail_customers c ON o.customer_id = c.customer_id")
_add(
    "qa3",
    _RETAIL,
    "SELECT o.order_id, r.order_id IS NOT NULL AS is_returned FROM retail_orders o LEFT JOIN retail_returns r ON o.order_id = r.order_id",
)
_add(
    "qa4",
    _RETAIL,
    """
SELECT name, o.order_id, return_date FROM retail_returns r JOIN retail_orders o ON r.order_id = o.order_id
JOIN retail_customers c ON o.customer_id = c.customer_id""",
)
_add(
    "qa5",
    _RETAIL,
    "SELECT name FROM retail_customers c LEFT JOIN retail_orders o ON c.customer_id = o.customer_id WHERE o.order_id IS NULL",
)
_VISITS = "visits v JOIN patients p ON v.patient_id = p.patient_id JOIN providers d ON v.provider_id = d.provider_id"
_add("qb1", _CARE, f"SELECT patient_name, provider_name, visit_date FROM {_VISITS}")
_add("qb2", _CARE, "SELECT patient_name, visit_id FROM patients p LEFT JOIN visits v ON p.patient_id = v.patient_id")
_add("qb3", _CARE, "SELECT provider_name, visit_id FROM providers d LEFT JOIN visits v ON d.provider_id = v.provider_id")
_add("qb4", _CARE, "SELECT patient_name FROM patients p LEFT JOIN visits v ON p.patient_id = v.patient_id WHERE visit_id IS NULL")
_add("qb5", _CARE, f"SELECT patient_name, provider_name, visit_date FROM {_VISITS} WHERE specialty = 'Cardiology'")
_add("qc1", _MAKING, "SELECT b.batch_id, test_type, result_type FROM batches b JOIN quality_tests q ON b.batch_id = q.batch_id")
_add("qc2", _MAKING, "SELECT b.batch_id, test_type, result_type FROM batches b LEFT JOIN quality_tests q ON b.batch_id = q.batch_id")
_add(
    "qc3",
    _MAKING,
    """
SELECT DISTINCT b.batch_id FROM batches b JOIN quality_tests q ON b.batch_id = q.batch_id JOIN deviations d ON b.batch_id = d.batch_id
WHERE result_type = 'Fail'""",
)
_add(
    "qc4",
    _MAKING,
    """
SELECT b.batch_id, count(DISTINCT test_id) AS test_count, count(DISTINCT deviation_id) AS deviation_count
FROM batches b LEFT JOIN quality_tests q ON b.batch_id = q.batch_id LEFT JOIN deviations d ON b.batch_id = d.batch_id
GROUP BY b.batch_id""",
)
_add("qc5", _MAKING, "SELECT b.batch_id FROM batches b LEFT JOIN deviations d ON b.batch_id = d.batch_id WHERE deviation_id IS NULL")
_add("qd1", _MARKETING, "SELECT email, campaign_id, send_date FROM campaign_sends s JOIN mkt_customers c ON s.customer_id = c.customer_id")
_add("qd2", _MARKETING, "SELECT s.send_id, click_id IS NOT NULL AS clicked FROM campaign_sends s LEFT JOIN clicks k ON s.send_id = k.send_id")
_add("qd3", _MARKETING, "SELECT email, campaign_id FROM mkt_customers c LEFT JOIN campaign_sends s ON c.customer_id = s.customer_id")
_add("qd4", _MARKETING, "SELECT s.send_id FROM campaign_sends s LEFT JOIN clicks k ON s.send_id = k.send_id WHERE click_id IS NULL")
_add("qd5", _MARKETING, "SELECT email FROM mkt_customers c LEFT JOIN campaign_sends s ON c.customer_id = s.customer_id WHERE send_id IS NULL")

# Survey grid, shared by several statements
_GRID = """,
steps AS (
  SELECT *, easting - 2180160.0001::DOUBLE AS dx, northing - 6660000.0::DOUBLE AS dy, 32.81::DOUBLE AS unit FROM scan
),
units AS (
  SELECT *, CAST(round((dx - dx % unit) / unit) AS BIGINT) AS gc, CAST(round((dy - dy % unit) / unit) AS BIGINT) AS gr FROM steps
),
cells AS (
  SELECT reading_id, easting, northing, reading,
         chr(CAST(65 + gr // 18 AS INTEGER)) || chr(CAST(65 + gc // 21 AS INTEGER)) AS tile,
         CAST((17 - gr % 18) * 21 + gc % 21 + 1 AS INTEGER) AS su,
         CAST(CAST(round(((dy - gr * unit) - (dy - gr * unit) % (unit / 10)) / (unit / 10)) AS BIGINT) * 10
            + CAST(round(((dx - gc * unit) - (dx - gc * unit) % (unit / 10)) / (unit / 10)) AS BIGINT) + 1 AS INTEGER) AS subcell
  FROM units
),
subcells AS (
  SELECT tile, su, subcell, avg(reading) AS a, stddev_samp(reading) AS sd, count(reading) AS n FROM cells GROUP BY ALL
)"""

ORACLES["join_attach"] = (
    with_views("scan")
    + _GRID
    + """, sus AS (SELECT tile, su, avg(a) AS sa FROM subcells GROUP BY ALL)
SELECT tile, su, subcell, round(a, 6) AS avg_reading, round(sa, 6) AS su_avg FROM subcells JOIN sus USING (tile, su)"""
)

# Aggregation, windows, sorting, sets
_add("group_sum_count", "hospitals_like", "SELECT city, count(name) AS num_hospitals, CAST(sum(beds) AS BIGINT) AS total_beds FROM hospitals_like GROUP BY city")
ORACLES["layered_avg"] = (
    with_views("scan") + _GRID + ", sus AS (SELECT tile, su, avg(a) AS a FROM subcells GROUP BY ALL) SELECT tile, round(avg(a), 4) AS tile_avg FROM sus GROUP BY tile"
)
_add(
    "count_distinct_multi",
    "",
    "SELECT l_suppkey, count(DISTINCT l_partkey) AS n_parts, count(DISTINCT l_orderkey) AS n_orders FROM lineitem GROUP BY l_suppkey",
)
_add("distinct_rows", "", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
_add(
    "dedup_keyed",
    "",
    """
SELECT l_orderkey, l_linenumber, l_extendedprice, l_partkey, l_suppkey FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice, l_partkey, l_suppkey) = 1""",
)
_add(
    "global_percent_rank",
    "",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round(percent_rank() OVER (ORDER BY l_extendedprice), 9) AS price_pctile,
       round(percent_rank() OVER (ORDER BY l_quantity DESC), 9) AS quantity_pctile,
       round(percent_rank() OVER (ORDER BY abs(l_discount - 0.05::DOUBLE)), 9) AS discount_pctile,
       round(percent_rank() OVER (ORDER BY CASE WHEN l_linenumber > 2 THEN l_linenumber END NULLS LAST), 9) AS line_pctile
FROM lineitem""",
)
_add(
    "top1_per_group",
    "",
    """
SELECT o_custkey, o_orderkey, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC NULLS LAST, o_orderkey) = 1""",
)
_add(
    "sort_multi",
    "",
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY o_orderstatus NULLS LAST, o_totalprice DESC NULLS LAST, o_orderkey",
)
_add("limit_preview", "", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 15")
_add(
    "top_k",
    "",
    """
SELECT l_extendedprice, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey LIMIT 10""",
)
_add(
    "union_all",
    "",
    """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance, 'customer' AS kind FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, 'supplier' FROM supplier""",
)

# Scalar functions
_add("fn_contains", "donations", "SELECT donation_id, contains(name, ',') AS has_comma, CASE WHEN contains(name, ',') THEN 1 ELSE 0 END AS comma_flag FROM donations")
_add("fn_length", "", "SELECT doc_id, CAST(length(text) AS INTEGER) AS n FROM documents")
_add("fn_regexp_replace", "", "SELECT doc_id, regexp_replace(text, '[^0-9]', '', 'g') AS digits FROM documents")
_add("fn_trim", "donations", "SELECT donation_id, trim(zip) AS trimmed, trim(category) = '' AS blank FROM donations")
_add("fn_cast_text", "", "SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS key_text, CAST(p_size AS VARCHAR) AS size_text FROM part")
_add(
    "fn_date_parts",
    "",
    """
SELECT l_orderkey, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS y, CAST(month(l_shipdate) AS INTEGER) AS m,
       CAST(day(l_shipdate) AS INTEGER) AS d
FROM lineitem""",
)
# A two-digit year must be told from a four-digit one by its length; a year after 2026 is a century too late.
_BORN = """CASE WHEN regexp_matches(date_of_birth, '^[0-9]+/[0-9]+/[0-9]{4}$') THEN CAST(try_strptime(date_of_birth, '%m/%d/%Y') AS DATE)
     WHEN regexp_matches(date_of_birth, '^[0-9]+/[0-9]+/[0-9]{2}$')
     THEN CAST(try_strptime(regexp_replace(date_of_birth, '/([0-9]{2})$', '/20\\1'), '%m/%d/%Y') AS DATE) END"""
_YEAR = f"(CASE WHEN year({_BORN}) > 2026 THEN year({_BORN}) - 100 ELSE year({_BORN}) END)"
_add("fn_as_of_date", "donations", f"SELECT donation_id, CAST(2026 - {_YEAR} AS INTEGER) AS years_old FROM donations")
_add("fn_try_date", "donations", f"SELECT donation_id, {_BORN} AS born FROM donations")
_add("fn_year_repair", "donations", f"SELECT donation_id, CAST({_YEAR} AS INTEGER) AS birth_year FROM donations")
_add("fn_abs", "", "SELECT c_custkey, abs(c_acctbal) AS magnitude FROM customer")
_add("fn_round", "", "SELECT l_orderkey, l_linenumber, round(l_extendedprice / 1000, 1) AS kilos FROM lineitem")
_add("fn_concat", "donations", "SELECT donation_id, age || ' - ' || phone AS label FROM donations")
_add("fn_coalesce", "donations", "SELECT donation_id, coalesce(phone, 'none') AS phone, coalesce(category, city) AS category FROM donations")
_add(
    "fn_substr_ascii",
    "",
    """
SELECT p_partkey, substr(p_name, 1, 1) AS first, ascii(substr(p_name, 1, 1)) AS code, chr(ascii(substr(p_name, 1, 1)) - 32) AS upper
FROM part""",
)
_add(
    "fn_floor_mod",
    "",
    """
SELECT l_orderkey, l_linenumber,
       CAST(round((l_extendedprice - l_extendedprice % 32.81::DOUBLE) / 32.81::DOUBLE) AS BIGINT) AS steps,
       round(l_extendedprice % 32.81::DOUBLE, 6) AS rest, ((l_linenumber - 4) % 3 + 3) % 3 AS wrapped
FROM lineitem""",
)
_add(
    "fn_to_timestamp",
    "readings",
    """
SELECT gps_unit_number, cesium_137_level, CAST(gps_calibration_timestamp AS TIMESTAMP) AS calibrated,
       CAST(CAST(gps_calibration_timestamp AS TIMESTAMP) AS DATE) AS calibrated_on, TRY_CAST(gps_unit_number AS TIMESTAMP) AS unreadable
FROM readings""",
)
_add(
    "fn_hash_key",
    "donations",
    """
SELECT donation_id, sha256(concat_ws('|', city, donation_id)) AS full_key, sha256(concat_ws('|', phone, zip)) AS gap_key
FROM donations""",
)
_add("fn_substring_test", "", "SELECT doc_id, contains(text, 'the') AS mentions FROM documents")
_NUMBER = "CASE WHEN regexp_matches(replace(trim({0}), ',', ''), '^[0-9]+$') THEN TRY_CAST(replace(trim({0}), ',', '') AS BIGINT) END"
_add("fn_clean_number", "donations", f"SELECT donation_id, {_NUMBER.format('zip')} AS number, {_NUMBER.format('phone')} AS phone_number FROM donations")
_add("fn_list_length", "", "SELECT doc_id, CAST(len(string_split(text, chr(10))) AS INTEGER) AS n_lines FROM documents")
_add(
    "fn_weighted_score",
    "",
    """
SELECT l_orderkey, l_linenumber,
       round((l_discount * 0.40::DOUBLE + l_tax * 0.35::DOUBLE + l_quantity * 0.25::DOUBLE) * 0.25::DOUBLE, 6) AS score
FROM lineitem""",
)
_add(
    "fn_division",
    "",
    """
SELECT l_orderkey, l_linenumber, round(l_extendedprice / 1000, 6) AS price_k,
       CASE WHEN l_discount <> 0 THEN round(l_quantity / l_discount, 4) END AS per_discount
FROM lineitem""",
)
_add(
    "fn_explode",
    "",
    """
SELECT doc_id, CAST(i - 1 AS INTEGER) AS line_no, CAST(length(lines[i]) AS INTEGER) AS n_chars
FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents))""",
)
_add(
    "fn_record_path",
    "rate_lines",
    """
, items AS (SELECT *, i FROM rate_lines, (VALUES (1), (2)) AS t(i) WHERE i <= 1 + l_linenumber % 2)
SELECT 'ITEM ' || l_partkey || '-' || i AS item_name, CAST(l_partkey AS VARCHAR) AS billing_code,
       CAST(a + 10 AS VARCHAR) AS service_code, CASE WHEN a IS NOT NULL THEN l_extendedprice * i END AS allowed_amount
FROM items LEFT JOIN (VALUES (1), (2)) AS u(a) ON a <= l_suppkey % 3""",
)
_RATES = """
SELECT 'ITEM ' || l_partkey || '-' || i AS name, CASE WHEN l_returnflag = 'R' THEN 'HCPCS' ELSE 'CPT' END AS billing_code_type,
       CAST(l_partkey AS VARCHAR) AS billing_code, 'Line "' || l_linenumber || '" of order ' || l_orderkey AS description,
       CAST(a + 10 AS VARCHAR) AS service_code, 'professional' AS billing_class, l_extendedprice * i AS allowed_amount,
       l_quantity + a AS billed_charge, CAST(l_suppkey * 10 + n AS DOUBLE) AS npi
FROM rate_lines, (VALUES (1), (2)) AS t(i), (VALUES (1), (2)) AS u(a), (VALUES (1), (2)) AS v(n)
WHERE i <= 1 + l_linenumber % 2 AND a <= l_suppkey % 3 AND n <= l_orderkey % 3"""
_add("flatten_rates", "rate_lines", _RATES)
_add("json_document_scan", "rate_lines", _RATES)
_add(
    "fn_arrays_zip",
    "",
    """
SELECT l_orderkey, l_partkey, CASE i WHEN 0 THEN l_returnflag ELSE l_linestatus END AS name, l_linenumber + i AS number
FROM lineitem, (VALUES (0), (1)) AS t(i) WHERE i <= l_linenumber % 2""",
)
# Point to line in the plane that touches the point, and point to point on the sphere.
_TO_LINE = """
  sqrt(pow(ax + t * vx, 2) + pow(ay + t * vy, 2)) * 6371008.8 * pi() / 180"""
_PLANE = """
SELECT *, greatest(0, least(1, -(ax * vx + ay * vy) / (vx * vx + vy * vy))) AS t
FROM (SELECT *, (lon0 - lon) * cos(radians(lat)) AS ax, lat0 - lat AS ay, (lon1 - lon0) * cos(radians(lat)) AS vx, lat1 - lat0 AS vy
      FROM {pairs})"""
_add(
    "fn_st_distance",
    "road_segments interchanges",
    f"""
, pairs AS (SELECT s.*, i.lon, i.lat FROM road_segments s JOIN interchanges i ON s.segment_id % 100 = i.interchange_id)
SELECT segment_id, round({_TO_LINE}, 2) AS to_road_m,
       round(2 * 6371008.8 * asin(sqrt(pow(sin(radians(lat0 - lat) / 2), 2)
             + cos(radians(lat)) * cos(radians(lat0)) * pow(sin(radians(lon0 - lon) / 2), 2))), 2) AS to_start_m
FROM ({_PLANE.format(pairs='pairs')})""",
)
# A line meets a box when the stretches of it between the two sides of either direction overlap.
_MEETS = """greatest(0, (min_lon - lon0) / (lon1 - lon0), (min_lat - lat0) / (lat1 - lat0))
         <= least(1, (max_lon - lon0) / (lon1 - lon0), (max_lat - lat0) / (lat1 - lat0))"""
_add(
    "fn_st_intersects",
    "road_segments env_constraints",
    f"SELECT segment_id, area_id, {_MEETS} AS meets FROM road_segments JOIN env_constraints ON segment_id % 25 = area_id",
)

# Data quality, documents, weather
_FLAGS = f"""
  CASE WHEN contains(name, ',') THEN 1 ELSE 0 END AS dq_reversed_name,
  CASE WHEN abs(age - (2026 - {_YEAR})) > 2 THEN 1 ELSE 0 END AS dq_age_dob_mismatch,
  CASE WHEN length(zip) < 5 THEN 1 ELSE 0 END AS dq_invalid_zip,
  CASE WHEN length(regexp_replace(phone, '[^0-9]', '', 'g')) <> 10 THEN 1 ELSE 0 END AS dq_invalid_phone_format,
  CASE WHEN category IS NULL OR trim(category) = '' THEN 1 ELSE 0 END AS dq_missing_category"""
_add(
    "dq_profile",
    "donations",
    f"""
, flagged AS (SELECT *, {_FLAGS}, CASE WHEN length(trim(zip)) < 5 THEN 1 ELSE 0 END AS short_zip FROM donations)
SELECT * EXCLUDE (short_zip),
       dq_reversed_name + dq_age_dob_mismatch + short_zip + dq_invalid_phone_format + dq_missing_category AS dq_total_issues
FROM flagged ORDER BY dq_total_issues DESC, donation_id""",
)
_add(
    "dq_rule_cases",
    "rule_cases",
    """
, judged AS (
SELECT *, CASE test_name
    WHEN 'dq_reversed_name' THEN CASE WHEN strpos(input_value, ',') > 0 THEN 1 ELSE 0 END
    WHEN 'dq_invalid_phone_format' THEN CASE WHEN length(regexp_replace(input_value, '[^0-9]', '', 'g')) <> 10 THEN 1 ELSE 0 END
    WHEN 'dq_invalid_zip' THEN CASE WHEN length(input_value) < 5 THEN 1 ELSE 0 END
    WHEN 'dq_missing_category' THEN CASE WHEN trim(coalesce(input_value, '')) = '' THEN 1 ELSE 0 END END AS actual
FROM rule_cases)
SELECT test_name, input_value, actual, expected, actual = expected AS match FROM judged
ORDER BY test_name, match, input_value NULLS FIRST""",
)
_add(
    "constraint_violations",
    "retail_returns retail_orders donations batch_costs cost_products",
    """
SELECT 'donations_key' AS "constraint", count(*) - count(DISTINCT donation_id) AS violations FROM donations
UNION ALL SELECT 'cost_grain', (SELECT count(*) FROM batch_costs) - (SELECT count(*) FROM (SELECT DISTINCT batch_id, cost_category, full_date FROM batch_costs))
UNION ALL SELECT 'donations_phone', count(*) FILTER (phone IS NULL) FROM donations
UNION ALL SELECT 'cost_units', count(*) FILTER (units_produced IS NULL) FROM batch_costs
UNION ALL SELECT 'returns_order', count(*) FROM retail_returns r WHERE NOT EXISTS (SELECT 1 FROM retail_orders o WHERE o.order_id = r.order_id)
UNION ALL SELECT 'cost_product', count(*) FROM batch_costs b WHERE NOT EXISTS (SELECT 1 FROM cost_products p WHERE p.product_id = b.product_id)""",
)
_ENROLLED = "CASE WHEN place_id % 4 <> 0 THEN CAST((1 + place_id % 9) * 1000 + place_id % 1000 AS BIGINT) END"
_add("html_labeled_number", "fact_pages", f"SELECT place_id, {_ENROLLED} AS enrolled FROM fact_pages")
_add(
    "severe_weather_days",
    "places weather_daily",
    f"""
, severe AS (
  SELECT place_id, string_agg(CAST(day AS VARCHAR), ',' ORDER BY day) AS days, CAST(count(*) AS INTEGER) AS n
  FROM weather_daily WHERE tmin <= -7 OR snowfall >= 10 GROUP BY place_id)
SELECT name, state, coalesce({_ENROLLED.replace('place_id', 'p.place_id')}, 0) AS enrolled, coalesce(days, '') AS severe_days,
       coalesce(n, 0) AS severe_day_count, coalesce({_ENROLLED.replace('place_id', 'p.place_id')}, 0) * coalesce(n, 0) AS student_days
FROM places p LEFT JOIN severe s ON p.place_id = s.place_id""",
)

# Grid survey


def _grid(name: str, body: str) -> None:
    ORACLES[name] = f"{with_views('scan')}{_GRID}{body}"


def _status(value: str) -> str:
    return f"CASE WHEN {value} < 5 THEN 'OK' WHEN {value} < 7.4::DOUBLE THEN 'Warning' ELSE 'Alarm' END"


for _name in ("grid_assign", "grid_assign_sql"):
    _grid(_name, " SELECT reading_id, easting, northing, tile, su, subcell FROM cells")
_grid("grid_subcell_avg", " SELECT tile, su, subcell, round(a, 6) AS avg_reading FROM subcells ORDER BY tile, su, subcell")
_grid(
    "tile_status_rollup",
    f"""
SELECT tile, count(*) FILTER (s = 'OK') AS ok_count, count(*) FILTER (s = 'Warning') AS warning_count,
       count(*) FILTER (s = 'Alarm') AS alarm_count, round(avg(a), 4) AS tile_avg_reading, round(max(a), 4) AS tile_max_reading,
       count(*) AS total_subcells
FROM (SELECT *, {_status('a')} AS s FROM subcells) GROUP BY tile ORDER BY alarm_count DESC, warning_count DESC, tile""",
)
_grid(
    "neighbor_change",
    """, tiles AS (SELECT tile, avg(reading) AS a FROM cells GROUP BY tile)
SELECT x.tile, round(x.a, 2) AS tile_avg, y.tile AS neighbor_tile, round(y.a, 2) AS neighbor_avg, round(abs(x.a - y.a), 2) AS tile_change
FROM tiles x JOIN tiles y ON abs(ascii(x.tile) - ascii(y.tile)) <= 1
  AND abs(ascii(substr(x.tile, 2, 1)) - ascii(substr(y.tile, 2, 1))) <= 1 AND x.tile <> y.tile
ORDER BY tile_change DESC, x.tile, y.tile""",
)
_grid(
    "rank_within_region",
    """, sus AS (SELECT tile, su, avg(a) AS sa FROM subcells GROUP BY tile, su)
SELECT tile, su, subcell, round(a, 2) AS subcell_avg, rank() OVER (PARTITION BY tile, su ORDER BY round(a, 9) DESC) AS subcell_rank_in_su,
       round(sa, 2) AS su_avg, rank() OVER (PARTITION BY tile ORDER BY round(sa, 9) DESC) AS su_rank_in_tile
FROM subcells JOIN sus USING (tile, su) ORDER BY tile, su, subcell_rank_in_su, subcell""",
)
_grid(
    "stability_score",
    """
SELECT tile, su, subcell, n AS num_readings, round(a, 2) AS subcell_avg, round(sd, 4) AS stddev_reading,
       round(1.0 / (1.0 + coalesce(sd, 0)), 4) AS stability_score
FROM subcells ORDER BY stability_score, tile, su, subcell""",
)
_FINDINGS = f""", sus AS (SELECT tile, su, avg(a) AS sa FROM subcells GROUP BY tile, su),
tiles AS (SELECT tile, avg(a) AS ta FROM subcells GROUP BY tile),
combined AS (
  SELECT tile, su, subcell, round(a, 2) AS subcell_avg, {_status('a')} AS subcell_status, round(sa, 2) AS su_avg, {_status('sa')} AS su_status,
         round(ta, 2) AS tile_avg, {_status('ta')} AS tile_status, round(1.0 / (1.0 + coalesce(sd, 0)), 4) AS stability_score,
         n AS num_readings
  FROM subcells JOIN sus USING (tile, su) JOIN tiles USING (tile)
),
found AS (
  (SELECT 1 AS o, 'Top Alarm Subcell' AS finding_category, * FROM combined WHERE subcell_status = 'Alarm'
   ORDER BY subcell_avg DESC, tile, su, subcell LIMIT 10)
  UNION ALL
  (SELECT 2, 'Warning / At-Risk Tile', * FROM combined
   WHERE subcell_status = 'Warning' OR (tile_status IN ('Alarm', 'Warning') AND subcell_status = 'OK')
   ORDER BY subcell_avg DESC, tile, su, subcell LIMIT 10)
  UNION ALL
  (SELECT 3, 'Low Stability - Needs Re-Survey', * FROM combined WHERE stability_score < 0.15::DOUBLE
   ORDER BY stability_score, tile, su, subcell LIMIT 10)
)"""
_grid("findings_report", _FINDINGS + " SELECT * EXCLUDE (o) FROM found ORDER BY o, subcell_avg DESC, tile, su, subcell")
_grid(
    "recommend_prompt",
    _FINDINGS
    + """
SELECT finding_category, tile, su, subcell, subcell_status,
       'AS an environmental remediation specialist. Given this Ra-226 finding: Category: ' || finding_category || ', Tile: ' || tile
       || ', SU: ' || su || ', Subcell: ' || subcell || ', Subcell Avg: ' || subcell_avg || ' pCi/g (' || subcell_status
       || '), SU Avg: ' || su_avg || ' pCi/g (' || su_status || '), Tile Avg: ' || tile_avg || ' pCi/g (' || tile_status
       || '), Stability Score: ' || stability_score || ', Num Readings: ' || num_readings
       || '. Thresholds: OK < 5, Warning 5-7.4, Alarm >= 7.4 pCi/g. In 1-2 sentences, recommend a specific remediation action for this location.'
       AS prompt,
       CASE subcell_status WHEN 'Alarm' THEN 'Excavate and dispose of the material, then survey again.'
            WHEN 'Warning' THEN 'Survey again and plan a local removal.' ELSE 'Keep monitoring; no removal is needed.' END AS recommendation
FROM found""",
)

# Site selection
_SITE_VIEWS = "road_segments traffic_counts weather_risk incidents power_infra interchanges env_constraints"
_SITES = f"""
, base AS (
  SELECT segment_id, interstate, start_mile, end_mile, lanes, speed_limit, aadt_total, aadt_ev, aadt_truck, peak_factor,
         risk_score AS weather_risk_score, crash_rate, incident_rate,
         CASE WHEN interstate = 'I-70' THEN 'STL_KC' ELSE 'STL_CHI' END AS corridor
  FROM road_segments JOIN traffic_counts USING (segment_id) JOIN weather_risk USING (segment_id) JOIN incidents USING (segment_id)
),
exclusions AS (SELECT DISTINCT segment_id FROM road_segments JOIN env_constraints ON {_MEETS}),
power AS (
  SELECT segment_id, min(d) AS min_power_dist_m, count(*) FILTER (d < 30000) AS power_assets_30km
  FROM (SELECT segment_id, {_TO_LINE} AS d FROM ({_PLANE.format(pairs='(SELECT s.*, lon, lat FROM road_segments s CROSS JOIN power_infra)')}))
  GROUP BY segment_id
),
close_by AS (
  SELECT segment_id, count(*) AS n
  FROM (SELECT segment_id, {_TO_LINE} AS d
        FROM ({_PLANE.format(pairs='(SELECT s.*, lon, lat FROM road_segments s JOIN interchanges i ON s.interstate = i.interstate)')}))
  WHERE d < 5000 GROUP BY segment_id
),
density AS (SELECT s.segment_id, coalesce(n, 0) AS interchange_count FROM road_segments s LEFT JOIN close_by c ON s.segment_id = c.segment_id)"""


def _site(name: str, tail: str, direction: str = "ASC") -> None:
    scored = f""",
scored AS (
  SELECT b.*, min_power_dist_m, power_assets_30km, interchange_count,
         percent_rank() OVER (ORDER BY aadt_ev) AS demand_pctile,
         percent_rank() OVER (ORDER BY round(min_power_dist_m, 3) DESC) AS power_prox_pctile,
         percent_rank() OVER (ORDER BY interchange_count {direction}) AS low_interchange_pctile,
         percent_rank() OVER (ORDER BY crash_rate {direction}) AS low_crash_pctile,
         percent_rank() OVER (ORDER BY weather_risk_score {direction}) AS low_weather_pctile,
         percent_rank() OVER (ORDER BY abs(speed_limit - 65) {direction}) AS speed_compat_pctile,
         CAST(CASE WHEN interstate IN ('I-70', 'I-55') THEN 1.0 WHEN interstate IN ('I-64', 'I-80') THEN 0.7 ELSE 0.5 END AS DOUBLE) AS corridor_importance,
         CAST(CASE WHEN aadt_total > 60000 THEN 1.0 WHEN aadt_total > 40000 THEN 0.7 ELSE 0.4 END AS DOUBLE) AS strategic_visibility
  FROM base b JOIN power USING (segment_id) JOIN density USING (segment_id)
  WHERE lanes >= 4 AND NOT EXISTS (SELECT 1 FROM exclusions e WHERE e.segment_id = b.segment_id)
),
parts AS (
  SELECT *, demand_pctile * 0.25::DOUBLE AS demand_score,
         (power_prox_pctile * 0.50::DOUBLE + low_interchange_pctile * 0.30::DOUBLE) * 0.25::DOUBLE AS feasibility_score,
         (low_crash_pctile * 0.40::DOUBLE + low_weather_pctile * 0.35::DOUBLE + speed_compat_pctile * 0.25::DOUBLE) * 0.25::DOUBLE AS safety_score,
         (strategic_visibility * 0.40::DOUBLE + corridor_importance * 0.60::DOUBLE) * 0.25::DOUBLE AS pilot_value_score
  FROM scored
),
totals AS (SELECT *, demand_score + feasibility_score + safety_score + pilot_value_score AS composite_score FROM parts),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY corridor ORDER BY round(composite_score, 9) DESC, segment_id) AS corridor_rank FROM totals
),
seconds AS (
  SELECT r.* FROM ranked r JOIN ranked f ON f.corridor = r.corridor AND f.corridor_rank = 1
  WHERE r.corridor_rank > 1 AND (r.interstate <> f.interstate OR abs(r.start_mile - f.start_mile) >= 50)
  QUALIFY row_number() OVER (PARTITION BY r.corridor ORDER BY r.corridor_rank) = 1
)"""
    _add(name, _SITE_VIEWS, f"{_SITES}{scored}\n{tail}")


_add("site_base", _SITE_VIEWS, _SITES + " SELECT * FROM base")
_add("spatial_exclusion", _SITE_VIEWS, _SITES + " SELECT segment_id FROM exclusions")
_add(
    "power_proximity",
    _SITE_VIEWS,
    _SITES + " SELECT segment_id, round(min_power_dist_m, 3) AS min_power_dist_m, power_assets_30km FROM power",
)
_add("interchange_density", _SITE_VIEWS, _SITES + " SELECT segment_id, interchange_count FROM density")
_PCTILES = ("demand_pctile", "power_prox_pctile", "low_interchange_pctile", "low_crash_pctile", "low_weather_pctile", "speed_compat_pctile")
_SCORES = ("demand_score", "feasibility_score", "safety_score", "pilot_value_score", "composite_score")
_site(
    "site_scored",
    f"SELECT segment_id, {', '.join(f'round({c}, 9) AS {c}' for c in _PCTILES)}, corridor_importance, strategic_visibility FROM scored",
)
_site("site_composite", f"SELECT segment_id, {', '.join(f'round({c}, 6) AS {c}' for c in _SCORES)} FROM totals")
_site("corridor_rank", "SELECT segment_id, corridor, corridor_rank FROM ranked")
_site("spaced_second_pick", "SELECT corridor, corridor_rank, segment_id, interstate, start_mile FROM seconds")
_REPORT = f"""
SELECT segment_id, interstate, corridor, start_mile || ' - ' || end_mile AS mile_range, lanes, speed_limit, aadt_total, aadt_ev, aadt_truck,
       peak_factor, weather_risk_score, crash_rate, incident_rate, round(min_power_dist_m / 1000, 1) AS nearest_power_km,
       power_assets_30km AS power_assets_within_30km, interchange_count AS interchanges_nearby,
       {', '.join(f'round({c}, 4) AS {c}' for c in _SCORES)}, corridor_rank AS rank_in_corridor
FROM (SELECT * FROM ranked WHERE corridor_rank = 1 UNION ALL SELECT * FROM seconds) ORDER BY corridor, corridor_rank"""
_site("site_selection", _REPORT)
_site("site_selection_intent", _REPORT, "DESC")

# Star schema
_STAMP = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
_CALIBRATED = "CAST(gps_calibration_timestamp AS TIMESTAMP)"
_LOCATION = f"""
, versions AS (
  SELECT gps_unit_number, gps_lat, gps_lng, gps_precision, {_CALIBRATED} AS calibration_timestamp FROM readings
  QUALIFY row_number() OVER (PARTITION BY gps_unit_number, calibration_timestamp ORDER BY gps_lat, gps_lng, gps_precision) = 1
),
locations AS (SELECT *, sha256(concat_ws('|', gps_unit_number, {_STAMP.format('calibration_timestamp')})) AS location_key FROM versions)"""
_DETECTOR = """
, detectors AS (
  SELECT cesium_137_unit AS detector_unit_number, 'CESIUM_137' AS detector_type, cesium_137_precision AS calibration_precision,
         CAST(detector_calibration_timestamp AS TIMESTAMP) AS calibration_timestamp FROM readings
  UNION ALL SELECT gamma_unit, 'GAMMA', gamma_precision, CAST(detector_calibration_timestamp AS TIMESTAMP) FROM readings
  UNION ALL SELECT thorium_232_unit, 'THORIUM_232', thorium_232_precision, CAST(detector_calibration_timestamp AS TIMESTAMP) FROM readings
),
units AS (
  SELECT *, sha256(concat_ws('|', detector_unit_number, detector_type)) AS detector_key FROM detectors
  QUALIFY row_number() OVER (PARTITION BY detector_unit_number, detector_type ORDER BY calibration_timestamp, calibration_precision) = 1
)"""
_DATE = ", days AS (SELECT DISTINCT CAST(CAST(collection_timestamp AS TIMESTAMP) AS DATE) AS date_actual FROM readings)"
_add("dim_location_versions", "readings", _LOCATION + " SELECT * FROM locations")
_add("dim_detector", "readings", _DETECTOR + " SELECT * FROM units")
_add(
    "dim_date",
    "readings",
    _DATE
    + """ SELECT date_actual, CAST(year(date_actual) AS INTEGER) AS year, CAST(month(date_actual) AS INTEGER) AS month,
       CAST(day(date_actual) AS INTEGER) AS day, CAST(date_actual AS VARCHAR) AS date_key FROM days""",
)
_add(
    "fact_readings",
    "readings",
    f"""
SELECT CAST(collection_timestamp AS TIMESTAMP) AS collection_timestamp, substr(collection_timestamp, 1, 10) AS date_key,
       sha256(concat_ws('|', gps_unit_number, {_STAMP.format(_CALIBRATED)})) AS location_key,
       sha256(concat_ws('|', cesium_137_unit, 'CESIUM_137')) AS cesium_detector_key,
       sha256(concat_ws('|', gamma_unit, 'GAMMA')) AS gamma_detector_key,
       sha256(concat_ws('|', thorium_232_unit, 'THORIUM_232')) AS thorium_detector_key,
       cesium_137_level, gamma_level, thorium_232_level
FROM readings""",
)
_add(
    "scd2_intervals",
    "readings",
    _LOCATION
    + """
, following AS (SELECT location_key, gps_unit_number, calibration_timestamp,
       lead(calibration_timestamp) OVER (PARTITION BY gps_unit_number ORDER BY calibration_timestamp) AS effective_to FROM locations)
SELECT *, calibration_timestamp AS effective_from, effective_to IS NULL AS is_current FROM following""",
)
_add(
    "scd2_write",
    "readings",
    _LOCATION
    + _DETECTOR
    + _DATE
    + """
SELECT 'dim_location' AS table_name, location_key AS row_key, gps_unit_number AS detail, calibration_timestamp AS moment, gps_lat AS measure FROM locations
UNION ALL SELECT 'dim_detector', detector_key, detector_type, calibration_timestamp, calibration_precision FROM units
UNION ALL SELECT 'dim_date', CAST(date_actual AS VARCHAR), NULL, CAST(date_actual AS TIMESTAMP), CAST(year(date_actual) AS DOUBLE) FROM days
UNION ALL SELECT 'fact_radiation_readings', sha256(concat_ws('|', gps_unit_number, """
    + _STAMP.format(_CALIBRATED)
    + """)),
       concat_ws('|', substr(collection_timestamp, 1, 10), sha256(concat_ws('|', cesium_137_unit, 'CESIUM_137'))),
       CAST(collection_timestamp AS TIMESTAMP), cesium_137_level FROM readings""",
)

# Costs. Money stays in whole cents; half a cent and half a hundredth of a percent round away from zero.
_COST = """
, fact AS (
  SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_id, product_id, batch_id, facility_id,
         CASE cost_category WHEN 'Material' THEN 1 WHEN 'Labor' THEN 2 WHEN 'Overhead' THEN 3 ELSE 4 END AS cost_category_id,
         CAST(sum(actual_cents) AS BIGINT) AS ac, CAST(sum(standard_cents) AS BIGINT) AS sc, CAST(sum(units_produced) AS INTEGER) AS units_produced
  FROM batch_costs GROUP BY ALL
)"""


def _money(cents: str, precision: int = 12) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(18,0)) * 0.01 AS DECIMAL({precision},2))"


def _ratio(top: str, bottom: str) -> str:
    """Hundredths of top / bottom as a whole number."""
    return f"CAST(sign({top}) AS BIGINT) * ((200 * abs({top}) + {bottom}) // (2 * {bottom}))"


_PERCENT = _money("CASE WHEN sc <> 0 THEN " + _ratio("(100 * (ac - sc))", "sc") + " END", 8)
_add(
    "cost_fact",
    "batch_costs",
    _COST
    + f"""
SELECT sha256(concat_ws('|', date_id, product_id, batch_id, facility_id, cost_category_id)) AS material_cost_id,
       date_id, product_id, batch_id, facility_id, cost_category_id, {_money('ac')} AS actual_cost, {_money('sc')} AS standard_cost,
       {_money('ac - sc')} AS cost_variance, {_PERCENT} AS variance_percent, units_produced,
       CAST(NULL AS DECIMAL(10,2)) AS labor_hours, CAST(NULL AS DECIMAL(10,2)) AS line_hours
FROM fact""",
)
_METRIC = "SELECT '{0}' AS dimension, CAST({0} AS VARCHAR) AS member, CAST(sum(ac) AS BIGINT) AS ac, CAST(sum(sc) AS BIGINT) AS sc, {1} AS u FROM {2} GROUP BY {0}"
_add(
    "cost_metrics_by_dim",
    "batch_costs",
    _COST
    + ", once AS (SELECT date_id, product_id, batch_id, facility_id, sum(ac) AS ac, sum(sc) AS sc, max(units_produced) AS units FROM fact GROUP BY ALL), metrics AS ("
    + " UNION ALL ".join(
        [_METRIC.format(d, "CAST(sum(units) AS BIGINT)", "once") for d in ("batch_id", "product_id", "facility_id", "date_id")]
        + [_METRIC.format("cost_category_id", "CAST(NULL AS BIGINT)", "fact")]
    )
    + f""")
SELECT dimension, member, {_money('ac', 18)} AS actual_cost, {_money('sc', 18)} AS standard_cost, {_money('ac - sc', 18)} AS cost_variance,
       {_PERCENT} AS variance_percent, {_money('CASE WHEN u <> 0 THEN (2 * ac + u) // (2 * u) END', 18)} AS cost_per_unit
FROM metrics""",
)
_add(
    "cost_ml_wide",
    "batch_costs cost_batches cost_facilities cost_products",
    _COST
    + f"""
, wide AS (
  SELECT batch_id, facility_id, product_id, date_id // 10000 AS year, date_id // 100 % 100 AS month,
         {', '.join(f'CAST(sum(ac) FILTER (cost_category_id = {i}) AS BIGINT) AS c{i}' for i in (1, 2, 3, 4))},
         CAST(sum(ac) AS BIGINT) AS ac, CAST(sum(sc) AS BIGINT) AS sc
  FROM fact GROUP BY ALL
)
SELECT batch_id, batch_status, actual_quantity, CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month, facility_name, is_sterile,
       overhead_rate, product_name, dosage_form, product_line, qa_hold_days, rework_hours,
       {_money('c1')} AS material_cost, {_money('c2')} AS labor_cost, {_money('c3')} AS overhead_cost, {_money('c4')} AS qc_cost,
       {_money('ac')} AS total_actual_cost, {_money('sc')} AS total_standard_cost, {_money('ac - sc')} AS total_variance,
       {_PERCENT} AS variance_percent, {_money('(2 * ac + actual_quantity) // (2 * actual_quantity)', 10)} AS cost_per_unit,
       {_PERCENT} > 15 AS exceeds_15_percent
FROM wide JOIN cost_batches USING (batch_id) JOIN cost_facilities USING (facility_id) JOIN cost_products USING (product_id)""",
)
_add(
    "cost_dim_date",
    "batch_costs",
    """
SELECT DISTINCT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_id, full_date, CAST(year(full_date) AS INTEGER) AS year,
       CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(month(full_date) AS INTEGER) AS month, monthname(full_date) AS month_name,
       CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week
FROM batch_costs""",
)
_add("cost_dim_facility", "facility_rows", "SELECT * FROM facility_rows")
_add("cost_dim_product", "product_rows", "SELECT * FROM product_rows")
_add("cost_dim_batch", "batch_rows", "SELECT * FROM batch_rows")
_add(
    "cost_dim_category",
    "batch_costs",
    """
SELECT DISTINCT CASE cost_category WHEN 'Material' THEN 1 WHEN 'Labor' THEN 2 WHEN 'Overhead' THEN 3 ELSE 4 END AS cost_category_id,
       cost_category AS cost_category_name, CASE WHEN cost_category IN ('Material', 'Labor') THEN 'Direct' ELSE 'Indirect' END AS cost_type
FROM batch_costs""",
)
