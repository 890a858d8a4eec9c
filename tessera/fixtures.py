"""Input tables of the analyses, derived from the given tables.

Each entry is one SELECT that Spark and DuckDB both understand; ``{name}`` marks a table or an
earlier entry.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tessera.sources.readers import load

INTERSTATE = "CASE {key} % 5 WHEN 0 THEN 'I-70' WHEN 1 THEN 'I-55' WHEN 2 THEN 'I-64' WHEN 3 THEN 'I-80' ELSE 'I-57' END"

# A small offset of its own for every key, so that no two rows lie in one place.
_OWN_LON = "CAST(p_partkey % 1009 AS DOUBLE) * CAST(0.0001 AS DOUBLE)"
_OWN_LAT = "CAST(p_partkey % 1013 AS DOUBLE) * CAST(0.0001 AS DOUBLE)"

VIEWS: dict[str, str] = {
    "scan": """
SELECT l_orderkey AS reading_id,
       CAST(2180160.0001 AS DOUBLE) + CAST(l_partkey % 2000 AS DOUBLE) AS easting,
       CAST(6660000.0 AS DOUBLE) + CAST((l_suppkey % 100) * 15 AS DOUBLE) AS northing,
       l_quantity / 5.0 + CAST(0.0137 AS DOUBLE) AS reading
FROM {lineitem}""",
    "road_segments": f"""
SELECT p_partkey AS segment_id, {INTERSTATE.format(key='p_partkey')} AS interstate,
       CAST(floor(p_partkey / 5.0) AS BIGINT) % 40 * 10 AS start_mile,
       CAST(floor(p_partkey / 5.0) AS BIGINT) % 40 * 10 + 10 AS end_mile,
       2 + 2 * (p_size % 3) AS lanes, 55 + 5 * (p_size % 4) AS speed_limit,
       CAST(-95 AS DOUBLE) + CAST(CAST(floor(p_partkey / 5.0) AS BIGINT) % 40 AS DOUBLE) * CAST(0.15 AS DOUBLE) + {_OWN_LON} AS lon0,
       CAST(37.5 AS DOUBLE) + CAST(p_partkey % 5 AS DOUBLE) * CAST(0.8 AS DOUBLE) + {_OWN_LAT} AS lat0,
       CAST(-95 AS DOUBLE) + CAST(CAST(floor(p_partkey / 5.0) AS BIGINT) % 40 + 1 AS DOUBLE) * CAST(0.15 AS DOUBLE) + {_OWN_LON} AS lon1,
       CAST(37.53 AS DOUBLE) + CAST(p_partkey % 5 AS DOUBLE) * CAST(0.8 AS DOUBLE) + {_OWN_LAT} AS lat1
FROM {{part}}""",
    "traffic_counts": """
SELECT p_partkey AS segment_id, 20000 + (p_partkey * 7919) % 60000 AS aadt_total,
       (p_partkey * 104729) % 5003 AS aadt_ev, (p_partkey * 611) % 9001 AS aadt_truck,
       CAST((p_partkey * 13) % 40 AS DOUBLE) / 100 + 1 AS peak_factor
FROM {part}""",
    "weather_risk": """
SELECT p_partkey AS segment_id, CAST((p_partkey * 31) % 101 AS DOUBLE) / 100 AS risk_score FROM {part}""",
    "incidents": """
SELECT p_partkey AS segment_id, CAST((p_partkey * 17) % 307 AS DOUBLE) / 100 AS crash_rate,
       CAST((p_partkey * 19) % 503 AS DOUBLE) / 100 AS incident_rate
FROM {part}""",
    "power_infra": f"""
SELECT s_suppkey AS asset_id, CAST(-95 AS DOUBLE) + CAST(s_suppkey * 37 % 100 AS DOUBLE) * CAST(0.06 AS DOUBLE) + {_OWN_LON.replace('p_partkey', 's_suppkey')} AS lon,
       CAST(37.5 AS DOUBLE) + CAST(s_suppkey * 53 % 100 AS DOUBLE) * CAST(0.032 AS DOUBLE) + {_OWN_LAT.replace('p_partkey', 's_suppkey')} AS lat
FROM {{supplier}}""",
    "interchanges": f"""
SELECT c_custkey AS interchange_id, {INTERSTATE.format(key='c_custkey')} AS interstate,
       CAST(-95 AS DOUBLE) + CAST(c_custkey * 41 % 600 AS DOUBLE) * CAST(0.01 AS DOUBLE) + {_OWN_LON.replace('p_partkey', 'c_custkey')} AS lon,
       CAST(37.51 AS DOUBLE) + CAST(c_custkey % 5 AS DOUBLE) * CAST(0.8 AS DOUBLE) + {_OWN_LAT.replace('p_partkey', 'c_custkey')} AS lat
FROM {{customer}}""",
    "env_constraints": """
SELECT n_nationkey AS area_id, CAST(-95 AS DOUBLE) + CAST(n_nationkey AS DOUBLE) * CAST(0.24 AS DOUBLE) AS min_lon,
       CAST(-94.95 AS DOUBLE) + CAST(n_nationkey AS DOUBLE) * CAST(0.24 AS DOUBLE) AS max_lon,
       CAST(37.4 AS DOUBLE) + CAST(n_nationkey % 5 AS DOUBLE) * CAST(0.8 AS DOUBLE) AS min_lat,
       CAST(37.6 AS DOUBLE) + CAST(n_nationkey % 5 AS DOUBLE) * CAST(0.8 AS DOUBLE) AS max_lat
FROM {nation}""",
    "donations": """
SELECT c_custkey AS donation_id,
       CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN concat('Last', c_custkey, ', First', c_custkey)
            ELSE concat('First', c_custkey, ' Last', c_custkey) END AS name,
       20 + c_custkey % 60 + CASE WHEN c_custkey % 9 = 0 THEN 10 ELSE 0 END AS age,
       CASE WHEN c_custkey % 11 = 0 THEN 'not a date'
            ELSE concat(c_custkey % 12 + 1, '/', c_custkey % 28 + 1, '/',
                 CASE WHEN c_custkey % 4 = 0 THEN CAST(2006 - c_custkey % 60 AS STRING)
                      ELSE lpad(CAST((2106 - c_custkey % 60) % 100 AS STRING), 2, '0') END) END AS date_of_birth,
       concat(c_custkey, ' Main St') AS street_address,
       concat('City', c_nationkey) AS city,
       CASE WHEN c_nationkey % 2 = 0 THEN 'MO' ELSE 'IL' END AS state,
       CASE WHEN c_custkey % 13 = 0 THEN ' 123 ' WHEN c_custkey % 6 = 0 THEN '631'
            ELSE lpad(CAST(c_custkey * 31 % 100000 AS STRING), 5, '0') END AS zip,
       CASE c_custkey % 5 WHEN 0 THEN '+1-555-123-4567' WHEN 1 THEN '(555) 123-4567' WHEN 2 THEN '555-1234' WHEN 3 THEN NULL ELSE '5551234567' END AS phone,
       CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '  ' ELSE c_mktsegment END AS category,
       concat('Org', c_custkey % 10) AS organization,
       c_acctbal AS amount
FROM {customer}""",
    # What the data generator above makes of each key, next to the value the rule must judge.
    "rule_cases": """
SELECT 'dq_reversed_name' AS test_name, name AS input_value,
       CASE WHEN donation_id % 3 = 0 AND donation_id % 17 <> 0 THEN 1 ELSE 0 END AS expected
FROM {donations}
UNION ALL
SELECT 'dq_invalid_phone_format', phone, CASE WHEN donation_id % 5 IN (0, 2) THEN 1 ELSE 0 END FROM {donations}
UNION ALL
SELECT 'dq_invalid_zip', zip, CASE WHEN donation_id % 6 = 0 AND donation_id % 13 <> 0 THEN 1 ELSE 0 END FROM {donations}
UNION ALL
SELECT 'dq_missing_category', category, CASE WHEN donation_id % 7 IN (0, 1) THEN 1 ELSE 0 END FROM {donations}""",
    "retail_customers": "SELECT c_custkey AS customer_id, c_name AS name FROM {customer}",
    # Every order; two thirds of the customers have none.
    "retail_orders": """
SELECT o_orderkey AS order_id, o_custkey - o_custkey % 3 AS customer_id, o_totalprice AS amount FROM {orders}""",
    # Texts with line breaks, and remarks that are empty or missing.
    "notes": """
SELECT doc_id, text, CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE lang END AS remark FROM {documents}""",
    "retail_returns": """
SELECT l_orderkey AS order_id, CAST(l_shipdate AS DATE) AS return_date
FROM {lineitem} WHERE l_returnflag = 'R'""",
    "visits": """
SELECT event_id AS visit_id, user_id AS patient_id, event_id % 80 AS provider_id, CAST(ts AS DATE) AS visit_date
FROM {events}""",
    "patients": "SELECT c_custkey AS patient_id, c_name AS patient_name FROM {customer}",
    "providers": """
SELECT s_suppkey AS provider_id, s_name AS provider_name,
       CASE s_nationkey % 5 WHEN 0 THEN 'Cardiology' WHEN 1 THEN 'Oncology' ELSE 'General' END AS specialty
FROM {supplier}""",
    "batches": "SELECT o_orderkey AS batch_id FROM {orders}",
    "quality_tests": """
SELECT concat(l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS test_id, l_orderkey AS batch_id,
       l_linestatus AS test_type, CASE WHEN l_returnflag = 'R' THEN 'Fail' ELSE 'Pass' END AS result_type
FROM {lineitem}""",
    "deviations": """
SELECT concat(l_orderkey, '-', l_linenumber, '-', l_partkey) AS deviation_id, l_orderkey AS batch_id
FROM {lineitem} WHERE l_quantity < 5""",
    "mkt_customers": """
SELECT c_custkey AS customer_id, concat('user', c_custkey, '@example.com') AS email FROM {customer}""",
    "campaign_sends": """
SELECT event_id AS send_id, user_id AS customer_id, event_type AS campaign_id, CAST(ts AS DATE) AS send_date
FROM {events}""",
    "clicks": "SELECT event_id + 1000000 AS click_id, event_id AS send_id FROM {events} WHERE event_type = 'click'",
    "readings": """
SELECT CAST(CAST(ts AS TIMESTAMP) AS STRING) AS collection_timestamp,
       concat('GPS-', user_id % 20) AS gps_unit_number,
       CAST(38 AS DOUBLE) + CAST(user_id % 20 AS DOUBLE) / 100 AS gps_lat,
       CAST(-90 AS DOUBLE) - CAST(user_id % 20 AS DOUBLE) / 100 AS gps_lng,
       CAST(user_id % 3 AS DOUBLE) / 10 AS gps_precision,
       concat(CAST(date_trunc('week', ts) AS DATE), ' 00:00:00') AS gps_calibration_timestamp,
       concat('CS-', user_id % 7) AS cesium_137_unit, concat('GM-', user_id % 5) AS gamma_unit,
       concat('TH-', user_id % 3) AS thorium_232_unit,
       CAST(user_id % 7 AS DOUBLE) / 100 AS cesium_137_precision, CAST(user_id % 5 AS DOUBLE) / 100 AS gamma_precision,
       CAST(user_id % 3 AS DOUBLE) / 100 AS thorium_232_precision,
       concat(CAST(date_trunc('month', ts) AS DATE), ' 00:00:00') AS detector_calibration_timestamp,
       value AS cesium_137_level, value / 2 AS gamma_level, value / 4 AS thorium_232_level
FROM {events}""",
    "batch_costs": """
SELECT CAST(l_shipdate AS DATE) AS full_date, l_partkey AS product_id, l_orderkey AS batch_id, l_suppkey AS facility_id,
       CASE l_linenumber % 4 WHEN 0 THEN 'Material' WHEN 1 THEN 'Labor' WHEN 2 THEN 'Overhead' ELSE 'QC' END AS cost_category,
       CAST(round(l_extendedprice * (1 + l_tax) * 100) AS BIGINT) AS actual_cents,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS standard_cents,
       CAST(l_quantity AS INT) AS units_produced
FROM {lineitem}""",
    "cost_batches": """
SELECT o_orderkey AS batch_id, o_orderstatus AS batch_status,
       CAST(50 + o_orderkey % 500 AS INT) AS actual_quantity, CAST(o_custkey % 8 AS INT) AS qa_hold_days,
       CAST(CAST(o_custkey % 50 AS DECIMAL(10,2)) / 4 AS DECIMAL(10,2)) AS rework_hours
FROM {orders}""",
    "cost_facilities": """
SELECT s_suppkey AS facility_id, s_name AS facility_name,
       CAST(CAST(s_nationkey AS DECIMAL(10,2)) / 10 AS DECIMAL(10,2)) AS overhead_rate,
       s_nationkey % 2 = 0 AS is_sterile
FROM {supplier}""",
    "cost_products": """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS dosage_form, p_brand AS product_line FROM {part}""",
    "facility_rows": """
SELECT s_suppkey AS facility_id, s_name AS facility_name, concat('City', s_nationkey) AS city,
       CASE WHEN s_nationkey % 2 = 0 THEN 'MO' ELSE 'IL' END AS state,
       CAST(CAST(s_nationkey AS DECIMAL(10,2)) / 10 AS DECIMAL(10,2)) AS overhead_rate, s_nationkey % 2 = 0 AS is_sterile
FROM {supplier}""",
    "product_rows": """
SELECT p_partkey AS product_id, p_name AS product_name, p_type AS dosage_form, p_brand AS product_line,
       concat('v', p_size % 4 + 1) AS formulation_version, CAST(p_size * 100 AS INT) AS target_batch_size
FROM {part}""",
    "batch_rows": """
SELECT o_orderkey AS batch_id, o_custkey % 10 AS facility_id, o_orderstatus AS batch_status,
       CAST(60 + o_orderkey % 500 AS INT) AS planned_quantity, CAST(50 + o_orderkey % 500 AS INT) AS actual_quantity,
       CAST(o_custkey % 8 AS INT) AS qa_hold_days,
       CASE WHEN o_custkey % 4 > 0 THEN CAST(CAST(o_custkey % 50 AS DECIMAL(10,2)) / 4 AS DECIMAL(10,2)) END AS rework_hours
FROM {orders}""",
    "hospitals_like": "SELECT c_mktsegment AS city, c_name AS name, c_nationkey AS beds FROM {customer}",
    # The days of ten stations; every place has one of them and is colder than it by up to six degrees.
    "station_days": """
SELECT user_id % 10 AS station, CAST(ts AS DATE) AS day, min(value) - 8 AS tmin, max(value) / 40 AS snowfall
FROM {events} GROUP BY user_id % 10, CAST(ts AS DATE)""",
    "weather_daily": """
SELECT page_id AS place_id, day, tmin - page_id % 7 AS tmin, snowfall FROM {pages} JOIN {station_days} ON page_id % 10 = station""",
    # A crawled page of any length, with its figures somewhere after the body text.
    "fact_pages": """
SELECT page_id AS place_id, concat(html, '<div class="fact"><p class="num">12</p><p class="label">Campus halls</p></div>',
       '<div class=', chr(39), 'wide fact', chr(39), '><div class="inner"><p class="num"> ',
       CASE WHEN page_id % 4 = 0 THEN 'n/a' ELSE concat(1 + page_id % 9, ',<b>', lpad(CAST(page_id % 1000 AS STRING), 3, '0'), '</b>') END,
       ' </p></div>
<p class="label"><b>Traditional</b>&nbsp;students &amp; others</p></div><div class="fact"><p class="num">99</p><p class="label">Labs</p></div>') AS html
FROM {pages}""",
    "places": """
SELECT page_id AS place_id, concat('Place ', page_id) AS name, CASE page_id % 2 WHEN 0 THEN 'Missouri' ELSE 'Illinois' END AS state
FROM {pages}""",
    # One nested price document per line item.
    "rate_lines": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_returnflag, l_linestatus
FROM {lineitem}""",
    "model_source": "SELECT CASE WHEN c_nationkey = 0 THEN NULL ELSE c_nationkey END AS id FROM {customer}",
}

_NAME = re.compile(r"\{(\w+)\}")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the input tables as a lazy DataFrame."""
    text = VIEWS[name]
    parts = {
        dep: view(spark, sf_dir, dep) if dep in VIEWS else load(spark, sf_dir, dep)
        for dep in sorted(set(_NAME.findall(text)))
    }
    return spark.sql(text, **parts)


def with_views(*names: str) -> str:
    """``WITH`` clause that defines the named input tables for an oracle statement."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dep in sorted(set(_NAME.findall(VIEWS[name]))):
            if dep in VIEWS:
                visit(dep)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{name} AS ({_NAME.sub(lambda m: m.group(1), VIEWS[name]).strip()})" for name in ordered)
