"""Every query by name: a function of the session and the folder of the tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.fixtures import view
from tessera.functions import geometry as G
from tessera.functions import scalar as S
from tessera.functions.grid import grid_assign, register_grid_function
from tessera.operators import aggregates as A
from tessera.operators import joins as J
from tessera.operators import relational as R
from tessera.operators.nested import flatten
from tessera.operators.ranking import Criterion, percent_rank, top_per_group
from tessera.plans import costs, grid_survey, models, quality, rates, sites, star, weather
from tessera.plans.join_suite import QUESTIONS
from tessera.session import prepare, scratch_path, spread
from tessera.sources import readers, writers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _over(*tables: str) -> Callable[[Callable[..., DataFrame]], Query]:
    """Registers a function of DataFrames as a query over the named tables or input views."""

    def register(function: Callable[..., DataFrame]) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return function(*[table(spark, sf_dir, t) for t in tables])

        QUERIES[function.__name__] = run
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from tessera.fixtures import VIEWS

    return view(spark, sf_dir, name) if name in VIEWS else readers.load(spark, sf_dir, name)


# Sources and sinks ---------------------------------------------------------------------------


@query
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.load(spark, sf_dir, "customer")


@query
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts with line breaks, empty values and missing ones, written as CSV and read back."""
    source = view(prepare(spark), sf_dir, "notes")
    path = scratch_path(spark, "csv")
    writers.write_csv(source, path)
    return readers.read_csv(spark, path, source.schema)


@query
def json_lines_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "json-lines")
    writers.write_json_lines(view(prepare(spark), sf_dir, "readings"), path)
    rows = readers.read_json_lines(spark, path, star.READINGS)
    return rows.select("gps_unit_number", "gps_lat", "cesium_137_unit", "cesium_137_level", "gps_calibration_timestamp")


@query
def json_document_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as JSON arrays over many lines, read back whole and flattened."""
    path = scratch_path(spark, "json-documents")
    writers.write_json_documents(rates.documents_from_lines(spread(view(prepare(spark), sf_dir, "rate_lines"))), path)
    return rates.flatten_rates(readers.read_json_documents(spark, path, rates.DOCUMENT))


@_over("model_source")
def model_table(source: DataFrame) -> DataFrame:
    return models.model_table(source)


@_over("model_source")
def model_view(source: DataFrame) -> DataFrame:
    return models.model_view(models.model_table(source))


@_over("readings")
def scd2_write(readings: DataFrame) -> DataFrame:
    """The rows of the four tables after they were written twice: the second write replaces the first."""
    spark = readings.sparkSession
    database = writers.scratch_database(spark)
    star.write_star(readings.filter(F.col("gamma_level") > 1), database)
    written = star.write_star(readings, database)
    return R.union_all(*[t.select(F.lit(n).alias("table_name"), *_star_row(n)) for n, t in written.items()])


# Per table: its key, other keys, a time and a number.
_STAR_ROWS = {
    "dim_location": ("location_key", "gps_unit_number", "calibration_timestamp", "gps_lat"),
    "dim_detector": ("detector_key", "detector_type", "calibration_timestamp", "calibration_precision"),
    "dim_date": ("date_key", "CAST(NULL AS STRING)", "CAST(date_actual AS TIMESTAMP)", "CAST(year AS DOUBLE)"),
    "fact_radiation_readings": ("location_key", "concat_ws('|', date_key, cesium_detector_key)", "collection_timestamp", "cesium_137_level"),
}


def _star_row(name: str) -> list[Column]:
    return [F.expr(e).alias(c) for e, c in zip(_STAR_ROWS[name], ("row_key", "detail", "moment", "measure"))]


# Projections, filters ------------------------------------------------------------------------


@_over("customer")
def project(customer: DataFrame) -> DataFrame:
    renamed = R.rename(customer, {"c_custkey": "customer_id", "c_name": "customer_name"})
    return R.project(renamed.drop("c_acctbal"), "customer_id", "customer_name", "c_mktsegment")


@_over("lineitem")
def score_components(lineitem: DataFrame) -> DataFrame:
    scored = R.with_columns(
        lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax"),
        net=F.col("l_extendedprice") * (1 - F.col("l_discount")),
    )
    return R.with_columns(scored, net=F.round("net", 5), gross=F.round(F.col("net") * (1 + F.col("l_tax")), 7))


@_over("lineitem")
def threshold_classify(lineitem: DataFrame) -> DataFrame:
    label = S.classify(F.col("l_quantity"), [(10.0, "small"), (30.0, "medium")], "large")
    return lineitem.select("l_orderkey", "l_linenumber", "l_quantity", label.alias("size_class"))


_LINE = ("l_orderkey", "l_linenumber", "l_quantity")


@_over("lineitem")
def filter_compare(lineitem: DataFrame) -> DataFrame:
    return lineitem.filter((F.col("l_quantity") >= 45) & (F.col("l_linestatus") != "O")).select(*_LINE)


@_over("orders")
def filter_in(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select("o_orderkey", "o_orderpriority")


@_over("donations")
def filter_null(donations: DataFrame) -> DataFrame:
    return donations.filter(F.col("phone").isNull() & F.col("category").isNotNull()).select("donation_id", "category")


@_over("lineitem")
def filter_compound(lineitem: DataFrame) -> DataFrame:
    bulky = (F.col("l_quantity") > 40) & (F.col("l_discount") < 0.03)
    returned = (F.col("l_returnflag") == "R") & (F.col("l_tax") > 0.06)
    return lineitem.filter(bulky | returned).select(*_LINE)


@_over("events")
def struct_field_extract(events: DataFrame) -> DataFrame:
    props = F.from_json("props", "k int").alias("props")
    by_path = F.try_variant_get(F.try_parse_json("props"), "$.k", "int").alias("k_by_path")
    return events.select("event_id", props, by_path).select("event_id", F.col("props.k").alias("k"), "k_by_path")


# Joins ---------------------------------------------------------------------------------------


@_over("orders", "customer")
def join_inner(orders: DataFrame, customer: DataFrame) -> DataFrame:
    joined = orders.join(customer, orders.o_custkey == customer.c_custkey, "inner")
    return joined.select("o_orderkey", "c_name", "o_totalprice")


@_over("lineitem", "orders", "customer", "nation")
def join_chain(lineitem: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    keyed = [
        lineitem.select(F.col("l_orderkey").alias("orderkey"), "l_linenumber", "l_quantity"),
        (R.rename(orders, {"o_orderkey": "orderkey", "o_custkey": "custkey"}), "orderkey"),
        (R.rename(customer, {"c_custkey": "custkey", "c_nationkey": "nationkey"}), "custkey"),
        (R.rename(nation, {"n_nationkey": "nationkey"}), "nationkey"),
    ]
    return J.chain(*keyed).select("orderkey", "l_linenumber", "l_quantity", "c_name", "n_name")


@_over("visits", "patients")
def join_using(visits: DataFrame, patients: DataFrame) -> DataFrame:
    return J.inner(visits, patients, "patient_id")


@_over("retail_customers", "retail_orders")
def join_left(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return J.keep_left(customers, orders, "customer_id").select("customer_id", "name", "order_id", "amount")


@_over("visits", "providers")
def join_right(visits: DataFrame, providers: DataFrame) -> DataFrame:
    return J.keep_right(visits, providers, "provider_id").select("provider_id", "specialty", "visit_id", "visit_date")


@_over("batches", "deviations")
def join_anti(batches: DataFrame, deviations: DataFrame) -> DataFrame:
    return J.anti(batches, deviations, "batch_id")


@_over("retail_orders", "retail_returns")
def join_flag(orders: DataFrame, returns: DataFrame) -> DataFrame:
    return J.exists_flag(orders, returns, "order_id", "was_returned")


@_over("scan")
def join_attach(scan: DataFrame) -> DataFrame:
    """Subcells with the average of their survey unit."""
    cells = grid_survey.subcell_averages(scan, ordered=False)
    units = A.group_avg(cells, ["tile", "su"], "avg_reading", "su_avg")
    attached = J.attach(cells, units, ["tile", "su"])
    return attached.select("tile", "su", "subcell", *[F.round(c, 6).alias(c) for c in ("avg_reading", "su_avg")])


@_over("quality_tests", "deviations")
def join_anti_detail(tests: DataFrame, deviations: DataFrame) -> DataFrame:
    """Tests of batches without a deviation; a batch may have any number of tests."""
    return J.anti(tests, deviations, "batch_id", hot_left=True)


@_over("batches", "quality_tests", "deviations")
def join_semi_both(batches: DataFrame, tests: DataFrame, deviations: DataFrame) -> DataFrame:
    return J.has_all(batches, [tests.filter(F.col("result_type") == "Pass"), deviations], "batch_id")


def _question(name: str) -> Query:
    return lambda spark, sf_dir: QUESTIONS[name](lambda t: table(prepare(spark), sf_dir, t))


QUERIES.update({name: _question(name) for name in QUESTIONS})


# Aggregation, windows, sorting, sets ---------------------------------------------------------


@_over("hospitals_like")
def group_sum_count(hospitals: DataFrame) -> DataFrame:
    return A.group_sum_count(hospitals, "city", "name", "beds", "num_hospitals", "total_beds")


@_over("scan")
def layered_avg(scan: DataFrame) -> DataFrame:
    levels = A.layered_avg(grid_survey.assign(scan), [["tile", "su", "subcell"], ["tile", "su"], ["tile"]], "reading", "tile_avg")
    return levels.select("tile", F.round("tile_avg", 4).alias("tile_avg"))


@_over("lineitem")
def count_distinct_multi(lineitem: DataFrame) -> DataFrame:
    return A.count_distinct_by(lineitem, "l_suppkey", {"n_parts": "l_partkey", "n_orders": "l_orderkey"})


@_over("lineitem")
def distinct_rows(lineitem: DataFrame) -> DataFrame:
    return R.distinct(lineitem.select("l_suppkey", "l_returnflag", "l_linestatus"))


@_over("lineitem")
def dedup_keyed(lineitem: DataFrame) -> DataFrame:
    columns = ["l_orderkey", "l_linenumber", "l_extendedprice", "l_partkey", "l_suppkey"]
    return R.dedup(lineitem.select(*columns), ["l_orderkey", "l_linenumber"], ["l_extendedprice"])


@_over("lineitem")
def global_percent_rank(lineitem: DataFrame) -> DataFrame:
    ranked = percent_rank(
        lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount"),
        [
            Criterion("price_pctile", "l_extendedprice"),
            Criterion("quantity_pctile", "l_quantity", descending=True),
            Criterion("discount_pctile", F.abs(F.col("l_discount") - 0.05)),
            Criterion("line_pctile", F.when(F.col("l_linenumber") > 2, F.col("l_linenumber"))),
        ],
    )
    shares = [F.round(c, 9).alias(c) for c in ("price_pctile", "quantity_pctile", "discount_pctile", "line_pctile")]
    return ranked.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", *shares)


@_over("orders")
def top1_per_group(orders: DataFrame) -> DataFrame:
    best = top_per_group(orders, ["o_custkey"], [R.order("o_totalprice", "desc"), R.order("o_orderkey")])
    return best.select("o_custkey", "o_orderkey", "o_totalprice")


@_over("orders")
def sort_multi(orders: DataFrame) -> DataFrame:
    keys = ["o_orderstatus", ("o_totalprice", "desc"), "o_orderkey"]
    return R.sort(orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), *keys)


@_over("orders")
def limit_preview(orders: DataFrame) -> DataFrame:
    return R.sort(orders.select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey").limit(15)


@_over("lineitem")
def top_k(lineitem: DataFrame) -> DataFrame:
    keys = [("l_extendedprice", "desc"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return R.top_k(lineitem.select("l_extendedprice", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), 10, *keys)


@_over("customer", "supplier")
def union_all(customer: DataFrame, supplier: DataFrame) -> DataFrame:
    parties = [
        (customer, "customer", {"c_custkey": "id", "c_name": "name", "c_acctbal": "balance"}),
        (supplier, "supplier", {"s_acctbal": "balance", "s_suppkey": "id", "s_name": "name"}),
    ]
    return R.union_all(*[R.tag(R.rename(df, names).select(*names.values()), "kind", kind) for df, kind, names in parties])


# Scalar functions ----------------------------------------------------------------------------


def _scalar(name: str, source: str, key: str | list[str], **columns: Callable[[], Column]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        keys = [key] if isinstance(key, str) else key
        return table(prepare(spark), sf_dir, source).select(*keys, *[make().alias(n) for n, make in columns.items()])

    QUERIES[name] = run


_scalar(
    "fn_contains", "donations", "donation_id",
    has_comma=lambda: F.contains("name", F.lit(",")),
    comma_flag=lambda: S.flag(F.contains("name", F.lit(","))),
)
_scalar("fn_length", "documents", "doc_id", n=lambda: F.length("text"))
_scalar("fn_regexp_replace", "documents", "doc_id", digits=lambda: S.digits(F.col("text")))
_scalar("fn_trim", "donations", "donation_id", trimmed=lambda: F.trim("zip"), blank=lambda: F.trim("category") == "")
_scalar("fn_cast_text", "part", "p_partkey", key_text=lambda: F.col("p_partkey").cast("string"), size_text=lambda: F.col("p_size").cast("string"))
_scalar(
    "fn_date_parts", "lineitem", ["l_orderkey", "l_linenumber"],
    y=lambda: F.year("l_shipdate"), m=lambda: F.month("l_shipdate"), d=lambda: F.dayofmonth("l_shipdate"),
)
_scalar(
    "fn_as_of_date", "donations", "donation_id",
    years_old=lambda: F.year(F.lit(quality.REVIEW_DATE)) - S.birth_year(F.col("date_of_birth"), quality.REVIEW_DATE),
)
_scalar("fn_try_date", "donations", "donation_id", born=lambda: S.try_date(F.col("date_of_birth")))
_scalar("fn_year_repair", "donations", "donation_id", birth_year=lambda: S.birth_year(F.col("date_of_birth"), quality.REVIEW_DATE))
_scalar("fn_abs", "customer", "c_custkey", magnitude=lambda: F.abs("c_acctbal"))
_scalar("fn_round", "lineitem", ["l_orderkey", "l_linenumber"], kilos=lambda: F.round(F.col("l_extendedprice") / 1000, 1))
_scalar(
    "fn_concat", "donations", "donation_id",
    label=lambda: F.concat(F.col("age").cast("string"), F.lit(" - "), F.col("phone")),
)
_scalar("fn_coalesce", "donations", "donation_id", phone=lambda: F.coalesce("phone", F.lit("none")), category=lambda: F.coalesce("category", "city"))
_scalar(
    "fn_substr_ascii", "part", "p_partkey",
    first=lambda: F.substring("p_name", 1, 1), code=lambda: F.ascii(F.substring("p_name", 1, 1)),
    upper=lambda: F.char(F.ascii(F.substring("p_name", 1, 1)) - 32),
)
_scalar(
    "fn_floor_mod", "lineitem", ["l_orderkey", "l_linenumber"],
    steps=lambda: F.round((F.col("l_extendedprice") - F.pmod("l_extendedprice", F.lit(32.81))) / F.lit(32.81)).cast("bigint"),
    rest=lambda: F.round(F.pmod("l_extendedprice", F.lit(32.81)), 6),
    wrapped=lambda: F.pmod(F.col("l_linenumber") - 4, F.lit(3)),
)
_scalar(
    "fn_to_timestamp", "readings", ["gps_unit_number", "cesium_137_level"],
    calibrated=lambda: F.try_to_timestamp(F.col("gps_calibration_timestamp")),
    calibrated_on=lambda: F.to_date(F.try_to_timestamp(F.col("gps_calibration_timestamp"))),
    unreadable=lambda: F.try_to_timestamp(F.col("gps_unit_number")),
)
_scalar(
    "fn_hash_key", "donations", "donation_id",
    full_key=lambda: S.hash_key(F.col("city"), F.col("donation_id")), gap_key=lambda: S.hash_key(F.col("phone"), F.col("zip")),
)
_scalar("fn_substring_test", "documents", "doc_id", mentions=lambda: F.col("text").contains("the"))
_scalar("fn_clean_number", "donations", "donation_id", number=lambda: S.clean_number(F.col("zip")), phone_number=lambda: S.clean_number(F.col("phone")))
_scalar("fn_list_length", "documents", "doc_id", n_lines=lambda: F.size(F.split("text", "\n")))
_scalar(
    "fn_weighted_score", "lineitem", ["l_orderkey", "l_linenumber"],
    score=lambda: F.round(sites.weighted({"l_discount": 0.40, "l_tax": 0.35, "l_quantity": 0.25}) * 0.25, 6),
)
_scalar(
    "fn_division", "lineitem", ["l_orderkey", "l_linenumber"],
    price_k=lambda: F.round(F.col("l_extendedprice") / 1000, 6),
    per_discount=lambda: F.round(F.try_divide("l_quantity", "l_discount"), 4),
)


@_over("documents")
def fn_explode(documents: DataFrame) -> DataFrame:
    """Words per line of the whole text; lines come from an exploded list."""
    lines = documents.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.select("doc_id", "line_no", F.length("line").alias("n_chars"))


@_over("rate_lines")
def fn_record_path(lines: DataFrame) -> DataFrame:
    """First level of the nested documents with its item's fields carried along, empty lists kept."""
    items = flatten(rates.documents_from_lines(lines), "out_of_network", {}, "item")
    keep = {"item_name": "item.name", "billing_code": "item.billing_code"}
    amounts = flatten(items, "item.allowed_amounts", keep, "amount", keep_empty=True)
    return amounts.select("item_name", "billing_code", "amount.service_code", "amount.payments.allowed_amount")


@_over("lineitem")
def fn_arrays_zip(lineitem: DataFrame) -> DataFrame:
    """Two lists of different length per row, zipped up to the shorter one."""
    names = F.array(F.col("l_returnflag"), F.col("l_linestatus"), F.lit("X"))
    counts = F.slice(F.array(F.col("l_linenumber"), F.col("l_linenumber") + 1), F.lit(1), F.col("l_linenumber") % 2 + 1)
    pairs = S.zip_complete(name=names, number=counts)
    return lineitem.select("l_orderkey", "l_partkey", F.inline(pairs))


@_over("road_segments", "interchanges")
def fn_st_distance(segments: DataFrame, interchanges: DataFrame) -> DataFrame:
    """Every segment with one interchange of its own; there are at least a hundred of them."""
    pairs = segments.drop("interstate").join(interchanges, segments.segment_id % 100 == interchanges.interchange_id)
    shapes = {
        "spot": G.point("lon", "lat"),
        "start": G.point("lon0", "lat0"),
        "road": G.line(("lon0", "lat0"), ("lon1", "lat1")),
    }
    metres = [F.round(G.distance(a, b), 2).alias(n) for n, a, b in (("to_road_m", "road", "spot"), ("to_start_m", "spot", "start"))]
    return pairs.withColumns(shapes).select("segment_id", *metres)


@_over("road_segments", "env_constraints")
def fn_st_intersects(segments: DataFrame, areas: DataFrame) -> DataFrame:
    """The scalar function alone: every segment is tested with one area. ``spatial_exclusion`` tests them all."""
    roads = segments.select("segment_id", G.line(("lon0", "lat0"), ("lon1", "lat1")).alias("road"))
    boxes = areas.select("area_id", G.box("min_lon", "min_lat", "max_lon", "max_lat").alias("area"))
    pairs = roads.join(boxes, F.col("segment_id") % 25 == F.col("area_id"))
    return pairs.select("segment_id", "area_id", G.intersects("road", "area").alias("meets"))


# Data quality, documents, weather -------------------------------------------------------------


@_over("donations")
def dq_profile(donations: DataFrame) -> DataFrame:
    return quality.dq_profile(donations)


@_over("rule_cases")
def dq_rule_cases(cases: DataFrame) -> DataFrame:
    return quality.rule_cases(cases)


@_over("retail_returns", "retail_orders", "donations", "batch_costs", "cost_products")
def constraint_violations(
    returns: DataFrame, orders: DataFrame, donations: DataFrame, cost_lines: DataFrame, products: DataFrame
) -> DataFrame:
    return quality.constraint_violations(
        quality.Unique("donations_key", donations, ["donation_id"]),
        quality.Unique("cost_grain", cost_lines, ["batch_id", "cost_category", "full_date"]),
        quality.NotNull("donations_phone", donations, "phone"),
        quality.NotNull("cost_units", cost_lines, "units_produced"),
        quality.References("returns_order", returns, "order_id", orders, "order_id"),
        quality.References("cost_product", cost_lines, "product_id", products, "product_id"),
    )


@_over("rate_lines")
def flatten_rates(lines: DataFrame) -> DataFrame:
    """Nested documents held as JSON text in a column, decoded and flattened."""
    documents = rates.documents_from_lines(spread(lines)).select(F.to_json(F.struct("out_of_network")).alias("document"))
    decoded = documents.select(F.from_json("document", rates.DOCUMENT).alias("d")).select("d.out_of_network")
    return rates.flatten_rates(decoded)


_FACT_CLASSES = {"item": "fact", "number": "num", "label": "label"}


@_over("fact_pages")
def html_labeled_number(pages: DataFrame) -> DataFrame:
    return weather.enrollment(pages, "Traditional", **_FACT_CLASSES)


@_over("places", "fact_pages", "weather_daily")
def severe_weather_days(places: DataFrame, pages: DataFrame, days: DataFrame) -> DataFrame:
    enrolled = weather.enrollment(pages, "Traditional", **_FACT_CLASSES)
    impact = weather.severe_weather_impact(places, enrolled, weather.payloads_from_days(days))
    return impact.withColumn("severe_days", F.array_join("severe_days", ","))


# Grid survey ---------------------------------------------------------------------------------


@_over("scan")
def grid_assign_cells(scan: DataFrame) -> DataFrame:
    return scan.select("reading_id", "easting", "northing", grid_assign("easting", "northing").alias("c")).select(
        "reading_id", "easting", "northing", "c.tile", "c.su", "c.subcell"
    )


QUERIES["grid_assign"] = QUERIES.pop("grid_assign_cells")


@_over("scan")
def grid_assign_sql(scan: DataFrame) -> DataFrame:
    name = register_grid_function(scan.sparkSession, "convert_xy")
    cells = scan.sparkSession.sql(f"SELECT reading_id, easting, northing, {name}(easting, northing) AS c FROM {{scan}}", scan=scan)
    return cells.select("reading_id", "easting", "northing", "c.tile", "c.su", "c.subcell")


@_over("scan")
def grid_subcell_avg(scan: DataFrame) -> DataFrame:
    return grid_survey.subcell_averages(scan).withColumn("avg_reading", F.round("avg_reading", 6))


@_over("scan")
def tile_status_rollup(scan: DataFrame) -> DataFrame:
    return grid_survey.tile_status_rollup(scan)


@_over("scan")
def neighbor_change(scan: DataFrame) -> DataFrame:
    return grid_survey.neighbor_change(scan)


@_over("scan")
def rank_within_region(scan: DataFrame) -> DataFrame:
    return grid_survey.rank_within_region(scan)


@_over("scan")
def stability_score(scan: DataFrame) -> DataFrame:
    return grid_survey.stability_scores(scan)


@_over("scan")
def findings_report(scan: DataFrame) -> DataFrame:
    return grid_survey.findings(scan)


@_over("scan")
def recommend_prompt(scan: DataFrame) -> DataFrame:
    """The findings with the request for each and the answer by rule."""
    found = grid_survey.findings(scan).withColumn("prompt", grid_survey.finding_prompt())
    columns = ("finding_category", "tile", "su", "subcell", "subcell_status", "prompt")
    return grid_survey.recommend(found.select(*columns))


# Site selection ------------------------------------------------------------------------------


def _sites(spark: SparkSession, sf_dir: str) -> sites.SiteTables:
    get = lambda name: view(prepare(spark), sf_dir, name)
    shaped = sites.with_geometry(get("road_segments"), get("power_infra"), get("interchanges"), get("env_constraints"))
    return sites.SiteTables(
        **shaped, traffic_counts=get("traffic_counts"), weather_risk=get("weather_risk"), incidents=get("incidents")
    )


@query
def site_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.base(_sites(spark, sf_dir)).drop("geom")


@query
def spatial_exclusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.excluded(_sites(spark, sf_dir))


@query
def power_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.power_proximity(_sites(spark, sf_dir)).withColumn("min_power_dist_m", F.round("min_power_dist_m", 3))


@query
def interchange_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.interchange_density(_sites(spark, sf_dir))


@query
def site_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = sites.scored(_sites(spark, sf_dir))
    return scored.select(
        "segment_id", *[F.round(c, 9).alias(c) for c in sites.PERCENTILES], "corridor_importance", "strategic_visibility"
    )


@query
def site_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = sites.composite(sites.scored(_sites(spark, sf_dir)))
    return scores.select("segment_id", *[F.round(c, 6).alias(c) for c in (*sites.WEIGHTS, "composite_score")])


@query
def corridor_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = sites.corridor_rank(sites.composite(sites.scored(_sites(spark, sf_dir))))
    return ranked.select("segment_id", "corridor", "corridor_rank")


@query
def spaced_second_pick(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = sites.corridor_rank(sites.composite(sites.scored(_sites(spark, sf_dir))))
    chosen = sites.picks(ranked).filter(F.col("corridor_rank") > 1)
    return chosen.select("corridor", "corridor_rank", "segment_id", "interstate", "start_mile")


@query
def site_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.site_selection(_sites(spark, sf_dir))


@query
def site_selection_intent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sites.site_selection(_sites(spark, sf_dir), intent=True)


# Star schema, costs --------------------------------------------------------------------------


@_over("readings")
def dim_location_versions(readings: DataFrame) -> DataFrame:
    return star.dim_location(readings)


@_over("readings")
def dim_detector(readings: DataFrame) -> DataFrame:
    return star.dim_detector(readings)


@_over("readings")
def dim_date(readings: DataFrame) -> DataFrame:
    return star.dim_date(readings)


@_over("readings")
def fact_readings(readings: DataFrame) -> DataFrame:
    return star.fact_readings(readings)


@_over("readings")
def scd2_intervals(readings: DataFrame) -> DataFrame:
    versions = star.dim_location(readings).select("location_key", "gps_unit_number", "calibration_timestamp")
    return star.scd2_intervals(versions, ["gps_unit_number"], "calibration_timestamp")


def _dimension(name: str, rows: DataFrame) -> DataFrame:
    return costs.write_dimension(rows, name, writers.scratch_database(rows.sparkSession))


@_over("batch_costs")
def cost_dim_date(lines: DataFrame) -> DataFrame:
    return _dimension("dim_date", costs.date_dimension(lines, "full_date"))


@_over("facility_rows")
def cost_dim_facility(rows: DataFrame) -> DataFrame:
    return _dimension("dim_facility", rows)


@_over("product_rows")
def cost_dim_product(rows: DataFrame) -> DataFrame:
    return _dimension("dim_product", rows)


@_over("batch_rows")
def cost_dim_batch(rows: DataFrame) -> DataFrame:
    return _dimension("dim_batch", rows)


@_over("batch_costs")
def cost_dim_category(lines: DataFrame) -> DataFrame:
    return _dimension("dim_cost_category", costs.category_dimension(lines))


@_over("batch_costs")
def cost_fact(lines: DataFrame) -> DataFrame:
    return costs.cost_fact(lines)


@_over("batch_costs")
def cost_metrics_by_dim(lines: DataFrame) -> DataFrame:
    return costs.cost_metrics_by_dim(lines)


@_over("batch_costs", "cost_batches", "cost_facilities", "cost_products")
def cost_ml_wide(lines: DataFrame, batches: DataFrame, facilities: DataFrame, products: DataFrame) -> DataFrame:
    return costs.cost_ml_wide(lines, batches, facilities, products)
