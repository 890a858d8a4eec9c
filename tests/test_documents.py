from __future__ import annotations

import json
import os
import random

from pyspark.sql import functions as F

from tessera.functions.markup import labeled_number
from tessera.functions.scalar import zip_complete
from tessera.operators.aggregates import group_sum_count
from tessera.plans import models, rates, weather
from tessera.sources import readers, writers


def amount(service, allowed, billed, npi):
    return {
        "tin": {"type": "npi", "value": str(npi[0] if npi else "")},
        "service_code": service,
        "billing_class": "professional",
        "payments": {"allowed_amount": allowed, "providers": [{"billed_charge": billed, "npi": npi}]},
    }


def item(code, *amounts):
    kind = "HCPCS" if code.startswith("G") else "CPT"
    return {"name": f"N {code}", "billing_code_type": kind, "billing_code": code, "description": f'"{code}", more', "allowed_amounts": list(amounts)}


# The expected rows of the nested example: eight of them.
DOCUMENT = {
    "version": "1.0.0",
    "out_of_network": [
        item("G0283", amount("11", 8.78, 10.0, [1184090458.0])),
        item("97140", amount("11", 20.03, 97.5, [1184090458.0]), amount("12", 24.64, 95.0, [1285296509.0])),
        item("99232", amount("61", 74.54, 112.0, [1306821053.0])),
        item("99233", amount("21", 100.35, 200.0, [1124356779.0])),
        item("97112", amount("11", 32.9, 97.5, [1184090458.0])),
        item("97110", amount("11", 21.51, 97.5, [1184090458.0]), amount("12", 26.62, 95.0, [1285296509.0])),
    ],
}
GOLDEN = [
    ("G0283", "11", 8.78, 10.0, 1184090458.0), ("97140", "11", 20.03, 97.5, 1184090458.0), ("97140", "12", 24.64, 95.0, 1285296509.0),
    ("99232", "61", 74.54, 112.0, 1306821053.0), ("99233", "21", 100.35, 200.0, 1124356779.0), ("97112", "11", 32.9, 97.5, 1184090458.0),
    ("97110", "11", 21.51, 97.5, 1184090458.0), ("97110", "12", 26.62, 95.0, 1285296509.0),
]


def read(spark, tmp_path, document, schema=rates.DOCUMENT):
    path = tmp_path / "document.json"
    path.write_text(json.dumps(document, indent=2))
    return readers.read_json_documents(spark, str(path), schema)


def test_flatten_golden(spark, tmp_path):
    for schema in (rates.DOCUMENT, None):
        flat = rates.flatten_rates(read(spark, tmp_path, DOCUMENT, schema))
        assert flat.columns == [
            "name", "billing_code_type", "billing_code", "description", "service_code", "billing_class", "allowed_amount", "billed_charge", "npi",
        ]
        rows = [(r.billing_code, r.service_code, r.allowed_amount, r.billed_charge, r.npi) for r in flat.collect()]
        assert sorted(rows) == sorted(GOLDEN)


def test_flatten_empty_lists(spark, tmp_path):
    document = {"out_of_network": [item("1"), item("2", amount("11", 1.0, 2.0, [])), item("3", amount("12", 3.0, 4.0, [5.0, 6.0]))]}
    df = read(spark, tmp_path, document)
    assert sorted((r.billing_code, r.npi) for r in rates.flatten_rates(df).collect()) == [("3", 5.0), ("3", 6.0)]
    kept = rates.flatten_rates(df, keep_empty=True).collect()
    assert sorted((r.billing_code, r.billed_charge, r.npi) for r in kept if r.npi is None or r.npi < 6) == [
        ("1", None, None), ("2", 2.0, None), ("3", 4.0, 5.0),
    ]
    assert len(kept) == 4


def test_csv_and_json_round_trip(spark, tmp_path):
    rows = [("BJC", 'B, "H"', "St. Louis", 1432), ("BJC", " padded ", "Creve Coeur", 1107), ("Mercy", "M", "Creve Coeur", 983), ("SSM", "S", "St. Louis", 965)]
    df = spark.createDataFrame(rows, "system string, name string, city string, beds int")
    writers.write_csv(df, str(tmp_path / "csv"))
    for schema in (df.schema, None):
        back = readers.read_csv(spark, str(tmp_path / "csv"), schema)
        assert sorted(map(tuple, back.collect())) == sorted(rows)
    totals = group_sum_count(back, "city", "name", "beds", "num_hospitals", "total_beds").collect()
    assert sorted(map(tuple, totals)) == [("Creve Coeur", 2, 2090), ("St. Louis", 2, 2397)]
    writers.write_json_lines(df, str(tmp_path / "json"))
    assert sorted(map(tuple, readers.read_json_lines(spark, str(tmp_path / "json"), df.schema).collect())) == sorted(rows)
    writers.write_json_documents(df, str(tmp_path / "documents"))
    assert sorted(map(tuple, readers.read_json_documents(spark, str(tmp_path / "documents"), df.schema).collect())) == sorted(rows)


def test_documents_are_written_compressed(spark, tmp_path):
    """Nested documents repeat their names in every row; files of several tasks and batches come back whole."""
    lines = spark.range(0, 25_000, 1, 2).selectExpr(
        "id AS l_orderkey", "CAST(id % 7 AS INT) AS l_linenumber", "id % 50 AS l_partkey", "id % 11 AS l_suppkey",
        "CAST(id % 50 AS DOUBLE) AS l_quantity", "id * 1.5D AS l_extendedprice", "IF(id % 3 = 0, 'R', 'N') AS l_returnflag",
    )
    documents = rates.documents_from_lines(lines)
    path = tmp_path / "documents"
    writers.write_json_documents(documents, str(path))
    text = documents.select(F.sum(F.length(F.to_json(F.struct("out_of_network")))).alias("n")).first().n
    assert sum(f.stat().st_size for f in path.glob("part-*")) * 4 < text
    back = readers.read_json_documents(spark, str(path), rates.DOCUMENT)
    figures = [rates.flatten_rates(d).select(F.count("*"), F.expr("sum(CAST(xxhash64(*) AS DECIMAL(38, 0)))")).first() for d in (documents, back)]
    assert figures[0] == figures[1] and back.count() == 25_000


def test_models(spark):
    source = spark.createDataFrame([(1,), (None,)], "id int")
    table = models.model_table(source)
    assert table.count() == 2
    assert [r.id for r in models.model_view(table).collect()] == [1]
    name = f"{writers.scratch_database(spark)}.replaced_model"
    again = models.model_table(source.filter("id = 1"), name)
    assert models.model_table(source, name).count() == 2
    assert again.columns == ["id"]


def test_csv_keeps_line_breaks_and_empty_values(spark, tmp_path):
    rows = [(1, 'two\nlines "quoted", and more\r\n', ""), (2, None, " spaces "), (3, "", None), (4, "\\N?", "a,b")]
    df = spark.createDataFrame(rows, "id int, text string, remark string")
    writers.write_csv(df, str(tmp_path / "notes"))
    assert sorted(map(tuple, readers.read_csv(spark, str(tmp_path / "notes"), df.schema).collect())) == rows


def figure(number, label, extra=""):
    return f'<div class="wide numbers-item"{extra}><p class="numbers-number">{number}</p><p class="numbers-description">{label}</p></div>'


def test_labeled_number(spark):
    filler = "<p>x</p>" * 5000
    pages = [
        (1, filler + figure("99", "Labs") + figure("\n 7,951 ", "<span>Traditional</span>\n undergraduates")),
        (2, figure("n/a", "Traditional") + figure("12", "Traditional")),
        (3, figure("5", "Other")),
        (4, '<div class="numbers-item"><p class="numbers-number">3</p></div>'),
        (5, None),
        (6, figure("1", "Traditional") + figure("2", "Traditional")),
        (7, "<div class='a numbers-item'><div><p class='numbers-number'>1,<b>234</b></p></div><div><p class='numbers-description'>Traditional&nbsp;ones</p></div></div>"),
        (8, figure("9", "Labs") + '<div class="numbers-item"><div>x</div><p class="numbers-number">8&#44;765</p><p class="numbers-description">R&amp;D Traditional</p></div>'),
    ]
    df = spark.createDataFrame(pages, "place_id int, html string")
    assert [r.n for r in df.select("place_id", labeled_number(F.col("html"), "Traditional").alias("n")).orderBy("place_id").collect()] == [
        7951, 12, None, None, None, 1, 1234, 8765,
    ]


def test_zip_stops_at_the_shortest(spark):
    df = spark.createDataFrame([([1, 2, 3], ["a", "b"]), ([], ["a"]), (None, ["a"])], "n array<int>, t array<string>")
    zipped = df.select(zip_complete(n=F.col("n"), t=F.col("t")).alias("z")).collect()
    assert [[tuple(p) for p in r.z] for r in zipped] == [[(1, "a"), (2, "b")], [], []]


def test_severe_days(spark):
    def payload(**daily):
        return json.dumps({"daily": daily})

    days = ["d1", "d2", "d3", "d4", "d5"]
    cases = [
        (1, payload(time=days, temperature_2m_min=[-7.0, -6.9, 0.0, None, -9.0], snowfall_sum=[0.0, 9.9, 10.0, 50.0, None])),
        (2, payload(time=days, temperature_2m_min=[-20.0, -20.0], snowfall_sum=[0.0, 0.0, 0.0])),
        (3, payload(time=days)),
        (4, "{}"),
        (5, None),
        (6, "not json"),
    ]
    df = spark.createDataFrame(cases, "place_id int, payload string")
    places = spark.createDataFrame([(i, f"P{i}", "MO") for i in range(1, 8)], "place_id int, name string, state string")
    enrolled = spark.createDataFrame([(1, 100), (2, None)], "place_id int, enrolled long")
    result = {r.name: r for r in weather.severe_weather_impact(places, enrolled, df).collect()}
    assert result["P1"].severe_days == ["d1", "d3"]
    assert result["P2"].severe_days == ["d1", "d2"]
    assert (result["P1"].severe_day_count, result["P1"].student_days, result["P2"].enrolled) == (2, 200, 0)
    assert all(result[f"P{i}"].severe_days == [] and result[f"P{i}"].student_days == 0 for i in range(3, 8))


def test_one_large_csv_file_is_read_by_many_tasks(spark, tmp_path):
    """Records with line breaks, quotes and empty or missing values, across the borders of small ranges."""
    rng = random.Random(4)
    piece = lambda: "".join(rng.choice(["a", '"', ",", "\n", "\r\n", " ", "é", "\n\n"]) for _ in range(rng.randrange(60)))
    rows = [(i, rng.choice([None, "", piece(), piece(), "x\n" * 400]), piece()) for i in range(600)]
    df = spark.createDataFrame(rows, "id int, note string, text string").coalesce(1)
    path = str(tmp_path / "one")
    writers.write_csv(df, path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1
        found = readers.records(spark, path)
        assert found.count() == len(rows)
        assert spark.read.option("lineSep", "\n").text(path).rdd.getNumPartitions() > 20
        assert sorted(map(tuple, readers.read_csv(spark, path, df.schema).collect())) == sorted(rows)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_csv_with_carriage_returns_and_without_a_last_line_break(spark, tmp_path):
    (tmp_path / "crlf.csv").write_bytes(b'id,text\r\n1,a\r\n\r\n2,"b\r\nc"\r\n3,d')
    got = readers.read_csv(spark, str(tmp_path / "crlf.csv"), "id int, text string").collect()
    assert sorted(map(tuple, got)) == [(1, "a"), (2, "b\r\nc"), (3, "d")]
