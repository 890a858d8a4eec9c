"""Table, CSV and JSON readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import materialise, prepare
from tessera.sources.schemas import TABLES
from tessera.sources.writers import CSV_NULL


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one of the Parquet tables by name; the schema of an undeclared table is inferred."""
    reader = prepare(spark).read
    if name in TABLES:
        reader = reader.schema(TABLES[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, null: str = CSV_NULL) -> DataFrame:
    """CSV with a header, whose quoted values may hold line breaks. With a schema, large files are read by many tasks;
    types are inferred (one extra pass, a task per file) only when no schema is given."""
    as_is = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"', "nullValue": null, "emptyValue": "", "multiLine": True}
    if schema is None:
        return spark.read.options(header=True, inferSchema=True, **as_is).csv(path)
    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {k: str(v).lower() if isinstance(v, bool) else v for k, v in as_is.items()}
    return records(spark, path).select(F.from_csv("record", ddl, options).alias("row")).select("row.*")


def records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """``record``: the text of every CSV record, line breaks in quotes kept, without the first of each file (``header``).

    A line starts a record if the quotes before it in its file are even in number; a quote inside a value is doubled, so it
    does not change that. Files are read in ranges: the quotes of each range are counted, running sums over the ranges of
    a file tell how each begins, and lines are put together inside their range. Only records that go on in another
    range meet their rest afterwards, two pieces per range at most.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"), "value", F.expr("length(value) - length(replace(value, '\"', '')) AS quotes"),
    )
    before = "OVER (PARTITION BY file ORDER BY block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    ranges = lines.groupBy("file", "block").agg(F.sum("quotes").alias("quotes"))
    ranges = materialise(ranges.selectExpr("file AS in_file", "block AS at", f"coalesce(sum(quotes) {before}, 0L) AS earlier"), "ranges")
    known = lines.join(ranges, (F.col("file") == F.col("in_file")) & (F.col("block") == F.col("at")))
    running = "OVER (PARTITION BY file, block ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND"
    started = known.selectExpr("*", f"(earlier + coalesce(sum(quotes) {running} 1 PRECEDING), 0L)) % 2 = 0 AS starts")
    # Number 0 goes on from an earlier range.
    numbered = started.selectExpr("*", f"sum(CAST(starts AS BIGINT)) {running} CURRENT ROW) AS number")
    pieces = numbered.groupBy("file", "block", "number").agg(_joined("place", "value").alias("record"), F.sum("quotes").alias("quotes"))
    pieces = materialise(pieces.selectExpr("*", "number > 0 AND quotes % 2 = 1 AS open", "number = 1 AND block = 0 AS first"), "pieces")
    # What goes on belongs to the last range that left a record open.
    origin = "max(IF(open, block, NULL)) OVER (PARTITION BY file ORDER BY block, number)"
    broken = pieces.filter("open OR number = 0").selectExpr("*", f"{origin} AS origin")
    mended = broken.groupBy("file", "origin").agg(_joined("block", "record").alias("record"), F.max("first").alias("first"))
    found = pieces.filter("NOT open AND number > 0").select("record", "first").unionByName(mended.select("record", "first"))
    found = found.withColumn("record", F.regexp_replace("record", "\r$", ""))
    return found.filter((F.col("record") != "") & ~(F.col("first") & F.lit(header))).select("record")


def _joined(place: str, text: str) -> Column:
    """Texts of a group as lines in the order of their places."""
    listed = F.array_sort(F.collect_list(F.struct(F.col(place).alias("place"), F.col(text).alias("text"))))
    return F.array_join(F.transform(listed, lambda p: p["text"]), "\n")


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Files that hold one JSON document each (an object, or an array of objects) over many lines."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.option("multiLine", True).json(path)
