"""From raw documents to a mixed training corpus: filter, clean, deduplicate, decontaminate, mix."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, line_dedup, mixing, quality_rules, simhash
from tessera.llm.common import same, table, word_count, written
from tessera.llm.queries import label_weight


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current quality policy keeps."""
    return quality_rules.filter_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the boilerplate lines of their source; ``n_chars`` counts what stays."""
    clean = line_dedup.drop_boilerplate(docs, F.col("source"))
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: 3-word shingles, 3 differing bits."""
    return simhash.keep_one(docs, shingle=3, radius=3)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with the number of ``copies`` of each, at least 1; sources weigh 5, 2, 1."""
    marks = label_weight(docs, table(spark, sf_dir, "labels"))
    size = word_count(F.col("text"))
    weighed = docs.select("doc_id", "source", size.alias("n_words")).join(marks, same(F.col("doc_id"), F.col("id")), "left")
    plan = mixing.mix(weighed, F.col("doc_id"), F.col("source"), F.col("n_words"), F.coalesce("weight", F.lit(1.0)))
    return mixing.select(docs, plan, "doc_id", size)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("mixing sources", mix),
]

# SQL has no XXH64, so it cannot express the near-duplicate stage; the tests run a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
