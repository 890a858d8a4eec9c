"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import materialise, prepare
from tessera.sources.readers import load

# A word is a run of characters that are not ASCII white space. bytes.split() cuts at the same characters.
WORD = r"[^\x20\x09-\x0D]+"
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load(prepare(spark), sf_dir, name)


def fresh(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has, whatever extra columns they bring."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Drops the shuffle files of every query that runs inside, as soon as it has ended."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back; its shuffle files go at once."""
    with shuffles_released(df.sparkSession):
        return materialise(df, name)


def word_count(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z in lower case;
    empty for NULL or without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, _URL, 1), _UPPER, _UPPER.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty where the host is."""
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))
