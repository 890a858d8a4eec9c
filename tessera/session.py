"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_OWN_SCRATCH = "tessera.scratch.dir"

# Runtime settings the queries are made for.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def get_session(cpus: int | str = 8, app: str = "tessera", **conf: str) -> SparkSession:
    """Local session for tests and benchmarks; on a cluster the session comes from spark-submit."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        # Recording the call site of every column costs more than small queries take.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def prepare(spark: SparkSession) -> SparkSession:
    """Sets what the queries are made for where the session says nothing; what its owner has set stays."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    Only a session in one process (``local`` or ``local[n]``) without that setting gets a folder of its own;
    the executors of a cluster, also of ``local-cluster``, may not see one, so there the setting is required.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_OWN_SCRATCH, None)
    if shared:
        return shared
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    own = tempfile.mkdtemp(prefix="tessera-")
    spark.conf.set(_OWN_SCRATCH, own)
    return own


# What this process has made in the shared folder: paths, and databases.
_MADE: list[str] = []
_DATABASES: list[str] = []


def note_database(name: str) -> None:
    _DATABASES.append(name)


def release(spark: SparkSession) -> None:
    """Deletes the intermediate tables and databases that queries of this process have left, once their results
    are no longer needed."""
    while _DATABASES:
        spark.sql(f"DROP DATABASE IF EXISTS {_DATABASES.pop()} CASCADE")
    configuration = spark._jsc.hadoopConfiguration()
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        path.getFileSystem(configuration).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[SparkSession]:
    """Releases on leaving what queries inside have written for themselves."""
    try:
        yield spark
    finally:
        release(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier call returned."""
    path = f"{scratch_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, fixes non-deterministic columns (partition ids) for good, and survives
    the loss of an executor, which cached blocks do not.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_by(df: DataFrame, name: str, *columns: str) -> Callable[..., DataFrame]:
    """Write ``df`` by the values of ``columns``; what is returned reads the rows of given values, so that the planner
    knows the bytes of those rows alone, or all rows."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.partitionBy(*columns).parquet(path)

    def read(*values) -> DataFrame:
        schema = T.StructType([f for f in df.schema.fields if f.name not in columns[: len(values)]])
        return spark.read.schema(schema).parquet("/".join([path, *[f"{c}={v}" for c, v in zip(columns, values)]]))

    return read


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where a scan has fewer splits than there are cores, for work that is heavy
    per row. A large table has more splits than cores and stays as it is. Only the planner's estimate is asked,
    so no job runs."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return df.repartition(cores) if planned_bytes(df) < cores * split else df


def planned_bytes(df: DataFrame) -> int:
    """The planner's estimate of the size of ``df``; for a written table, its bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def lanes(spark: SparkSession) -> int:
    """Partitions for rows that are heavy to work on: as many as shuffles get, and one per core at least. A number
    that is asked for is not coalesced."""
    return max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def sized_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with ``right`` written first: the planner then knows its bytes and broadcasts it below
    ``spark.sql.autoBroadcastJoinThreshold``; beyond, a join of two plain shuffles can be split where a key is hot."""
    return left.join(materialise(right, "joined"), on, how)
