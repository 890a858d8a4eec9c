"""Flat sensor readings to a star schema with versioned dimensions and hash keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.scalar import hash_key
from tessera.operators.ranking import row_number
from tessera.operators.relational import dedup, order
from tessera.session import materialise
from tessera.sources.writers import save_table

# Fixed names of the detector types; the source columns carry them as a prefix in lower case.
DETECTOR_TYPES = ("CESIUM_137", "GAMMA", "THORIUM_232")

READINGS = """
collection_timestamp string, gps_unit_number string, gps_lat double, gps_lng double, gps_precision double,
gps_calibration_timestamp string, cesium_137_unit string, gamma_unit string, thorium_232_unit string,
cesium_137_precision double, gamma_precision double, thorium_232_precision double,
detector_calibration_timestamp string, cesium_137_level double, gamma_level double, thorium_232_level double
"""


def _timestamp(name: str) -> Column:
    return F.try_to_timestamp(F.col(name))


def dim_location(readings: DataFrame) -> DataFrame:
    """One row per unit and calibration: every version is kept. Among several positions of one
    version the smallest survives, so the result does not depend on the order of the rows."""
    versions = readings.select(
        "gps_unit_number", "gps_lat", "gps_lng", "gps_precision", _timestamp("gps_calibration_timestamp").alias("calibration_timestamp")
    )
    unique = dedup(versions, ["gps_unit_number", "calibration_timestamp"], ["gps_lat", "gps_lng"])
    return unique.withColumn("location_key", hash_key(F.col("gps_unit_number"), F.col("calibration_timestamp")))


def dim_detector(readings: DataFrame) -> DataFrame:
    """One row per detector unit and type, with its earliest calibration. The three detectors of a
    reading come from one scan."""
    detectors = F.array(
        *[
            F.struct(
                F.col(f"{d.lower()}_unit").alias("detector_unit_number"),
                F.lit(d).alias("detector_type"),
                F.col(f"{d.lower()}_precision").alias("calibration_precision"),
                _timestamp("detector_calibration_timestamp").alias("calibration_timestamp"),
            )
            for d in DETECTOR_TYPES
        ]
    )
    rows = readings.select(F.inline(detectors))
    unique = dedup(rows, ["detector_unit_number", "detector_type"], ["calibration_timestamp", "calibration_precision"])
    return unique.withColumn("detector_key", hash_key(F.col("detector_unit_number"), F.col("detector_type")))


def dim_date(readings: DataFrame) -> DataFrame:
    days = readings.select(F.to_date(_timestamp("collection_timestamp")).alias("date_actual")).distinct()
    return days.withColumns(
        {
            "year": F.year("date_actual"),
            "month": F.month("date_actual"),
            "day": F.dayofmonth("date_actual"),
            "date_key": F.col("date_actual").cast("string"),
        }
    )


def fact_readings(readings: DataFrame) -> DataFrame:
    """One row per reading. The foreign keys are the same hashes as in the dimensions, so no join is needed."""
    collected = _timestamp("collection_timestamp")
    detector_keys = [
        hash_key(F.col(f"{d.lower()}_unit"), F.lit(d)).alias(f"{d.split('_')[0].lower()}_detector_key") for d in DETECTOR_TYPES
    ]
    return readings.select(
        collected.alias("collection_timestamp"),
        F.to_date(collected).cast("string").alias("date_key"),
        hash_key(F.col("gps_unit_number"), _timestamp("gps_calibration_timestamp")).alias("location_key"),
        *detector_keys,
        *[f"{d.lower()}_level" for d in DETECTOR_TYPES],
    )


def build_star(readings: DataFrame) -> dict[str, DataFrame]:
    return {
        "dim_location": dim_location(readings),
        "dim_detector": dim_detector(readings),
        "dim_date": dim_date(readings),
        "fact_radiation_readings": fact_readings(readings),
    }


def write_star(readings: DataFrame, database: str) -> dict[str, DataFrame]:
    """Replace the four tables. The source is written once and read four times; the fact table is
    partitioned by day."""
    star = build_star(materialise(readings, "readings"))
    return {
        name: save_table(table, f"{database}.{name}", ["date_key"] if name.startswith("fact") else None) for name, table in star.items()
    }


def scd2_intervals(versions: DataFrame, keys: list[str], since: str) -> DataFrame:
    """Validity of each version: from its own time to the next version's, and whether it is current.

    An extension: the star above keeps versions without intervals. The next version is found by its
    number, so one key with very many versions spreads over many tasks. ``since`` is unique per key.
    """
    numbered = materialise(row_number(versions, keys, [order(since)], "__version"), "versions")
    following = numbered.select(
        *[F.col(k).alias(f"__{k}") for k in keys], (F.col("__version") - 1).alias("__before"), F.col(since).alias("effective_to")
    )
    # A missing key is a key like any other.
    same = F.col("__version") == F.col("__before")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    joined = numbered.join(following, same, "left")
    return joined.select(
        *versions.columns, F.col(since).alias("effective_from"), "effective_to", F.col("effective_to").isNull().alias("is_current")
    )
