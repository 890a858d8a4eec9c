"""Severe winter days per place and the student-days they cost."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.markup import labeled_number
from tessera.functions.scalar import zip_complete
from tessera.operators.aggregates import qualifying

PAYLOAD = "daily struct<time: array<string>, temperature_2m_min: array<double>, snowfall_sum: array<double>>"
MIN_TEMPERATURE = -7.0
MIN_SNOWFALL = 10.0


def payloads_from_days(days: DataFrame) -> DataFrame:
    """Column-parallel JSON payload per place. ``days`` has one row per place and calendar day, so
    an array is no longer than the calendar."""
    ordered = F.sort_array(F.collect_list(F.struct(F.col("day").cast("string").alias("day"), "tmin", "snowfall")))
    daily = F.struct(
        F.col("days.day").alias("time"), F.col("days.tmin").alias("temperature_2m_min"), F.col("days.snowfall").alias("snowfall_sum")
    )
    grouped = days.groupBy("place_id").agg(ordered.alias("days"))
    return grouped.select("place_id", F.to_json(F.struct(daily.alias("daily")), {"ignoreNullFields": "false"}).alias("payload"))


def severe_days(payload: Column, min_temperature: float = MIN_TEMPERATURE, min_snowfall: float = MIN_SNOWFALL) -> Column:
    """Days at or beyond either limit. A missing payload or series gives an empty list; a day with
    either value missing is skipped."""
    daily = F.from_json(payload, PAYLOAD)["daily"]
    days = zip_complete(
        time=F.coalesce(daily["time"], F.array().cast("array<string>")),
        low=F.coalesce(daily["temperature_2m_min"], F.array().cast("array<double>")),
        snow=F.coalesce(daily["snowfall_sum"], F.array().cast("array<double>")),
    )

    def severe(d: Column) -> Column:
        known = d["low"].isNotNull() & d["snow"].isNotNull()
        return known & ((d["low"] <= min_temperature) | (d["snow"] >= min_snowfall))

    return qualifying(days, severe, lambda d: d["time"])


def enrollment(pages: DataFrame, keyword: str = "Traditional", **classes: str) -> DataFrame:
    return pages.select("place_id", labeled_number(F.col("html"), keyword, **classes).alias("enrolled"))


def severe_weather_impact(places: DataFrame, enrolled: DataFrame, payloads: DataFrame) -> DataFrame:
    """Per place: enrolled students, the severe days, their number, and the product of both."""
    days = payloads.select("place_id", severe_days(F.col("payload")).alias("severe_days"))
    joined = places.join(enrolled, "place_id", "left").join(days, "place_id", "left")
    return joined.select(
        "name",
        "state",
        F.coalesce("enrolled", F.lit(0)).alias("enrolled"),
        F.coalesce("severe_days", F.array().cast("array<string>")).alias("severe_days"),
    ).withColumns(
        {
            "severe_day_count": F.size("severe_days"),
            "student_days": F.col("enrolled") * F.size("severe_days"),
        }
    )
