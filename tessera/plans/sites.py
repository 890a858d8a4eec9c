"""Site selection: road segments scored on six criteria, two spaced picks per corridor."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import geometry as G
from tessera.operators import spatial
from tessera.operators.joins import anti
from tessera.operators.ranking import Criterion, percent_rank, row_number, spaced_second
from tessera.operators.relational import order, sort
from tessera.session import materialise

# Fixed values of the analysis.
POWER_RADIUS_M = 30_000
INTERCHANGE_RADIUS_M = 5_000
MIN_LANES = 4
IDEAL_SPEED = 65
MIN_SPACING_MILES = 50
CORRIDORS = {"I-70": "STL_KC"}
OTHER_CORRIDOR = "STL_CHI"
IMPORTANCE = {1.0: ("I-70", "I-55"), 0.7: ("I-64", "I-80")}
OTHER_IMPORTANCE = 0.5
VISIBILITY = [(60_000, 1.0), (40_000, 0.7)]
OTHER_VISIBILITY = 0.4
CATEGORY_WEIGHT = 0.25
WEIGHTS = {
    "demand_score": {"demand_pctile": 1.0},
    "feasibility_score": {"power_prox_pctile": 0.50, "low_interchange_pctile": 0.30},
    "safety_score": {"low_crash_pctile": 0.40, "low_weather_pctile": 0.35, "speed_compat_pctile": 0.25},
    "pilot_value_score": {"strategic_visibility": 0.40, "corridor_importance": 0.60},
}
PERCENTILES = [c for parts in WEIGHTS.values() for c in parts if c.endswith("_pctile")]

# Scores equal up to the order of summation must tie; the segment id then decides.
_SCORE_DIGITS = 9
# Distances equal up to the last bits must tie as well.
_DISTANCE_DIGITS = 3


@dataclass(frozen=True)
class SiteTables:
    """``road_segments``, ``power_infra``, ``interchanges`` and ``env_constraints`` have a ``geom`` column."""

    road_segments: DataFrame
    traffic_counts: DataFrame
    weather_risk: DataFrame
    incidents: DataFrame
    power_infra: DataFrame
    interchanges: DataFrame
    env_constraints: DataFrame


def criteria(intent: bool = False) -> list[Criterion]:
    """Percentiles of the six criteria.

    By default the last four rank larger values higher, as the analysis to be matched does. With
    ``intent`` they rank smaller values higher, as their names say.
    """
    return [
        Criterion("demand_pctile", "aadt_ev"),
        Criterion("power_prox_pctile", F.round("min_power_dist_m", _DISTANCE_DIGITS), descending=True),
        Criterion("low_interchange_pctile", "interchange_count", descending=intent),
        Criterion("low_crash_pctile", "crash_rate", descending=intent),
        Criterion("low_weather_pctile", "weather_risk_score", descending=intent),
        Criterion("speed_compat_pctile", F.abs(F.col("speed_limit") - IDEAL_SPEED), descending=intent),
    ]


def _lookup(column: Column, table: dict, default) -> Column:
    chain = F
    for value, members in table.items():
        chain = chain.when(column.isin(*members), F.lit(value))
    return chain.otherwise(F.lit(default))


def base(t: SiteTables) -> DataFrame:
    """Segments with traffic, weather and incident figures, and their corridor."""
    joined = (
        t.road_segments.join(t.traffic_counts, "segment_id")
        .join(t.weather_risk.withColumnRenamed("risk_score", "weather_risk_score"), "segment_id")
        .join(t.incidents, "segment_id")
    )
    corridor = _lookup(F.col("interstate"), {c: (i,) for i, c in CORRIDORS.items()}, OTHER_CORRIDOR)
    return joined.withColumn("corridor", corridor)


def _indexes(t: SiteTables, *names: str) -> list[spatial.ShapeIndex | None]:
    """Indexes of several tables, numbered together."""
    keys = {"interchanges": "interstate"}
    found = spatial.build_indexes({n: (getattr(t, n), "geom", keys.get(n)) for n in names})
    return [found[n] for n in names]


def _near_power(segments: DataFrame, power: spatial.ShapeIndex | None) -> DataFrame:
    return spatial.nearest_and_count(segments, power, "segment_id", "geom", POWER_RADIUS_M, "min_power_dist_m", "power_assets_30km")


def _near_interchanges(segments: DataFrame, interchanges: spatial.ShapeIndex | None) -> DataFrame:
    return spatial.count_within(segments, interchanges, "segment_id", "geom", INTERCHANGE_RADIUS_M, "interchange_count", key="interstate")


def excluded(t: SiteTables) -> DataFrame:
    """Segments that touch a protected area."""
    return spatial.intersecting(t.road_segments, *_indexes(t, "env_constraints"), "segment_id", "geom")


def power_proximity(t: SiteTables) -> DataFrame:
    """Per segment the distance to the nearest power asset and the number of assets in reach."""
    return _near_power(t.road_segments, *_indexes(t, "power_infra"))


def interchange_density(t: SiteTables) -> DataFrame:
    """Per segment the number of interchanges of its own interstate close by."""
    return _near_interchanges(t.road_segments, *_indexes(t, "interchanges"))


def eligible(t: SiteTables) -> DataFrame:
    """Segments wide enough and outside protected areas, with all their figures.

    Both conditions come first, so distances are worked out for eligible segments only.
    """
    areas, power, interchanges = _indexes(t, "env_constraints", "power_infra", "interchanges")
    wide = base(t).filter(F.col("lanes") >= MIN_LANES)
    outside = anti(wide, spatial.intersecting(wide, areas, "segment_id", "geom"), "segment_id")
    kept = materialise(outside, "eligible")
    return kept.join(_near_power(kept, power), "segment_id").join(_near_interchanges(kept, interchanges), "segment_id").drop("geom")


def scored(t: SiteTables, intent: bool = False) -> DataFrame:
    """Eligible segments with a percentile per criterion, importance and visibility."""
    ranked = percent_rank(materialise(eligible(t), "figures"), criteria(intent))
    visibility = F
    for limit, value in VISIBILITY:
        visibility = visibility.when(F.col("aadt_total") > limit, F.lit(value))
    return ranked.withColumns(
        {
            "corridor_importance": _lookup(F.col("interstate"), IMPORTANCE, OTHER_IMPORTANCE),
            "strategic_visibility": visibility.otherwise(F.lit(OTHER_VISIBILITY)),
        }
    )


def weighted(weights: dict[str, float]) -> Column:
    """Weighted sum of columns."""
    total = None
    for column, weight in weights.items():
        part = F.col(column) * F.lit(weight)
        total = part if total is None else total + part
    return total


def composite(df: DataFrame) -> DataFrame:
    scores = {name: weighted(parts) * F.lit(CATEGORY_WEIGHT) for name, parts in WEIGHTS.items()}
    with_parts = df.withColumns(scores)
    return with_parts.withColumn("composite_score", sum((F.col(n) for n in list(scores)[1:]), F.col(list(scores)[0])))


def corridor_rank(df: DataFrame) -> DataFrame:
    """Place of each segment in its corridor. There are only two corridors, so neither is one task."""
    best_first = [order(F.round("composite_score", _SCORE_DIGITS), "desc"), order("segment_id")]
    return row_number(df, ["corridor"], best_first, "corridor_rank")


def picks(ranked: DataFrame, spacing: float = MIN_SPACING_MILES) -> DataFrame:
    return spaced_second(ranked, "corridor", "corridor_rank", "interstate", "start_mile", spacing)


def report(chosen: DataFrame) -> DataFrame:
    rows = chosen.select(
        "segment_id",
        "interstate",
        "corridor",
        F.concat(F.col("start_mile").cast("string"), F.lit(" - "), F.col("end_mile").cast("string")).alias("mile_range"),
        *["lanes", "speed_limit", "aadt_total", "aadt_ev", "aadt_truck", "peak_factor", "weather_risk_score", "crash_rate", "incident_rate"],
        F.round(F.col("min_power_dist_m") / 1000, 1).alias("nearest_power_km"),
        F.col("power_assets_30km").alias("power_assets_within_30km"),
        F.col("interchange_count").alias("interchanges_nearby"),
        *[F.round(c, 4).alias(c) for c in (*WEIGHTS, "composite_score")],
        F.col("corridor_rank").alias("rank_in_corridor"),
    )
    return sort(rows, "corridor", "rank_in_corridor")


def site_selection(t: SiteTables, intent: bool = False) -> DataFrame:
    return report(picks(corridor_rank(composite(scored(t, intent)))))


def with_geometry(segments: DataFrame, power: DataFrame, interchanges: DataFrame, areas: DataFrame) -> dict[str, DataFrame]:
    """Geometry columns from plain coordinates: end points, points, and box sides."""
    ends = (("lon0", "lat0"), ("lon1", "lat1"))
    sides = ("min_lon", "min_lat", "max_lon", "max_lat")
    return {
        "road_segments": segments.withColumn("geom", G.line(*ends)).drop(*ends[0], *ends[1]),
        "power_infra": power.withColumn("geom", G.point("lon", "lat")).drop("lon", "lat"),
        "interchanges": interchanges.withColumn("geom", G.point("lon", "lat")).drop("lon", "lat"),
        "env_constraints": areas.withColumn("geom", G.box(*sides)).drop(*sides),
    }
