"""Survey readings on a grid: averages, status, neighbours, ranks, stability, findings."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from string import Formatter

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.grid import Grid, grid_assign
from tessera.functions.scalar import classify, order_map
from tessera.operators.ranking import rank_in, top_per_group
from tessera.operators.relational import order, sort

# Fixed values of the survey: limits of the status, in pCi/g, and of a low stability score.
STATUS_LIMITS = [(5.0, "OK"), (7.4, "Warning")]
WORST_STATUS = "Alarm"
LOW_STABILITY = 0.15
TOP_FINDINGS = 10
CATEGORIES = {"Top Alarm Subcell": 1, "Warning / At-Risk Tile": 2, "Low Stability - Needs Re-Survey": 3}
# Fixed text of the request for a recommendation.
PROMPT = (
    "AS an environmental remediation specialist. Given this Ra-226 finding: Category: {finding_category}, "
    "Tile: {tile}, SU: {su}, Subcell: {subcell}, Subcell Avg: {subcell_avg} pCi/g ({subcell_status}), "
    "SU Avg: {su_avg} pCi/g ({su_status}), Tile Avg: {tile_avg} pCi/g ({tile_status}), "
    "Stability Score: {stability_score}, Num Readings: {num_readings}. "
    "Thresholds: OK < 5, Warning 5-7.4, Alarm >= 7.4 pCi/g. "
    "In 1-2 sentences, recommend a specific remediation action for this location."
)

_CELL = ["tile", "su", "subcell"]
# Two averages of the same readings may differ in the last bits; ranks must not.
_RANK_DIGITS = 9


def status(average: Column) -> Column:
    return classify(average, STATUS_LIMITS, WORST_STATUS)


def assign(scan: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Readings with the grid labels of their coordinates."""
    return scan.withColumn("coordinates", grid_assign("easting", "northing", grid)).select(
        "*", "coordinates.tile", "coordinates.su", "coordinates.subcell"
    ).drop("coordinates")


def _subcells(scan: DataFrame, grid: Grid) -> DataFrame:
    return assign(scan, grid).groupBy(*_CELL).agg(F.avg("reading").alias("avg_reading"))


def _stability(spread: Column) -> Column:
    return F.round(1.0 / (1.0 + F.coalesce(spread, F.lit(0.0))), 4)


def subcell_averages(scan: DataFrame, grid: Grid = Grid(), ordered: bool = True) -> DataFrame:
    cells = _subcells(scan, grid)
    return sort(cells, *_CELL) if ordered else cells


def tile_status_rollup(scan: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Subcells of each status, mean and maximum of the subcell averages per tile; most alarms first."""
    classified = _subcells(scan, grid).withColumn("status", status(F.col("avg_reading")))
    counts = [F.count_if(F.col("status") == s).alias(f"{s.lower()}_count") for s in ("OK", "Warning", "Alarm")]
    rollup = classified.groupBy("tile").agg(
        *counts,
        F.round(F.avg("avg_reading"), 4).alias("tile_avg_reading"),
        F.round(F.max("avg_reading"), 4).alias("tile_max_reading"),
        F.count("*").alias("total_subcells"),
    )
    return sort(rollup, ("alarm_count", "desc"), ("warning_count", "desc"), "tile")


def neighbor_pairs(tiles: DataFrame, row: str, column: str) -> DataFrame:
    """Pairs of rows one step apart in either direction or both, each pair in both directions.

    Every row looks up its eight surrounding places, so this is an equi-join. The partner's columns
    get the prefix ``n_``.
    """
    steps = [(r, c) for r in (-1, 0, 1) for c in (-1, 0, 1) if (r, c) != (0, 0)]
    offsets = F.array(*[F.struct(F.lit(r).alias("r"), F.lit(c).alias("c")) for r, c in steps])
    looking = tiles.withColumn("__o", F.explode(offsets)).withColumns(
        {"__row": F.col(row) + F.col("__o.r"), "__col": F.col(column) + F.col("__o.c")}
    )
    partners = tiles.select(*[F.col(c).alias(f"n_{c}") for c in tiles.columns])
    on = (F.col("__row") == F.col(f"n_{row}")) & (F.col("__col") == F.col(f"n_{column}"))
    return looking.join(partners, on).drop("__o", "__row", "__col")


def neighbor_change(scan: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Difference of the reading averages of neighbouring tiles, largest first."""
    tiles = assign(scan, grid).groupBy("tile").agg(F.avg("reading").alias("tile_avg")).withColumns(
        {"row": F.ascii(F.substring("tile", 1, 1)), "col": F.ascii(F.substring("tile", 2, 1))}
    )
    pairs = neighbor_pairs(tiles, "row", "col").select(
        "tile",
        F.round("tile_avg", 2).alias("tile_avg"),
        F.col("n_tile").alias("neighbor_tile"),
        F.round("n_tile_avg", 2).alias("neighbor_avg"),
        F.round(F.abs(F.col("tile_avg") - F.col("n_tile_avg")), 2).alias("tile_change"),
    )
    return sort(pairs, ("tile_change", "desc"), "tile", "neighbor_tile")


def _layers(subcells: DataFrame) -> DataFrame:
    """Averages of the subcell averages per survey unit and per tile. A window partition is bounded
    by the grid: the subcells of one unit, or of one tile."""
    return subcells.withColumns(
        {
            "su_avg": F.avg("avg_reading").over(Window.partitionBy("tile", "su")),
            "tile_avg": F.avg("avg_reading").over(Window.partitionBy("tile")),
        }
    )


def rank_within_region(scan: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Rank of each subcell in its survey unit, and of its unit in the tile (by subcell rows, so the
    second one skips as many places as a unit has subcells)."""
    layered = _subcells(scan, grid).withColumn("su_avg", F.avg("avg_reading").over(Window.partitionBy("tile", "su")))
    ranked = rank_in(layered, ["tile", "su"], [order(F.round("avg_reading", _RANK_DIGITS), "desc")], "subcell_rank_in_su")
    ranked = rank_in(ranked, ["tile"], [order(F.round("su_avg", _RANK_DIGITS), "desc")], "su_rank_in_tile")
    result = ranked.select(
        *_CELL, F.round("avg_reading", 2).alias("subcell_avg"), "subcell_rank_in_su", F.round("su_avg", 2).alias("su_avg"), "su_rank_in_tile"
    )
    return sort(result, "tile", "su", "subcell_rank_in_su", "subcell")


def stability_scores(scan: DataFrame, grid: Grid = Grid()) -> DataFrame:
    """Spread of the readings of each subcell as a score between 0 and 1, least stable first."""
    spread = F.stddev("reading")
    scores = assign(scan, grid).groupBy(*_CELL).agg(
        F.count("reading").alias("num_readings"),
        F.round(F.avg("reading"), 2).alias("subcell_avg"),
        F.round(spread, 4).alias("stddev_reading"),
        _stability(spread).alias("stability_score"),
    )
    return sort(scores, "stability_score", *_CELL)


def findings(scan: DataFrame, grid: Grid = Grid(), k: int = TOP_FINDINGS) -> DataFrame:
    """The worst alarms, the worst warnings or units at risk, and the least stable subcells."""
    subcells = assign(scan, grid).groupBy(*_CELL).agg(
        F.avg("reading").alias("avg_reading"), F.stddev("reading").alias("spread"), F.count("reading").alias("num_readings")
    )
    combined = _layers(subcells).select(
        *_CELL,
        F.round("avg_reading", 2).alias("subcell_avg"),
        status(F.col("avg_reading")).alias("subcell_status"),
        F.round("su_avg", 2).alias("su_avg"),
        status(F.col("su_avg")).alias("su_status"),
        F.round("tile_avg", 2).alias("tile_avg"),
        status(F.col("tile_avg")).alias("tile_status"),
        _stability(F.col("spread")).alias("stability_score"),
        "num_readings",
    )
    alarm, at_risk, unstable = CATEGORIES
    own, tile = F.col("subcell_status"), F.col("tile_status")
    groups = F.array_compact(
        F.array(
            F.when(own == "Alarm", alarm),
            F.when((own == "Warning") | ((own == "OK") & tile.isin("Alarm", "Warning")), at_risk),
            F.when(F.col("stability_score") < LOW_STABILITY, unstable),
        )
    )
    # A subcell may belong to several groups. One pass tags them all; the top rows per group are cut
    # down in every task before the shuffle.
    tagged = combined.withColumn("finding_category", F.explode(groups))
    urgency = F.when(F.col("finding_category") == unstable, F.col("stability_score")).otherwise(-F.col("subcell_avg"))
    top = top_per_group(tagged, ["finding_category"], [order(urgency), *[order(c) for c in _CELL]], k)
    report = top.select("finding_category", *combined.columns)
    return sort(report, order_map(F.col("finding_category"), CATEGORIES), ("subcell_avg", "desc"), *_CELL)


def finding_prompt() -> Column:
    """Text that asks for a remediation of one finding; NULL if any part of it is."""
    pieces = []
    for text, field, _, _ in Formatter().parse(PROMPT):
        pieces.append(F.lit(text))
        if field:
            pieces.append(F.col(field).cast("string"))
    return F.concat(*pieces)


def rule_recommendation(batch: pd.DataFrame) -> pd.Series:
    """Recommendation by rule, for use without a text service."""
    text = {
        "Alarm": "Excavate and dispose of the material, then survey again.",
        "Warning": "Survey again and plan a local removal.",
        "OK": "Keep monitoring; no removal is needed.",
    }
    return batch["subcell_status"].map(text)


def recommend(df: DataFrame, answer: Callable[[pd.DataFrame], pd.Series] = rule_recommendation, out: str = "recommendation") -> DataFrame:
    """Adds the answers of a batch function, called once per Arrow batch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(**{out: answer(batch)})

    return df.mapInPandas(run, df.withColumn(out, F.lit("")).schema)
