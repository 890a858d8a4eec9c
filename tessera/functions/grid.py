"""Survey grid: coordinates to tile, survey unit and subcell, as one native expression."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """A grid of square survey units, grouped into tiles and split into subcells.

    The defaults are fixed values of the survey.
    """

    origin_x: float = 2180160.0001
    origin_y: float = 6660000.0
    unit: float = 32.81
    tile_columns: int = 21
    tile_rows: int = 18
    subcells: int = 10


def _steps(value: str, size: str) -> str:
    # Whole steps below a value. floor(value / size) is off by one on some cell edges, because
    # the quotient is rounded up to the next whole number; the remainder is exact.
    return f"CAST(round(({value} - pmod({value}, {size})) / {size}) AS BIGINT)"


def grid_sql(x: str, y: str, grid: Grid = Grid()) -> str:
    """SQL text of ``struct<tile, su, subcell>`` for two SQL expressions of type double."""
    unit = f"{grid.unit!r}D"
    sub = f"({unit} / {grid.subcells})"
    dx, dy = f"({x} - {grid.origin_x!r}D)", f"({y} - {grid.origin_y!r}D)"
    col, row = _steps(dx, unit), _steps(dy, unit)
    letters = ", ".join(
        f"char(ascii('A') + ({n} - pmod({n}, {size})) div {size})" for n, size in ((row, grid.tile_rows), (col, grid.tile_columns))
    )
    # Units count from the top left of the tile, subcells from the bottom left of the unit.
    su = f"({grid.tile_rows - 1} - pmod({row}, {grid.tile_rows})) * {grid.tile_columns} + pmod({col}, {grid.tile_columns}) + 1"
    sub_col = _steps(f"({dx} - {col} * {unit})", sub)
    sub_row = _steps(f"({dy} - {row} * {unit})", sub)
    return (
        f"named_struct('tile', concat({letters}), 'su', CAST({su} AS INT), "
        f"'subcell', CAST({sub_row} * {grid.subcells} + {sub_col} + 1 AS INT))"
    )


def grid_assign(x: str, y: str, grid: Grid = Grid()) -> Column:
    """``struct<tile:string, su:int, subcell:int>`` of the coordinates in columns ``x`` and ``y``."""
    return F.expr(grid_sql(f"CAST({x} AS DOUBLE)", f"CAST({y} AS DOUBLE)", grid))


def register_grid_function(spark: SparkSession, name: str = "convert_xy", grid: Grid = Grid()) -> str:
    """The same expression as a temporary SQL function of two coordinates."""
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(x DOUBLE, y DOUBLE) "
        f"RETURNS STRUCT<tile: STRING, su: INT, subcell: INT> RETURN {grid_sql('x', 'y', grid)}"
    )
    return name
