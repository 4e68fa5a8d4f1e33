"""Raster geometry as column arithmetic."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from freshet.schemas import Grid

# Kilometres per degree, and the rounded degree factor the rainfall product is defined with.
KM_PER_DEGREE = 111.111
RAIN_DEG2RAD = 0.01745


def center_x(col: Column, grid: Grid) -> Column:
    return F.lit(grid.x0) + (col + F.lit(0.5)) * F.lit(grid.px)


def center_y(row: Column, grid: Grid) -> Column:
    return F.lit(grid.y0) - (row + F.lit(0.5)) * F.lit(grid.py)


def pixel_center(row: Column, col: Column, grid: Grid) -> tuple[Column, Column]:
    """(lon, lat) of a cell's centre."""
    return center_x(col, grid), center_y(row, grid)


def pixel_area(lat: Column, grid: Grid, deg2rad: float = math.pi / 180.0) -> Column:
    """Square kilometres of a cell at this latitude."""
    return F.lit(KM_PER_DEGREE * KM_PER_DEGREE) * F.cos(lat * F.lit(deg2rad)) * F.lit(grid.px) * F.lit(grid.py)


def cell_of(lon: Column, lat: Column, grid: Grid) -> tuple[Column, Column]:
    """(row, col) of the cell that holds a point."""
    row = F.floor((F.lit(grid.y0) - lat) / F.lit(grid.py)).cast("int")
    col = F.floor((lon - F.lit(grid.x0)) / F.lit(grid.px)).cast("int")
    return row, col
