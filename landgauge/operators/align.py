"""Alignment of layers on one grid, and change of resolution.

Layers are tables (x, y, value...).  Grids agree but for float jitter, so
coordinates are snapped to integer cells once, and alignment is a left equi
join on cells; layers written bucketed by cell join without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Grid:
    """Centres at x0 + column * resolution and y0 - row * resolution."""

    x0: float
    y0: float
    resolution: float
    tolerance: float = 1e-5

    def cell(self, x: Column, y: Column) -> tuple[Column, Column]:
        """Row and column; null where a point is further from a centre than the tolerance."""
        c, r = F.round((x - self.x0) / self.resolution), F.round((F.lit(self.y0) - y) / self.resolution)
        near = (F.abs(x - (c * self.resolution + self.x0)) <= self.tolerance) & (F.abs(y - (F.lit(self.y0) - r * self.resolution)) <= self.tolerance)
        return F.when(near, r.cast("int")), F.when(near, c.cast("int"))


def snap(layer: DataFrame, grid: Grid, x: str = "x", y: str = "y") -> DataFrame:
    """``layer`` with ``row`` and ``col`` in place of x and y; points off the grid go."""
    r, c = grid.cell(F.col(x), F.col(y))
    return layer.withColumns({"row": r, "col": c}).where("row IS NOT NULL AND col IS NOT NULL").drop(x, y)


def overwrite(layer: DataFrame, own: Grid, shape: tuple[int, int], x: str = "x", y: str = "y") -> DataFrame:
    """``layer`` by position: its n-th row and column are those of the reference grid, whatever its coordinates say.

    ``own`` is the layer's own grid; what lies beyond ``shape`` (rows,
    columns) of the reference goes.
    """
    placed = snap(layer, Grid(own.x0, own.y0, own.resolution, own.resolution / 2), x, y)
    return placed.where(F.col("row").between(0, shape[0] - 1) & F.col("col").between(0, shape[1] - 1))


def align(base: DataFrame, layers: dict[str, DataFrame], fill: dict[str, float] | None = None, on: tuple = ("row", "col")) -> DataFrame:
    """``base`` with one column for each layer's ``value``, null where it has none.

    Layers named in ``fill`` get that value instead, as those of sparse
    extent need: a null class drops the pixel from groups.  A layer with more
    rows for a cell (years) multiplies the cell's rows, as a year dimension
    does.
    """
    out = base
    for name, layer in layers.items():
        out = out.join(layer.withColumnRenamed("value", name), list(on), "left")
    return out.fillna(fill) if fill else out


def exact(left: DataFrame, right: DataFrame, on: tuple = ("row", "col")) -> DataFrame:
    """A left join for grids known to be identical."""
    return left.join(right, list(on), "left")


def over_years(pixels: DataFrame, years: DataFrame, on: tuple = ("row", "col")) -> DataFrame:
    """A year-less layer next to each year of one that has years."""
    return years.join(pixels, list(on), "inner")


def parent_cell(row: Column | str, col: Column | str, ratio: int) -> tuple[Column, Column]:
    """Cell of a grid ``ratio`` times as coarse that a cell's centre lies in."""
    r, c = (F.col(v) if isinstance(v, str) else v for v in (row, col))
    return F.floor(r / ratio).cast("int"), F.floor(c / ratio).cast("int")


def resample(fine: DataFrame, coarse: DataFrame, ratio: int, value: str = "value", how: str = "left") -> DataFrame:
    """``fine`` with the rate of the coarse cell around each cell.

    An equi join by integer division.  The coarse grid has ``ratio`` squared
    times fewer rows, but grows with the extent; whether it is broadcast is
    left to its measured size.
    """
    r, c = parent_cell("row", "col", ratio)
    parents = coarse.select(F.col("row").alias("__r"), F.col("col").alias("__c"), value)
    return fine.withColumns({"__r": r, "__c": c}).join(parents, ["__r", "__c"], how).drop("__r", "__c")


def downscale(fine: DataFrame, coarse: DataFrame, ratio: int, value: str = "value", how: str = "left") -> DataFrame:
    """Like :func:`resample`, for totals: each child gets an equal part, so the mass is kept."""
    return resample(fine, coarse.withColumn(value, F.col(value) / (ratio * ratio)), ratio, value, how)
