"""Pixels within areas: window, polygon clip and tile pruning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgauge.functions import geo
from landgauge.operators.align import Grid

EDGE = T.ArrayType(T.StructType([T.StructField(n, T.DoubleType(), False) for n in ("x1", "y1", "x2", "y2")]))
AREA = T.StructType([T.StructField("aoi_id", T.StringType()), T.StructField("aoi_type", T.StringType()), *(T.StructField(n, T.DoubleType()) for n in ("min_x", "min_y", "max_x", "max_y")), T.StructField("edges", EDGE)])


class AreaTooSmall(ValueError):
    """An area covers no pixel centre although it lies within the data."""


def areas(spark: SparkSession, geometries: dict[str, dict], aoi_type: str = "feature_collection") -> DataFrame:
    """One row for each area of a request (at most some dozens): box and edges."""
    return spark.createDataFrame([(i, aoi_type, *geo.bounds(g), geo.edges(g)) for i, g in geometries.items()], AREA)


def window(pixels: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Pixels whose centres lie in a closed box; reaches the scan as min/max pruning."""
    a, b, c, d = box
    return pixels.where(F.col("x").between(a, c) & F.col("y").between(b, d))


def with_tile(pixels: DataFrame, size: float) -> DataFrame:
    return pixels.withColumns({"tile_x": F.floor(F.col("x") / size), "tile_y": F.floor(F.col("y") / size)})


def _tiles(area: DataFrame, size: float) -> DataFrame:
    """A row for each tile that an area's box touches, with the edges that rays from its row can meet.

    Edges are cut to rows of tiles first and to what is not left of the tile
    then, so that a long border is not copied whole to each of its tiles.
    """
    along = lambda low, high: F.explode(F.sequence(F.floor(F.col(low) / size), F.floor(F.col(high) / size)))
    top, bottom = (F.col("tile_y") + 1) * size, F.col("tile_y") * size
    in_row = F.filter("edges", lambda e: (F.greatest(e["y1"], e["y2"]) >= bottom) & (F.least(e["y1"], e["y2"]) <= top))
    rows = area.withColumn("tile_y", along("min_y", "max_y")).withColumn("edges", in_row)
    return rows.withColumn("tile_x", along("min_x", "max_x")).withColumn("edges", F.filter("edges", lambda e: F.greatest(e["x1"], e["x2"]) >= F.col("tile_x") * size))


def _crosses(size: float) -> Column:
    """Whether an edge touches a tile: their boxes overlap, and the tile's corners are not all on one side of the edge."""
    x, y = F.col("tile_x") * size, F.col("tile_y") * size
    corners = [(x + i * size, y + j * size) for i in (0, 1) for j in (0, 1)]

    def touches(e: Column) -> Column:
        side = [(e["x2"] - e["x1"]) * (cy - e["y1"]) - (e["y2"] - e["y1"]) * (cx - e["x1"]) for cx, cy in corners]
        boxes = (F.greatest(e["x1"], e["x2"]) >= x) & (F.least(e["x1"], e["x2"]) <= x + size) & (F.greatest(e["y1"], e["y2"]) >= y) & (F.least(e["y1"], e["y2"]) <= y + size)
        return boxes & (F.least(*side) <= 0) & (F.greatest(*side) >= 0)

    return F.exists("edges", touches)


def classify_tiles(area: DataFrame, size: float) -> DataFrame:
    """Tiles by area: ``whole`` if no edge comes near; tiles outside are gone.

    A tile that no edge touches lies wholly inside or outside, so its centre
    decides; only the others need a test for each pixel, and they alone carry
    edges.
    """
    t = _tiles(area, size).withColumn("whole", ~_crosses(size))
    centre = geo.inside((F.col("tile_x") + 0.5) * size, (F.col("tile_y") + 0.5) * size, F.col("edges"))
    t = t.where(~F.col("whole") | centre)
    return t.select("aoi_id", "aoi_type", "tile_x", "tile_y", "whole", F.when(~F.col("whole"), F.col("edges")).alias("edges"))


def clip(pixels: DataFrame, area: DataFrame, size: float = 1.0) -> DataFrame:
    """Pixels with the areas whose polygons hold their centres.

    A hash join on tiles, never a nested loop; ``pixels`` may carry tile_x and
    tile_y already, as a table stored by tile does.
    """
    p = pixels if "tile_x" in pixels.columns else with_tile(pixels, size)
    tiles = classify_tiles(area, size)
    out = p.join(tiles, ["tile_x", "tile_y"])
    return out.where(F.col("whole") | geo.inside(F.col("x"), F.col("y"), F.col("edges"))).drop("tile_x", "tile_y", "whole", "edges")


def too_small(geometries: dict[str, dict], grid: Grid, extent: tuple[float, float, float, float]) -> list[str]:
    """Ids of areas that lie within the data but hold no pixel centre.

    ``extent`` is the box of the data, from the grid's metadata: nothing is
    scanned.  An area off the data is not too small: its result is empty.
    """
    half = grid.resolution / 2
    found = []
    for i, g in sorted(geometries.items()):
        a, b, c, d = geo.bounds(g)
        near = c >= extent[0] - half and a <= extent[2] + half and d >= extent[1] - half and b <= extent[3] + half
        if near and not geo.holds_centre(g, grid.x0, grid.y0, grid.resolution):
            found.append(i)
    return found


def require_pixels(geometries: dict[str, dict], grid: Grid, extent: tuple[float, float, float, float]) -> None:
    """Raise :class:`AreaTooSmall` if any area of the request is."""
    if found := too_small(geometries, grid, extent):
        raise AreaTooSmall(f"no pixel centre in {', '.join(found)}")


def of_features(pixels: DataFrame, features: dict, grid: Grid, extent: tuple[float, float, float, float], size: float, aoi_type: str = "feature_collection") -> DataFrame:
    """Pixels within the features of a collection, with aoi_id and aoi_type.

    Ids go with their own geometries, in whatever order they come.  The box
    of all features is filtered first, which reaches the scan.
    """
    shapes = {str(f["id"] if f.get("id") is not None else f["properties"]["id"]): f["geometry"] for f in features["features"]}
    require_pixels(shapes, grid, extent)
    boxes = [geo.bounds(g) for g in shapes.values()]
    near = window(pixels, (min(b[0] for b in boxes), min(b[1] for b in boxes), max(b[2] for b in boxes), max(b[3] for b in boxes)))
    return clip(near, areas(pixels.sparkSession, shapes, aoi_type), size)
