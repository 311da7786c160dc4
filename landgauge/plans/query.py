"""The zonal query: measures, grouping layers and filters, compiled to a plan.

The same query runs over a roll-up table (administrative areas, answered from
few rows) or over pixels clipped to areas; Catalyst does the rest.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from landgauge.functions import codes
from landgauge.functions.expressions import code_of, label, missing

OPS = {
    "=": lambda c, v: c == v, "!=": lambda c, v: c != v, "<": lambda c, v: c < v, ">": lambda c, v: c > v, "<=": lambda c, v: c <= v, ">=": lambda c, v: c >= v,
    "in": lambda c, v: c.isin(*v),
}


@dataclass(frozen=True)
class Layer:
    """A column of result tables, and how its pixel codes read."""

    name: str
    column: str
    labels: dict | None = None
    offset: int = 0
    boolean: bool = False

    def pixel_value(self, value):
        """A filter's value as the pixels have it."""
        if isinstance(value, (list, tuple)):
            return [self.pixel_value(v) for v in value]
        if self.labels is not None:
            return code_of(value, self.labels)
        if self.boolean:
            return int(value)
        return int(value) - self.offset if self.offset else value

    def read(self, code: Column) -> Column:
        """A pixel code as results have it."""
        if self.labels is not None:
            return label(code, self.labels)
        if self.boolean:
            return code.cast("boolean")
        return code + self.offset if self.offset else code


LAYERS = {
    x.name: x
    for x in (
        Layer("area", "area_ha"),
        Layer("loss_year", "tree_cover_loss_year", offset=codes.LOSS_YEAR_BASE),
        Layer("gain_period", "tree_cover_gain_period", codes.GAIN_PERIODS),
        Layer("canopy", "canopy_cover", codes.CANOPY_PERCENT),
        Layer("intact", "is_intact_forest", boolean=True),
        Layer("primary", "is_primary_forest", boolean=True),
        Layer("natural_forest", "natural_forests_class", codes.NATURAL_FORESTS),
        Layer("loss_driver", "tree_cover_loss_driver", codes.LOSS_DRIVERS),
        Layer("carbon", "carbon_emissions_MgCO2e"),
        Layer("fire_area", "tree_cover_loss_from_fires_area_ha"),
    )
}


@dataclass(frozen=True)
class Filter:
    layer: str
    op: str
    value: object

    def __post_init__(self):
        if self.op not in OPS:
            raise ValueError(f"unknown operator {self.op!r}")
        if (self.op == "in") != isinstance(self.value, (list, tuple)):
            raise ValueError("a list goes with 'in', and only with it")

    def _typed(self, value, kind: T.DataType):
        """Request values come as texts and 0/1; ANSI comparison wants the column's own type."""
        if isinstance(value, (list, tuple)):
            return [self._typed(v, kind) for v in value]
        if isinstance(kind, T.BooleanType):
            return bool(int(value))
        if isinstance(kind, T.IntegralType):
            return int(value)
        if isinstance(kind, T.FractionalType):
            return float(value)
        return str(value) if isinstance(kind, T.StringType) else value

    def on(self, df: DataFrame, pixels: bool = False) -> Column:
        layer = LAYERS[self.layer]
        value = layer.pixel_value(self.value) if pixels else self.value
        return OPS[self.op](F.col(layer.column), self._typed(value, df.schema[layer.column].dataType))

    def sql(self) -> str:
        quote = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) and not v.lstrip("-").isdigit() else str(v)
        value = "(" + ", ".join(map(quote, self.value)) + ")" if self.op == "in" else quote(self.value)
        return f"{LAYERS[self.layer].column} {self.op} {value}"


@dataclass(frozen=True)
class ZonalQuery:
    measures: tuple[str, ...]
    func: str = "sum"
    group_by: tuple[str, ...] = ()
    filters: tuple[Filter, ...] = field(default=())

    def __post_init__(self):
        if self.func not in ("sum", "count"):
            raise ValueError(f"unknown function {self.func!r}")
        for n in (*self.measures, *self.group_by):
            if n not in LAYERS:
                raise ValueError(f"unknown layer {n!r}")

    def over_table(self, table: DataFrame, aoi_ids: list[str] | None = None) -> DataFrame:
        """Over a roll-up table; filters and ids reach its scan."""
        for f in self.filters:
            table = table.where(f.on(table))
        if aoi_ids is not None:
            table = table.where(F.col("aoi_id").isin(*aoi_ids))
        return self._grouped(table, ["aoi_id", "aoi_type", *(LAYERS[g].column for g in self.group_by)])

    def over_pixels(self, pixels: DataFrame) -> DataFrame:
        """Over pixels that carry aoi_id and aoi_type; codes are filtered as such and read last."""
        for f in self.filters:
            pixels = pixels.where(f.on(pixels, pixels=True))
        columns = [LAYERS[g].column for g in self.group_by]
        for c in columns:
            pixels = pixels.where(F.col(c).isNotNull())
        out = self._grouped(pixels, ["aoi_id", "aoi_type", *columns])
        return out.withColumns({LAYERS[g].column: LAYERS[g].read(F.col(LAYERS[g].column)) for g in self.group_by})

    def _grouped(self, df: DataFrame, keys: list[str]) -> DataFrame:
        agg = F.sum if self.func == "sum" else F.count
        names = [LAYERS[m].column for m in self.measures]
        out = df.groupBy(*keys).agg(*(agg(missing(n) if isinstance(df.schema[n].dataType, T.FractionalType) else F.col(n)).alias(n) for n in names))
        return out.where(F.coalesce(*names).isNotNull()) if self.func == "sum" else out

    def sql(self, aoi_ids: list[str], table: str = "data_source") -> str:
        """The roll-up query as text, for engines that take SQL."""
        keys = ", ".join(["aoi_id", "aoi_type", *(LAYERS[g].column for g in self.group_by)])
        aggs = ", ".join(f"{self.func.upper()}({LAYERS[m].column}) AS {LAYERS[m].column}" for m in self.measures)
        ids = ", ".join("'" + i.replace("'", "''") + "'" for i in aoi_ids)
        where = " AND ".join([*(f.sql() for f in self.filters), f"aoi_id IN ({ids})"])
        return f"SELECT {keys}, {aggs} FROM {table} WHERE {where} GROUP BY {keys}"


def answer(query: ZonalQuery, aoi_type: str, aoi_ids: list[str], rollup: DataFrame | None, clipped) -> DataFrame:
    """From the roll-up where it can answer, else from pixels.

    ``clipped`` is called only then; it gives pixels with their areas.
    """
    wanted = {LAYERS[n].column for n in (*query.measures, *query.group_by, *(f.layer for f in query.filters))}
    if aoi_type == "admin" and rollup is not None and wanted <= set(rollup.columns):
        return query.over_table(rollup, aoi_ids)
    return query.over_pixels(clipped())
