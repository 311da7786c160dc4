"""Batch plans: from aligned pixels to the tables that products are answered from.

``pixels`` has one row a pixel (and year, where a layer has years) with the
admin codes ``country``, ``region``, ``subregion`` (0: no such unit) and the
layers as codes.  ``iso`` is the country dimension (code, alpha3).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landgauge.functions import codes
from landgauge.functions.expressions import absolute, canopy_percent, confidence_code, day_code, epoch_date, flag, label, masked, missing, natural_flag, natural_forest_code, vegetation_code, without_suffix
from landgauge.operators.align import downscale, resample
from landgauge.operators.reshape import melt_years, pivot_dense
from landgauge.operators.rollup import ADMIN, admin_rollup, with_country, zonal
from landgauge.operators.thresholds import accumulate, loss_table, unaccumulate


def decode_alerts(raw: DataFrame, encoded: str = "date_conf") -> DataFrame:
    """Encoded alerts to ``alert_day`` and ``confidence``."""
    return raw.withColumns({"alert_day": day_code(encoded), "confidence": confidence_code(encoded)}).drop(encoded)


_CARBON = "carbon_emissions_MgCO2e"
LOSS_CONTEXT = ["tree_cover_loss_year", "canopy_cover", "is_intact_forest", "tree_cover_loss_driver", "is_primary_forest", "natural_forests_class"]


def loss(pixels: DataFrame, iso: DataFrame, years: range = range(1, 31)) -> DataFrame:
    """Tree cover loss by year, canopy and forest classes, rolled up.

    Layers: loss, canopy, intact, driver, primary, natural_lands, mangrove,
    gain; measures: area_ha, carbon, fire (nonzero where fire took the loss).
    """
    p = pixels.select(
        *ADMIN,
        F.col("loss").alias("tree_cover_loss_year"), "canopy", "intact", "driver", "primary", natural_forest_code("natural_lands").alias("natural"), flag(F.col("mangrove") > 0).alias("mangrove_stock_2000"),
        flag(F.col("gain") > 0).alias("tree_cover_gain_from_height"), "area_ha", "carbon", masked("area_ha", F.col("fire") > 0).alias("fire_area"),
    )
    keys = ["tree_cover_loss_year", "canopy", "intact", "driver", "primary", "natural", "mangrove_stock_2000", "tree_cover_gain_from_height", *ADMIN]
    p = p.fillna(0, subset=["intact", "driver", "primary"])
    p = zonal(p, keys, {"area_ha": "area_ha", _CARBON: "carbon", "tree_cover_loss_from_fires_area_ha": "fire_area"}, expected={"tree_cover_loss_year": list(years)})
    p = p.fillna(0.0, subset=["area_ha", _CARBON, "tree_cover_loss_from_fires_area_ha"])
    p = with_country(p, iso).select(
        *ADMIN, (F.col("tree_cover_loss_year") + codes.LOSS_YEAR_BASE).alias("tree_cover_loss_year"), canopy_percent("canopy").alias("canopy_cover"),
        F.col("intact").cast("boolean").alias("is_intact_forest"), label("driver", codes.LOSS_DRIVERS_STORED).alias("tree_cover_loss_driver"), F.col("primary").cast("boolean").alias("is_primary_forest"),
        label("natural", codes.NATURAL_FORESTS_STORED).alias("natural_forests_class"), "mangrove_stock_2000", "tree_cover_gain_from_height", "area_ha", _CARBON, "tree_cover_loss_from_fires_area_ha",
    )
    areas = ["area_ha", "tree_cover_loss_from_fires_area_ha"]
    table = loss_table(p, LOSS_CONTEXT, list(ADMIN), _CARBON, areas)
    rolled = admin_rollup(table, LOSS_CONTEXT, ["area_ha", _CARBON, "tree_cover_loss_from_fires_area_ha"])
    return unaccumulate(rolled, ["aoi_id", "aoi_type", *(c for c in LOSS_CONTEXT if c != "canopy_cover")], _CARBON)


_FLUX = ("carbon_net_flux", "carbon_gross_removals", "carbon_gross_emissions")


def carbon_flux(pixels: DataFrame, iso: DataFrame) -> DataFrame:
    """Three fluxes at each canopy threshold, rolled up.  Layers: canopy, mangrove, gain."""
    p = pixels.withColumns({"canopy_cover": canopy_percent(F.coalesce("canopy", F.lit(0))), "mangrove_stock_2000": flag(F.col("mangrove") > 0), "tree_cover_gain_from_height": flag(F.col("gain") > 0)} | {m: missing(m) for m in _FLUX})
    out = accumulate(with_country(p, iso), list(ADMIN), list(_FLUX)).withColumnRenamed("canopy_cover", "tree_cover_density")
    out = admin_rollup(out, ["tree_cover_density"], list(_FLUX))
    return out.withColumnsRenamed({m: f"{m}_Mg_CO2e" for m in _FLUX})


def disturbance(pixels: DataFrame, iso: DataFrame, kind: str | None = None, first_day: int = 731, last_day: int = 3287) -> DataFrame:
    """Alert areas by admin unit, day and confidence, and one class if asked.

    Layers: alert_day, confidence and, by ``kind``, driver, grasslands (of
    2022), land_cover (of 2024) or natural_lands.  Confidence other than low
    and high is left out.
    """
    name = {"driver": "driver", "grasslands": "grasslands", "land_cover": "land_cover", "natural_lands": "natural_land_class", None: None}[kind]
    text = {
        "driver": lambda c: label(c, codes.DISTURBANCE_DRIVERS), "land_cover": lambda c: label(c, codes.LAND_COVER), "natural_lands": lambda c: label(c, codes.NATURAL_LANDS, default="Unclassified"),
        "grasslands": lambda c: F.when(c == codes.NATURAL_GRASSLAND, "grasslands").otherwise("non-grasslands"),
    }
    p = pixels.where(F.col("alert_day").between(first_day, last_day))
    if kind:
        p = p.where(F.col(kind).isNotNull()).withColumn(name, text[kind](F.col(kind))).where(F.col(name).isNotNull())
    keys = [*ADMIN, *([name] if name else []), "alert_day", "confidence"]
    out = with_country(zonal(p, keys, {"area_ha": "area_ha"}, expected={"confidence": list(codes.CONFIDENCE_DISTURBANCE)}), iso)
    return out.select(*keys[:-2], epoch_date("alert_day").alias("dist_alert_date"), label("confidence", codes.CONFIDENCE_DISTURBANCE, strict=True).alias("dist_alert_confidence"), F.col("area_ha").cast("float").alias("area_ha"))


def integrated(pixels: DataFrame, iso: DataFrame, first_day: int = 2923) -> DataFrame:
    """Integrated alert areas, rolled up.  Layers: alert_day, confidence; area_m2."""
    p = pixels.where(F.col("alert_day") >= first_day)
    out = zonal(p, [*ADMIN, "alert_day", "confidence"], {"area_ha": F.col("area_m2").cast("double") / 10_000}, expected={"confidence": list(codes.CONFIDENCE)})
    out = with_country(out, iso).withColumns({"alert_date": epoch_date("alert_day", codes.INTEGRATED_EPOCH), "alert_confidence": label("confidence", codes.CONFIDENCE, strict=True)})
    return admin_rollup(out, ["alert_date", "alert_confidence"], ["area_ha"])


def grasslands(pixels: DataFrame, iso: DataFrame) -> DataFrame:
    """Natural grassland by admin unit and year.  Layers: grasslands, year."""
    p = pixels.where(F.col("grasslands") == codes.NATURAL_GRASSLAND)
    return with_country(zonal(p, [*ADMIN, "year"], {"area_ha": "area_ha"}), iso)


def natural_lands(pixels: DataFrame, iso: DataFrame) -> DataFrame:
    """Area by admin unit and natural-lands class, with the natural flag."""
    out = with_country(zonal(pixels, [*ADMIN, "natural_lands"], {"area_ha": "area_ha"}), iso)
    return out.select(*ADMIN, natural_flag("natural_lands").alias("natural_flag"), label("natural_lands", codes.NATURAL_LANDS, default="unclassified").alias("natural_lands_class"), "area_ha")


INVENTORY = ["gross_emissions_MgCO2e", "gross_removals_MgCO2", "net_flux_MgCO2e"]


def vegetation(pixels: DataFrame, iso: DataFrame, measures: list[str] = INVENTORY) -> DataFrame:
    """Vegetation fluxes by land-state class and year, rolled up, dense.

    Measures are rates by hectare; layers: land_state, year.
    """
    amounts = {m: absolute(m, "area_ha") for m in measures} | {"area_ha": F.coalesce(missing("area_ha"), F.lit(0.0))}
    p = pixels.withColumn("class", vegetation_code("land_state")).where(F.col("class") != 0)
    out = with_country(zonal(p, [*ADMIN, "class", "year"], amounts), iso)
    out = out.withColumn("land_state_class", label("class", codes.VEGETATION, strict=True))
    return admin_rollup(out, ["land_state_class", "year"], [*measures, "area_ha"]).fillna(0.0)


def agriculture(pixels: DataFrame, iso: DataFrame, categories: tuple = ("cropland", "livestock"), measure: str = "gross_emissions_MgCO2e") -> DataFrame:
    """Emissions of each category (a column of absolute amounts), rolled up."""
    long = pixels.select(*ADMIN, F.explode(F.array(*(F.struct(F.lit(c).alias("category"), missing(c).alias(measure)) for c in categories))).alias("e")).select(*ADMIN, "e.*")
    return admin_rollup(with_country(zonal(long, [*ADMIN, "category"], {measure: measure}), iso), ["category"], [measure]).fillna(0.0)


def mineral_soil(pixels: DataFrame, iso: DataFrame, measures: list[str] = INVENTORY) -> DataFrame:
    amounts = {m: absolute(m, "area_ha") for m in measures} | {"area_ha": F.coalesce(missing("area_ha"), F.lit(0.0))}
    return admin_rollup(with_country(zonal(pixels, list(ADMIN), amounts), iso), [], [*measures, "area_ha"]).fillna(0.0)


def organic_soil(pixels: DataFrame, iso: DataFrame, measure: str = "gross_emissions_MgCO2e") -> DataFrame:
    """Burned and drained emissions by block of years; area where soil is organic."""
    rate = F.coalesce(missing("burned"), F.lit(0.0)) + F.coalesce(missing("drained"), F.lit(0.0))
    amounts = {measure: absolute(rate, "area_ha"), "area_ha": absolute("organic", "area_ha")}
    return admin_rollup(with_country(zonal(pixels, [*ADMIN, "interval_end_year"], amounts), iso), ["interval_end_year"], [measure, "area_ha"]).fillna(0.0)


def land_cover_change(pixels: DataFrame, iso: DataFrame) -> DataFrame:
    keys = ["land_cover_class_start", "land_cover_class_end"]
    p = pixels.withColumnsRenamed({"land_cover_start": keys[0], "land_cover_end": keys[1]})
    out = with_country(zonal(p, [*ADMIN, *keys], {"area_ha": "area_ha"}, expected={k: list(codes.LAND_COVER) for k in keys}), iso)
    return admin_rollup(out.withColumns({k: label(k, codes.LAND_COVER) for k in keys}), keys, ["area_ha"])


def land_cover_composition(pixels: DataFrame, iso: DataFrame) -> DataFrame:
    out = with_country(zonal(pixels, [*ADMIN, "land_cover_end"], {"area_ha": "area_ha"}, expected={"land_cover_end": list(codes.LAND_COVER)}), iso)
    return admin_rollup(out.withColumn("land_cover_class", label("land_cover_end", codes.LAND_COVER)), ["land_cover_class"], ["area_ha"])


def emission_factors(wide: DataFrame, crops: DataFrame | None = None) -> DataFrame:
    """Wide yearly columns of all gases and levels (already one table) to rows a year.

    Keys: gid, crop, gas_type.  ``crops`` maps a source code (crop) to its
    name (crop_type); crops it lacks go.
    """
    out = melt_years(wide, ["gid", "crop", "gas_type"]).withColumns({"aoi_id": without_suffix("gid"), "aoi_type": F.lit("admin")})
    out = out.where(F.col("aoi_id").isNotNull() & (F.col("aoi_id") != "nan")).drop("gid")
    return out.join(crops, "crop").drop("crop") if crops is not None else out.withColumnRenamed("crop", "crop_type")


def normalised(old: DataFrame, renames: dict[str, str], measure: str = "area_ha", divisor: float = 1.0, aoi_type: str | None = None) -> DataFrame:
    """A table of an older layout: new names, other unit, an area type."""
    name = renames.get(measure, measure)
    out = old.withColumnsRenamed(renames).withColumn(name, F.col(name) / divisor)
    return out.withColumn("aoi_type", F.lit(aoi_type)) if aoi_type else out


def pixel_counts(pixels: DataFrame, iso: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Counts of non-missing pixels by admin unit and keys."""
    return with_country(zonal(pixels, [*ADMIN, *keys], {"count": value}, "count"), iso)


def gridded_emissions(fine: DataFrame, rate_kg: Column, area: Column) -> DataFrame:
    """Rates (kg by area unit) to Mg for each pixel."""
    return fine.withColumn("emissions_Mg", absolute(rate_kg, area, 1000.0))


def gridded_agriculture(fine: DataFrame, cropland_kg: DataFrame, livestock_kg: DataFrame, crop_ratio: int, stock_ratio: int) -> DataFrame:
    """Cropland and livestock emissions (Mg) of each fine cell, for a table of their own.

    Cropland comes as a rate (kg by area unit) on a coarse grid, livestock as
    a total (kg) that its cells share out evenly; ``fine`` has row, col and
    area.
    """
    rated = resample(fine, cropland_kg.withColumnRenamed("value", "cropland"), crop_ratio, "cropland")
    both = downscale(rated, livestock_kg.withColumnRenamed("value", "livestock"), stock_ratio, "livestock")
    return both.select("row", "col", absolute("cropland", "area", 1000.0).alias("cropland_Mg"), (F.coalesce(missing("livestock"), F.lit(0.0)) / 1000.0).alias("livestock_Mg"))


def stacked(df: DataFrame, keys: list[str], layer: str, value: str, columns: list[str]) -> DataFrame:
    """The dense table of a measure stored one row a layer."""
    return pivot_dense(df, keys, layer, value, columns)
