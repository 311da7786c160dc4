"""Command line: run a batch plan and publish its table.

    python -m landgauge.plans.run --plan loss --pixels IN --iso ISO --out OUT --version v20240101

Writes OUT/<plan>/<version> once and then marks the version as the latest.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from landgauge.operators import spatial
from landgauge.plans import batch
from landgauge.sources import tables

PLANS = {
    "loss": batch.loss, "carbon_flux": batch.carbon_flux, "integrated": batch.integrated, "grasslands": batch.grasslands, "natural_lands": batch.natural_lands, "vegetation": batch.vegetation,
    "agriculture": batch.agriculture, "mineral_soil": batch.mineral_soil, "organic_soil": batch.organic_soil, "land_cover_change": batch.land_cover_change, "land_cover_composition": batch.land_cover_composition,
    "disturbance": batch.disturbance,
    **{f"disturbance_{k}": (lambda p, iso, k=k: batch.disturbance(p, iso, k)) for k in ("driver", "grasslands", "land_cover", "natural_lands")},
}
#: Plans over inputs that come again and again under new versions.
VERSIONED = {"integrated", *(p for p in PLANS if p.startswith("disturbance"))}


def parse(args: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--plan", required=True, choices=sorted(PLANS))
    p.add_argument("--pixels", required=True)
    p.add_argument("--iso", required=True, help="CSV of code, alpha3")
    p.add_argument("--out", required=True)
    p.add_argument("--version")
    p.add_argument("--bbox", type=lambda t: tuple(map(float, t.split(","))), help="min x, min y, max x, max y")
    p.add_argument("--overwrite", action="store_true")
    found = p.parse_args(args)
    if found.plan in VERSIONED and not found.version:
        p.error(f"{found.plan} needs a version")
    if found.bbox and len(found.bbox) != 4:
        p.error("a box has four sides")
    return found


def run(spark: SparkSession, a: argparse.Namespace) -> str:
    """The path of the table, written or found."""
    folder = f"{a.out.rstrip('/')}/{a.plan}"
    version = a.version or "v1"

    def table():
        pixels = tables.parquet(spark, a.pixels)
        if a.bbox:
            pixels = spatial.window(pixels, a.bbox)
        return PLANS[a.plan](pixels, spark.read.csv(a.iso, header=True, schema="code int, alpha3 string"))

    if tables.write_once(table, spark, f"{folder}/{version}", a.overwrite):
        tables.mark_latest(spark, folder, version)
    return f"{folder}/{version}"


if __name__ == "__main__":
    print(run(SparkSession.builder.appName("plans").getOrCreate(), parse()))
