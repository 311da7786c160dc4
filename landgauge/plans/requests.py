"""Requests: areas of interest and the parameters of each product, validated."""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from dataclasses import asdict, dataclass, field
from datetime import date

from landgauge.functions import codes

MOST_ADMIN_IDS, MOST_FEATURES = 1000, 50
_ADMIN, _YEAR, _DAY = re.compile(r"[A-Z]{3}(\.\d+)*"), re.compile(r"\d{4}"), re.compile(r"\d{4}(-\d{1,2}-\d{1,2})?")


class InvalidRequest(ValueError):
    pass


def _need(ok: bool, why: str) -> None:
    if not ok:
        raise InvalidRequest(why)


@dataclass(frozen=True)
class Area:
    """Areas of one type: ids of a known layer, or features of the request itself."""

    type: str
    ids: tuple[str, ...] = ()
    features: dict | None = field(default=None, compare=False)
    provider: str = "gadm"
    version: str = "4.1"

    def __post_init__(self):
        kinds = ("admin", "key_biodiversity_area", "protected_area", "indigenous_land", "feature_collection")
        _need(self.type in kinds, f"unknown area type {self.type!r}")
        if self.type == "feature_collection":
            object.__setattr__(self, "ids", self._feature_ids())
            return
        _need(len(self.ids) > 0, "no ids")
        if self.type == "admin":
            _need(len(self.ids) <= MOST_ADMIN_IDS, f"at most {MOST_ADMIN_IDS} ids")
            for i in self.ids:
                _need(bool(_ADMIN.fullmatch(i)), f"{i!r} is no administrative id")
                _need(i.count(".") <= 2, "the deepest level is 2")
        else:
            _need(len(self.ids) <= MOST_FEATURES, f"at most {MOST_FEATURES} ids")

    def _feature_ids(self) -> tuple[str, ...]:
        f = self.features or {}
        _need(f.get("type") == "FeatureCollection", "features must be a FeatureCollection")
        own = f.get("features")
        _need(isinstance(own, list) and 0 < len(own) <= MOST_FEATURES, f"from 1 to {MOST_FEATURES} features")
        found = []
        for n, x in enumerate(own):
            _need(isinstance(x, dict), f"feature {n} is no object")
            i = x.get("id")
            i = (x.get("properties") or {}).get("id") if i is None else i
            _need(i is not None and str(i).strip() != "", f"feature {n} has no id")
            found.append(str(i))
        _need(len(set(found)) == len(found), "feature ids must differ")
        return tuple(found)

    def at_level(self, level: int) -> list[tuple]:
        """The ids of one administrative level, as (country, region, subregion) parts."""
        parts = [i.split(".") for i in self.ids]
        return [(p[0], *map(int, p[1:])) for p in parts if len(p) == level + 1]

    def geometry_hash(self) -> str:
        return hashlib.sha256(json.dumps(self.features, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


@dataclass(frozen=True)
class Request:
    area: Area
    admin_only, own_version = False, "1"

    def thumbprint(self, inputs: dict | None = None) -> uuid.UUID:
        """The same request on the same inputs has the same id."""
        body = asdict(self) | {"product": type(self).__name__, "version": self.own_version, "inputs": inputs or {}}
        if self.area.features is not None:
            body["area"]["features"] = self.area.geometry_hash()
        return uuid.uuid5(uuid.NAMESPACE_DNS, json.dumps(body, sort_keys=True, separators=(",", ":"), default=str))

    def __post_init__(self):
        _need(not self.admin_only or self.area.type == "admin", "only administrative areas")


def _years(start: str, end: str, first: int, last: int | None = None) -> None:
    for y in (start, end):
        _need(bool(_YEAR.fullmatch(str(y))), f"{y!r} is no year")
        _need(int(y) >= first, f"years start at {first}")
        _need(last is None or int(y) <= last, f"years end at {last}")
    _need(int(end) >= int(start), "the end is before the start")


@dataclass(frozen=True)
class TreeCoverLoss(Request):
    start_year: str = "2001"
    end_year: str = "2024"
    canopy_cover: int | None = None
    forest_filter: str | None = None
    intersections: tuple[str, ...] = ()

    def __post_init__(self):
        super().__post_init__()
        _years(self.start_year, self.end_year, 2001)
        _need(self.canopy_cover in (None, 10, 15, 20, 25, 30, 50, 75), "no such canopy cover")
        _need(self.forest_filter in (None, "primary_forest", "natural_forest", "intact_forest"), "no such forest filter")
        _need(len(self.intersections) <= 1 and set(self.intersections) <= {"driver", "fire"}, "at most one of driver and fire")
        _need(bool(self.canopy_cover or self.forest_filter), "a canopy cover or a forest filter is needed")
        if self.forest_filter == "natural_forest":
            _need(int(self.start_year) >= 2021, "natural forests are those of 2020")
            _need(self.canopy_cover is None, "natural forests of 2020 do not go with canopy cover of 2000")
            _need(self.area.type != "admin", "no natural forests by administrative area")


@dataclass(frozen=True)
class TreeCover(Request):
    canopy_cover: int = 30
    forest_filter: str | None = None

    def __post_init__(self):
        super().__post_init__()
        _need(self.canopy_cover in (10, 15, 20, 25, 30, 50, 75), "no such canopy cover")
        _need(self.forest_filter in (None, "primary_forest"), "no such forest filter")


@dataclass(frozen=True)
class TreeCoverGain(Request):
    start_year: str = "2000"
    end_year: str = "2020"
    forest_filter: str | None = None

    def __post_init__(self):
        super().__post_init__()
        _years(self.start_year, self.end_year, 2000)
        _need(int(self.start_year) % 5 == 0 and int(self.end_year) % 5 == 0, "years are multiples of 5")
        _need(int(self.end_year) > int(self.start_year), "the end is not after the start")


@dataclass(frozen=True)
class CarbonFlux(Request):
    canopy_cover: int = 30

    def __post_init__(self):
        super().__post_init__()
        _need(self.canopy_cover in codes.CARBON_THRESHOLDS, "canopy cover is one of 30, 50, 75")


def _dates(start: str, end: str, whole: bool) -> None:
    for d in (start, end):
        _need(bool(_DAY.fullmatch(d)) and (not whole or "-" in d), f"{d!r} is no date")
    if "-" in start and "-" in end:
        a, b = (date(*map(int, d.split("-"))) for d in (start, end))
        _need(b >= a, "the end is before the start")
    else:
        _need(end[:4] >= start[:4], "the end is before the start")


@dataclass(frozen=True)
class DisturbanceAlerts(Request):
    """Dates may be bare years and are compared as texts, as stored."""

    start_date: str = "2023"
    end_date: str = "2025"
    intersections: tuple[str, ...] = ()

    def __post_init__(self):
        super().__post_init__()
        _dates(self.start_date, self.end_date, whole=False)
        _need(len(self.intersections) <= 1 and set(self.intersections) <= {"driver", "natural_lands", "grasslands", "land_cover"}, "at most one known intersection")


@dataclass(frozen=True)
class IntegratedAlerts(Request):
    start_date: str = "2023-01-01"
    end_date: str = "2025-12-31"

    def __post_init__(self):
        super().__post_init__()
        _dates(self.start_date, self.end_date, whole=True)


@dataclass(frozen=True)
class Grasslands(Request):
    start_year: str = "2000"
    end_year: str = "2022"

    def __post_init__(self):
        super().__post_init__()
        _years(self.start_year, self.end_year, 2000)


@dataclass(frozen=True)
class NaturalLands(Request):
    pass


@dataclass(frozen=True)
class LandCoverChange(Request):
    pass


@dataclass(frozen=True)
class LandCoverComposition(Request):
    pass


@dataclass(frozen=True)
class LandInventory(Request):
    admin_only = True


@dataclass(frozen=True)
class EmissionFactors(Request):
    gas_types: tuple[str, ...] = ("CO2e",)
    crop_types: tuple[str, ...] = ()
    start_year: str = "2020"
    end_year: str = "2024"
    admin_only = True

    def __post_init__(self):
        super().__post_init__()
        _years(self.start_year, self.end_year, 2020, 2024)
        _need(len(self.gas_types) > 0 and set(self.gas_types) <= set(codes.GASES), "unknown gas")
        _need(len(self.crop_types) > 0 and set(self.crop_types) <= set(codes.CROPS), "unknown crop")
