"""Jobs: identity, state, stored results, routing.  Plain Python around the plans."""

from __future__ import annotations

import hashlib
import json
import os
import threading
import time
from collections import OrderedDict
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from concurrent.futures import TimeoutError as Late
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession

from landgauge.functions.geo import geodesic_area_ha
from landgauge.operators.align import Grid
from landgauge.operators.spatial import AreaTooSmall, of_features
from landgauge.plans.products import PRODUCTS, columns
from landgauge.plans.requests import Request
from landgauge.sources import tables

PENDING, SAVED, FAILED = "pending", "saved", "failed"
TIME_LIMIT, LOCAL_LIMIT_HA = 600.0, 50_000_000.0


class Results:
    """Metadata, status and results as JSON files by thumbprint; features by their hash, once.

    ``root`` may be a folder of any store that Spark reads, so that several
    machines share what they have computed.
    """

    def __init__(self, root: str | os.PathLike, spark: SparkSession | None = None):
        self.root, self.spark = str(root).rstrip("/"), spark or SparkSession.builder.getOrCreate()

    def _path(self, key: str, part: str) -> str:
        return f"{self.root}/{key}.{part}.json"

    def _write(self, path: str, body) -> None:
        tables.write_text(self.spark, path, json.dumps(body, default=str))

    def _read(self, path: str):
        found = tables.read_text(self.spark, path)
        return None if found is None else json.loads(found)

    def load(self, key: str) -> dict | None:
        """Status, metadata and, once saved, the result; None if unknown."""
        job = self._read(self._path(key, "job"))
        if job is not None and job["status"] == SAVED:
            job["result"] = self._read(self._path(key, "result"))
        return job

    def note(self, key: str, status: str, metadata: dict, message: str | None = None) -> None:
        area = dict(metadata.get("area") or {})
        if area.get("features"):
            body = json.dumps(area["features"], sort_keys=True, separators=(",", ":"))
            area["features"] = hashlib.sha256(body.encode()).hexdigest()
            if not tables.exists(self.spark, self._path(area["features"], "features")):
                self._write(self._path(area["features"], "features"), json.loads(body))
        self._write(self._path(key, "job"), {"status": status, "metadata": metadata | ({"area": area} if area else {}), "message": message})

    def save(self, key: str, result: dict) -> None:
        self._write(self._path(key, "result"), result)


class Service:
    """Creates jobs and answers polls; the same request is computed once.

    ``sources`` gives the tables of a request.  Jobs run in the scheduler pool
    that :func:`pool_for` names; those past their time are cancelled.
    """

    def __init__(self, sources: Callable[[Request], dict[str, DataFrame]], results: Results, inputs: dict | None = None, limit: float = TIME_LIMIT, workers: int = 4):
        self.sources, self.results, self.inputs, self.limit = sources, results, inputs or {}, limit
        self.pool = ThreadPoolExecutor(workers)
        self.lock = threading.Lock()

    def create(self, request: Request, wait: bool = False) -> str:
        """The job's id; the work starts unless its state is known already."""
        key = str(request.thumbprint(self.inputs.get(type(request).__name__)))
        with self.lock:
            if self.results.load(key) is not None:
                return key
            self.results.note(key, PENDING, asdict(request))
        done = self.pool.submit(self._run, key, request)
        if wait:
            done.result()
        return key

    def _run(self, key: str, request: Request) -> None:
        note = lambda status, message=None: self.results.note(key, status, asdict(request), message)
        worker = ThreadPoolExecutor(1)
        try:
            result = worker.submit(self._compute, key, request).result(timeout=self.limit)
            self.results.save(key, result)
            note(SAVED)
        except AreaTooSmall as e:
            note(FAILED, f"the area is too small for the resolution: {e}")
        except Late:
            self.results.spark.sparkContext.cancelJobsWithTag(key)
            note(FAILED, "the analysis took too long")
        except Exception as e:  # the job's state tells, whatever it was
            note(FAILED, f"{type(e).__name__}: {str(e)[:500]}")
        finally:
            worker.shutdown(wait=False, cancel_futures=True)

    def _compute(self, key: str, request: Request) -> dict:
        context = self.results.spark.sparkContext
        context.addJobTag(key)
        if request.area.features is not None:
            context.setLocalProperty("spark.scheduler.pool", pool_for(request.area.features))
        out = PRODUCTS[type(request)](request, self.sources(request))
        return {n: columns(d) for n, d in out.items()} if isinstance(out, dict) else columns(out)

    def poll(self, key: str) -> tuple[int, dict, dict]:
        """Status code, headers and body, as an endpoint would give them."""
        job = self.results.load(key)
        if job is None:
            return 404, {}, {"message": "unknown analysis"}
        public = {k: v for k, v in job["metadata"].items() if not k.startswith("_")}
        body = {"status": job["status"], "message": job["message"], "metadata": public, "result": job.get("result")}
        return 200, {"Retry-After": "1"} if job["status"] == PENDING else {}, body


def pixel_sources(pixels: DataFrame, grid: Grid, extent: tuple[float, float, float, float], rollups: dict[str, DataFrame], size: float = 1.0) -> Callable[[Request], dict[str, DataFrame]]:
    """The tables of any request: roll-ups for administrative areas, else pixels clipped to the request's features."""

    def give(request: Request) -> dict[str, DataFrame]:
        if request.area.features is None:
            return rollups
        return rollups | {"pixels": of_features(pixels, request.area.features, grid, extent, size, request.area.type)}

    return give


def chain(*handlers: tuple[Callable[[Request], bool], Callable]) -> Callable:
    """The first handler that takes a request answers it."""

    def handle(request: Request):
        for takes, answers in handlers:
            if takes(request):
                return answers(request)
        raise LookupError(f"nothing handles {type(request).__name__}")

    return handle


def pool_for(features: dict, limit_ha: float = LOCAL_LIMIT_HA) -> str:
    """Scheduler pool of a request: large areas go to one of their own."""
    return "large" if geodesic_area_ha(features) > limit_ha else "interactive"


def overlay(base: dict[str, dict], environments: dict[str, dict], name: str) -> dict[str, dict]:
    """Table addresses by product for an environment, what it lacks from ``base``."""
    own = environments.get(name, {})
    return {k: v | own.get(k, {}) for k, v in base.items()}


class Roles:
    """Who may ask for guarded products: tokens looked up once in a while.

    ``lookup`` gives a token's role, or None; refusals are remembered too.
    """

    def __init__(self, lookup: Callable[[str], str | None], seconds: float = 120.0, most: int = 1024, clock: Callable[[], float] = time.monotonic):
        self.lookup, self.seconds, self.most, self.clock = lookup, seconds, most, clock
        self.known: OrderedDict[str, tuple[float, str | None]] = OrderedDict()

    def role(self, token: str) -> str | None:
        at, role = self.known.get(token, (None, None))
        if at is None or self.clock() - at >= self.seconds:
            role = self.lookup(token)
            self.known[token] = (self.clock(), role)
            self.known.move_to_end(token)
            while len(self.known) > self.most:
                self.known.popitem(last=False)
        return role

    def require(self, token: str | None, role: str = "ADMIN") -> None:
        if not token or self.role(token) != role:
            raise PermissionError(f"role {role} is needed")
