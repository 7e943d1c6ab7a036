"""Feature layers served over HTTP: keyset-paged Python data source with pushed-down filters.

    spark.dataSource.register(LayerSource)
    spark.read.format("layer").options(url=..., since="2022-01-01", partitions="16").load()

The object id range is cut into partitions, each paging by ``OBJECTID > last`` within its range, so a failed task reads
its range again and nothing else. Tests and offline use name a fetcher (``module:function``) in the option ``fetcher``.
"""

from __future__ import annotations

import importlib
import json
import time
import urllib.parse
import urllib.request
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from docketry.schema import schema_fingerprint
from docketry.sources.snapshots import settle_snapshot, write_snapshot

PAGE_SIZE, RETRIES, TIMEOUT_S = 2000, 4, 60
ID = "OBJECTID"
_SPARK_TYPES = {"esriFieldTypeOID": "bigint", "esriFieldTypeInteger": "bigint", "esriFieldTypeSmallInteger": "int", "esriFieldTypeDouble": "double", "esriFieldTypeSingle": "double", "esriFieldTypeDate": "bigint"}


def fetch_json(url: str, params: dict) -> dict:
    """GET with doubling waits; an error body under status 200 counts as a failure."""
    for attempt in range(RETRIES + 1):
        try:
            with urllib.request.urlopen(f"{url}?{urllib.parse.urlencode(params | {'f': 'json'})}", timeout=TIMEOUT_S) as answer:
                body = json.load(answer)
            if "error" in body:
                raise OSError(str(body["error"]))
            return body
        except OSError:
            if attempt == RETRIES:
                raise
            time.sleep(2**attempt)
    raise AssertionError


def local_time(epoch_ms: Column, zone: str = "America/New_York") -> Column:
    """Epoch milliseconds as the wall clock of the zone; what is no number gives null."""
    return F.from_utc_timestamp(F.timestamp_millis(epoch_ms.try_cast("bigint")), zone)


@dataclass
class Manifest:
    """What a pull asked for and got."""

    url: str
    where: str
    fetched_at: str
    server_count: int
    rows_fetched: int
    fields: list[str] = field(default_factory=list)
    schema_fingerprint: str = ""
    max_date_reported: str = ""

    @property
    def reconciled(self) -> bool:
        return self.server_count == self.rows_fetched

    def to_json(self) -> str:
        return json.dumps(asdict(self), indent=1)


class IdRange(InputPartition):
    def __init__(self, low: int, high: int):
        super().__init__((low, high))
        self.low, self.high = low, high


class LayerSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "layer"

    def _fetch(self):
        named = self.options.get("fetcher")
        if not named:
            return fetch_json
        module, function = named.split(":")
        return getattr(importlib.import_module(module), function)

    def schema(self) -> str:
        fields = self._fetch()(self.options["url"], {})["fields"]
        return ", ".join(f"`{f['name']}` {_SPARK_TYPES.get(f['type'], 'string')}" for f in fields)

    def reader(self, schema):
        return LayerReader(self.options, self._fetch(), [f.name for f in schema.fields])


class LayerReader(DataSourceReader):
    _SIGNS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}

    def __init__(self, options, fetch, columns):
        self.url, self.fetch, self.columns = options["url"], fetch, columns
        self.parts, self.page = int(options.get("partitions", "8")), int(options.get("pagesize", str(PAGE_SIZE)))
        self.where = [f"{options.get('datefield', 'DATE_REPORTED')} >= DATE '{options['since']}'"] if "since" in options else []

    def pushFilters(self, filters):
        """Simple comparisons go to the server; all others, and all again to be safe with its types, stay with Spark."""
        for f in filters:
            if type(f) in self._SIGNS and isinstance(f.value, (int, float, str)) and len(f.attribute) == 1:
                shown = "'" + f.value.replace("'", "''") + "'" if isinstance(f.value, str) else str(f.value)
                self.where.append(f"{f.attribute[0]} {self._SIGNS[type(f)]} {shown}")
            yield f

    def condition(self) -> str:
        return " AND ".join(f"({w})" for w in self.where) or "1=1"

    def partitions(self):
        def edge(order: str) -> int | None:
            rows = self.fetch(self.url + "/query", {"where": self.condition(), "outFields": ID, "orderByFields": f"{ID} {order}", "resultRecordCount": 1, "returnGeometry": "false"})["features"]
            return rows[0]["attributes"][ID] if rows else None

        low, high = edge("ASC"), edge("DESC")
        if low is None:
            return [IdRange(0, 0)]
        step = max(1, -(-(high - low + 1) // self.parts))
        return [IdRange(a - 1, min(a + step - 1, high)) for a in range(low, high + 1, step)]

    def read(self, part: IdRange):
        last = part.low
        while last < part.high:
            where = f"({self.condition()}) AND {ID} > {last} AND {ID} <= {part.high}"
            rows = self.fetch(self.url + "/query", {"where": where, "outFields": "*", "orderByFields": ID, "resultRecordCount": self.page, "returnGeometry": "false"})["features"]
            if not rows:
                return
            for row in rows:
                yield tuple(row["attributes"].get(c) for c in self.columns)
            last = rows[-1]["attributes"][ID]


def server_count(url: str, where: str = "1=1", fetch=fetch_json) -> int:
    return int(fetch(url + "/query", {"where": where, "returnCountOnly": "true"})["count"])


# Date columns of the published layer.
LAYER_DATES = ["DATE_REPORTED", "DATE_INCIDENT_BEGAN", "DATE_INCIDENT_END", "CLEARANCE_DATE"]


def pull(spark: SparkSession, url: str, root, since: str, fetched_at: str, fetcher: str | None = None, partitions: int = 16, dates: Sequence[str] = LAYER_DATES) -> Manifest:
    """Pull a layer into a raw snapshot: count at the server, read in id ranges, bring dates to local time, write with a manifest.

    ``fetched_at`` is an ISO instant; its day names the snapshot. The rows are counted as written, so a feature that
    came or went between count and read shows as not reconciled.
    """
    fetch = fetch_json if fetcher is None else getattr(importlib.import_module(fetcher.split(":")[0]), fetcher.split(":")[1])
    spark.dataSource.register(LayerSource)
    options = {"url": url, "since": since, "partitions": str(partitions)} | ({"fetcher": fetcher} if fetcher else {})
    where = f"DATE_REPORTED >= DATE '{since}'"
    counted = server_count(url, where, fetch)
    raw = spark.read.format("layer").options(**options).load()
    rows = raw.withColumns({c: local_time(F.col(c)) for c in dates if c in raw.columns})
    seen = Observation("pull")
    watched = rows.observe(seen, F.count("*").alias("rows"), *([F.max("DATE_REPORTED").alias("newest")] if "DATE_REPORTED" in rows.columns else []))
    manifest = Manifest(url, where, fetched_at, counted, 0, raw.columns, schema_fingerprint(raw.columns))
    write_snapshot(watched, root, f".{fetched_at[:10]}.read", {})
    got = seen.get
    manifest.rows_fetched, manifest.max_date_reported = got["rows"], str(got.get("newest") or "")
    settle_snapshot(spark, root, f".{fetched_at[:10]}.read", fetched_at[:10], asdict(manifest))
    return manifest
