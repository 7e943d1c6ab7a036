"""Queries of the general problems over the project's tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry.functions.instants import ZONE_OFFSETS
from docketry.operators import drift, instants, proximity, snapshots
from docketry.schema import ALIASES
from docketry.session import table

#: box outside which a delivered coordinate is no location
LAT_BOX, LON_BOX = (34.9, 35.6), (-81.2, -80.5)


def _agency_values(spark: SparkSession, sf_dir: str, concepts: tuple[str, ...]) -> DataFrame:
    """(record_key, source, concept, value): scalar values of the named concepts of every agency record, as text."""
    entries = drift.raw_fields(table(spark, sf_dir, "agency_files")).select("file_id", "row_no", F.explode("_fields").alias("field", "_v"))
    named = entries.withColumn("concept", drift.concept_of(F.col("field"))).where(F.col("concept").isin(*concepts))
    key = F.concat_ws("/", "file_id", F.col("row_no").cast("string"))
    return named.select(key.alias("record_key"), F.col("file_id").alias("source"), "concept", F.when(drift.json_kind(F.col("_v")).isin("string", "number"), F.try_variant_get("_v", "$", "string")).alias("value"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.drift(table(spark, sf_dir, "agency_files"))


def p1_ingested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All agency records in the canonical columns, objects replayed, two approved fields promoted, the rest rescued."""
    records = drift.latest_delivery(table(spark, sf_dir, "agency_files"))
    return drift.promote(drift.replay(drift.ingest(records)), {"weapon": "string", "premise": "string"})


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.snapshot_changes(table(spark, sf_dir, "incident_snapshots"))


def located(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(record_key, lat, lon) of every incident and agency record with a location."""
    incidents = table(spark, sf_dir, "incidents").select(F.col("incident_id").alias("record_key"), "lat", "lon")
    fields = drift.ingest(table(spark, sf_dir, "agency_files"), targets={"lat": "double", "lon": "double"}, keep=("file_id", "row_no"), only=("lat", "lon"))
    agencies = drift.replay(fields).select(F.concat_ws("/", "file_id", F.col("row_no").cast("string")).alias("record_key"), "lat", "lon")
    return incidents.unionByName(agencies).where(F.col("lat").between(*LAT_BOX) & F.col("lon").between(*LON_BOX))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    sites = table(spark, sf_dir, "sites")
    return proximity.near_sites(located(spark, sf_dir), sites, 250.0, cells=proximity.coverage_bound(sites, 250.0))


def p5_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(record_key, region_id): records inside the diamond of 0.0050005 degrees about a site, as regions given by their border."""
    corner = lambda dy, dx: F.struct((F.col("lat") + dy).alias("lat"), (F.col("lon") + dx).alias("lon"))
    ring = F.array(corner(0.0050005, 0.0), corner(0.0, 0.0050005), corner(-0.0050005, 0.0), corner(0.0, -0.0050005))
    return proximity.in_regions(located(spark, sf_dir), table(spark, sf_dir, "sites").select(F.col("site_id").alias("region_id"), F.array(ring).alias("rings")))


def _instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    incidents = table(spark, sf_dir, "incidents")
    fields = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in ("date_reported", "clearance_date")])
    own = incidents.select(F.col("incident_id").alias("record_key"), F.inline(fields)).select("record_key", F.concat(F.lit("incidents."), "field").alias("source"), "field", "value").where(F.col("value").isNotNull())
    agency = _agency_values(spark, sf_dir, ("date_reported", "date_occurred")).where(F.col("value").isNotNull())
    reported = agency.where(F.col("concept") == "date_reported").select("record_key", "source", F.lit("date_reported").alias("field"), "value")
    occurred = agency.where(F.col("concept") == "date_occurred").select("source", "value")
    return instants.normalise_instants(own.unionByName(reported), fixed_month_first=F.col("source").startswith("incidents."), evidence=occurred)


def p7_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value with its instant, reading, posterior and whether it stays ambiguous."""
    return _instants(spark, sf_dir).distinct()


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _instants(spark, sf_dir).where(F.col("epoch_s").isNotNull()).select("record_key", "field", "epoch_s").distinct()


QUERIES = {"p1_found": p1_found, "p1_ingested": p1_ingested, "p4_found": p4_found, "p5_found": p5_found, "p5_regions": p5_regions, "p7_found": p7_found, "p7_instants": p7_instants}

#: agency records' coordinates by the spellings of their keys; text with sign or hemisphere is read like drift.read_degrees
_POINTS = """
        f AS (SELECT file_id || '/' || row_no AS record_key, k, payload ->> ('$."' || k || '"') AS v, json_type(payload, '$."' || k || '"') AS kind
            FROM (SELECT file_id, row_no, payload, unnest(json_keys(payload)) AS k FROM agency_files WHERE json_valid(payload))),
        c AS (SELECT record_key, CASE WHEN lower(trim(k)) IN ('latitude_public','latitude','lat','y') THEN 'lat' WHEN lower(trim(k)) IN ('longitude_public','longitude','lon','long','lng','x') THEN 'lon' END AS axis,
            regexp_extract(v, '^\\s*([-+]?[0-9]+([.][0-9]*)?)\\s*[°º]?\\s*([NSEW]?)\\s*$', 1) AS n, regexp_extract(v, '([SW])\\s*$', 1) AS west FROM f WHERE kind NOT IN ('OBJECT', 'ARRAY', 'BOOLEAN', 'NULL')),
        d AS (SELECT record_key, axis, CASE WHEN west = '' THEN try_cast(n AS DOUBLE) ELSE -abs(try_cast(n AS DOUBLE)) END AS x FROM c WHERE axis IS NOT NULL AND n <> ''),
        p AS (SELECT DISTINCT * FROM (
            SELECT incident_id AS record_key, lat, lon FROM incidents
            UNION ALL SELECT a.record_key, a.x, b.x FROM d a JOIN d b USING (record_key) WHERE a.axis = 'lat' AND b.axis = 'lon') WHERE lat BETWEEN 34.9 AND 35.6 AND lon BETWEEN -81.2 AND -80.5)"""

_SPELLINGS = "(VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in ALIASES.items()) + ") AS al(spelled, concept)"
_KEY = "trim(regexp_replace(lower(trim({})), '[^a-z0-9]+', '_', 'g'), '_')"
_PARTED = _KEY.format("regexp_replace(trim({}), '([a-z0-9])([A-Z])', '\\1_\\2', 'g')")
#: every entry of the agency records with its concept
_ENTRIES = f"""
        r AS (SELECT * FROM agency_files WHERE json_valid(payload) AND json_type(payload) = 'OBJECT'),
        k AS (SELECT *, unnest(json_keys(payload)) AS field FROM r),
        names AS (SELECT field, coalesce(a.concept, b.concept, parted) AS concept FROM (SELECT DISTINCT field, {_KEY.format('field')} AS key, {_PARTED.format('field')} AS parted FROM k) d
            LEFT JOIN {_SPELLINGS.replace('AS al', 'AS a')} ON a.spelled = d.key LEFT JOIN {_SPELLINGS.replace('AS al', 'AS b')} ON b.spelled = d.parted),
        entries AS (SELECT agency, period, file_id, row_no, received_at, k.field, concept, json_type(payload, '$."' || k.field || '"') AS jt, payload ->> ('$."' || k.field || '"') AS value FROM k JOIN names USING (field))"""
_TIME = r"(?:(?:T|\s*,?\s+(?:at\s+)?)(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)?\s*([AaPp]\.?[Mm]\.?)?\s*([A-Za-z]{1,4}|[+-]\d{2}:?\d{2})?)?$"
_CLOCK = "'hh', 'mi', 'ss', 'half', 'zone'"
#: shape, pattern and the names of its groups; numeric dates once for each mark, as there is no reference back
_READINGS = [
    ("iso", r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})" + _TIME, "'y', 'm', 'd'"),
    ("basic", r"^(\d{4})(\d{2})(\d{2})(?:T(\d{2})(\d{2})(\d{2})?(?:[.,]\d+)?()\s*([A-Za-z]{1,4}|[+-]\d{2}:?\d{2})?)?$", "'y', 'm', 'd'"),
    *(("numeric", rf"^(\d{{1,2}})[{c}](\d{{1,2}})[{c}](\d{{4}}|\d{{2}})" + _TIME, "'a', 'b', 'y'") for c in "/.-"),
    ("name", r"^(?:[A-Za-z]{3,9}\.?,?\s+)?(\d{1,2})(?:\s+|-)([A-Za-z]{3,9})\.?(?:\s*,?\s+|-)(\d{4}|\d{2})" + _TIME, "'d', 'mon', 'y'"),
    ("name", r"^(?:[A-Za-z]{3,9}\.?,\s+)?([A-Za-z]{3,9})\.?\s+(\d{1,2})(?:st|nd|rd|th)?\s*,?\s+(\d{4}|\d{2})" + _TIME, "'mon', 'd', 'y'"),
]
_ZONES = "MAP {" + ", ".join(f"'{a}': {b}" for a, b in ZONE_OFFSETS.items()) + "}"
_READ = "\n        UNION ALL ".join(
    f"SELECT record_key, source, field, {k} AS rank, '{shape}' AS shape, " + ", ".join(f"x.{g}" if f"'{g}'" in groups + _CLOCK else f"'' AS {g}" for g in ("y", "m", "d", "a", "b", "mon", "hh", "mi", "ss", "half", "zone"))
    + f" FROM (SELECT *, regexp_extract(t, '{pattern}', [{groups}, {_CLOCK}]) AS x FROM v WHERE regexp_matches(t, '{pattern}'))"
    for k, (shape, pattern, groups) in enumerate(_READINGS)
)
_DAY = "try_cast(lpad({}::VARCHAR, 4, '0') || '-' || lpad({}::VARCHAR, 2, '0') || '-' || lpad({}::VARCHAR, 2, '0') AS DATE)"
_P7 = f"""
        WITH {_ENTRIES},
        v AS (SELECT *, trim(regexp_replace(trim(value), '\\s+', ' ', 'g')) AS t FROM (
            SELECT incident_id AS record_key, 'incidents' AS source, 'date_reported' AS field, date_reported AS value FROM incidents
            UNION ALL SELECT incident_id, 'incidents', 'clearance_date', clearance_date FROM incidents
            UNION ALL SELECT file_id || '/' || row_no, file_id, concept, value FROM entries WHERE concept IN ('date_reported', 'date_occurred') AND jt NOT IN ('OBJECT', 'ARRAY', 'BOOLEAN', 'NULL')) WHERE value IS NOT NULL),
        h AS ({_READ}),
        g AS (SELECT record_key, source, field, shape, CASE WHEN y::INTEGER < 100 THEN y::INTEGER + 2000 ELSE y::INTEGER END AS y, coalesce(try_cast(m AS INTEGER), nullif(list_position(['jan','feb','mar','apr','may','jun','jul','aug','sep','oct','nov','dec'], lower(substr(mon, 1, 3))), 0)) AS m, try_cast(d AS INTEGER) AS d, try_cast(a AS INTEGER) AS a, try_cast(b AS INTEGER) AS b,
            try_cast(hh AS INTEGER) AS hh, coalesce(try_cast(mi AS INTEGER), 0) AS mi, coalesce(try_cast(ss AS INTEGER), 0) AS ss, lower(substr(half, 1, 1)) AS half, upper(zone) AS zone FROM h),
        o AS (SELECT source, count(*) FILTER ({_DAY.format('y', 'a', 'b')} IS NOT NULL AND {_DAY.format('y', 'b', 'a')} IS NULL) AS month_only, count(*) FILTER ({_DAY.format('y', 'b', 'a')} IS NOT NULL AND {_DAY.format('y', 'a', 'b')} IS NULL) AS day_only FROM g WHERE shape = 'numeric' GROUP BY 1),
        w AS (SELECT record_key, field, zone, CASE WHEN shape <> 'numeric' THEN {_DAY.format('y', 'm', 'd')} WHEN source = 'incidents' OR coalesce(month_only >= day_only, true) THEN {_DAY.format('y', 'a', 'b')} ELSE {_DAY.format('y', 'b', 'a')} END AS day,
            CASE WHEN mi > 59 OR ss > 59 THEN NULL WHEN hh IS NULL THEN 0 WHEN half <> '' THEN CASE WHEN hh BETWEEN 1 AND 12 THEN hh % 12 + CASE half WHEN 'p' THEN 12 ELSE 0 END END WHEN hh <= 23 THEN hh END * 3600 + mi * 60 + ss AS s FROM g LEFT JOIN o USING (source)),
        i AS (SELECT record_key, field, zone, day::TIMESTAMP + to_seconds(s) AS wall FROM w WHERE day IS NOT NULL AND s IS NOT NULL),
        z AS (SELECT *, epoch(wall AT TIME ZONE 'America/New_York')::BIGINT AS e, CASE WHEN zone ~ '^[+-]' THEN (CASE WHEN zone LIKE '-%' THEN -1 ELSE 1 END) * (substr(replace(zone, ':', ''), 2, 2)::INTEGER * 3600 + substr(replace(zone, ':', ''), 4, 2)::INTEGER * 60) ELSE {_ZONES}[zone] END AS off FROM i)
        SELECT DISTINCT record_key, field, epoch_s FROM (
            SELECT record_key, field, CASE WHEN zone = '' THEN CASE WHEN to_timestamp(e - 3600) AT TIME ZONE 'America/New_York' = wall THEN e - 3600 ELSE e END ELSE epoch(wall)::BIGINT - off END AS epoch_s FROM z
            UNION ALL SELECT record_key, field, try_cast(t AS BIGINT) // 1000 FROM v WHERE t ~ '^[0-9]{{13}}$' UNION ALL SELECT record_key, field, try_cast(t AS BIGINT) FROM v WHERE t ~ '^[0-9]{{10}}$') WHERE epoch_s IS NOT NULL AND field <> 'date_occurred'"""

ORACLES = {
    "p1_found": f"""
        WITH {_ENTRIES},
        c AS (SELECT agency, period, file_id, field, concept, CASE jt WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'NULL' THEN NULL ELSE 'number' END AS kind FROM entries QUALIFY received_at = max(received_at) OVER (PARTITION BY file_id)),
        n AS (SELECT *, count(*) AS n FROM c GROUP BY ALL),
        f AS (SELECT agency, period, file_id, field, concept, kind FROM n QUALIFY row_number() OVER (PARTITION BY agency, period, file_id, field ORDER BY kind IS NULL, n DESC, kind DESC) = 1),
        p AS (SELECT file_id, lag(file_id) OVER (PARTITION BY agency ORDER BY period, file_id) AS before FROM (SELECT DISTINCT agency, period, file_id FROM f)),
        now AS (SELECT p.file_id, field, concept, kind FROM p JOIN f USING (file_id) WHERE before IS NOT NULL), was AS (SELECT p.file_id, field, concept, kind FROM p JOIN f ON f.file_id = p.before),
        came AS (SELECT *, row_number() OVER (PARTITION BY file_id, concept ORDER BY field) AS k FROM now ANTI JOIN was USING (file_id, concept, field)), went AS (SELECT *, row_number() OVER (PARTITION BY file_id, concept ORDER BY field) AS k FROM was ANTI JOIN now USING (file_id, concept, field)),
        moved AS (SELECT file_id, w.field AS old, w.kind AS ok, c.field AS new, c.kind AS nk FROM came c FULL JOIN went w USING (file_id, concept, k))
        SELECT file_id, 'retyped' AS change, field AS old_field, field AS new_field FROM now JOIN was USING (file_id, concept, field) WHERE now.kind <> was.kind
        UNION ALL SELECT file_id, 'renamed', old, new FROM moved WHERE old IS NOT NULL AND new IS NOT NULL UNION ALL SELECT file_id, 'retyped', old, new FROM moved WHERE ok <> nk
        UNION ALL SELECT file_id, 'added', '', new FROM moved WHERE old IS NULL UNION ALL SELECT file_id, 'removed', old, '' FROM moved WHERE new IS NULL""",
    "p7_found": _P7,
    "p5_found": f"""
        WITH {_POINTS}
        SELECT DISTINCT p.record_key, s.site_id FROM p JOIN sites s ON s.lat BETWEEN p.lat - 0.01 AND p.lat + 0.01 AND s.lon BETWEEN p.lon - 0.01 AND p.lon + 0.01
        WHERE 2 * 6371008.8 * asin(sqrt(pow(sin(radians(s.lat - p.lat) / 2), 2) + cos(radians(p.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lon - p.lon) / 2), 2))) <= 250""",
    "p5_regions": f"""
        WITH {_POINTS}
        SELECT DISTINCT p.record_key, s.site_id AS region_id FROM p JOIN sites s ON abs(s.lat - p.lat) + abs(s.lon - p.lon) < 0.0050005""",
    "p4_found": """
        WITH s AS (SELECT DISTINCT snapshot, incident_id, upper(trim(coalesce(offense_code, ''))) AS a, upper(trim(coalesce(clearance_status, ''))) AS b FROM incident_snapshots),
        o AS (SELECT snapshot, lead(snapshot) OVER (ORDER BY snapshot) AS nxt FROM (SELECT DISTINCT snapshot FROM s)),
        pairs AS (
            SELECT coalesce(n.snapshot, p.nxt) AS snapshot, coalesce(n.incident_id, p.incident_id) AS incident_id, p.incident_id IS NULL AS came, n.incident_id IS NULL AS went, n.a <> p.a AS da, n.b <> p.b AS db
            FROM (SELECT s.*, o.nxt FROM s JOIN o USING (snapshot) WHERE o.nxt IS NOT NULL) p
            FULL JOIN (SELECT * FROM s WHERE snapshot > (SELECT min(snapshot) FROM s)) n ON n.snapshot = p.nxt AND n.incident_id = p.incident_id)
        SELECT snapshot, incident_id, 'added' AS change, '' AS field FROM pairs WHERE came
        UNION ALL SELECT snapshot, incident_id, 'removed', '' FROM pairs WHERE went
        UNION ALL SELECT snapshot, incident_id, 'changed', 'offense_code' FROM pairs WHERE da
        UNION ALL SELECT snapshot, incident_id, 'changed', 'clearance_status' FROM pairs WHERE db""",
}
