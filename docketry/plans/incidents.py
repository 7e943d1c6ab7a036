"""Queries of the audit, publishing, diff and linkage operators over whole tables, each with its reference SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry import schema
from docketry.functions import text
from docketry.functions.similarity import jaro_winkler
from docketry.lineage import cut
from docketry.operators import contract, drift, evaluation, gates, jurisdiction, linkage, monthly, restatement, timeliness
from docketry.session import table
from docketry.sources import people

AS_OF = date(2026, 10, 1)

CONTRACT = {
    "key": "incident_id",
    "columns": {
        "incident_id": {"type": "str", "required": True, "regex": r"\d{8}-\d{4}-\d{2}", "regex_severity": "WARN"},
        "date_reported": {"type": "date", "required": True, "min": "2000-01-01", "not_future": True},
        "offense_code": {"type": "str", "required": True, "regex": r"\d{2}[A-Z]|\d{3}", "regex_severity": "WARN"},
        "zip": {"type": "float", "min": 200, "max": 600, "range_severity": "WARN"},
    },
    "row_rules": [{"name": "id_date_mismatch", "severity": "WARN"}, {"name": "not_local_midnight", "severity": "WARN"}],
}
LINE_CONTRACT = {
    "key": "l_orderkey",
    "columns": {"l_discount": {"type": "float", "max": 0.08, "range_severity": "WARN"}, "l_shipdate": {"type": "date", "required": True, "min": "1996-01-01", "min_severity": "WARN"}, "l_quantity": {"type": "float", "min": 2, "max": 49}},
}


REGION = {"region": "NORTH KESTRIA|UNITED STATES|USA", "region_code": "N K"}
#: limits of the batch and what is known of the pull it came by
LIMITS = {"batch_gates": {"max_error_rate": 0.01, "require_reconciled_count": True, "max_staleness_days": 10, "expected_fingerprint": "76fd6e617cc7"}, "deadlines": {"month_settle_days": 30}, "volume": {"trailing_months": 6, "robust_z_warn": 2.5}}
FETCHED, REVIEWED = "2026-10-01T12:00:00", {"2026-02": "known low"}


def _snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "incident_snapshots")


def _last(spark: SparkSession, sf_dir: str, back: int = 0) -> DataFrame:
    """The rows of the last snapshot, or of one before it, by a literal that reaches the scan."""
    rows, name = _snapshots(spark, sf_dir), None
    for _ in range(back + 1):
        older = rows if name is None else rows.where(F.col("snapshot") < name)
        name = older.agg(F.max("snapshot")).first()[0]
    return rows.where(F.col("snapshot").eqNullSafe(F.lit(name).cast("string")) & F.lit(name is not None))


def map_columns_orders(spark, sf_dir):
    named = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("Case #"), F.col("o_orderdate").alias("Report Date"), F.col("o_orderstatus").alias("NIBRS Code"), F.col("o_totalprice").alias("Loss"))
    return schema.map_columns(named)[0].select("incident_id", F.to_date("date_reported").alias("date_reported"), "offense_code")


def offense_groups(spark, sf_dir):
    return _snapshots(spark, sf_dir).groupBy("snapshot", text.offense_group(F.col("offense_code")).alias("offense_group")).agg(F.count("*").alias("n"))


def monthly_counts(spark, sf_dir):
    return monthly.monthly_counts(_last(spark, sf_dir), AS_OF)


def trailing_12_change(spark, sf_dir):
    months = monthly_counts(spark, sf_dir)
    every = [monthly.trailing_12_change(months, g).withColumn("group", F.lit(g)) for g in monthly.GROUPS]
    return every[0].unionByName(every[1]).select("group", "last_12", "prior_12", F.round("pct_change", 6).alias("pct_change"), "window_from", "window_to")


def unfounded_share(spark, sf_dir):
    return monthly.unfounded_share(_snapshots(spark, sf_dir)).select("n", "unfounded", F.round("pct", 6).alias("pct"))


def volume_anomalies(spark, sf_dir):
    out = timeliness.volume_anomalies(timeliness.monthly_volume(table(spark, sf_dir, "orders"), "o_orderdate"))
    return out.select("month", "n", F.round("per_day", 6).alias("per_day"), F.round("trailing_median", 6).alias("trailing_median"), F.round("robust_z", 6).alias("robust_z"), "flag")


def daily_gaps(spark, sf_dir):
    return timeliness.daily_gaps(table(spark, sf_dir, "orders"), "o_orderdate")


def file_deadlines(spark, sf_dir):
    files = table(spark, sf_dir, "agency_files").groupBy("file_id", "period").agg(F.min("received_at").alias("received"))
    return files.select("file_id", timeliness.deadline(F.col("period"), F.col("received")).alias("d")).select("file_id", "d.due", "d.status", "d.days_late")


def settled_months(spark, sf_dir):
    months = _snapshots(spark, sf_dir).where("date_reported IS NOT NULL").select(F.trunc(F.to_date("date_reported"), "MM").alias("month")).distinct()
    return months.withColumn("settled", timeliness.settled(F.col("month"), AS_OF))


def freshness(spark, sf_dir):
    out = timeliness.freshness(table(spark, sf_dir, "orders"), "o_orderdate", F.lit("2001-08-15 12:00:00"))
    return out.select(F.to_date("newest").alias("newest"), "days", "fresh")


def validate_exceptions(spark, sf_dir):
    return contract.validate(_last(spark, sf_dir), CONTRACT, AS_OF)


def audit_summary(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    out = contract.summary(contract.validate(rows, LINE_CONTRACT, AS_OF), rows.count())
    return out.select("rule", "severity", "rows", F.round("pct", 6).alias("pct"))


def quarantine_rate(spark, sf_dir):
    rows = _last(spark, sf_dir)
    return contract.error_rate(rows, contract.validate(rows, CONTRACT, AS_OF)).select("rows", "quarantined", F.round("rate", 6).alias("rate"))


def clean_incidents(spark, sf_dir):
    rows = _last(spark, sf_dir)
    return contract.clean_rows(rows, contract.validate(rows, CONTRACT, AS_OF), "incident_id").select("incident_id", "offense_code")


def _diff(spark, sf_dir):
    return restatement.diff_snapshots(_last(spark, sf_dir, 1), _last(spark, sf_dir))


def snapshot_added(spark, sf_dir):
    return _diff(spark, sf_dir).added


def snapshot_removed(spark, sf_dir):
    return _diff(spark, sf_dir).removed


def restatements(spark, sf_dir):
    return _diff(spark, sf_dir).restatements.select("month", "group", "old", "new", "delta")


def diff_changed_fields(spark, sf_dir):
    return _diff(spark, sf_dir).changed


def diff_headline(spark, sf_dir):
    return restatement.headline(_diff(spark, sf_dir))


def _people(spark, sf_dir):
    return table(spark, sf_dir, "synth_a").unionByName(table(spark, sf_dir, "synth_b"))


def batch_gates(spark, sf_dir):
    """Verdicts on the last snapshot: audited, and compared with the one before."""
    rows = _last(spark, sf_dir)
    manifest = {"server_count": 1, "rows_fetched": 1, "fetched_at": FETCHED, "schema_fingerprint": schema.schema_fingerprint(rows.columns)}
    return gates.audit(rows, CONTRACT | LIMITS, AS_OF, manifest, _diff(spark, sf_dir), REVIEWED)[1].select("gate", "status")


def file_gates(spark, sf_dir):
    """Which agency files came late, by their first delivery."""
    files = table(spark, sf_dir, "agency_files").groupBy("file_id", "period").agg(F.min("received_at").alias("received"))
    return gates.file_deadline(files)


def link_quality(spark, sf_dir):
    """Linkage of two labelled sources of invented persons, as many as synth_a has records, at the published threshold."""
    n = table(spark, sf_dir, "synth_a").count()
    a, b = (cut(side) for side in people.labelled_sources(spark, n, seed=2026))
    return linkage.quality(linkage.link(a, b, 0.65)[0], evaluation.truth_pairs(a, b))


def normalized_people(spark, sf_dir):
    names = _people(spark, sf_dir).select("rec_id", *[text.normalize_person_name(F.col(f"{c}_name")).alias(c) for c in ("first", "last")])
    return names.select("rec_id", F.col("first.name").alias("first"), F.col("first.suffix").alias("first_suffix"), F.col("last.name").alias("last"), F.col("last.suffix").alias("last_suffix"))


def normalized_addresses(spark, sf_dir):
    every = _people(spark, sf_dir).select(F.col("rec_id").alias("id"), "address").unionByName(table(spark, sf_dir, "incidents").select(F.col("incident_id").alias("id"), "address"))
    return every.select("id", text.normalize_address(F.col("address")).alias("a")).select("id", "a.street", "a.unit")


def normalized_agencies(spark, sf_dir):
    return table(spark, sf_dir, "incidents").groupBy(text.normalize_agency(F.col("agency")).alias("agency")).agg(F.count("*").alias("n"))


def jurisdiction_crosswalk(spark, sf_dir):
    cities = table(spark, sf_dir, "incidents").select(F.col("city").alias("raw"))
    return jurisdiction.resolve_places(cities, table(spark, sf_dir, "gazetteer"), **REGION).select("raw", "canonical", "method", F.round("score", 6).alias("score"), "rows")


def jurisdictions(spark, sf_dir):
    """Every incident with the place its city resolves to."""
    return jurisdiction.resolve_column(table(spark, sf_dir, "incidents"), table(spark, sf_dir, "gazetteer"), **REGION)[0].select("incident_id", "city", "jurisdiction")


def jurisdiction_methods(spark, sf_dir):
    return jurisdiction_crosswalk(spark, sf_dir).groupBy("method").agg(F.sum("rows").alias("rows"))


def jaro_winkler_pairs(spark, sf_dir):
    """Family names of both person sources that share a birth date."""
    a, b = (table(spark, sf_dir, n).where("dob IS NOT NULL AND trim(dob) <> '' AND last_name <> ''").select("dob", F.upper("last_name").alias(c)).distinct() for n, c in (("synth_a", "a"), ("synth_b", "b")))
    pairs = a.join(b, "dob").select("a", "b").distinct()
    return pairs.select("a", "b", F.round(jaro_winkler(F.col("a"), F.col("b")), 6).alias("similarity"))


def blocking_stats(spark, sf_dir):
    a, b = (linkage.prepare(table(spark, sf_dir, n)) for n in ("synth_a", "synth_b"))
    pairs = linkage.candidate_pairs(a, b).agg(F.count("*").alias("candidates"))
    sizes = table(spark, sf_dir, "synth_a").agg(F.count("*").alias("n")).crossJoin(table(spark, sf_dir, "synth_b").agg(F.count("*").alias("m")))  # one row each
    return pairs.crossJoin(sizes).withColumn("reduction_ratio", F.round(1 - F.col("candidates") / (F.col("n") * F.col("m")), 5))


def person_links(spark, sf_dir):
    return linkage.link(table(spark, sf_dir, "synth_a"), table(spark, sf_dir, "synth_b"), 0.65)[0].select("rec_id_a", "rec_id_b", "score", "needs_review")


def exact_links(spark, sf_dir):
    """Exact-join baseline on names and birth date."""
    return evaluation.exact_links(table(spark, sf_dir, "synth_a"), table(spark, sf_dir, "synth_b"))


def _judged(spark, sf_dir):
    """(links, truth, scored, second source): the exact links held against records that share birth date and zip."""
    a, b = table(spark, sf_dir, "synth_a"), table(spark, sf_dir, "synth_b")
    person = F.when((F.trim("dob") != "") & (F.trim("zip") != ""), F.concat_ws("/", "dob", "zip"))
    a, b = (df.withColumn("pid", person) for df in (a, b))
    b = b.withColumn("corruption", F.element_at(F.array(*map(F.lit, ("none", "typo", "typo+moved"))), (F.length(F.coalesce("last_name", F.lit(""))) % 3 + 1).cast("int")))
    links, truth = evaluation.exact_links(a, b), evaluation.truth_pairs(a, b)
    names = lambda df, s: df.select(F.col("rec_id").alias(f"rec_id_{s}"), F.coalesce(F.upper("last_name"), F.lit("")).alias(f"last_{s}"))
    scored = links.join(names(a, "a"), "rec_id_a").join(names(b, "b"), "rec_id_b").where("last_a <> '' AND last_b <> ''").select("rec_id_a", "rec_id_b", F.round(jaro_winkler(F.col("last_a"), F.col("last_b")), 6).alias("score"))
    return links, truth, scored, b


def link_rates(spark, sf_dir):
    links, truth, _, _ = _judged(spark, sf_dir)
    return linkage.quality(links, truth)


def wrong_links(spark, sf_dir):
    links, truth, scored, _ = _judged(spark, sf_dir)
    return evaluation.false_positives(links, truth, scored)


def missed_links(spark, sf_dir):
    links, truth, scored, _ = _judged(spark, sf_dir)
    return evaluation.false_negatives(links, truth, scored)


def link_recall(spark, sf_dir):
    links, truth, _, b = _judged(spark, sf_dir)
    return evaluation.recall_by_corruption(truth, links, b).select("corruption", "true_pairs", F.round("recall", 6).alias("recall"))


def link_blocking(spark, sf_dir):
    links, truth, _, _ = _judged(spark, sf_dir)
    return evaluation.blocking(links, truth, table(spark, sf_dir, "synth_a").count(), table(spark, sf_dir, "synth_b").count())


def field_fingerprints(spark, sf_dir):
    """Order-insensitive fingerprint of the fields of each file."""
    fields = drift.field_profile(drift.ingest(table(spark, sf_dir, "agency_files"), origin=True))
    return fields.groupBy("file_id").agg(F.substring(F.sha2(F.array_join(F.array_sort(F.collect_set(schema.header_key(F.col("field")))), "|"), 256), 1, 12).alias("fingerprint"))


QUERIES = {
    f.__name__: f
    for f in (
        map_columns_orders, offense_groups, monthly_counts, trailing_12_change, unfounded_share, volume_anomalies, daily_gaps, file_deadlines, settled_months, freshness, validate_exceptions,
        audit_summary, quarantine_rate, clean_incidents, snapshot_added, snapshot_removed, restatements, diff_changed_fields, diff_headline, normalized_people, normalized_addresses,
        normalized_agencies, batch_gates, file_gates, link_quality, link_rates, wrong_links, missed_links, link_recall, link_blocking, jurisdictions, jurisdiction_crosswalk, jurisdiction_methods, jaro_winkler_pairs, blocking_stats, person_links, exact_links, field_fingerprints,
    )
}

_GROUP = """CASE WHEN offense_code IS NULL THEN 'unknown' WHEN upper(trim(offense_code, ' ')) IN ('09A','11A','11B','11C','120','13A') THEN 'violent'
    WHEN upper(trim(offense_code, ' ')) IN ('200','220','23A','23B','23C','23D','23E','23F','23G','23H','240') THEN 'property'
    WHEN regexp_full_match(upper(trim(offense_code, ' ')), '8[0-9][0-9]') THEN 'non_criminal' ELSE 'other_criminal' END"""
_LAST = "(SELECT * FROM incident_snapshots WHERE snapshot = (SELECT max(snapshot) FROM incident_snapshots))"
_BEFORE = "(SELECT * FROM incident_snapshots WHERE snapshot = (SELECT max(snapshot) FROM incident_snapshots WHERE snapshot < (SELECT max(snapshot) FROM incident_snapshots)))"
_MONTHLY = f"""SELECT date_trunc('month', date_reported)::DATE AS month, count(*) FILTER (g = 'property') AS property, count(*) FILTER (g = 'violent') AS violent,
    date_diff('day', last_day(date_trunc('month', date_reported)::DATE), DATE '2026-10-01') >= 30 AS settled
    FROM (SELECT date_reported, {_GROUP} AS g FROM {_LAST} WHERE upper(coalesce(clearance_status, '')) <> 'UNFOUNDED') WHERE g IN ('property', 'violent') AND date_reported IS NOT NULL
    GROUP BY 1, 4 HAVING last_day(date_trunc('month', min(date_reported))::DATE) <= (SELECT max(date_reported)::DATE FROM {_LAST})"""
_ERRORS = f"""SELECT DISTINCT coalesce(incident_id, '<null>') AS k FROM (SELECT *, count(*) OVER (PARTITION BY incident_id) AS c FROM {_LAST})
    WHERE incident_id IS NULL OR date_reported IS NULL OR offense_code IS NULL OR (incident_id IS NOT NULL AND c > 1) OR date_reported > TIMESTAMP '2026-10-02' OR date_reported < TIMESTAMP '2000-01-01'"""
_DIFF = f"""o AS (SELECT * FROM {_BEFORE} WHERE date_reported IS NOT NULL QUALIFY row_number() OVER (PARTITION BY incident_id ORDER BY date_reported NULLS FIRST, offense_code NULLS FIRST, clearance_status NULLS FIRST) = 1),
    n AS (SELECT * FROM {_LAST} WHERE date_reported <= (SELECT max(date_reported) FROM {_BEFORE}) QUALIFY row_number() OVER (PARTITION BY incident_id ORDER BY date_reported NULLS FIRST, offense_code NULLS FIRST, clearance_status NULLS FIRST) = 1)"""

_STREETS = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in text.STREET_WORDS.items()) + "}"
_SQUASH = "trim(regexp_replace(regexp_replace({}, '[^A-Z0-9# ]+', ' ', 'g'), ' +', ' ', 'g'))"
_PERSON = "string_split(" + _SQUASH.format("upper(strip_accents(replace(replace(coalesce({}, ''), '-', ' '), '''', '')))") + ", ' ')"
_UNITS = r"(?:\b(?:APT|APARTMENT|UNIT|STE|SUITE|LOT|RM|ROOM)\b|#)\s*#?\s*([A-Z0-9-]+)\b"
_CONTRACT_ROWS = f"""WITH l AS (SELECT *, count(*) OVER (PARTITION BY incident_id) AS copies, coalesce(incident_id, '<null>') AS k, date_reported::VARCHAR AS shown, try_strptime(substr(incident_id, 1, 8), '%Y%m%d')::DATE AS told FROM {_LAST})
    SELECT k AS record_key, 'required_null' AS rule, 'ERROR' AS severity, 'incident_id' AS "column", NULL AS value FROM l WHERE incident_id IS NULL
    UNION ALL SELECT k, 'format', 'WARN', 'incident_id', incident_id FROM l WHERE NOT regexp_full_match(incident_id, '[0-9]{{8}}-[0-9]{{4}}-[0-9]{{2}}')
    UNION ALL SELECT k, 'required_null', 'ERROR', 'date_reported', NULL FROM l WHERE date_reported IS NULL
    UNION ALL SELECT k, 'future_date', 'ERROR', 'date_reported', shown FROM l WHERE date_reported > TIMESTAMP '2026-10-02'
    UNION ALL SELECT k, 'implausibly_old', 'ERROR', 'date_reported', shown FROM l WHERE date_reported < TIMESTAMP '2000-01-01'
    UNION ALL SELECT k, 'required_null', 'ERROR', 'offense_code', NULL FROM l WHERE offense_code IS NULL
    UNION ALL SELECT k, 'format', 'WARN', 'offense_code', offense_code FROM l WHERE NOT regexp_full_match(offense_code, '[0-9]{{2}}[A-Z]|[0-9]{{3}}')
    UNION ALL SELECT k, 'out_of_range', 'WARN', 'zip', zip FROM l WHERE try_cast(zip AS DOUBLE) < 200 OR try_cast(zip AS DOUBLE) > 600
    UNION ALL SELECT k, 'id_date_mismatch', 'WARN', 'incident_id', incident_id FROM l WHERE told IS NOT NULL AND told IS DISTINCT FROM date_reported::DATE
    UNION ALL SELECT k, 'not_local_midnight', 'WARN', 'date_reported', shown FROM l WHERE date_reported <> date_trunc('day', date_reported)
    UNION ALL SELECT k, 'duplicate_key', 'ERROR', 'incident_id', incident_id FROM l WHERE incident_id IS NOT NULL AND copies > 1"""
#: the tiers, fuzzy ones by rows of the table of longest common subsequences
_CROSSWALK = """RECURSIVE raws AS (SELECT coalesce(city, '') AS raw, count(*) AS rows FROM incidents GROUP BY 1),
    c AS (SELECT raw, rows, nullif(regexp_extract(upper(raw), '\\b([0-9]{5})(?:-?[0-9]{4})?\\b', 1), '') AS zip5,
        trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(upper(raw), '[0-9]+', ' ', 'g'), '\\b(?:NORTH KESTRIA|UNITED STATES|USA)\\b', ' ', 'g'), ',?\\s*\\bN\\.?\\s*K\\b\\.?', ' ', 'g'), '[^A-Z]+', ' ', 'g')) AS name FROM raws),
    forms AS (SELECT name, min(canonical) AS exact FROM (SELECT canonical, canonical AS name FROM gazetteer UNION SELECT canonical, alias FROM gazetteer WHERE alias IS NOT NULL) GROUP BY 1),
    zips AS (SELECT zip5, min(canonical) AS by_zip FROM (SELECT DISTINCT canonical, unnest(zips) AS zip5 FROM gazetteer) GROUP BY 1 HAVING count(*) = 1),
    listed AS (SELECT DISTINCT canonical FROM gazetteer), open AS (SELECT DISTINCT name FROM c WHERE name <> '' AND name NOT IN (SELECT name FROM forms)),
    begun AS (SELECT name, count(*) AS n, min(canonical) AS by_prefix FROM open, listed WHERE length(canonical) >= 6 AND starts_with(name, canonical) GROUP BY 1),
    dp(a, b, i, row) AS (SELECT name, canonical, 0, list_transform(range(length(canonical)), lambda x: 0) FROM open, listed
        UNION ALL SELECT a, b, i + 1, list_transform(range(1, length(b) + 1), lambda j: list_max(list_transform(range(1, j + 1), lambda k: greatest(row[k], (CASE WHEN k > 1 THEN row[k - 1] ELSE 0 END) + (substr(a, i + 1, 1) = substr(b, k, 1))::INTEGER)))) FROM dp WHERE i < length(a)),
    ratio AS (SELECT a AS name, b AS canonical, 200.0::DOUBLE * row[length(b)] / (length(a) + length(b)) AS r FROM dp WHERE i = length(a)),
    ranked AS (SELECT *, row_number() OVER w AS k, coalesce(lead(r) OVER w, 0) AS second FROM ratio WINDOW w AS (PARTITION BY name ORDER BY r DESC, canonical)),
    x AS (SELECT c.raw, c.rows, CASE WHEN exact IS NOT NULL THEN 'exact' WHEN begun.n = 1 THEN 'prefix' WHEN length(c.name) >= 4 AND r >= 80 AND r - second >= 10 THEN 'fuzzy' WHEN by_zip IS NOT NULL THEN 'zip' ELSE 'unresolved' END AS method, exact, by_prefix, canonical, r, by_zip
        FROM c LEFT JOIN forms USING (name) LEFT JOIN begun USING (name) LEFT JOIN (SELECT * FROM ranked WHERE k = 1) USING (name) LEFT JOIN zips USING (zip5)),
    crosswalk AS (SELECT raw, CASE method WHEN 'exact' THEN exact WHEN 'prefix' THEN by_prefix WHEN 'fuzzy' THEN canonical WHEN 'zip' THEN by_zip END AS canonical, method, round(CASE method WHEN 'exact' THEN 100 WHEN 'prefix' THEN 80 WHEN 'fuzzy' THEN r WHEN 'zip' THEN 70 ELSE 0 END::DOUBLE, 6) AS score, rows FROM x)"""

def _sounded(x: str) -> str:
    """SQL of the four-place sound code of an upper-case word."""
    codes = f"translate(regexp_replace({x}, '[^A-Z]', 'E', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '01230127022455012623017202')"
    body = f"substr({codes}, 1, 1) || replace(substr({codes}, 2), '7', '')"
    for d in "123456":
        body = f"regexp_replace({body}, '{d}{d}+', '{d}', 'g')"
    return f"CASE WHEN {x} = '' THEN '' WHEN NOT regexp_matches({x}, '^[A-Z]') THEN {x} ELSE substr({x}, 1, 1) || rpad(substr(replace(substr({body}, 2), '0', ''), 1, 3), 3, '0') END"


_NICKNAMES = "MAP {" + ", ".join(f"'{a}': '{b}'" for a, b in linkage.NICKNAMES.items()) + "}"
_JUDGED = f"""s AS (SELECT 'a' AS s, * FROM synth_a UNION ALL SELECT 'b', * FROM synth_b),
    p AS (SELECT rec_id, s, list_filter({_PERSON.format('first_name')}, lambda x: x NOT IN ('JR','SR','II','III','IV')) AS f, array_to_string(list_filter({_PERSON.format('last_name')}, lambda x: x NOT IN ('JR','SR','II','III','IV')), ' ') AS last, CASE WHEN dob = 'nan' THEN '' ELSE coalesce(dob, '') END AS dob, CASE WHEN trim(dob) <> '' AND trim(zip) <> '' THEN dob || '/' || zip END AS pid,
        upper(coalesce(last_name, '')) AS name, ['none', 'typo', 'multiple'][length(coalesce(last_name, '')) % 3 + 1] AS corruption FROM s), q AS (SELECT *, coalesce(f[1], '') AS first FROM p),
    links AS (SELECT DISTINCT a.rec_id AS rec_id_a, b.rec_id AS rec_id_b, CASE WHEN a.name <> '' AND b.name <> '' THEN round(jaro_winkler_similarity(a.name, b.name), 6) END AS score FROM q a JOIN q b ON a.s = 'a' AND b.s = 'b' AND a.first = b.first AND a.last = b.last AND a.dob = b.dob),
    truth AS (SELECT DISTINCT a.rec_id AS rec_id_a, b.rec_id AS rec_id_b, b.corruption FROM q a JOIN q b ON a.s = 'a' AND b.s = 'b' AND a.pid = b.pid),
    counts AS (SELECT (SELECT count(*) FROM links SEMI JOIN truth USING (rec_id_a, rec_id_b)) AS tp, (SELECT count(*) FROM links ANTI JOIN truth USING (rec_id_a, rec_id_b)) AS fp, (SELECT count(*) FROM truth ANTI JOIN links USING (rec_id_a, rec_id_b)) AS fn)"""
_SUFFIX = "x IN ('JR','SR','II','III','IV')"

ORACLES = {
    "link_rates": f"WITH {_JUDGED}, r AS (SELECT tp, fp, fn, coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS p, coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS r FROM counts) SELECT tp, fp, fn, round(p, 4) AS precision, round(r, 4) AS recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0), 4) AS f1 FROM r",
    "wrong_links": f"WITH {_JUDGED} SELECT rec_id_a, rec_id_b, score FROM links ANTI JOIN truth USING (rec_id_a, rec_id_b) WHERE score IS NOT NULL",
    "missed_links": f"WITH {_JUDGED} SELECT rec_id_a, rec_id_b, NULL::DOUBLE AS score FROM truth ANTI JOIN links USING (rec_id_a, rec_id_b)",
    "link_recall": f"WITH {_JUDGED} SELECT corruption, count(*) AS true_pairs, round(avg((l.rec_id_a IS NOT NULL)::INTEGER), 6) AS recall FROM truth t LEFT JOIN links l USING (rec_id_a, rec_id_b) GROUP BY 1",
    "link_blocking": f"WITH {_JUDGED} SELECT tp + fp AS candidate_pairs, (SELECT count(*) FROM synth_a) * (SELECT count(*) FROM synth_b) AS all_pairs, round(1 - (tp + fp)::DOUBLE / ((SELECT count(*) FROM synth_a) * (SELECT count(*) FROM synth_b)), 5) AS reduction_ratio, round(tp::DOUBLE / greatest(tp + fn, 1), 4) AS pair_completeness FROM counts",
    "blocking_stats": f"""WITH s AS (SELECT 'a' AS s, * FROM synth_a UNION ALL SELECT 'b', * FROM synth_b),
        t AS (SELECT s, rec_id, list_filter({_PERSON.format('first_name')}, lambda x: NOT {_SUFFIX}) AS f, array_to_string(list_filter({_PERSON.format('last_name')}, lambda x: NOT {_SUFFIX}), ' ') AS last, CASE WHEN dob = 'nan' THEN '' ELSE coalesce(dob, '') END AS dob, substr(coalesce(zip, ''), 1, 5) AS zip,
            replace(regexp_replace(upper(strip_accents(coalesce(address, ''))), '[^\\x00-\\x7F]', '', 'g'), '.', '') AS p FROM s),
        u AS (SELECT s, rec_id, last, dob, zip, coalesce({_NICKNAMES}[f[1]], f[1], '') AS canon, regexp_extract({_SQUASH.format(f"replace(regexp_replace(p, '{_UNITS}', ''), '#', ' ')")}, '^([0-9]+)', 1) AS number FROM t),
        v AS (SELECT s, rec_id, unnest([CASE WHEN last <> '' AND trim(substr(dob, 1, 4)) <> '' THEN '0|' || {_sounded('last')} || '|' || substr(dob, 1, 4) END, CASE WHEN trim(substr(canon, 1, 1) || zip) <> '' THEN '1|' || substr(canon, 1, 1) || zip END,
            CASE WHEN trim(number || zip) <> '' THEN '2|' || number || zip END, CASE WHEN trim(dob) <> '' THEN '3|' || dob END, CASE WHEN canon || last <> '' THEN '4|' || array_to_string(list_sort([{_sounded('canon')}, {_sounded('last')}]), ' ') END]) AS key FROM u),
        c AS (SELECT count(*) AS candidates FROM (SELECT DISTINCT a.rec_id, b.rec_id FROM v a JOIN v b USING (key) WHERE a.s = 'a' AND b.s = 'b')), n AS (SELECT count(*) FILTER (s = 'a') AS n, count(*) FILTER (s = 'b') AS m FROM s)
        SELECT candidates, n, m, round(1 - candidates::DOUBLE / (n * m), 5) AS reduction_ratio FROM c, n""",
    "validate_exceptions": _CONTRACT_ROWS,
    "diff_headline": f"""WITH {_DIFF}, g AS (SELECT count(*) FILTER (coalesce(a.n, 0) <> coalesce(b.n, 0)) AS restated FROM (SELECT date_trunc('month', date_reported) AS m, {_GROUP} AS g, count(*) AS n FROM o GROUP BY 1, 2) a FULL JOIN (SELECT date_trunc('month', date_reported) AS m, {_GROUP} AS g, count(*) AS n FROM n GROUP BY 1, 2) b USING (m, g))
        SELECT (SELECT count(*) FROM n ANTI JOIN o USING (incident_id)) AS added, (SELECT count(*) FROM o ANTI JOIN n USING (incident_id)) AS removed,
        (SELECT count(*) FROM o JOIN n USING (incident_id) WHERE o.date_reported IS DISTINCT FROM n.date_reported OR o.offense_code IS DISTINCT FROM n.offense_code OR o.clearance_status IS DISTINCT FROM n.clearance_status) AS changed, (SELECT restated FROM g) AS restated""",
    "normalized_addresses": f"""WITH s AS (SELECT id, replace(regexp_replace(upper(strip_accents(coalesce(address, ''))), '[^\\x00-\\x7F]', '', 'g'), '.', '') AS p FROM (SELECT rec_id AS id, address FROM synth_a UNION ALL SELECT rec_id, address FROM synth_b UNION ALL SELECT incident_id, address FROM incidents))
        SELECT id, array_to_string(list_transform(string_split({_SQUASH.format(f"replace(regexp_replace(p, '{_UNITS}', ''), '#', ' ')")}, ' '), lambda w: coalesce({_STREETS}[w], w)), ' ') AS street, nullif(regexp_extract(p, '{_UNITS}', 1), '') AS unit FROM s""",
    "jurisdiction_crosswalk": f"WITH {_CROSSWALK} SELECT * FROM crosswalk",
    "jurisdiction_methods": f"WITH {_CROSSWALK} SELECT method, sum(rows)::BIGINT AS rows FROM crosswalk GROUP BY 1",
    "jurisdictions": f"WITH {_CROSSWALK} SELECT incident_id, city, canonical AS jurisdiction FROM incidents JOIN crosswalk ON coalesce(city, '') = raw",
    "exact_links": f"""WITH p AS (SELECT rec_id, s, list_filter({_PERSON.format('first_name')}, lambda x: x NOT IN ('JR','SR','II','III','IV')) AS f, array_to_string(list_filter({_PERSON.format('last_name')}, lambda x: x NOT IN ('JR','SR','II','III','IV')), ' ') AS last, CASE WHEN dob = 'nan' THEN '' ELSE coalesce(dob, '') END AS dob
            FROM (SELECT 'a' AS s, * FROM synth_a UNION ALL SELECT 'b', * FROM synth_b)), q AS (SELECT rec_id, s, coalesce(f[1], '') AS first, last, dob FROM p)
        SELECT a.rec_id AS rec_id_a, b.rec_id AS rec_id_b FROM q a JOIN q b ON a.s = 'a' AND b.s = 'b' AND a.first = b.first AND a.last = b.last AND a.dob = b.dob""",
    "field_fingerprints": """WITH f AS (SELECT file_id, payload FROM agency_files QUALIFY received_at = max(received_at) OVER (PARTITION BY file_id)),
        k AS (SELECT DISTINCT file_id, trim(regexp_replace(lower(trim(k)), '[^a-z0-9]+', '_', 'g'), '_') AS h FROM (SELECT file_id, unnest(json_keys(payload)) AS k FROM f WHERE json_valid(payload)))
        SELECT file_id, substr(sha256(string_agg(h, '|' ORDER BY h)), 1, 12) AS fingerprint FROM k GROUP BY 1""",
    "file_gates": """WITH f AS (SELECT file_id, period, min(received_at) AS r FROM agency_files GROUP BY 1, 2), d AS (SELECT *, ((period || '-01')::DATE + INTERVAL 1 MONTH + INTERVAL 14 DAY)::DATE AS due FROM f), l AS (SELECT *, greatest(date_diff('day', due, r::DATE), 0) AS late FROM d)
        SELECT 'file_deadline' AS gate, CASE WHEN late > 0 THEN 'WARN' ELSE 'PASS' END AS status, file_id || ': period ' || period || ' due ' || due || CASE WHEN late > 0 THEN ', days late: ' || late ELSE '' END AS detail FROM l""",
    "batch_gates": f"""WITH {_DIFF}, l AS (SELECT * FROM {_LAST}), e AS ({_ERRORS}),
        m AS (SELECT date_trunc('month', date_reported)::DATE AS month, count(*)::DOUBLE / day(last_day(date_trunc('month', date_reported)::DATE)) AS per_day FROM l WHERE date_reported IS NOT NULL GROUP BY date_trunc('month', date_reported)),
        s AS (SELECT *, median(per_day) OVER w AS med, mad(per_day) OVER w AS mad, row_number() OVER (ORDER BY month) AS k FROM m WHERE date_diff('day', last_day(month), DATE '2026-10-01') >= 30 WINDOW w AS (ORDER BY month ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING)),
        v AS (SELECT month FROM s WHERE k > 6 AND abs(0.6745 * (per_day - med) / (CASE WHEN mad = 0 THEN 1 ELSE mad END)) > 2.5),
        d AS (SELECT count(DISTINCT date_reported::DATE) AS seen, date_diff('day', min(date_reported)::DATE, max(date_reported)::DATE) + 1 AS every FROM l),
        r AS (SELECT count(*) AS n FROM (SELECT date_trunc('month', date_reported) AS m, {_GROUP} AS g, count(*) AS n FROM o GROUP BY 1, 2) a FULL JOIN (SELECT date_trunc('month', date_reported) AS m, {_GROUP} AS g, count(*) AS n FROM n GROUP BY 1, 2) b USING (m, g) WHERE coalesce(a.n, 0) <> coalesce(b.n, 0))
        SELECT 'error_rate' AS gate, CASE WHEN (SELECT count(*) FROM e)::DOUBLE / greatest((SELECT count(*) FROM l), 1) <= 0.01 THEN 'PASS' ELSE 'FAIL' END AS status
        UNION ALL SELECT 'reconciled_count', 'PASS' UNION ALL SELECT 'schema_fingerprint', 'WARN'
        UNION ALL SELECT 'freshness', CASE WHEN floor((epoch(TIMESTAMP '2026-10-01 12:00:00') - epoch((SELECT max(date_reported) FROM l))) / 86400) <= 10 THEN 'PASS' ELSE 'FAIL' END
        UNION ALL SELECT 'volume_anomaly', CASE WHEN strftime(month, '%Y-%m') = '2026-02' THEN 'REVIEWED' ELSE 'WARN' END FROM v UNION ALL SELECT 'volume_anomaly', 'PASS' WHERE (SELECT count(*) FROM v) = 0
        UNION ALL SELECT 'daily_gaps', CASE WHEN seen = every THEN 'PASS' ELSE 'FAIL' END FROM d UNION ALL SELECT 'restatements', CASE WHEN n = 0 THEN 'PASS' ELSE 'WARN' END FROM r""",
    "map_columns_orders": "SELECT o_orderkey AS incident_id, o_orderdate::DATE AS date_reported, o_orderstatus AS offense_code FROM orders",
    "offense_groups": f"SELECT snapshot, {_GROUP} AS offense_group, count(*) AS n FROM incident_snapshots GROUP BY 1, 2",
    "monthly_counts": _MONTHLY,
    "trailing_12_change": " UNION ALL ".join(f"""SELECT '{g}' AS "group", sum({g}) FILTER (k <= 12)::BIGINT AS last_12, sum({g}) FILTER (k BETWEEN 13 AND 24)::BIGINT AS prior_12,
        round(100.0 * (sum({g}) FILTER (k <= 12) - sum({g}) FILTER (k BETWEEN 13 AND 24))::DOUBLE / (sum({g}) FILTER (k BETWEEN 13 AND 24))::DOUBLE, 6) AS pct_change,
        min(month) FILTER (k <= 12) AS window_from, max(month) FILTER (k <= 12) AS window_to FROM (SELECT *, row_number() OVER (ORDER BY month DESC) AS k FROM ({_MONTHLY}) WHERE settled) HAVING count(*) >= 24""" for g in monthly.GROUPS),
    "unfounded_share": f"""SELECT count(*) AS n, count(*) FILTER (upper(coalesce(clearance_status, '')) = 'UNFOUNDED') AS unfounded,
        round(100.0::DOUBLE * count(*) FILTER (upper(coalesce(clearance_status, '')) = 'UNFOUNDED') / greatest(count(*), 1), 6) AS pct FROM incident_snapshots WHERE {_GROUP} IN ('violent', 'property')""",
    "volume_anomalies": """WITH m AS (SELECT date_trunc('month', o_orderdate)::DATE AS month, count(*) AS n FROM orders GROUP BY 1),
        r AS (SELECT *, n::DOUBLE / day(last_day(month)) AS per_day, row_number() OVER (ORDER BY month) AS k FROM m),
        w AS (SELECT *, median(per_day) OVER (ORDER BY month ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS med, mad(per_day) OVER (ORDER BY month ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING) AS mad FROM r),
        z AS (SELECT *, 0.6745::DOUBLE * (per_day - med) / (CASE WHEN mad = 0 THEN 1.0 ELSE mad END) AS z FROM w WHERE k > 12)
        SELECT month, n, round(per_day, 6) AS per_day, round(med, 6) AS trailing_median, round(z, 6) AS robust_z, abs(z) > 3.5 AS flag FROM z""",
    "daily_gaps": """WITH d AS (SELECT o_orderdate::DATE AS day, count(*) AS n FROM orders GROUP BY 1)
        SELECT s.day, 0::BIGINT AS n FROM (SELECT unnest(generate_series((SELECT min(day) FROM d)::TIMESTAMP, (SELECT max(day) FROM d)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day) s ANTI JOIN d USING (day)""",
    "file_deadlines": """WITH f AS (SELECT file_id, period, min(received_at) AS r FROM agency_files GROUP BY 1, 2), d AS (SELECT file_id, r, ((period || '-01')::DATE + INTERVAL 1 MONTH + INTERVAL 14 DAY)::DATE AS due FROM f)
        SELECT file_id, due, CASE WHEN r::DATE > due THEN 'LATE' ELSE 'ON_TIME' END AS status, greatest(date_diff('day', due, r::DATE), 0)::INTEGER AS days_late FROM d""",
    "settled_months": "SELECT DISTINCT date_trunc('month', date_reported)::DATE AS month, date_diff('day', last_day(date_reported::DATE), DATE '2026-10-01') >= 30 AS settled FROM incident_snapshots WHERE date_reported IS NOT NULL",
    "freshness": "SELECT max(o_orderdate)::DATE AS newest, floor((epoch(TIMESTAMP '2001-08-15 12:00:00') - epoch(max(o_orderdate)::TIMESTAMP)) / 86400)::BIGINT AS days, floor((epoch(TIMESTAMP '2001-08-15 12:00:00') - epoch(max(o_orderdate)::TIMESTAMP)) / 86400) <= 10 AS fresh FROM orders",
    "audit_summary": """WITH l AS (SELECT *, count(*) OVER (PARTITION BY l_orderkey) AS c FROM lineitem), n AS (SELECT count(*) AS n FROM lineitem),
        x AS (SELECT 'out_of_range' AS rule, 'WARN' AS severity FROM l WHERE l_discount > 0.08 UNION ALL SELECT 'required_null', 'ERROR' FROM l WHERE l_shipdate IS NULL
        UNION ALL SELECT 'implausibly_old', 'WARN' FROM l WHERE l_shipdate < TIMESTAMP '1996-01-01' UNION ALL SELECT 'out_of_range', 'ERROR' FROM l WHERE l_quantity < 2 OR l_quantity > 49
        UNION ALL SELECT 'duplicate_key', 'ERROR' FROM l WHERE l_orderkey IS NOT NULL AND c > 1)
        SELECT rule, severity, count(*) AS rows, round(100.0::DOUBLE * count(*) / any_value(n.n), 6) AS pct FROM x, n GROUP BY 1, 2""",
    "quarantine_rate": f"SELECT (SELECT count(*) FROM {_LAST}) AS rows, count(*) AS quarantined, round(count(*)::DOUBLE / (SELECT count(*) FROM {_LAST}), 6) AS rate FROM ({_ERRORS})",
    "clean_incidents": f"SELECT incident_id, offense_code FROM {_LAST} WHERE coalesce(incident_id, '<null>') NOT IN ({_ERRORS})",
    "snapshot_added": f"WITH {_DIFF} SELECT incident_id FROM n ANTI JOIN o USING (incident_id)",
    "snapshot_removed": f"WITH {_DIFF} SELECT incident_id FROM o ANTI JOIN n USING (incident_id)",
    "restatements": f"""WITH {_DIFF}, a AS (SELECT date_trunc('month', date_reported)::DATE AS month, {_GROUP} AS "group", count(*) AS old FROM o GROUP BY 1, 2), b AS (SELECT date_trunc('month', date_reported)::DATE AS month, {_GROUP} AS "group", count(*) AS new FROM n GROUP BY 1, 2)
        SELECT month, "group", coalesce(old, 0) AS old, coalesce(new, 0) AS new, coalesce(new, 0) - coalesce(old, 0) AS delta FROM a FULL JOIN b USING (month, "group")""",
    "diff_changed_fields": f"""WITH {_DIFF}, j AS (SELECT o.incident_id, strftime(o.date_reported, '%Y-%m-%d %H:%M:%S') AS a1, strftime(n.date_reported, '%Y-%m-%d %H:%M:%S') AS a2, o.offense_code AS b1, n.offense_code AS b2, o.clearance_status AS c1, n.clearance_status AS c2 FROM o JOIN n USING (incident_id))
        SELECT incident_id, 'date_reported' AS field, a1 AS old, a2 AS new FROM j WHERE a1 IS DISTINCT FROM a2 UNION ALL SELECT incident_id, 'offense_code', b1, b2 FROM j WHERE b1 IS DISTINCT FROM b2 UNION ALL SELECT incident_id, 'clearance_status', c1, c2 FROM j WHERE c1 IS DISTINCT FROM c2""",
    "normalized_people": f"""WITH s AS (SELECT rec_id, {_PERSON.format('first_name')} AS f, {_PERSON.format('last_name')} AS l FROM (SELECT rec_id, first_name, last_name FROM synth_a UNION ALL SELECT rec_id, first_name, last_name FROM synth_b))
        SELECT rec_id, array_to_string(list_filter(f, lambda x: x NOT IN ('JR','SR','II','III','IV')), ' ') AS first, coalesce(list_filter(f, lambda x: x IN ('JR','SR','II','III','IV'))[1], '') AS first_suffix,
        array_to_string(list_filter(l, lambda x: x NOT IN ('JR','SR','II','III','IV')), ' ') AS last, coalesce(list_filter(l, lambda x: x IN ('JR','SR','II','III','IV'))[1], '') AS last_suffix FROM s""",
    "normalized_agencies": """WITH s AS (SELECT trim(regexp_replace(regexp_replace(upper(replace(replace(coalesce(agency, ''), '''', ''), '-', ' ')), '[^A-Z0-9# ]+', ' ', 'g'), ' +', ' ', 'g')) AS a FROM incidents),
        e AS (SELECT regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(a,
        '\\bSHERIFF OFFICE\\b', 'SHERIFFS OFFICE', 'g'), '\\bCMPD\\b', 'CHARLOTTE MECKLENBURG POLICE DEPARTMENT', 'g'), '\\bPOLICE DEPT\\b', 'POLICE DEPARTMENT', 'g'), '\\bDEPT\\b', 'DEPARTMENT', 'g'), '\\bCNTY\\b', 'COUNTY', 'g'), '\\bUNIV\\b', 'UNIVERSITY', 'g'),
        '\\bP D\\b', 'POLICE DEPARTMENT', 'g'), '\\bTWP\\b', 'TOWNSHIP', 'g'), '\\bPD\\b', 'POLICE DEPARTMENT', 'g'), '\\bSO\\b', 'SHERIFFS OFFICE', 'g'), '\\bCO\\b', 'COUNTY', 'g') AS a FROM s)
        SELECT array_to_string(list_filter(string_split(a, ' '), lambda w: w NOT IN ('THE','OF','TOWN','CITY','VILLAGE','NC','NORTH','CAROLINA')), ' ') AS agency, count(*) AS n FROM e GROUP BY 1""",
    "jaro_winkler_pairs": """WITH a AS (SELECT DISTINCT dob, upper(last_name) AS a FROM synth_a WHERE dob IS NOT NULL AND trim(dob) <> '' AND last_name <> ''), b AS (SELECT DISTINCT dob, upper(last_name) AS b FROM synth_b WHERE dob IS NOT NULL AND trim(dob) <> '' AND last_name <> '')
        SELECT DISTINCT a, b, round(jaro_winkler_similarity(a, b), 6) AS similarity FROM a JOIN b USING (dob)""",
}
