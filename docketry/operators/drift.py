"""Schemas that drift between files: rescue-column ingestion and a report of every change.

A raw record is one JSON object. Each of its keys is resolved to what it records (a concept); concepts of the target
schema are cast into typed columns, everything else, and every value that does not cast, is kept untouched as JSON in
``_rescued``. Approved fields can be promoted out of the rescue column later, and rescued values replayed into their
typed columns when a reading for them is known. All of it is row-local: ingestion shuffles nothing.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from docketry.lineage import cut
from docketry.schema import ALIASES, header_key, parted_key

RESCUED = "_rescued"
ORIGIN = "_origin"
MALFORMED = "_malformed"

#: target column -> Spark type; a value that does not cast is rescued
TARGET_TYPES = {c: "string" for c in ("incident_id", "agency", "date_reported", "date_occurred", "offense_code", "offense_desc", "address", "city", "zip", "division", "clearance_status", "clearance_date")} | {"lat": "double", "lon": "double"}

#: paths at which a rescued object holds the value of a target column
REPLAY_PATHS = {"city": ("$.name",), "address": ("$.street",)}


def read_degrees(text: Column) -> Column:
    """Decimal degrees written with a degree sign or a hemisphere letter; south and west are negative. Else null."""
    form = r"^\s*([-+]?\d+(?:\.\d*)?)\s*[°º]?\s*([NSEWnsew]?)\s*$"
    number = F.regexp_extract(text, form, 1).try_cast("double")
    letter = F.upper(F.regexp_extract(text, form, 2))
    return F.when(letter.isin("S", "W"), -F.abs(number)).otherwise(number)


#: how a rescued scalar is read into a target column it did not cast to
REPLAY_READINGS: dict[str, Callable[[Column], Column]] = {"lat": read_degrees, "lon": read_degrees}


def concept_of(key: Column, aliases: Mapping[str, str] = ALIASES) -> Column:
    """Concept a key records: its registered meaning, also with camel case parted, else the parted spelling itself."""
    names = F.create_map(*[F.lit(x) for pair in aliases.items() for x in pair])
    return F.coalesce(names[header_key(key)], names[parted_key(key)], parted_key(key))


def json_kind(value: Column) -> Column:
    """string, number, boolean, object or array; null for a JSON null."""
    # bound once: within a lambda every use of an expression is worked out again
    return F.get(F.transform(F.array(F.schema_of_variant(value)), _kind_of), F.lit(0))


def _kind_of(kind: Column) -> Column:
    return (
        F.when(kind.isNull() | (kind == "VOID"), None)
        .when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind.startswith("OBJECT"), "object")
        .when(kind.startswith("ARRAY"), "array")
        .otherwise("number")
    )


def raw_fields(records: DataFrame, payload: str = "payload") -> DataFrame:
    """Add ``_fields``: map of the payload's keys to variants; null where the payload is no JSON object."""
    return records.withColumn("_fields", F.from_json(payload, "map<string, variant>"))


def ingest(records: DataFrame, payload: str = "payload", aliases: Mapping[str, str] = ALIASES, targets: Mapping[str, str] = TARGET_TYPES, keep: Sequence[str] = ("file_id", "agency", "period", "received_at", "row_no"), only: Sequence[str] | None = None, origin: bool = False) -> DataFrame:
    """Records as the target columns (typed), the ``keep`` columns and ``_rescued`` (JSON object or null).

    A record that is no JSON object has null targets and its text under ``_malformed``. Nulls stay null; an object or
    array where a scalar is expected is rescued under its own key. ``keep`` wins over a target of the same name.
    ``only`` names the concepts the caller wants; keys of others are then neither read nor rescued. ``origin`` adds
    ``_origin``: for each entry the concept, the key as written, the JSON kind and whether it was rescued.
    """
    fields = raw_fields(records, payload)
    if only is not None:
        fields = fields.withColumn("_fields", F.map_filter("_fields", lambda k, _: concept_of(k, aliases).isin(*only)))
    entries = fields.withColumn(
        "_entries",
        F.transform(F.map_entries("_fields"), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"), concept_of(e["key"], aliases).alias("concept"), json_kind(e["value"]).alias("kind"))),
    )
    wanted = [t for t in targets if t not in keep]

    def read(target: str) -> Column:
        kind = targets[target]
        readable = F.filter("_entries", lambda e: (e["concept"] == target) & e["kind"].isin("string", "number", "boolean") & F.try_variant_get(e["value"], "$", kind).isNotNull())
        return F.try_variant_get(F.get(readable, F.lit(0))["value"], "$", kind)

    out = {t: read(t) for t in wanted}
    typed = F.create_map(*[F.lit(x) for t in wanted for x in (t, targets[t])])
    is_read = lambda e: (e["kind"].isNull() & typed[e["concept"]].isNotNull()) | (
        e["kind"].isin("string", "number", "boolean")
        & F.when(typed[e["concept"]] == "string", True).when(typed[e["concept"]] == "double", F.try_variant_get(e["value"], "$", "double").isNotNull()).otherwise(False)
    )
    left = F.filter("_entries", lambda e: ~F.coalesce(is_read(e), F.lit(False)))
    rest = F.to_json(F.map_from_entries(F.transform(left, lambda e: F.struct(e["key"], e["value"]))))
    rescued = F.when(F.col("_fields").isNull() & F.col(payload).isNotNull(), F.to_json(F.create_map(F.lit(MALFORMED), F.col(payload)))).when(F.size(left) > 0, rest)
    told = [F.transform("_entries", lambda e: F.struct(e["concept"], e["key"].alias("field"), e["kind"], (~F.coalesce(is_read(e), F.lit(False))).alias("rescued"))).alias(ORIGIN)] if origin else []
    return entries.select(*keep, *[c.alias(t) for t, c in out.items()], rescued.alias(RESCUED), *told)


def promote(table: DataFrame, fields: Mapping[str, str], aliases: Mapping[str, str] = ALIASES) -> DataFrame:
    """Move approved concepts (name -> type) out of ``_rescued`` into columns; what does not cast stays rescued."""
    entries = table.withColumn("_entries", F.transform(F.map_entries(F.from_json(RESCUED, "map<string, variant>")), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"), concept_of(e["key"], aliases).alias("concept"))))

    def fits(e: Column, name: str) -> Column:
        return F.coalesce((e["concept"] == name) & F.try_variant_get(e["value"], "$", fields[name]).isNotNull(), F.lit(False))

    out = {name: F.try_variant_get(F.get(F.filter("_entries", lambda e: fits(e, name)), F.lit(0))["value"], "$", kind) for name, kind in fields.items()}
    left = F.filter("_entries", lambda e: ~functools.reduce(lambda a, b: a | b, [fits(e, n) for n in fields], F.lit(False)))
    rest = F.when(F.size(left) > 0, F.to_json(F.map_from_entries(F.transform(left, lambda e: F.struct(e["key"], e["value"])))))
    return entries.withColumns(out | {RESCUED: rest}).drop("_entries")


def replay(table: DataFrame, paths: Mapping[str, Sequence[str]] = REPLAY_PATHS, readings: Mapping[str, Callable[[Column], Column]] = REPLAY_READINGS, aliases: Mapping[str, str] = ALIASES) -> DataFrame:
    """Fill null targets from rescued values of the same concept.

    Objects are read at the first path that holds a value, scalars by the reading known for the column. Replayed
    scalars leave ``_rescued``; objects stay, as they hold further members. Columns the table lacks are passed over.
    """
    entries = table.withColumn("_entries", F.transform(F.map_entries(F.from_json(RESCUED, "map<string, variant>")), lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value"), concept_of(e["key"], aliases).alias("concept"))))

    def found(column: str) -> Column:
        return F.get(F.filter("_entries", lambda e: e["concept"] == column), F.lit(0))["value"]

    out = {column: F.coalesce(F.col(column), *[F.try_variant_get(found(column), p, "string") for p in tries]) for column, tries in paths.items() if column in table.columns}
    read = {column: how for column, how in readings.items() if column in table.columns}
    as_text = lambda e: F.when(json_kind(e["value"]) == "string", F.try_variant_get(e["value"], "$", "string"))
    fits = lambda e, column: F.coalesce((e["concept"] == column) & read[column](as_text(e)).isNotNull(), F.lit(False))

    def replayed(column: str) -> Column:
        return F.get(F.transform(F.filter("_entries", lambda e: fits(e, column)), lambda e: read[column](as_text(e))), F.lit(0))

    out |= {column: F.coalesce(F.col(column), replayed(column)) for column in read}
    if read:
        left = F.filter("_entries", lambda e: ~functools.reduce(lambda a, b: a | b, [fits(e, c) for c in read]))
        out[RESCUED] = F.when(F.size(left) > 0, F.to_json(F.map_from_entries(F.transform(left, lambda e: F.struct(e["key"], e["value"])))))
    return entries.withColumns(out).drop("_entries")


def latest_delivery(records: DataFrame, keys: Sequence[str] = ("file_id", "row_no"), received: str = "received_at") -> DataFrame:
    """One row per record: the copy delivered last (ties by payload). Aggregation, so repeats combine before the shuffle."""
    rest = [c for c in records.columns if c not in keys]
    order = [received] + [c for c in rest if c != received]
    best = records.groupBy(*keys).agg(F.max(F.struct(*order)).alias("_r"))
    return best.select(*[c if c in keys else F.col(f"_r.{c}").alias(c) for c in records.columns])


def field_profile(ingested: DataFrame) -> DataFrame:
    """(agency, period, file_id, concept, field, kind): the fields of each file with their JSON type.

    ``ingested`` is a table of ``ingest`` with its ``_origin``, so read and rescued entries both count. Only the last
    delivery of a file speaks for it. A field that is null throughout has a null type. Where values of one field differ
    in type, the most frequent one counts (ties by name).
    """
    cells = ingested.select("agency", "period", "file_id", "received_at", F.inline(ORIGIN))
    counted = cells.groupBy("agency", "period", "file_id", "received_at", "concept", "field", "kind").count()
    best = counted.groupBy("agency", "period", "file_id", "received_at", "concept", "field").agg(F.max(F.when(F.col("kind").isNotNull(), F.struct("count", "kind")))["kind"].alias("kind"))
    last = Window.partitionBy("file_id")  # over a file's fields, not its rows
    newest = best.withColumn("_last", F.max("received_at").over(last)).where(F.col("received_at").eqNullSafe(F.col("_last")))
    return newest.select("agency", "period", "file_id", "concept", "field", "kind")


def compare_files(profile: DataFrame) -> DataFrame:
    """(file_id, before, change, old_field, new_field, old_concept, new_concept, old_kind, new_kind) by registered concepts."""
    files = profile.groupBy("agency", "period", "file_id").agg(F.collect_set(F.struct("concept", "field", "kind")).alias("now"))
    order = Window.partitionBy("agency").orderBy("period", "file_id")
    pairs = files.withColumns({"was": F.lag("now").over(order), "before": F.lag("file_id").over(order)}).where(F.col("was").isNotNull())
    # a file has as many fields as its header, so these arrays are small whatever the number of rows
    same = lambda x, side: F.exists(side, lambda y: (y["concept"] == x["concept"]) & (y["field"] == x["field"]))
    rank = lambda side, other: F.array_sort(F.filter(side, lambda x: ~same(x, other)))
    split = pairs.select("file_id", "before", "was", F.filter("now", lambda x: same(x, F.col("was"))).alias("kept"), rank("now", F.col("was")).alias("came"), rank("was", F.col("now")).alias("went"))
    numbered = lambda side: F.transform(side, lambda x: F.struct(x["concept"].alias("concept"), x["field"].alias("field"), x["kind"].alias("kind"), F.size(F.filter(side, lambda y: (y["concept"] == x["concept"]) & (y["field"] < x["field"]))).alias("n")))
    split = split.withColumns({"came": numbered(F.col("came")), "went": numbered(F.col("went"))})
    partner = lambda x, side: F.get(F.filter(side, lambda y: (y["concept"] == x["concept"]) & (y["n"] == x["n"])), F.lit(0))
    twin = lambda x: F.get(F.filter("was", lambda y: (y["concept"] == x["concept"]) & (y["field"] == x["field"])), F.lit(0))
    nothing = F.struct(F.lit("").alias("field"), F.lit(None).cast("string").alias("concept"), F.lit(None).cast("string").alias("kind"))

    def row(change: str, old: Column, new: Column) -> Column:
        return F.struct(F.lit(change).alias("change"), *[x[k].alias(f"{side}_{k}") for side, x in (("old", old), ("new", new)) for k in ("field", "concept", "kind")])

    retyped = F.transform(F.filter("kept", lambda x: twin(x)["kind"] != x["kind"]), lambda x: row("retyped", twin(x), x))
    moved = F.filter("came", lambda x: partner(x, F.col("went")).isNotNull())
    renamed = F.transform(moved, lambda x: row("renamed", partner(x, F.col("went")), x))
    added = F.transform(F.filter("came", lambda x: partner(x, F.col("went")).isNull()), lambda x: row("added", nothing, x))
    removed = F.transform(F.filter("went", lambda x: partner(x, F.col("came")).isNull()), lambda x: row("removed", x, nothing))
    return split.select("file_id", "before", F.inline(F.concat(retyped, renamed, added, removed)))


#: buckets of a field's values and of their shapes; likeness of two fields that record one thing
BUCKETS, ALIKE = 256, 0.7


def value_likeness(records: DataFrame, wanted: DataFrame, payload: str = "payload") -> DataFrame:
    """(a_file, a, b_file, b, likeness) of pairs of fields by what they hold: shared mass of values and, counted double, of their shapes.

    Every field becomes two histograms of fixed size, one of its values and one of their shapes (digits and letters
    without which); only files of ``wanted`` pairs are read.
    """
    sides = wanted.select(F.col("a_file").alias("file_id"), F.col("a").alias("field")).unionByName(wanted.select(F.col("b_file").alias("file_id"), F.col("b").alias("field"))).distinct()
    some = raw_fields(records.join(sides.select("file_id").distinct(), "file_id", "left_semi"), payload).select("file_id", F.explode("_fields").alias("field", "_v")).join(sides, ["file_id", "field"], "left_semi")
    text = F.upper(F.trim(F.coalesce(F.try_variant_get("_v", "$", "string"), F.to_json("_v"))))
    shape = F.regexp_replace(F.regexp_replace(text, "[0-9]", "9"), "[A-Z]+", "A")
    bucket = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.pmod(F.xxhash64(c), F.lit(BUCKETS)).alias("bucket"))
    held = some.where(json_kind(F.col("_v")).isNotNull()).select("file_id", "field", F.explode(F.array(bucket("value", text), bucket("shape", shape))).alias("x"))
    counts = held.groupBy("file_id", "field", "x.kind", "x.bucket").agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("file_id", "field", "kind"))  # at most BUCKETS rows each
    shares = counts.withColumn("share", share)
    side = lambda x: shares.select(F.col("file_id").alias(f"{x}_file"), F.col("field").alias(x), "kind", "bucket", F.col("share").alias(f"{x}_share"))
    both = wanted.join(side("a"), ["a_file", "a"]).join(side("b"), ["b_file", "b", "kind", "bucket"])
    return both.groupBy("a_file", "a", "b_file", "b").agg((F.sum(F.least("a_share", "b_share") * F.when(F.col("kind") == "shape", 2).otherwise(1)) / 3).alias("likeness"))


def drift(records: DataFrame, payload: str = "payload", aliases: Mapping[str, str] = ALIASES) -> DataFrame:
    """(file_id, change, old_field, new_field): each file against the agency's latest earlier delivered period.

    ``added`` and ``removed`` name one field and leave the other empty; ``renamed`` is any difference in spelling;
    ``retyped`` another JSON type of the non-null values. A field both renamed and retyped gives both rows. A concept
    under several keys in one file is compared key by key, equal spellings first. Where a key is in no registry of
    spellings, a field that went and one that came are one renamed field if their values are alike and each is the
    other's best. The first file of an agency, and files of unreadable records only, have no rows.
    """
    changes = cut(compare_files(field_profile(ingest(records, payload, aliases, origin=True))))
    registered = sorted(set(aliases.values()))
    open_ends = changes.where(F.col("change").isin("added", "removed"))
    side = lambda change, x: open_ends.where(F.col("change") == change).select("file_id", "before", F.col(f"{x}_field").alias(x), F.col(f"{x}_concept").isin(registered).alias(f"{x}_known"), F.col(f"{x}_kind"))
    met = side("removed", "old").join(side("added", "new"), ["file_id", "before"]).where(~(F.col("old_known") & F.col("new_known")))
    wanted = cut(met.select(F.col("before").alias("a_file"), F.col("old").alias("a"), F.col("file_id").alias("b_file"), F.col("new").alias("b"), "old_kind", "new_kind"))
    plain = changes.select("file_id", "change", "old_field", "new_field").unionByName(changes.where((F.col("change") == "renamed") & (F.col("old_kind") != F.col("new_kind"))).select("file_id", F.lit("retyped").alias("change"), "old_field", "new_field"))
    if wanted.isEmpty():  # every key is registered, or nothing went that could have come back
        return plain
    like = value_likeness(records, wanted.select("a_file", "a", "b_file", "b"), payload).where(F.col("likeness") >= ALIKE)
    best = lambda x: F.row_number().over(Window.partitionBy("b_file", x).orderBy(F.col("likeness").desc(), "a", "b"))
    mutual = cut(like.withColumns({"_a": best("a"), "_b": best("b")}).where("_a = 1 AND _b = 1").join(wanted, ["a_file", "a", "b_file", "b"]))
    found = mutual.select(F.col("b_file").alias("file_id"), F.lit("renamed").alias("change"), F.col("a").alias("old_field"), F.col("b").alias("new_field"))
    found = found.unionByName(mutual.where(F.col("old_kind") != F.col("new_kind")).select(F.col("b_file").alias("file_id"), F.lit("retyped").alias("change"), F.col("a").alias("old_field"), F.col("b").alias("new_field")))
    gone = mutual.select(F.col("b_file").alias("file_id"), F.lit("removed").alias("change"), F.col("a").alias("old_field"), F.lit("").alias("new_field"))
    come = mutual.select(F.col("b_file").alias("file_id"), F.lit("added").alias("change"), F.lit("").alias("old_field"), F.col("b").alias("new_field"))
    return plain.join(gone.unionByName(come), ["file_id", "change", "old_field", "new_field"], "left_anti").unionByName(found)
