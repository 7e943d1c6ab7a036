"""Same postal address written differently.

An address is read into house number, direction, street name, type and unit; blocks and crossings name no building.
Street names become weighted character n-grams. An inverted index keyed by house number and the grams of a prefix finds
the candidates: a pair whose cosine reaches the threshold shares a gram of both prefixes. The cosine then decides which
spellings at one house number are one street. Direction, type and place must be compatible, and a part left out is taken
for the only possibility among those spellings or not at all.
"""

from __future__ import annotations

import functools
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.lineage import cut
from docketry.llm.ngrams import damped_weights, pair_cosines, vectors

#: cosine of two spellings of one street at the same house number
SAME_STREET = 0.5

# Street types with their spellings.
TYPES = {
    "AVE": "AV AVE AVEN AVENUE AVN", "BLVD": "BV BLVD BOUL BOULEVARD BLV", "CIR": "CIR CIRCLE CRCL CRC CIRC", "CT": "CT COURT CRT",
    "DR": "DR DRIVE DRV", "LN": "LN LANE", "PKWY": "PKWY PARKWAY PKY PWY PKW", "PL": "PL PLACE", "RD": "RD ROAD", "ST": "ST STREET STR",
    "TER": "TER TERRACE TERR", "WAY": "WY WAY", "HWY": "HWY HIGHWAY", "SQ": "SQ SQUARE", "TRL": "TRL TRAIL", "ALY": "ALY ALLEY",
}
# Directions with their spellings.
DIRECTIONS = {"N": "N NORTH NO", "S": "S SOUTH SO", "E": "E EAST", "W": "W WEST"}
# Written ordinals.
ORDINALS = {"FIRST": "1ST", "SECOND": "2ND", "THIRD": "3RD", "FOURTH": "4TH", "FIFTH": "5TH", "SIXTH": "6TH", "SEVENTH": "7TH", "EIGHTH": "8TH", "NINTH": "9TH", "TENTH": "10TH"}
# Abbreviated words of street names.
NAME_WORDS = {"SAINT": "SAINT", "FT": "FORT", "MT": "MOUNT"}

_TYPE = {w: t for t, words in TYPES.items() for w in words.split()}
_DIRECTION = {w: d for d, words in DIRECTIONS.items() for w in words.split()}
_UNIT = re.compile(r"(?:\b(?:APT|APARTMENT|UNIT|STE|SUITE|RM|ROOM|LOT)\b\.?\s*#?\s*[A-Z0-9-]+|#\s*[0-9A-Z-]+)")
_COUNTY = re.compile(r"\b(?:COUNTY\s+(?:ROAD|RD)|CO\s+(?:ROAD|RD)|CR|C\s?R)[\s-]*([0-9]+)\b")
_NOT_ONE = re.compile(r"\bBLOCK\b|\bBLK\b|[/&@]|\bAT\b|\bAND\b|\bNEAR\b")

SCHEMA = "number string, direction string, street string, type string, city string"


def _numbered(text: str) -> tuple[str | None, str]:
    """House number and the rest of a text without units."""
    lead = re.match(r"\s*(?:NO\.?\s*)?([0-9]{1,6})(?![0-9]|ST\b|ND\b|RD\b|TH\b)[\s,]+(?=.*[A-Z])", text)
    if lead:
        return lead[1], text[lead.end() :]
    tail = re.search(r"[\s,]+(?:NO\.?\s*|#\s*)?([0-9]{1,6})\b(?=[\s,]*(?:[A-Z ]*$))", text)
    if tail:
        return tail[1], text[: tail.start()] + " " + text[tail.end() :]
    return None, text


@functools.lru_cache(maxsize=200_000)
def read_address(text: str, cities: tuple[tuple[str, str], ...]) -> tuple[str | None, ...] | None:
    """(number, direction, street, type, city) of an address naming one building, else None.

    ``cities`` are (spelling, canonical) pairs that may stand at the end. The street keeps letters and digits only.
    """
    t = re.sub(r"\s+", " ", text.upper()).strip()
    if _NOT_ONE.search(t):
        return None
    t = re.sub(r"\b[0-9]{5}(?:-[0-9]{4})?\s*$", "", t).strip(" ,")
    t = re.sub(r"[\s,]+(?:NK|N\.K\.)\s*$", "", t).strip(" ,")
    city = None
    for spelled, canonical in cities:  # longest first
        if t.endswith(spelled) and len(t) > len(spelled) and not t[-len(spelled) - 1].isalnum():
            before = t[: -len(spelled)].strip(" ,")
            if re.search(r"[A-Z]", before):
                t, city = before, canonical
                break
    t = t.replace(".", " ")
    county = _COUNTY.search(t)
    if county:  # its number must not be taken for the house number
        t = f"{t[: county.start()]} COUNTYROAD {t[county.end() :]}"
    stripped = re.sub(r"^\s*NO\s*[0-9]+\s*,\s*(?=[0-9])", "", t)  # a unit before the house number
    if re.match(r"\s*[0-9]{1,6}\s", stripped):  # the house number leads: any further NO is a unit
        stripped = re.sub(r"\b(?:NO|NUM)\s+[0-9A-Z]+\s*$", " ", stripped)
        stripped = _UNIT.sub(" ", stripped)
    else:
        lead_unit = re.match(r"\s*(?:" + _UNIT.pattern + r")\s*,", stripped)
        if lead_unit:
            stripped = stripped[lead_unit.end() :]
        # without a leading house number a bare sign stands before it ("SUMAC RD, #6680"); only worded units go
        stripped = re.sub(r"\b(?:APT|APARTMENT|UNIT|STE|SUITE|RM|ROOM|LOT)\b\s*#?\s*[A-Z0-9-]+", " ", stripped)
    number, rest = _numbered(stripped)
    if number is None:
        return None
    rest = re.sub(r"[#,]", " ", rest)
    rest = re.sub(r"\bNO\s*$", " ", rest)
    words = [w for w in re.sub(r"[^A-Z0-9_ ]", "", rest).split() if w]
    if not words:
        return None
    direction = kind = None
    if len(words) > 1 and words[0] in _DIRECTION:
        direction = _DIRECTION[words.pop(0)]
    elif len(words) > 1 and words[-1] in _DIRECTION:
        direction = _DIRECTION[words.pop()]
    if county:
        return number.lstrip("0") or "0", direction, f"COUNTYROAD{county[1]}", None, city
    if len(words) > 1 and words[-1] in _TYPE:
        kind = _TYPE[words.pop()]
        if direction is None and len(words) > 1 and words[-1] in _DIRECTION:
            direction = _DIRECTION[words.pop()]
    words = [ORDINALS.get(w, NAME_WORDS.get(w, "SAINT" if w == "ST" else w)) for w in words]
    return number.lstrip("0") or "0", direction, "".join(words), kind, city


def city_spellings(gazetteer: DataFrame) -> tuple[tuple[str, str], ...]:
    """(spelling, canonical) of the reference list, longest first; the list is a fixed table of a few dozen rows."""
    rows = gazetteer.select("canonical", F.explode(F.array("canonical", "alias")).alias("raw")).where(F.col("raw").isNotNull())
    return tuple(sorted(((r["raw"].upper(), r["canonical"]) for r in rows.toLocalIterator()), key=lambda x: (-len(x[0]), x)))


def parse(addresses: DataFrame, cities: tuple[tuple[str, str], ...]) -> DataFrame:
    """Distinct ``address`` -> its parts; blocks, crossings and unnumbered texts drop out."""

    def read(batches):
        for pdf in batches:
            rows = [(a, *r) for a in pdf["address"] if (r := read_address(a, cities)) is not None]
            yield pd.DataFrame(rows, columns=["address", "number", "direction", "street", "type", "city"], dtype=object)

    # a stated number of partitions: adaptive execution would merge the small texts into too few tasks for the reading
    tasks = int(addresses.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return addresses.select("address").where(F.col("address").isNotNull()).distinct().repartition(tasks, "address").mapInPandas(read, "address string, " + SCHEMA)


def same_streets(parsed: DataFrame, threshold: float = SAME_STREET) -> DataFrame:
    """(number, street, other): spellings at one house number whose cosine reaches the threshold, each with itself too.

    Both orders are given. Digits name a street, so they must be equal. Spellings are compared once for each pair,
    whatever the number of houses and rows that write them.
    """
    streets = parsed.groupBy(F.col("street").alias("text")).agg(F.count("*").alias("n"))
    held = cut(vectors(streets.select("text"), damped_weights(streets), threshold))
    spots = parsed.select("number", "street").distinct()
    keyed = spots.join(held.select(F.col("text").alias("street"), "prefix"), "street").select("number", F.regexp_replace("street", "[^0-9]", "").alias("digits"), "street", F.explode("prefix").alias("gram"))
    other = keyed.withColumnRenamed("street", "other")
    met = cut(keyed.join(other, ["number", "digits", "gram"]).where(F.col("street") < F.col("other")).select("number", "street", "other").distinct())
    near = pair_cosines(met.select(F.col("street").alias("text"), F.col("other").alias("reference")).distinct(), held).where(F.col("cosine") >= threshold)
    pairs = met.join(near.select(F.col("text").alias("street"), F.col("reference").alias("other")), ["street", "other"]).select("number", "street", "other")
    return pairs.unionByName(pairs.select("number", F.col("other").alias("street"), F.col("street").alias("other"))).unionByName(spots.withColumn("other", F.col("street")))


def zip5(column):
    """Five digits of a zip; shorter numbers lost their leading zeros."""
    digits = F.regexp_extract(column, r"^\s*([0-9]{1,5})(?:-[0-9]{4})?\s*$", 1)
    return F.when(digits != "", F.lpad(digits, 5, "0"))


def locate(records: DataFrame, parsed: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Records with their address parts and the set of ``places`` they may lie in (null where nothing says so).

    The city written in the address counts first, then the record's ``city``, then its zip; a zip narrows a city only if
    they agree.
    """
    held = gazetteer.select("canonical", F.explode("zips").alias("zip5")).groupBy("zip5").agg(F.collect_set("canonical").alias("by_zip"))
    rows = records.withColumn("zip5", zip5(F.col("zip"))).join(parsed.withColumnRenamed("city", "written"), "address").join(held, "zip5", "left")
    city = F.coalesce("written", "city")
    places = F.when(city.isNotNull(), F.array(city)).otherwise(F.col("by_zip"))
    return rows.select("id", "source", "number", "street", "direction", "type", "zip5", F.array_sort(places).alias("places"))


def _known(column, field: str):
    return F.array_distinct(F.filter(F.transform(column, lambda p: p[field]), lambda x: x != ""))


def settle(readings: DataFrame, streets: DataFrame) -> DataFrame:
    """Readings with the parts left out: ``d`` direction, ``t`` type, ``where`` the places they may lie in.

    A part left out is the only one that fits among the spellings of the street at the number; where several fit it
    stays its own variant. A reading without place takes the one place named there; with several it stays open. The
    sets gathered are of directions, types and places, of which there are few.
    """
    empty = lambda c: F.coalesce(c, F.lit(""))
    own = readings.groupBy("number", F.col("street").alias("other")).agg(F.collect_set(F.struct(empty("direction").alias("d"), empty("type").alias("t"))).alias("p"))
    seen = streets.join(own, ["number", "other"]).groupBy("number", "street").agg(F.array_distinct(F.flatten(F.collect_set("p"))).alias("pairs"))
    fits = F.filter("pairs", lambda p: (F.col("direction").isNull() | (p["d"] == F.col("direction"))) & (F.col("type").isNull() | (p["t"] == F.col("type"))))
    both = readings.join(seen, ["number", "street"]).withColumn("fits", fits)
    pick = lambda given, f: F.coalesce(given, F.when(F.size(_known("fits", f)) == 1, _known("fits", f)[0]), F.lit(""))
    parts = cut(both.withColumns({"d": pick(F.col("direction"), "d"), "t": pick(F.col("type"), "t")}).drop("pairs", "fits", "direction", "type"))
    named = parts.groupBy("number", F.col("street").alias("other"), "d", "t").agg(F.collect_set(F.when(F.size("places") == 1, F.col("places")[0])).alias("one"), F.array_distinct(F.flatten(F.collect_set("places"))).alias("all"))
    there = streets.join(named, ["number", "other"]).groupBy("number", "street", "d", "t").agg(F.array_distinct(F.flatten(F.collect_set("one"))).alias("one"), F.array_distinct(F.flatten(F.collect_set("all"))).alias("all"))
    only = F.when(F.size("one") == 1, F.col("one")).when(F.size("one") == 0, F.when(F.size("all") == 0, F.array(F.lit(""))).otherwise(F.col("all")))
    return parts.join(there, ["number", "street", "d", "t"]).select("reading", "number", "street", "d", "t", "zip5", F.coalesce("places", only).alias("where"))


def same_building(records: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """(left, right): an incident and a person record at the same building.

    ``records`` has ``id, source (left or right), address, zip, city (canonical or null)``. Null and empty addresses,
    blocks and crossings match nothing; repeated rows count once. Records are first folded to distinct readings, so an
    address holding a tenth of all rows is one reading until the pairs are written out, where adaptive execution splits
    its rows.
    """
    cities = city_spellings(gazetteer)
    # each is read several times below; without the cut every reader would parse and compare again
    parsed = cut(parse(records, cities))
    streets = cut(same_streets(parsed))
    key = ["number", "street", "direction", "type", "zip5", "places"]
    located = cut(locate(records, parsed, gazetteer).withColumn("reading", F.sha2(F.to_json(F.struct(*key)), 256)).distinct())
    building = cut(settle(located.select("reading", *key).distinct(), streets))
    left, right = (located.where(F.col("source") == s).select(F.col("id").alias(s), F.col("reading").alias(s[0])) for s in ("left", "right"))
    side = lambda rows, x: building.join(rows.select(F.col(x).alias("reading")).distinct(), "reading", "left_semi").select(F.col("reading").alias(x), "number", F.col("street").alias("street" if x == "l" else "other"), "d", "t", F.col("zip5").alias(f"{x}z"), F.col("where").alias(f"{x}w"))
    met = side(left, "l").join(streets, ["number", "street"]).join(side(right, "r"), ["number", "other", "d", "t"]).where((F.col("lz") == F.col("rz")) | F.arrays_overlap("lw", "rw"))
    return cut(met.select("l", "r").distinct()).join(left, "l").join(right, "r").select("left", "right").distinct()
