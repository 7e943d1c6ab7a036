"""Tolerant reading of agency CSV exports, in splits like any text file.

Lines arrive as raw bytes. One aggregation over all of them settles the encoding; delimiter and header come from the
first lines; everything else is a projection. Nothing but the first lines and the figures of the log reaches the driver.
"""

from __future__ import annotations

import csv
import re
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.schema import DATE_COLUMNS, HeaderPlan, map_columns, schema_fingerprint

DELIMITERS = (",", ";", "\t", "|")
FOOTER = r"(?i)^\s*(?:total|grand total|end of report|page \d+)"
#: first lines from which delimiter and header are told
HEAD_LINES = 200
# Date formats in the order they are tried.
DATE_FORMATS = ["yyyy-MM-dd", "M/d/yyyy", "M/d/yy", "yyyy-MM-dd HH:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy h:mm a", "d-MMM-yyyy", "MMM d, yyyy"]
#: years written with two digits are 20xx below it, 19xx from it on
CENTURY_TURN = 2069


def _cp1252() -> tuple[str, str, str]:
    """What the bytes 80 to 9F are in cp1252: bytes as Latin-1 characters, their characters, and the bytes it lacks."""
    known, missing = {}, []
    for n in range(0x80, 0xA0):
        try:
            known[chr(n)] = bytes([n]).decode("cp1252")
        except UnicodeDecodeError:
            missing.append(chr(n))
    return "".join(known), "".join(known.values()), "".join(missing)


@dataclass
class ParseLog:
    encoding: str
    delimiter: str
    header_row: int
    footer_rows_dropped: int
    fingerprint: str
    mapping: HeaderPlan
    unparseable_dates: dict[str, int] = field(default_factory=dict)


def sniff(lines: list[str]) -> str:
    """Delimiter that occurs most in the first fifty lines, a comma where none does."""
    counts = {d: sum(line.count(d) for line in lines[:50]) for d in DELIMITERS}
    best = max(DELIMITERS, key=lambda d: counts[d])
    return best if counts[best] else ","


def find_header(lines: list[str], delimiter: str, scan: int = 25) -> int:
    """Index of the first line with the usual number of cells of which most are words; 0 where none is."""
    rows = [next(csv.reader([line], delimiter=delimiter)) if line.strip() else [] for line in lines[:HEAD_LINES]]
    widths = Counter(len(r) for r in rows if r)
    usual = max(widths, key=lambda w: (widths[w], w)) if widths else 0
    for i, row in enumerate(rows[:scan]):
        if usual > 1 and len(row) == usual and sum(bool(re.search("[A-Za-z]", c)) and not re.search(r"\d{2,}", c) for c in row) >= 0.6 * usual:
            return i
    return 0


def parse_date(text: Column) -> Column:
    """Timestamp under the first of DATE_FORMATS that fits, else null."""

    def one(form: str) -> Column:
        stamp = F.try_to_timestamp(text, F.lit(form))
        if "yyyy" in form:
            return stamp
        return F.when(F.year(stamp) >= CENTURY_TURN, stamp - F.make_interval(years=F.lit(100))).otherwise(stamp)

    return F.coalesce(*map(one, DATE_FORMATS))


def _decoded(raw: Column, encoding: str) -> Column:
    if encoding == "utf-8-sig":
        return raw
    latin = F.decode(raw.cast("binary"), "ISO-8859-1")
    given, written, _ = _cp1252()
    return F.translate(latin, given, written) if encoding == "cp1252" else latin


def read_agency_csv(spark: SparkSession, path: str, agency: str | None = None) -> tuple[DataFrame, ParseLog]:
    """Canonical columns of one export and a log of how it was read.

    The encoding is the first of UTF-8, cp1252 and Latin-1 that fits every line. Blank lines and footer rows are dropped
    and counted. Values are trimmed, empty ones null; date columns become timestamps, what is no date becomes null and
    is counted. An empty file has no columns.
    """
    lines = spark.read.text(path).select(F.col("value").alias("raw"), F.monotonically_increasing_id().alias("id"), (F.col("_metadata.file_block_start") == 0).alias("first"))
    lacking = "[" + _cp1252()[2] + "]"
    told = lines.agg(
        F.bool_and(F.is_valid_utf8("raw")).alias("utf8"),
        F.bool_or(F.decode(F.col("raw").cast("binary"), "ISO-8859-1").rlike(lacking)).alias("odd"),
        F.min(F.when(F.col("first"), F.col("id"))).alias("begin"),  # lines of the first split are numbered in order
    ).first()
    encoding = "utf-8-sig" if told["utf8"] is not False else "latin-1" if told["odd"] else "cp1252"
    text = lines.select(_decoded(F.col("raw"), encoding).alias("value"), F.when(F.col("first"), F.col("id") - F.lit(told["begin"])).alias("n"))
    head = [r["value"].removeprefix("﻿") for r in text.where(F.col("n") < HEAD_LINES).orderBy("n").collect()]
    delimiter = sniff(head)
    at = find_header(head, delimiter)
    header = [h.strip() for h in next(csv.reader([head[at]], delimiter=delimiter))] if head else []
    body = text.where(F.col("n").isNull() | (F.col("n") > at))
    junk = F.col("value").rlike(FOOTER) | (F.trim("value") == "")
    cells = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])
    shape = ", ".join(f"{f.name} string" for f in cells.fields)
    read = F.from_csv("value", shape, {"sep": delimiter, "ignoreLeadingWhiteSpace": "true"}) if header else F.lit(None)
    rows = body.where(~junk).select(read.alias("r")) if header else body.where(F.lit(False))
    named = rows.select([F.nullif(F.trim(F.col(f"r.c{i}")), F.lit("")).alias(h) for i, h in _distinct(header)])
    mapped, plan = map_columns(named)
    dates = [c for c in DATE_COLUMNS if c in mapped.columns]
    unread = mapped.agg(F.lit(0).alias("_"), *[F.count_if(F.col(c).isNotNull() & parse_date(F.col(c)).isNull()).alias(c) for c in dates]).first()
    out = mapped.withColumns({c: parse_date(F.col(c)) for c in dates}) if dates else mapped
    if agency is not None and "agency" not in out.columns:
        out = out.withColumn("agency", F.lit(agency))
    return out, ParseLog(encoding, delimiter, at, body.where(junk).count(), schema_fingerprint(header), plan, {c: unread[c] for c in dates})


def _distinct(header: list[str]) -> list[tuple[int, str]]:
    """Places and names of the columns; a name met again is told apart, so that it still counts as repeated."""
    seen: Counter[str] = Counter()
    out = []
    for i, h in enumerate(header):
        key = h.lower()
        out.append((i, h + " " * seen[key]))
        seen[key] += 1
    return out
