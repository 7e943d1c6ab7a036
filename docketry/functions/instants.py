"""Reading one textual timestamp into calendar parts, wholly in JVM expressions.

``parsed_parts`` recognises a shape first and leaves the reading of ambiguous numeric dates to the caller, who decides
from the whole source whether the month or the day stands first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month abbreviations, in calendar order.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

# Zone abbreviations and their offsets from UTC in seconds.
ZONE_OFFSETS = {
    "Z": 0, "UTC": 0, "GMT": 0,
    "EST": -18000, "EDT": -14400, "CST": -21600, "CDT": -18000,
    "MST": -25200, "MDT": -21600, "PST": -28800, "PDT": -25200,
}

LOCAL_ZONE = "America/New_York"

_TIME = r"(?:(?:T|\s*,?\s+(?:at\s+)?)(\d{1,2}):(\d{2})(?::(\d{2})(?:[.,]\d+)?)?\s*([AaPp]\.?[Mm]\.?)?\s*([A-Za-z]{1,4}|[+-]\d{2}:?\d{2})?)?$"
_MONTH_NAME = r"([A-Za-z]{3,9})\.?"

#: shape name -> (pattern, groups of year, month, day, open first and second number, month name; the time's five follow)
_SHAPES = {
    "iso": (r"^(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})" + _TIME, dict(y=1, m=2, d=3, t=4)),
    "basic": (r"^(\d{4})(\d{2})(\d{2})(?:T(\d{2})(\d{2})(\d{2})?(?:[.,]\d+)?()\s*([A-Za-z]{1,4}|[+-]\d{2}:?\d{2})?)?$", dict(y=1, m=2, d=3, t=4)),
    "numeric": (r"^(\d{1,2})([/.-])(\d{1,2})\2(\d{4}|\d{2})" + _TIME, dict(y=4, a=1, b=3, t=5)),
    "day_name": (r"^(?:[A-Za-z]{3,9}\.?,?\s+)?(\d{1,2})(?:\s+|-)" + _MONTH_NAME + r"(?:\s*,?\s+|-)(\d{4}|\d{2})" + _TIME, dict(y=3, mon=2, d=1, t=4)),
    "name_day": (r"^(?:[A-Za-z]{3,9}\.?,\s+)?" + _MONTH_NAME + r"\s+(\d{1,2})(?:st|nd|rd|th)?\s*,?\s+(\d{4}|\d{2})" + _TIME, dict(y=3, mon=1, d=2, t=4)),
}
_ROLES = ("y", "m", "d", "a", "b", "mon")
_CLOCK = ("hh", "mi", "ss", "half", "zone")
#: beginning of whatever may be a date with numbers only, whose order is open
OPEN_ORDER = r"^\s*\d{1,2}[/.-]\d{1,2}[/.-]\d"


def _month_number(name: Column) -> Column:
    short = F.lower(F.substring(name, 1, 3))
    where = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), short)
    return F.when(where > 0, where.cast("int"))


def pieces_of(text: Column) -> Column:
    """Array of the name of the first shape the trimmed text has and of what its groups hold; null without a shape.

    One replacement writes out all groups at once, so a value is matched once by its own pattern.
    """
    out = F.when(text.rlike(r"^\d{13}$"), F.array(F.lit("epoch_ms"))).when(text.rlike(r"^\d{10}$"), F.array(F.lit("epoch_s")))
    for name, (pattern, at) in _SHAPES.items():
        held = [f"${at[role]}" if role in at else "" for role in _ROLES] + [f"${at['t'] + k}" for k in range(len(_CLOCK))]
        out = out.when(text.rlike(pattern), F.split(F.regexp_replace(text, pattern, "|".join([name, *held])), r"\|"))
    return out


def parts_of(pieces: Column) -> Column:
    """Struct of the numbers a shape holds: ``y, m, d`` or, for numeric dates, ``y, a, b`` with the order left open."""
    piece = lambda role: F.nullif(F.get(pieces, F.lit(1 + (*_ROLES, *_CLOCK).index(role))), F.lit(""))
    number = lambda role: piece(role).cast("int")
    year = number("y")
    return F.struct(
        F.when(year < 100, year + 2000).otherwise(year).alias("y"),
        F.coalesce(number("m"), _month_number(piece("mon"))).alias("m"),
        *[number(role).alias(role) for role in ("d", "a", "b", "hh", "mi", "ss")],
        F.lower(F.substring(piece("half"), 1, 1)).alias("half"),
        F.upper(piece("zone")).alias("zone"),
    )


def days_in_month(y: Column, m: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)


def is_date(y: Column, m: Column, d: Column) -> Column:
    """True where the three numbers name a day of the calendar; null parts give false."""
    return F.coalesce(m.between(1, 12) & (d >= 1) & (d <= days_in_month(y, m)) & (y >= 1), F.lit(False))


def zone_offset(zone: Column) -> Column:
    """Seconds east of UTC of a zone word or numeric offset; null where the word is unknown."""
    named = F.create_map(*[F.lit(x) for pair in ZONE_OFFSETS.items() for x in pair])
    digits = F.regexp_replace(zone, "[^0-9]", "")
    hours, minutes = F.substring(digits, 1, 2).cast("int"), F.substring(digits, 3, 2).cast("int")
    signed = F.when(zone.startswith("-"), -1).otherwise(1) * (hours * 3600 + minutes * 60)
    return F.when(zone.rlike(r"^[+-]"), F.when((hours <= 18) & (minutes < 60), signed)).otherwise(named[zone])


def seconds_of_day(p: Column) -> Column:
    """Seconds since midnight; a date alone is midnight, an impossible clock time is null."""
    hour, minute, second = p["hh"], F.coalesce(p["mi"], F.lit(0)), F.coalesce(p["ss"], F.lit(0))
    clock = (
        F.when(hour.isNull(), F.lit(0))
        .when(p["half"] == "a", F.when(hour.between(1, 12), hour % 12))
        .when(p["half"] == "p", F.when(hour.between(1, 12), hour % 12 + 12))
        .otherwise(F.when(hour.between(0, 23), hour))
    )
    return F.when((minute < 60) & (second < 60), clock * 3600 + minute * 60 + second)


def epoch_seconds(y: Column, m: Column, d: Column, p: Column, local_zone: str = LOCAL_ZONE) -> Column:
    """UTC epoch of a wall clock reading.

    Without a zone the reading is local: Java's zone rules give a repeated hour its first pass and a skipped hour the
    offset in force before it.
    """
    ok = is_date(y, m, d)
    day = F.unix_date(F.make_date(F.when(ok, y), F.when(ok, m), F.when(ok, d))).cast("long")
    wall = day * 86400 + seconds_of_day(p)
    local = F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(wall), local_zone))
    return F.when(p["zone"].isNull(), local).otherwise(wall - zone_offset(p["zone"]))
