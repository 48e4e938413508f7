"""Mixed timestamp texts to one unambiguous form (problem 5).

An ordered cascade of anchored patterns takes a text apart into date, clock and zone; what the
patterns leave is parsed strictly (a day, month or hour out of range makes the value unreadable).
Everything is built from JVM expressions, so it stays inside whole-stage code generation.

Defined results
---------------
* null, blank or unmatched text, impossible dates (``0000-00-00``, 30 February, hour 24 or 60): null.
* no zone in the text: the source's default zone, looked up by the caller; where that is null or
  unknown, ``fallback_zone``.
* a wall time that occurs twice: its first occurrence; one that does not exist: moved forward by
  the length of the gap. A numeric offset or zone letters decide by themselves.
* zone letters that several regions use mean what the default zone's region means by them; letters
  that nobody uses make the value unreadable.
* digits finer than a millisecond are cut, not rounded.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Months in English by their first three letters.
MONTHS = ["jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec"]

# Offsets of zone letters with one usual meaning.
ZONE_LETTERS = {
    "Z": "+00:00", "UT": "+00:00", "UTC": "+00:00", "GMT": "+00:00", "WET": "+00:00", "WEST": "+01:00",
    "CET": "+01:00", "CEST": "+02:00", "EET": "+02:00", "EEST": "+03:00", "MSK": "+03:00",
    "EST": "-05:00", "EDT": "-04:00", "CST": "-06:00", "CDT": "-05:00", "MST": "-07:00", "MDT": "-06:00",
    "PST": "-08:00", "PDT": "-07:00", "AKST": "-09:00", "AKDT": "-08:00", "HST": "-10:00",
    "AST": "-04:00", "ADT": "-03:00", "NST": "-03:30", "NDT": "-02:30", "BRT": "-03:00", "BRST": "-02:00",
    "ART": "-03:00", "BST": "+01:00", "SAST": "+02:00", "PKT": "+05:00", "IST": "+05:30", "NPT": "+05:45",
    "WIB": "+07:00", "ICT": "+07:00", "SGT": "+08:00", "HKT": "+08:00", "AWST": "+08:00", "JST": "+09:00",
    "KST": "+09:00", "ACST": "+09:30", "ACDT": "+10:30", "AEST": "+10:00", "AEDT": "+11:00",
    "NZST": "+12:00", "NZDT": "+13:00",
}
# Letters that mean something else in some regions (prefix of the default zone).
REGION_LETTERS = {
    "IST": [("Europe/", "+01:00"), ("Asia/Jerusalem", "+02:00"), ("Asia/Tel_Aviv", "+02:00")],
    "BST": [("Asia/", "+06:00"), ("Pacific/", "+11:00")],
    "CST": [("Asia/", "+08:00"), ("Australia/", "+09:30"), ("America/Havana", "-05:00")],
    "CDT": [("Australia/", "+10:30"), ("America/Havana", "-04:00")],
    "EST": [("Australia/", "+10:00")],
    "EDT": [("Australia/", "+11:00")],
    "AST": [("Asia/", "+03:00")],
    "WST": [("Australia/", "+08:00")],
}

_BLANK = r"[\s ​﻿]+"
_DAY_NAME = r"(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun)[a-z]*\.?,? +"
_MONTH_NAME = "((?i:" + "|".join(MONTHS) + ")[a-zA-Z]*)"
_REST = r"((?:[T ,].*)?)"
#: anchored date patterns, in order, and how their groups give year|month|day|rest
DATE_CASCADE = [
    (rf"^(\d{{4}})[-/](\d{{1,2}})[-/](\d{{1,2}}){_REST}$", "$1|$2|$3|$4"),
    (rf"^(\d{{4}})(\d{{2}})(\d{{2}})((?:T.*)?)$", "$1|$2|$3|$4"),
    (r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$", "$1|$2|$3|T$4:$5:$6"),
    (rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}){_REST}$", "$3|$1|$2|$4"),
    (rf"^(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}}){_REST}$", "$3|$2|$1|$4"),
    (rf"^(\d{{1,2}})[ -]{_MONTH_NAME}\.?[ -](\d{{4}}){_REST}$", "$3|$2|$1|$4"),
    (rf"^{_MONTH_NAME}\.? (\d{{1,2}}),? (\d{{4}}){_REST}$", "$3|$1|$2|$4"),
]
_CLOCK = (
    r"^(?:[T ]|, ?) *(\d{1,2})[:-]?(\d{2})(?:[:-]?(\d{2})(?:[.,](\d{1,9}))?)?(?: ?([AaPp])\.?[Mm]\.?(?![A-Za-z]))? *"
    r"((?:UTC|GMT)?[+-]\d{2}(?::?\d{2})?|[A-Za-z]{1,5}|[A-Za-z]+(?:/[A-Za-z0-9_+-]+)+)?$"
)
_EPOCH = r"^\d{9,13}(?:\.\d{1,9})?$|^\d{15,19}$"


def known_zones(spark: SparkSession) -> list[str]:
    """Zone ids the JVM can resolve; anything else would make the whole query fail."""
    return sorted(spark._jvm.java.time.ZoneId.getAvailableZoneIds())


def _pick(cases: list[tuple[Column, Column]]) -> Column:
    return reduce(lambda acc, case: acc.when(*case), cases[1:], F.when(*cases[0]))


def _month_number(token: Column) -> Column:
    place = F.instr(F.lit("".join(MONTHS)), F.lower(F.substring(token, 1, 3)))
    return F.lpad(F.when(token.rlike("^[0-9]"), token).when(place % 3 == 1, ((place + 2) / 3).cast("int").cast("string")), 2, "0")


def _literal_map(pairs: dict[str, str]) -> Column:
    return F.map_from_arrays(F.lit(list(pairs)), F.lit(list(pairs.values())))


def _zone_of(token: Column, default: Column, zones: list[str]) -> Column:
    """The zone id meant by ``token`` (may be empty) for a source whose default zone is ``default``.

    Lookups go through literal maps and arrays, so the generated code stays small.
    """
    regional = {f"{name}|{prefix}": offset for name, regions in REGION_LETTERS.items() for prefix, offset in regions}
    letters = F.upper(token)
    by_region = F.coalesce(
        F.try_element_at(_literal_map(regional), F.concat(letters, F.lit("|"), default)),
        F.try_element_at(_literal_map(regional), F.concat(letters, F.lit("|"), F.regexp_extract(default, "^[A-Za-z]+/", 0))),
    )
    return (
        F.when(token == "", default)
        .when(token.rlike(r"^(?:UTC|GMT)?[+-](?:0\d|1[0-7])(?::?[0-5]\d)?$"), F.regexp_replace(F.regexp_replace(token, "^(?:UTC|GMT)|:", ""), r"^([+-]\d{2})(\d{2})?$", "$1:$2"))
        .when(token.rlike(r"^[A-Za-z]{1,5}$"), F.coalesce(by_region, F.try_element_at(_literal_map(ZONE_LETTERS), letters)))
        .when(F.array_contains(F.lit(zones), token), token)
    )


def _shift(source: Column, target: Column, wall: Column) -> Column:
    return F.convert_timezone(source, target, wall)


def once(df: DataFrame, *names: str) -> DataFrame:
    """Keep later filters on ``names`` from being pushed below, where each would repeat their whole expression."""
    rest = [c for c in df.columns if c not in names]
    return df.select(*rest, F.inline(F.array(F.struct(*names))))


def known_or_null(zone: Column, zones: list[str]) -> Column:
    """For the few rows of a lookup table: ids the JVM cannot resolve become null."""
    return F.when(F.array_contains(F.lit(zones), zone), zone)


def resolve(df: DataFrame, value: str, default_zone: str, zones: list[str], fallback_zone: str = "UTC") -> DataFrame:
    """``df`` plus ``_wall`` (local timestamp_ntz), ``_zone``, ``_home`` (default zone) and ``_date_only``.

    ``default_zone`` must hold known zone ids or null (see ``known_or_null``). The steps are separate columns, not one expression: each is used more than once, so the
    optimizer keeps them apart and every pattern is matched once a row.
    """
    home = F.coalesce(F.col(default_zone), F.lit(fallback_zone))
    text = F.regexp_replace(F.col(value), rf"^{_BLANK}|{_BLANK}$", "")
    text = F.regexp_replace(text, rf"^\[(.*)\]$", "$1")
    df = df.withColumns({"_home": home, "_text": F.regexp_replace(text, f"^{_DAY_NAME}", "")})
    dated = _pick([(F.col("_text").rlike(p), F.regexp_replace("_text", p, to)) for p, to in DATE_CASCADE])
    df = df.withColumn("_parts", F.split(dated, r"\|"))
    part = lambda i: F.get("_parts", F.lit(i))
    df = df.withColumns({
        "_day": F.concat_ws("-", part(0), _month_number(part(1)), F.lpad(part(2), 2, "0")),
        "_rest": part(3),
    })
    clock = F.when(F.col("_rest").rlike(_CLOCK), F.regexp_replace("_rest", _CLOCK, "$1|$2|$3|$4|$5|$6"))
    df = df.withColumn("_clock", F.split(clock, r"\|", -1))
    at = lambda i: F.get("_clock", F.lit(i))
    hour, half = at(0).try_cast("int"), F.lower(at(4))
    hour24 = F.when(half == "", hour).when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0))
    seconds = F.when(at(2) == "", F.lit("00")).otherwise(at(2))
    clock_text = F.concat(F.lpad(hour24.cast("string"), 2, "0"), F.lit(":"), at(1), F.lit(":"), seconds, F.lit("."), F.rpad(F.substring(at(3), 1, 3), 3, "0"))
    df = df.withColumns({
        "_date_only": F.coalesce(F.col("_rest") == "", F.lit(False)),
        "_clock_text": clock_text,
        "_token": F.coalesce(at(5), F.lit("")),
        "_epoch": F.coalesce(F.col("_text").rlike(_EPOCH), F.lit(False)),
    })
    written = F.when(F.col("_date_only"), F.col("_day")).otherwise(F.concat(F.col("_day"), F.lit(" "), F.col("_clock_text")))
    wall = F.when(F.col("_epoch"), _epoch_wall(F.col("_text"))).otherwise(written.try_cast("timestamp_ntz"))
    zone = F.when(F.col("_epoch"), F.lit("UTC")).when(F.col("_date_only"), F.col("_home")).otherwise(_zone_of(F.col("_token"), F.col("_home"), zones))
    df = df.withColumns({"_wall": wall, "_zone": zone})
    return df.withColumn("_zone", F.when(F.col("_zone").rlike(":$"), F.concat(F.col("_zone"), F.lit("00"))).otherwise(F.col("_zone"))).drop("_text", "_parts", "_day", "_rest", "_clock", "_clock_text", "_token", "_epoch")


def _epoch_wall(text: Column) -> Column:
    whole = F.regexp_extract(text, r"^(\d+)", 1)
    fraction = F.regexp_extract(text, r"\.(\d+)$", 1)
    n = F.length(whole)
    # the number of digits names the unit: up to 11 seconds, 12-14 ms, 15-17 us, 18-19 ns
    millis = (
        F.when(n <= 11, F.concat(whole, F.rpad(F.substring(fraction, 1, 3), 3, "0")))
        .when(n <= 14, whole)
        .when(n <= 17, F.substring(whole, F.lit(1), n - 3))
        .otherwise(F.substring(whole, F.lit(1), n - 6))
    ).try_cast("decimal(18,0)")
    seconds = (millis / F.lit(1000).cast("decimal(4,0)")).cast("decimal(18,6)")
    zero = F.lit(0)
    return F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")) + F.make_dt_interval(zero, zero, zero, seconds)


def with_instant_utc(df: DataFrame, value: str, default_zone: str, zones: list[str], name: str, fallback_zone: str = "UTC") -> DataFrame:
    """``df`` plus ``name``: UTC wall time (timestamp_ntz, cut to milliseconds) of a timestamp text, or null."""
    df = resolve(df, value, default_zone, zones, fallback_zone)
    df = df.withColumn(name, _shift(F.col("_zone"), F.lit("UTC"), F.col("_wall"))).drop("_wall", "_zone", "_home", "_date_only")
    return once(df, name)


def instant_form(instant: Column) -> Column:
    """``YYYY-MM-DDTHH:MM:SS.mmmZ`` of a UTC timestamp_ntz."""
    text = instant.cast("string")
    fine = F.rpad(F.substring(text, 21, 3), 3, "0")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit("."), fine, F.lit("Z"))


def with_calendar_day(df: DataFrame, value: str, default_zone: str, zones: list[str], name: str, fallback_zone: str = "UTC") -> DataFrame:
    """``df`` plus ``name``: ``YYYY-MM-DD`` of a date text; an instant means its day in the source's default zone."""
    df = resolve(df, value, default_zone, zones, fallback_zone)
    local = F.when(F.col("_date_only"), F.col("_wall")).otherwise(_shift(F.col("_zone"), F.col("_home"), F.col("_wall")))
    df = df.withColumn(name, F.substring(local.cast("string"), 1, 10)).drop("_wall", "_zone", "_home", "_date_only")
    return once(df, name)


INSTANT_FORM = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{3}Z$"
DAY_FORM = r"^\d{4}-\d{2}-\d{2}$"
