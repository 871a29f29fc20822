"""Lenient reading of date text (Q5), one pattern for each shape of text.

Each row is read by the shape of its own text. The shapes: ISO dates and times
with dashes, slashes or dots, year and month, year, compact digits, month first
(day first where only that gives a month), and English month names. A time of
day, AM or PM and a zone may follow. Times with an offset or ``Z``, ``UTC``,
``GMT`` are moved to UTC; other zone names are ignored, so such times and times
without a zone count as UTC.

Null: text of no shape, days and times that do not exist, a time of day alone,
and years outside 1677 to 2262 (what a count of nanoseconds can hold).
Fractions beyond microseconds are cut.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month names, in order.
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August",
          "September", "October", "November", "December"]
FIRST, LAST = "1677-09-21 00:12:43.145224", "2262-04-11 23:47:16.854775"

_NAME = "(?i:" + "|".join(f"{m[:3]}(?:{m[3:]})?" if len(m) > 3 else m for m in MONTHS) + "|Sept)"
_DAY = r"(\d{1,2})(?:st|nd|rd|th)?"
_WEEKDAY = r"(?:[A-Z][a-z]{2,8},?\s+)?"
# hour, minute, second, fraction, half of the day, zone: all may be missing
_TIME = (r"(?:(?:T|\s+)(\d{1,2})(?::(\d{2})(?::(\d{2})(?:\.(\d{1,9}))?)?)?"
         r"\s*([AaPp][Mm])?\s*(Z|[A-Z]{3,4}|[+-]\d{2}:?\d{2})?)?")


def _rest(first: int) -> str:
    return "|".join(f"${k}" for k in range(first, first + 6))


# (pattern, the same text as year|month|day|hour|minute|second|fraction|half|zone)
_SHAPES: list[tuple[str, str]] = [
    (rf"(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}}){_TIME}", f"$1|$2|$3|{_rest(4)}"),
    (rf"(\d{{4}})[-/](\d{{1,2}}){_TIME}", f"$1|$2|1|{_rest(3)}"),
    (rf"(\d{{4}}){_TIME}", f"$1|1|1|{_rest(2)}"),
    (r"(\d{4})(\d{2})(\d{2})", "$1|$2|$3||||||"),
    (r"(\d{4})(\d{2})(\d{2})T?(\d{2})(\d{2})(\d{2})", "$1|$2|$3|$4|$5|$6|||"),
    (rf"(0?[1-9]|1[0-2])[-/.](\d{{1,2}})[-/.](\d{{4}}|\d{{2}}){_TIME}", f"$3|$1|$2|{_rest(4)}"),
    (rf"(\d{{1,2}})[-/.](\d{{1,2}})[-/.](\d{{4}}|\d{{2}}){_TIME}", f"$3|$2|$1|{_rest(4)}"),
    (rf"{_WEEKDAY}({_NAME})\.?\s+{_DAY},?\s+(\d{{4}}){_TIME}", f"$3|$1|$2|{_rest(4)}"),
    (rf"{_WEEKDAY}{_DAY}[\s-]+({_NAME})\.?[\s,-]+(\d{{4}}){_TIME}", f"$3|$2|$1|{_rest(4)}"),
    (rf"(\d{{4}})-({_NAME})-(\d{{1,2}}){_TIME}", f"$1|$2|$3|{_rest(4)}"),
    (rf"({_NAME})\s+(\d{{4}}){_TIME}", f"$2|$1|1|{_rest(3)}"),
    (rf"[A-Z][a-z]{{2}}\s+({_NAME})\s+(\d{{1,2}})\s+(\d{{1,2}}):(\d{{2}}):(\d{{2}})\s+(\d{{4}})",
     "$6|$1|$2|$3|$4|$5|||"),
]


def _bind(value: Column, body) -> Column:
    """``body`` of ``value``, which is evaluated once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _from_parts(p: Column) -> Column:
    def number(k: int) -> Column:
        return F.get(p, F.lit(k)).try_cast("int")

    def part(k: int) -> Column:
        return F.get(p, F.lit(k))

    short = F.array(*[F.lit(m[:3].lower()) for m in MONTHS])
    month = F.coalesce(number(1), F.array_position(
        short, F.lower(F.substring(part(1), 1, 3))).cast("int"))
    year = number(0)
    year = F.when(F.length(part(0)) == 2,  # 1969 to 2068
                  year + F.when(year < 69, 2000).otherwise(1900)).otherwise(year)
    hour, half = F.coalesce(number(3), F.lit(0)), F.lower(part(7))
    hour = (F.when(half == "", hour)
            .when(hour.between(1, 12), hour % 12 + F.when(half == "pm", 12).otherwise(0)))
    second = F.coalesce(number(5), F.lit(0))
    micros = F.rpad(F.substring(part(6), 1, 6), 6, "0").cast("int")
    exact = second.cast("decimal(16,6)") + (micros.cast("decimal(16,6)") / 1_000_000)
    made = F.try_make_timestamp_ntz(year, month, number(2), hour,
                                    F.coalesce(number(4), F.lit(0)), exact.cast("decimal(16,6)"))
    zone = part(8)
    ahead = F.when(zone.rlike("^[+-]"), (
        F.substring(zone, 2, 2).try_cast("int") * 60 + F.substring(zone, -2, 2).try_cast("int"))
        * F.when(zone.startswith("-"), -1).otherwise(1)).otherwise(0)
    return F.when((F.size(p) == 9) & (second < 60), F.timestamp_add("MINUTE", -ahead, made))


def lenient_timestamp(value: Column) -> Column:
    """The timestamp (without zone, UTC) that a text names, or null."""
    text = F.trim(value.cast("string"))
    parts = F.translate(text, "|", "#")  # the mark between parts is no part of a shape
    for pattern, to in _SHAPES:
        parts = F.regexp_replace(parts, f"^{pattern}$", to)
    found = F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("timestamp_ntz")).otherwise(
        _bind(F.split(parts, "[|]"), _from_parts))
    return _bind(found, lambda t: F.when(t.between(
        *[F.lit(x).cast("timestamp_ntz") for x in (FIRST, LAST)]), t))
