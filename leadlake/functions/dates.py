"""Mixed-format date parsing and calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from leadlake.functions.text import strip

# Time of day is optional in every format; a 12-hour clock needs its own pattern.
_TIMES = ("[ H:mm[:ss[.SSSSSS]]]", " h:mm[:ss] a")


#: The spelling that most exports use throughout; it needs no stripping.
_ISO = r"^\d{4}-\d{2}-\d{2}(?: \d{2}:\d{2}:\d{2})?$"


def _first(col: Column, *dates: str) -> Column:
    """First of the date patterns, each with and without time, that reads `col`."""
    return F.coalesce(
        *[F.try_to_timestamp(col, F.lit(d + t)) for d in dates for t in _TIMES]
    )


def parse_mixed_ts(col: Column | str) -> Column:
    """Parse text dates of mixed formats to UTC timestamps; unreadable text becomes null.

    ISO forms go first. In `a/b/yyyy` the month leads; the day leads only when `a` exceeds 12. Each value
    meets only the formats of its own shape, as every failed format costs an exception in the parser. What none
    of them reads is taken apart into date, time and offset, whatever the order and the marks between.
    """
    text, plain = strip(col), F.col(col) if isinstance(col, str) else col
    iso = F.when(plain.rlike(_ISO), F.try_to_timestamp(plain))
    return F.coalesce(iso, _by_format(text), _taken_apart(text))


def _by_format(text: Column) -> Column:
    """The common spellings, by format."""
    return (
        F.when(text.rlike(r"^\d{8}$"), F.try_to_timestamp(text, F.lit("yyyyMMdd")))
        .when(text.rlike(r"^\d{14}$"), F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss")))
        .when(text.rlike(r"^\d{4}(-|$)"), F.try_to_timestamp(text))
        .when(text.rlike(r"^\d{4}/"), _first(text, "yyyy/M/d"))
        .when(text.rlike(r"^\d{1,2}/"), _first(text, "M/d/yyyy", "d/M/yyyy"))
        .when(text.rlike(r"^\d{1,2}-\d"), _first(text, "M-d-yyyy", "d-M-yyyy"))
        .when(text.rlike(r"^\d{1,2}\.\d"), _first(text, "M.d.yyyy", "d.M.yyyy"))
        .when(
            text.rlike(r"^\d{1,2}[ -]\p{L}"),
            _first(text, "d MMM yyyy", "d MMMM yyyy", "d-MMM-yyyy", "d-MMMM-yyyy"),
        )
        .when(
            text.rlike(r"^\p{L}"),
            _first(text, "MMM d, yyyy", "MMMM d, yyyy", "MMM d yyyy", "MMMM d yyyy"),
        )
    )


#: Names of months and weekdays: three letters, or the whole name.
_MONTHS = (
    "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?|oct(?:ober)?"
    "|nov(?:ember)?|dec(?:ember)?"
)
_WEEKDAY = r"\b(?:mon|tues?|wed(?:nes)?|thu(?:rs?)?|fri|sat(?:ur)?|sun)(?:day)?\b\.?"
_CLOCK = r"\b(\d{1,2}):(\d{2})(?::(\d{2})(?:\.(\d{1,9}))?)?(?: ?([ap])\.?m\b\.?)?"
_OFFSET = r"(?:^|[\d:m ])(?:z|utc|gmt)?([+-])(\d{2}):?(\d{2})$"
#: Years of two digits from this one on belong to the 1900s.
_PIVOT = 69


def _once(value: Column, use) -> Column:
    """`use(value)` with the value computed once; the expression stays small however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _taken_apart(text: Column) -> Column:
    """A timestamp from a date in any common order, an optional clock time and an optional offset."""
    low = F.lower(text)
    low = F.regexp_replace(low, r"^(\d{8})[t ]?(\d{2})(\d{2})(\d{2})$", "$1 $2:$3:$4")
    low = F.regexp_replace(low, r"^(\d{8})[t ]?(\d{2})(\d{2})$", "$1 $2:$3")
    low = F.regexp_replace(low, r"(\d)t(?=\d)", "$1 ")
    low = F.regexp_replace(low, _WEEKDAY + "|,", " ")
    low = F.regexp_replace(low, r"(\d)(?:st|nd|rd|th)\b", "$1")
    low = F.regexp_replace(low, r"([a-z]{3})\.", "$1")
    low = F.trim(F.regexp_replace(low, r"\s+", " "))
    return _once(low, lambda plain: _once(_pieces(plain), _assembled))


def _pieces(low: Column) -> Column:
    """Struct of offset in minutes, hour, minute, second, and the text of the date."""
    has_clock = low.rlike(_CLOCK)
    part = lambda pattern, n: F.nullif(F.regexp_extract(low, pattern, n), F.lit(""))
    sign = F.when(part(_OFFSET, 1) == "-", -1).otherwise(1)
    offset = sign * (part(_OFFSET, 2).cast("int") * 60 + part(_OFFSET, 3).cast("int"))
    hour, half = part(_CLOCK, 1).cast("int"), part(_CLOCK, 5)
    on_dial = F.when(hour.between(1, 12), hour % 12 + F.when(half == "p", 12).otherwise(0)).otherwise(-1)
    fraction = F.rpad(F.substring(F.coalesce(part(_CLOCK, 4), F.lit("0")), 1, 6), 6, "0")
    second = F.concat(F.coalesce(part(_CLOCK, 3), F.lit("0")), F.lit("."), fraction).cast("decimal(8,6)")
    no_offset = F.regexp_replace(low, r"(?:z|utc|gmt)?[+-]\d{2}:?\d{2}$|(?<=[ \d])(?:z|utc|gmt)$", "")
    day = F.when(has_clock, F.regexp_replace(no_offset, _CLOCK, " ")).otherwise(low)
    return F.struct(
        F.when(has_clock & low.rlike(_OFFSET), offset).otherwise(0).alias("offset"),
        F.when(~has_clock, 0).when(half.isNull(), hour).otherwise(on_dial).alias("hour"),
        F.when(has_clock, part(_CLOCK, 2).cast("int")).otherwise(0).alias("minute"),
        F.when(has_clock, second).otherwise(F.lit(0).cast("decimal(8,6)")).alias("second"),
        F.trim(F.regexp_replace(day, r"\s+", " ")).alias("day"),
    )


#: Shapes of a date, and what their groups are.
_SHAPES = {
    r"^(\d{4})[-/. ](\d{1,2})[-/. ](\d{1,2})$": "ymd",
    r"^(\d{4})(\d{2})(\d{2})$": "ymd",
    r"^(1[3-9]|2\d|3[01])[-/. ](\d{1,2})[-/. ](\d{4}|\d{2})$": "dmy",
    r"^(\d{1,2})[-/. ](\d{1,2})[-/. ](\d{4}|\d{2})$": "mdy",
    rf"^(\d{{1,2}})[-/. ]?({_MONTHS})[-/. ]?(\d{{4}}|\d{{2}})$": "dmy",
    rf"^({_MONTHS})[-/. ](\d{{1,2}})[-/. ](\d{{4}}|\d{{2}})$": "mdy",
    rf"^(\d{{4}})[-/. ]({_MONTHS})[-/. ](\d{{1,2}})$": "ymd",
    rf"^({_MONTHS})[-/. ](\d{{4}})$": "my",
    r"^(\d{4})[-/.](\d{1,2})$": "ym",
}


def _assembled(pieces: Column) -> Column:
    found = F.lit(None).cast("struct<y:string,m:string,d:string>")
    for pattern, order in reversed(_SHAPES.items()):
        group = {p: F.regexp_extract(pieces["day"], pattern, i + 1) for i, p in enumerate(order)}
        fields = [group.get(p, F.lit("1")).alias(p) for p in "ymd"]
        found = F.when(pieces["day"].rlike(pattern), F.struct(*fields)).otherwise(found)

    def made(date: Column) -> Column:
        year = date["y"].try_cast("int")
        year = F.when(F.length(date["y"]) > 2, year).otherwise(year + F.when(year >= _PIVOT, 1900).otherwise(2000))
        place = F.instr(F.lit("janfebmaraprmayjunjulaugsepoctnovdec"), F.substring(date["m"], 1, 3))
        month = F.coalesce(date["m"].try_cast("int"), ((place + 2) / 3).cast("int"))
        clock = (pieces["hour"], pieces["minute"], pieces["second"])
        return F.try_make_timestamp(year, month, date["d"].try_cast("int"), *clock)

    return F.timestamp_add("MINUTE", -pieces["offset"], _once(found, made))


def date_key(day: Column) -> Column:
    """yyyyMMdd as a number."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("long")


def calendar_columns(day: Column) -> dict[str, Column]:
    """All columns of the date dimension from one date column. `week` counts from 0 and starts on Sunday."""
    return {
        "date_key": date_key(day),
        "full_date": day,
        "year": F.year(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "quarter": F.quarter(day),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": F.date_format(day, "EEEE"),
        "week": F.floor((F.dayofyear(day) - F.dayofweek(day) + 7) / 7).cast("int"),
    }
