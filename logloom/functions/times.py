"""UNIX seconds, dates and strptime formats, all independent of the session time zone."""

from __future__ import annotations

import re
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# What strptime directives match, in two widths. The strict width is for digits that touch
# the next directive; the lenient one also takes unpadded numbers.
_DIRECTIVES = {
    "Y": ("[0-9]{4}", "[0-9]{4}"),
    "y": ("[0-9]{2}", "[0-9]{2}"),
    "m": ("[0-9]{2}", "[0-9]{1,2}"),
    "d": ("[0-9]{2}", " ?[0-9]{1,2}"),
    "e": (" ?[0-9]{1,2}", " ?[0-9]{1,2}"),
    "j": ("[0-9]{3}", "[0-9]{1,3}"),
    "H": ("[0-9]{2}", " ?[0-9]{1,2}"),
    "I": ("[0-9]{2}", " ?[0-9]{1,2}"),
    "M": ("[0-9]{2}", "[0-9]{1,2}"),
    "S": ("[0-9]{2}", "[0-9]{1,2}"),
    "f": ("[0-9]{1,6}", "[0-9]{1,6}"),
    "b": ("[A-Za-z]{3}", "[A-Za-z]{3}"),
    "h": ("[A-Za-z]{3}", "[A-Za-z]{3}"),
    "B": ("[A-Za-z]{3,9}", "[A-Za-z]{3,9}"),
    "p": ("[AaPp][Mm]", "[AaPp][Mm]"),
    "z": ("Z|[+-][0-9]{2}:?[0-9]{2}", "Z|[+-][0-9]{2}:?[0-9]{2}"),
    "Z": ("UTC|GMT", "UTC|GMT"),
    "a": ("[A-Za-z]{3}", "[A-Za-z]{3}"),
    "A": ("[A-Za-z]{6,9}", "[A-Za-z]{6,9}"),
}
_COMPOUND = {"T": "%H:%M:%S", "R": "%H:%M", "D": "%m/%d/%y", "F": "%Y-%m-%d"}
_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october",
           "november", "december")
# Fixed value: two-digit years from here on belong to the last century.
_PIVOT = 69
_SEPARATOR = "\x01"


def floor_to(time: Column, width: int, origin: int = 0) -> Column:
    """Start of the `width` seconds wide span, counted from `origin`, that a time lies in."""
    return time - F.pmod(time - F.lit(origin), F.lit(width))


def seconds(ts: Column) -> Column:
    """UNIX seconds of a TIMESTAMP_NTZ taken as UTC; the session time zone plays no part."""
    in_day = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return F.unix_date(ts.cast("date")).cast("bigint") * 86400 + in_day


def utc_date(time: Column) -> Column:
    """UTC calendar day of UNIX seconds."""
    return F.date_from_unix_date((floor_to(time, 86400) / 86400).cast("int"))


def utc_day(time: int) -> Column:
    """The same for a number known when the query is built."""
    return F.date_from_unix_date(F.lit(time // 86400).cast("int"))


def _parts(strptime: str) -> list[tuple[bool, str]]:
    """Directives and literal characters of a format, in one scan, compound directives taken apart."""
    parts: list[tuple[bool, str]] = []
    for directive, literal in re.findall(r"%(.)|(%$|[^%])", strptime, re.DOTALL):
        if directive == "%":
            parts.append((False, "%"))
        elif directive in _COMPOUND:
            parts += _parts(_COMPOUND[directive])
        elif directive:
            parts.append((True, directive))
        else:
            parts.append((False, literal))
    return parts


def time_regex(strptime: str) -> tuple[str, list[str]]:
    """A regex for whole values of a strptime format, with a group per directive, and the directives; one
    that cannot be parsed is a ValueError."""
    parts = _parts(strptime)
    found = [p for is_directive, p in parts if is_directive]
    for letter in found:
        if letter not in _DIRECTIVES:
            raise ValueError(f"time format directive %{letter} is not supported")
    named = set(found)
    if not (named & {"Y", "y"} and (named & {"m", "b", "h", "B"} and named & {"d", "e"} or "j" in named)):
        raise ValueError(f"time format {strptime!r} does not name a full date")
    if "I" in named and "p" not in named:
        raise ValueError("a 12-hour clock needs %p")
    regex = ""
    for n, (is_directive, p) in enumerate(parts):
        if not is_directive:
            regex += r"\s+" if p.isspace() else re.escape(p)
            continue
        touches = any(0 <= m < len(parts) and parts[m][0] for m in (n - 1, n + 1))
        regex += f"({_DIRECTIVES[p][0 if touches else 1]})"
    return rf"\A{regex}\s*\z", found


def _time_of(fields: Column, directives: list[str], zone: str) -> Column:
    """UNIX seconds from the texts of the directives, NULL where they name no time."""
    def text(*letters: str) -> Column | None:
        places = [n for n, d in enumerate(directives) if d in letters]
        return F.get(fields, F.lit(places[-1] + 1)) if places else None

    def number(*letters: str) -> Column | None:
        found = text(*letters)
        return None if found is None else F.trim(found).try_cast("int")

    year = number("Y")
    if year is None:
        short = number("y")
        year = short + F.when(short >= _PIVOT, 1900).otherwise(2000)
    month = number("m")
    if month is None and text("b", "h", "B") is not None:
        names = F.create_map(*chain.from_iterable(
            (F.lit(k), F.lit(n)) for n, m in enumerate(_MONTHS, 1) for k in dict.fromkeys((m, m[:3]))))
        month = F.try_element_at(names, F.lower(text("b", "h", "B")))
    hour = number("H")
    if hour is None and text("I") is not None:
        afternoon = F.lower(text("p")) == "pm"
        twelve = number("I")
        hour = F.when(twelve.between(1, 12), twelve % 12 + F.when(afternoon, 12).otherwise(0))
    hour, minute, second = (F.lit(0) if c is None else c for c in (hour, number("M"), number("S")))
    if month is None:
        days = number("j")
        valid = days.between(1, 365) | ((days == 366) & (F.dayofyear(F.make_date(year, F.lit(12), F.lit(31))) == 366))
        date = F.when(valid, F.date_add(F.make_date(year, F.lit(1), F.lit(1)), days - 1))
        parts = [F.year(date), F.month(date), F.day(date)]
    else:
        parts = [year, month, number("d", "e")]
    # strptime takes second 60 and 61, which no calendar day has
    local = F.try_make_timestamp_ntz(*parts, hour, minute, F.least(second, F.lit(59)).cast("decimal(16,6)"))
    if text("z") is not None:
        offset = F.replace(F.replace(text("z"), F.lit(":")), F.lit("Z"), F.lit("+0000"))
        sign = F.when(offset.startswith("-"), -1).otherwise(1)
        ahead = sign * (F.substring(offset, 2, 2).try_cast("int") * 3600 + F.substring(offset, 4, 2).try_cast("int") * 60)
        return seconds(local) - ahead
    if text("Z") is not None or zone == "UTC":
        return seconds(local)
    return seconds(F.convert_timezone(F.lit(zone), F.lit("UTC"), local))


def parse_seconds(value: Column, strptime: str, zone: str = "UTC") -> Column:
    """UNIX seconds of a formatted time, NULL when it does not parse. `zone` applies when the
    format carries no offset; `%s` is plain UNIX seconds. Names of days are skipped, names of zones
    other than UTC and GMT do not parse."""
    if strptime == "%s":
        return F.when(value.rlike(r"\A\s*[0-9]+\s*\z"), value.try_cast("bigint"))
    regex, directives = time_regex(strptime)
    # One replacement writes all groups, so the regex runs once; what does not match stays one piece.
    written = F.regexp_replace(value, regex, "".join(f"{_SEPARATOR}${n}" for n in range(1, len(directives) + 1)))
    fields = F.split(written, _SEPARATOR)
    time = F.transform(F.array(fields), lambda f: F.when(
        (F.size(f) == len(directives) + 1) & (F.get(f, F.lit(0)) == ""), _time_of(f, directives, zone)))
    return F.when(~F.contains(value, F.lit(_SEPARATOR)), F.get(time, F.lit(0)))
