"""Dates in the notations that people write.

A text is read by its shape: digits and month names are replaced by signs, and
a table says for each shape where year, month and day stand. What has no shape
in the table is not a date.

* Numbers with ``/``, ``-`` or ``.`` are year first if the year comes first,
  else month first; day first only if the first number cannot be a month.
* Eight digits are year, month and day. Other runs of digits are not dates,
  but four digits alone are a year.
* Month names, short or whole, in any case; a day's name in front is skipped.
* Years of two digits: 69 to 99 are 1969 to 1999, 00 to 68 are 2000 to 2068.
* Times of 24 hours, or of 12 with AM or PM; seconds and fractions of them may
  be absent. A zone after the time is not applied: the clock time counts.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.
# ---------------------------------------------------------------------------

MONTHS = (
    "JANUARY", "FEBRUARY", "MARCH", "APRIL", "MAY", "JUNE", "JULY", "AUGUST", "SEPTEMBER",
    "OCTOBER", "NOVEMBER", "DECEMBER",
)
DAYS = ("MONDAY", "TUESDAY", "WEDNESDAY", "THURSDAY", "FRIDAY", "SATURDAY", "SUNDAY")

#: shape → which number is the year, the month, the day (from 1). 0: the month's
#: name, -1: absent. Signs: y four digits, n one or two, b a month's name.
SHAPES = {
    "y-n-n": (1, 2, 3), "y/n/n": (1, 2, 3), "y.n.n": (1, 2, 3),
    "n-n-y": (3, 1, 2), "n/n/y": (3, 1, 2), "n.n.y": (3, 1, 2),
    "n-n-n": (3, 1, 2), "n/n/n": (3, 1, 2),
    "n-b-y": (2, 0, 1), "n/b/y": (2, 0, 1), "n b y": (2, 0, 1), "n b, y": (2, 0, 1),
    "n-b-n": (2, 0, 1), "n b n": (2, 0, 1),
    "b n y": (2, 0, 1), "b n, y": (2, 0, 1), "b-n-y": (2, 0, 1),
    "y-b-n": (1, 0, 2), "y b n": (1, 0, 2),
    "b y": (1, 0, -1), "b, y": (1, 0, -1), "b-y": (1, 0, -1),
    "y-n": (1, 2, -1), "y/n": (1, 2, -1), "n/y": (2, 1, -1),
    "y": (1, -1, -1),
}

# ---------------------------------------------------------------------------

_MONTH = "(?:SEPT|" + "|".join(f"{m[:3]}(?:{m[3:]})?" for m in MONTHS) + r")\b\.?"
_DAY = "^(?:" + "|".join(f"{d[:3]}(?:{d[3:]})?" for d in DAYS) + r")\b\.?,?\s+"
_ZONE = r"(:\d{2}(?:\.\d+)?)\s*(?:Z|UTC|GMT|[+-]\d{2}:?\d{2})$"
_SPLIT = r"^(.*?)(?:(?:\s+|(?<=\d)T)(\d{1,2}(?::.*|\s*[AP]\.?M\.?)))?$"
_TIME = r"^(\d{1,2})(?::(\d{2})(?::(\d{2}(?:\.\d{1,9})?))?)?\s*(?:([AP])\.?M\.?)?$"
_ISO = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?)?$"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once. A lambda keeps expressions
    that use a value many times small, also in the code generated for them."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _by_shape() -> Column:
    pairs = [
        part for shape, at in SHAPES.items() for part in (F.lit(shape), F.array(*map(F.lit, at)))
    ]
    return F.create_map(*pairs)


def _number(text: Column) -> Column:
    return F.nullif(text, F.lit("")).try_cast("int")


def _halves(clock: Column) -> Column:
    """(date, time) of a text without zone and day's name."""
    date = F.regexp_extract(clock, _SPLIT, 1)
    date = F.regexp_replace(date, r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return F.struct(date.alias("date"), F.regexp_extract(clock, _SPLIT, 2).alias("time"))


def _looked_up(halves: Column) -> Column:
    """The shape of the date and where its numbers stand."""
    signs = [(_MONTH, "b"), (r"\d{4}", "y"), (r"\d{1,2}", "n"), (r"\s+", " ")]
    shape = reduce(lambda t, s: F.regexp_replace(t, *s), signs, halves["date"])
    name = F.substring(F.regexp_extract(halves["date"], f"({_MONTH})", 1), 1, 3)
    return F.struct(
        shape.alias("shape"),
        F.regexp_extract_all(halves["date"], F.lit(r"(\d+)"), F.lit(1)).alias("numbers"),
        F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), name).cast("int").alias("named"),
        F.regexp_extract(halves["time"], _TIME, 1).alias("hour"),
        F.regexp_extract(halves["time"], _TIME, 2).alias("minute"),
        F.regexp_extract(halves["time"], _TIME, 3).alias("second"),
        F.regexp_extract(halves["time"], _TIME, 4).alias("half"),
        (halves["time"] == "").alias("whole_day"),
    )


def _parts(seen: Column) -> Column:
    """Year, first and second number and time as numbers."""
    at = F.try_element_at(_by_shape(), seen["shape"])

    def part(place: Column, i: int) -> Column:
        here = F.get(place, F.lit(i))
        number = F.try_element_at(seen["numbers"], F.when(here > 0, here)).try_cast("int")
        return F.when(here == -1, F.lit(1)).otherwise(number)

    def of(place: Column) -> Column:
        return F.struct(
            part(place, 0).alias("year"), part(place, 1).alias("month"), part(place, 2).alias("day"),
            (F.get(place, F.lit(1)) == 0).alias("is_named"),
        )

    hour = _number(seen["hour"])
    in_day = F.when(seen["half"] == "", hour).when(
        hour.between(1, 12), hour % 12 + F.when(seen["half"] == "P", F.lit(12)).otherwise(F.lit(0))
    )
    second = F.nullif(seen["second"], F.lit("")).try_cast("decimal(16,6)")
    return F.struct(
        _let(at, of).alias("date"),
        seen["named"].alias("named"),
        F.contains(seen["shape"], F.lit("y")).alias("is_full"),
        F.startswith(seen["shape"], F.lit("n")).alias("number_first"),
        F.when(seen["whole_day"], F.lit(0)).otherwise(in_day).alias("hour"),
        F.coalesce(_number(seen["minute"]), F.lit(0)).alias("minute"),
        F.coalesce(second, F.lit(0).cast("decimal(16,6)")).alias("second"),
    )


def _timestamp(p: Column) -> Column:
    year, month, day = (p["date"][n] for n in ("year", "month", "day"))
    full = F.when(p["is_full"] | (year > 99), year).when(year < 69, year + 2000).otherwise(year + 1900)
    swapped = p["number_first"] & ~p["date"]["is_named"] & (month > 12) & (day <= 12)
    in_year = F.when(p["date"]["is_named"], p["named"]).when(swapped, day).otherwise(month)
    in_month = F.when(swapped, month).otherwise(day)
    return F.try_make_timestamp_ntz(full, in_year, in_month, p["hour"], p["minute"], p["second"])


def _written(text: Column) -> Column:
    """Timestamp of an upper-case text in any notation."""
    clock = F.regexp_replace(F.regexp_replace(text, _ZONE, "$1"), _DAY, "")
    return _let(clock, lambda c: _let(_halves(c), lambda h: _let(_looked_up(h), lambda s: _let(_parts(s), _timestamp))))


def read_timestamp(text: Column) -> Column:
    """Timestamp without a zone, or null. ISO texts, by far the most frequent,
    take the engine's own parser; the shape of others is looked at."""
    trimmed = F.upper(F.trim(text))
    iso = F.when(trimmed.rlike(_ISO), trimmed.try_cast("timestamp_ntz"))
    return F.coalesce(iso, F.when(~trimmed.rlike(_ISO), _written(trimmed)))
