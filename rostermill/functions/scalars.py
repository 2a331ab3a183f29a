"""Scalar column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from rostermill.codes import GENDERS
from rostermill.functions.dates import read_timestamp

ColumnOrName = Column | str

def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts_tolerant(text: ColumnOrName) -> Column:
    """Wall-clock timestamp of a text, null when it cannot be read.

    The notations are those of :mod:`~rostermill.functions.dates`. The result
    has no zone, so it does not depend on the session's.
    """
    return read_timestamp(col(text))


def parse_ts_strict(text: ColumnOrName) -> Column:
    """Like :func:`parse_ts_tolerant`, but unreadable text is an error."""
    value = col(text)
    problem = F.raise_error(F.concat(F.lit("not a date: "), value))
    return F.when(
        value.isNotNull(),
        F.coalesce(parse_ts_tolerant(value), problem.cast("timestamp_ntz")),
    )


def is_unreadable_ts(text: ColumnOrName) -> Column:
    """True where strict parsing would fail."""
    value = col(text)
    return value.isNotNull() & parse_ts_tolerant(value).isNull()


def format_date(ts: ColumnOrName) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd")


def empty_to_null(text: ColumnOrName) -> Column:
    return F.nullif(col(text), F.lit(""))


def full_name(first: ColumnOrName, middle: ColumnOrName, last: ColumnOrName) -> Column:
    """Non-empty name parts joined by one blank; "" when there is none."""
    return F.concat_ws(" ", *[empty_to_null(p) for p in (first, middle, last)])


def name_of(demographic: str) -> Column:
    """:func:`full_name` over a stored demographic struct."""
    return full_name(
        f"{demographic}.firstName", f"{demographic}.middleName", f"{demographic}.lastName"
    )


def fallback_if_empty(value: ColumnOrName, other: ColumnOrName) -> Column:
    return F.coalesce(empty_to_null(value), col(other))


def gender_label(code: ColumnOrName) -> Column:
    """F/M/O in either case to the stored label, anything else null."""
    value = col(code)
    return reduce(
        lambda chain, item: chain.when(value.isin(item[0], item[0].lower()), item[1]),
        GENDERS.items(),
        F.when(F.lit(False), F.lit(None).cast("string")),
    )


def gender_code(label: ColumnOrName) -> Column:
    value = col(label)
    return reduce(
        lambda chain, item: chain.when(value == item[1], item[0]),
        GENDERS.items(),
        F.when(F.lit(False), F.lit(None).cast("string")),
    )


def qualifier_struct(code: ColumnOrName, label: ColumnOrName) -> Column:
    """{codeQualifier, label}; no code gives two empty texts.

    ``label`` is what the code list lookup found, null when unknown.
    """
    return F.struct(
        F.coalesce(col(code), F.lit("")).alias("codeQualifier"),
        F.when(col(code) != "", F.coalesce(col(label), F.lit("")))
        .otherwise("")
        .alias("label"),
    )


def nested_get(path: str, default=None) -> Column:
    """Field at a dotted path; the default when any level is null."""
    return F.coalesce(F.col(path), F.lit(default))


def default_flag(flag: ColumnOrName, default: bool = True) -> Column:
    return F.coalesce(col(flag), F.lit(default))


def surrogate_key(*parts: ColumnOrName) -> Column:
    """Deterministic id of a key tuple.

    Each part is written with its length, so ("a", null) and (null, "a")
    or parts that contain the separator never give the same text.
    """
    tagged = [
        F.coalesce(
            F.concat(
                F.length(col(p).cast("string")).cast("string"),
                F.lit(":"),
                col(p).cast("string"),
            ),
            F.lit("-"),
        )
        for p in parts
    ]
    return F.md5(F.concat_ws("#", *tagged).cast("binary"))


def epoch_millis(ts: ColumnOrName) -> Column:
    """Milliseconds since 1970-01-01 of a wall-clock timestamp.

    Counted between two zone-less timestamps, so the session zone plays
    no part.
    """
    elapsed = col(ts).cast("timestamp_ntz") - F.lit("1970-01-01").cast("timestamp_ntz")
    days = F.extract(F.lit("DAY"), elapsed).cast("bigint")
    hours = F.extract(F.lit("HOUR"), elapsed).cast("bigint")
    minutes = F.extract(F.lit("MINUTE"), elapsed).cast("bigint")
    seconds = F.extract(F.lit("SECOND"), elapsed)
    whole = (days * 24 + hours) * 3600 + minutes * 60
    return whole * 1000 + F.floor(seconds * 1000).cast("bigint")


def stored_name(received_ms: ColumnOrName, name: ColumnOrName) -> Column:
    return F.concat(col(received_ms).cast("string"), F.lit("-"), col(name))


def archive_key(module: str, stored: ColumnOrName, environment: str) -> Column:
    """``environment/module/stored`` without a doubled environment prefix."""
    prefix = environment.rstrip("/") + "/"
    key = F.concat(F.lit(f"{module}/"), col(stored))
    return F.when(key.startswith(prefix), key).otherwise(F.concat(F.lit(prefix), key))


def file_name(path: ColumnOrName) -> Column:
    return F.element_at(F.split(col(path), "/"), -1)


def file_suffix(name: ColumnOrName) -> Column:
    """Last extension with its dot, "" when there is none."""
    return F.regexp_extract(col(name), r"[^/.](\.[^./]+)$", 1)


def unfused(value: str) -> str:
    """SQL text with the same result as ``value``, taken through a lambda function.

    The engine fuses neighbouring steps into one method, and the JVM compiles
    no method above 8000 bytes: wide steps would be interpreted. A step that
    has a lambda function is not fused, and generated in small methods.
    """
    return f"get(transform(array({value}), x -> x), 0)"
