"""Projection, schema and missing-value operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostermill.schemas import NA_TOKENS, ORDINAL


def project_columns(df: DataFrame, columns: Iterable[str], keep: Iterable[str] = ()) -> DataFrame:
    """Select ``columns``; a missing one is an error. ``keep`` may be absent."""
    wanted = list(columns)
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    extra = [c for c in keep if c in df.columns and c not in wanted]
    return df.select(*wanted, *extra)


def enforce_string_schema(
    df: DataFrame, columns: Iterable[str], required: Iterable[str] | None = None
) -> DataFrame:
    """All ``columns`` as nullable strings, with the scan's position columns.

    A column that is absent becomes null unless it is required (all are, by
    default).
    """
    wanted = list(columns)
    need = wanted if required is None else list(required)
    missing = [c for c in need if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    present = set(df.columns)
    texts = [f"CAST({c if c in present else 'NULL'} AS STRING) AS `{c}`" for c in wanted]
    return df.selectExpr(*texts, *[c for c in ORDINAL if c in present])


def normalize_nulls(
    df: DataFrame, columns: Iterable[str] | None = None, tokens: Iterable[str] = NA_TOKENS
) -> DataFrame:
    """Turn the usual "missing" texts into null; NaN in doubles too."""
    fields = df.schema.fields
    names = {f.name for f in fields} if columns is None else set(columns)
    marks = ", ".join("'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'" for t in tokens)

    def cleaned(field: T.StructField) -> str:
        value = f"`{field.name}`"
        if field.name not in names or field.name in ORDINAL:
            return value
        if isinstance(field.dataType, T.StringType):
            return f"CASE WHEN trim({value}) NOT IN ({marks}) THEN {value} END AS {value}"
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            return f"CASE WHEN NOT isnan({value}) THEN {value} END AS {value}"
        return value

    return df.selectExpr(*[cleaned(f) for f in fields])


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def drop_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)


def filter_not_equal(df: DataFrame, column: str, value: object) -> DataFrame:
    """Rows whose column differs from the value; null differs too."""
    return df.where(~F.col(column).eqNullSafe(F.lit(value)))


def filter_changed(df: DataFrame, old: str | Column, new: str | Column) -> DataFrame:
    """Rows where the two sides differ, null being equal to null."""
    left = F.col(old) if isinstance(old, str) else old
    right = F.col(new) if isinstance(new, str) else new
    return df.where(~left.eqNullSafe(right))


def filter_any_present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows with at least one non-null value among the columns."""
    return df.where(F.coalesce(*[F.col(c).cast("string") for c in columns]).isNotNull())


def page_after(df: DataFrame, key: str, after: object | None, rows: int) -> DataFrame:
    """The next ``rows`` rows after a key, in key order (None: the first)."""
    rest = df if after is None else df.where(F.col(key) > F.lit(after))
    return rest.orderBy(key).limit(rows)
