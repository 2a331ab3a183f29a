"""One text and one digest for any nested value, generated from its type.

Two values of a type have the same canonical text exactly if they are equal:
every field is written with its name, every leaf with its length, nulls have a
sign of their own at each level, and map entries are sorted by key.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostermill.functions.scalars import unfused

NULL = "-"
#: texts of fewer code points find what stands before them in a list
LISTED = 100
#: a concat of more parts is above what the JVM compiles as one method
FEW_PARTS = 30
_LEADS = "split('" + " ".join(f"{n}:" for n in range(LISTED)) + "', ' ')"


def _leaf_parts(head: str, value: str) -> list[str]:
    """Name, length and text of a leaf; a null leaf has the sign of nulls."""
    text = f"CAST({value} AS STRING)"
    lead = f"coalesce(get({_LEADS}, length({text})), concat(length({text}), ':'), '{NULL}')"
    return [f"'{head}'", lead, f"coalesce({text}, '')"]


def _field_parts(
    fields: list[T.StructField], root: str, opening: str = "", depth: int = 0, present: bool = True
) -> list[str]:
    """SQL texts whose results, one after another, are the fields' canonical texts.

    ``present``: what holds the fields is not null, so neither are structs that
    their type declares so, and their fields are parts like all others.
    """
    parts = []
    for i, f in enumerate(fields):
        head, value = f"{opening if i == 0 else ','}{f.name}=", f"{root}`{f.name}`"
        if present and isinstance(f.dataType, T.StructType) and f.dataType.fields and not f.nullable:
            parts += _field_parts(f.dataType.fields, f"{value}.", head + "{", depth) + ["'}'"]
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            parts += [f"'{head}'", canonical_sql(f.dataType, value, depth)]
        else:
            parts += _leaf_parts(head, value)
    return parts


def canonical_sql(kind: T.DataType, value: str, depth: int = 0) -> str:
    """SQL text that gives the canonical text of ``value``, an SQL expression.

    struct ``{name=...,...}``, array ``[...,...]``, map as an array of
    (key, value) sorted by key, leaf ``length:text``, null ``-``.
    """
    if isinstance(kind, T.StructType):
        parts = _field_parts(kind.fields, f"{value}.", "{", depth)
        whole = "concat(" + ", ".join(parts) + ", '}')" if parts else "'{}'"
    elif isinstance(kind, T.ArrayType):
        item = f"x{depth}"
        each = canonical_sql(kind.elementType, item, depth + 1)
        whole = f"concat('[', array_join(transform({value}, {item} -> {each}), ','), ']')"
    elif isinstance(kind, T.MapType):
        entry = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        return canonical_sql(T.ArrayType(entry), f"array_sort(map_entries({value}))", depth)
    else:
        return "concat(" + ", ".join(_leaf_parts("", value)) + ")"
    return f"CASE WHEN {value} IS NULL THEN '{NULL}' ELSE {whole} END"


def row_digest(schema: T.StructType, root: str | None = None) -> Column:
    """SHA-256 of the canonical text of a struct column, or of whole rows.

    Map keys must be sortable. The text is one ``concat`` of all names, lengths
    and leaves, so each is copied once; wide layouts cost one pass and no Python.
    With many parts, one more is an empty text that keeps the step by itself.
    """
    parts = _field_parts(schema.fields, f"{root}." if root else "", present=root is None)
    if len(parts) > FEW_PARTS:
        value = f"{root}." if root else ""
        alone = unfused(f"{value}`{schema.fields[0].name}` IS NULL")
        parts.append(f"substring(CAST({alone} AS STRING), 1, 0)")
    return F.expr("sha2(concat(" + ", ".join(parts) + "), 256)")
