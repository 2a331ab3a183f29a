"""Chat records of several layouts as one formatted text with a loss mask.

The nested field paths of a record are hashed, and the fingerprint selects a
declarative mapping to turns. Of a record's paths those that a mapping knows
are fingerprinted, so further fields do not matter, whatever their names; of
several mappings that fit, the one of most paths counts. A table's own schema
is looked at once; records kept as JSON are told row by row, so one column may
mix layouts. Everything is DataFrame expressions.

Turns are written in a template whose markers enclose each text::

    <<SYS>>text<</SYS>>   [INST]text[/INST]   <s>text</s>
    [ROLE]role[SAYS]text[/ROLE]          for any other role

Inside texts and roles a backslash becomes ``\\b`` and the first character of
a control string becomes ``\\o`` (for ``[``) or ``\\l`` (for ``<``), so
markers never occur in them and the escape can be undone. The loss mask is the
list of spans of the assistant's texts in the formatted text, in code points.

Edge cases: null text or role counts as empty; turns are ordered by turn (null
first), then role, then text, so ties have one result; repeated rows are
turns of their own; rows with a null conversation id form one conversation;
unknown layouts raise for a table and are listed, with their fingerprint,
by :func:`unmapped_json` for JSON. A conversation is one row of output, so the
turns of one conversation meet in one task; that is the format's limit.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# fixed values: the template's markers by role, and those of other roles
MARKERS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("[ROLE]", "[SAYS]", "[/ROLE]")
CODES = {"\\": "\\b", "[": "\\o", "<": "\\l"}

CONTROL = [marker for pair in MARKERS.values() for marker in pair] + list(OTHER)


# -- layouts ------------------------------------------------------------------


def field_paths(kind: T.DataType, at: str = "") -> list[str]:
    """Paths of the leaves of a type; ``[]`` stands for an array's elements."""
    if isinstance(kind, T.StructType):
        return [p for f in kind.fields for p in field_paths(f.dataType, f"{at}.{f.name}" if at else f.name)]
    if isinstance(kind, T.ArrayType):
        return field_paths(kind.elementType, f"{at}[]")
    return [at]


@dataclass(frozen=True)
class Mapping:
    """A layout: its leaf paths and, in SQL, its turns as (role, text) structs."""

    name: str
    paths: tuple[str, ...]
    turns: str
    ddl: str
    #: the turn's number, where a record is one turn; else turns are counted
    number: str | None = None

    @property
    def print(self) -> str:
        return fingerprint(self.paths)


def fingerprint(paths: Iterable[str]) -> str:
    """Digest of a set of field paths."""
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def _turn(role: str, text: str) -> str:
    return f"named_struct('role', {role}, 'text', {text})"


MAPPINGS = [
    Mapping(
        "turn",
        ("role", "text", "turn"),
        f"array({_turn('role', 'text')})",
        "role string, text string, turn long",
        "turn",
    ),
    Mapping(
        "messages",
        ("messages[].role", "messages[].content"),
        "transform(messages, m -> named_struct('role', m.role, 'text', m.content))",
        "messages array<struct<role: string, content: string>>",
    ),
    Mapping(
        "from and value",
        ("conversations[].from", "conversations[].value"),
        "transform(conversations, m -> named_struct('role', CASE m.`from` WHEN 'human' THEN 'user' "
        "WHEN 'gpt' THEN 'assistant' ELSE m.`from` END, 'text', m.value))",
        "conversations array<struct<`from`: string, value: string>>",
    ),
    Mapping(
        "prompt",
        ("prompt", "completion"),
        f"array({_turn(repr('user'), 'prompt')}, {_turn(repr('assistant'), 'completion')})",
        "prompt string, completion string",
    ),
    Mapping(
        "prompt and response",
        ("prompt", "response"),
        f"array({_turn(repr('user'), 'prompt')}, {_turn(repr('assistant'), 'response')})",
        "prompt string, response string",
    ),
    Mapping(
        "instruction",
        ("instruction", "output"),
        f"array({_turn(repr('user'), 'instruction')}, {_turn(repr('assistant'), 'output')})",
        "instruction string, output string",
    ),
    Mapping(
        "instruction with input",
        ("instruction", "input", "output"),
        "array(" + _turn("'user'", r"concat_ws('\n', instruction, nullif(input, ''))") + f", {_turn(repr('assistant'), 'output')})",
        "instruction string, input string, output string",
    ),
]
_BY_PRINT = {m.print: m for m in MAPPINGS}
#: those of most paths first, the earlier one of several
_CHOICE = sorted(MAPPINGS, key=lambda m: -len(m.paths))
_KNOWN = sorted({p for m in MAPPINGS for p in m.paths})


def canonical_turns(df: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, turn, role, text) from a table in any known layout.

    A layout fits if the fingerprint of the paths that it knows is its own;
    further columns do not matter. An unknown layout raises.
    """
    paths = {p for p in field_paths(df.schema) if p != key}
    prints = (fingerprint(paths.intersection(m.paths)) for m in _CHOICE)
    found = next((_BY_PRINT[p] for p in prints if p in _BY_PRINT), None)
    if found is None:
        raise ValueError(f"no mapping for the fields {sorted(paths.intersection(_KNOWN))}")
    if found.number is not None:
        return df.select(key, found.number, "role", "text")
    return _turn_rows(df.select(key, F.expr(found.turns).alias("turns")), key)


def _turn_rows(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, F.posexplode("turns").alias("turn", "t")).select(key, "turn", "t.role", "t.text")


def _prefixed(texts: Column, prefix: str) -> Column:
    return F.transform(texts, lambda t: F.concat(F.lit(prefix), t))


def json_paths(record: Column) -> Column:
    """Field paths of a JSON record, as far as mappings know them.

    An empty list stands for a list of all its fields, so that a record
    without turns has a layout. Null for what is not a JSON object.
    """
    names = F.json_object_keys(record)
    paths = names
    for owner in sorted({p.split("[]")[0] for p in _KNOWN if "[]" in p}):
        inner = [p for p in _KNOWN if p.startswith(f"{owner}[].")]
        items = F.from_json(F.get_json_object(record, f"$.{owner}"), T.ArrayType(T.StringType()))
        # a list element that is no object has no keys
        keys = F.flatten(F.transform(items, lambda x: F.coalesce(F.json_object_keys(x), F.array().cast("array<string>"))))
        found = _prefixed(keys, f"{owner}[].")
        empty = F.array(*[F.lit(p) for p in inner])
        none = F.array().cast("array<string>")
        found = F.when(F.size(items) == 0, empty).otherwise(F.coalesce(found, none))
        paths = F.concat(paths, F.when(F.array_contains(names, owner), found).otherwise(none))
    return F.array_distinct(paths)


def _print_of(paths: Column, known: Iterable[str]) -> Column:
    """:func:`fingerprint` of those of a column's paths that are ``known``."""
    mine = F.array_intersect(paths, F.array(*[F.lit(p) for p in sorted(known)]))
    return F.sha2(F.array_join(F.sort_array(mine), "\n"), 256)


def _chosen(paths: Column) -> Column:
    """Number of the mapping that a record's paths select, or null."""
    return F.coalesce(*[F.when(_print_of(paths, m.paths) == m.print, F.lit(MAPPINGS.index(m))) for m in _CHOICE])


def turns_of_json(df: DataFrame, record: str, key: str = "conv_id") -> DataFrame:
    """(key, turn, role, text) from JSON records of mixed layouts.

    Further fields do not matter, as in tables; a record whose list of turns
    is empty gives no row.
    """
    marked = df.select(key, F.col(record).alias("_record"), json_paths(F.col(record)).alias("_paths"))
    marked = marked.withColumn("_chosen", _chosen(F.col("_paths")))
    shape = T.ArrayType(T.StructType([T.StructField("role", T.StringType()), T.StructField("text", T.StringType())]))
    turns, number = F.lit(None).cast(shape), F.lit(None).cast("long")
    for at, mapping in enumerate(MAPPINGS):
        fits = F.col("_chosen") == at
        marked = marked.withColumn(f"_m{at}", F.when(fits, F.from_json("_record", mapping.ddl)))
        turns = F.when(fits, F.expr(_inside(mapping, f"_m{at}"))).otherwise(turns)
        if mapping.number:
            number = F.when(fits, F.col(f"_m{at}.{mapping.number}")).otherwise(number)
    rows = marked.select(key, number.alias("_number"), F.posexplode(turns).alias("turn", "t"))
    at = F.coalesce("_number", F.col("turn").cast("long")).alias("turn")
    return rows.select(key, at, "t.role", "t.text")


def _inside(mapping: Mapping, owner: str) -> str:
    """The turns of a mapping whose fields lie in the struct ``owner``."""
    sql = mapping.turns
    for name in {re.split(r"[.\[]", path)[0] for path in mapping.paths}:
        sql = re.sub(rf"(?<![\w.'`]){name}(?![\w'`(])", f"{owner}.{name}", sql)
    return sql


def unmapped_json(df: DataFrame, record: str, key: str = "conv_id") -> DataFrame:
    """(key, print) of JSON records whose layout no mapping fits.

    ``print`` is the fingerprint of their known paths, null for what is not a
    JSON object.
    """
    found = df.select(key, json_paths(F.col(record)).alias("paths"))
    return found.where(_chosen(F.col("paths")).isNull()).select(key, _print_of(F.col("paths"), _KNOWN).alias("print"))


# -- template -----------------------------------------------------------------


def escape(text: Column) -> Column:
    """Text without control strings."""
    out = F.replace(text, F.lit("\\"), F.lit(CODES["\\"]))
    for control in CONTROL:
        out = F.replace(out, F.lit(control), F.lit(CODES[control[0]] + control[1:]))
    return out


def unescape(text: Column) -> Column:
    """What was escaped."""
    for plain in ("[", "<", "\\"):
        text = F.replace(text, F.lit(CODES[plain]), F.lit(plain))
    return text


def format_turns(turns: DataFrame, key: str = "conv_id") -> DataFrame:
    """One row per conversation: key, formatted, loss_spans (start, length)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    before = F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1]))
    after = F.lit(OTHER[2])
    for name, (opens, closes) in MARKERS.items():
        before = F.when(role == name, F.lit(opens)).otherwise(before)
        after = F.when(role == name, F.lit(closes)).otherwise(after)
    pieces = turns.select(
        key, "turn", role.alias("role"), text.alias("text"), before.alias("before"), escape(text).alias("escaped"), after.alias("after")
    )
    size = F.length("before") + F.length("escaped") + F.length("after")
    upto = Window.partitionBy(key).orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    placed = pieces.withColumn("end", F.sum(size.cast("long")).over(upto))
    start = F.col("end") - F.length("after") - F.length("escaped")
    row = F.struct(
        "end",
        F.concat("before", "escaped", "after").alias("piece"),
        F.when(F.col("role") == "assistant", F.struct(start.alias("start"), F.length("escaped").cast("long").alias("length"))).alias("span"),
    )
    whole = placed.groupBy(key).agg(F.sort_array(F.collect_list(row)).alias("rows"))
    return whole.select(
        key,
        F.array_join("rows.piece", "").alias("formatted"),
        F.filter("rows.span", lambda s: s.isNotNull()).alias("loss_spans"),
    )


_PATTERN = "(?s)" + "|".join(
    rf"\Q{opens}\E.*?\Q{closes}\E" for opens, closes in [*MARKERS.values(), (OTHER[0], OTHER[2])]
)


def read_back(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """The turns and the text under the mask, from the formatted text alone.

    Returns key, turns (role, text), loss_text, formatted.
    """
    pieces = F.regexp_extract_all("formatted", F.lit(_PATTERN), F.lit(0))

    def between(piece: Column, opens: str, closes: str) -> Column:
        return F.substr(piece, F.lit(len(opens) + 1), F.length(piece) - len(opens) - len(closes))

    def turn(piece: Column) -> Column:
        inner = between(piece, OTHER[0], OTHER[2])
        cut = F.instr(inner, OTHER[1])
        role = unescape(F.substr(inner, F.lit(1), cut - 1))
        text = F.substr(inner, cut + len(OTHER[1]))
        for name, (opens, closes) in MARKERS.items():
            mine = F.startswith(piece, F.lit(opens))
            role = F.when(mine, F.lit(name)).otherwise(role)
            text = F.when(mine, between(piece, opens, closes)).otherwise(text)
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    masked = F.transform(
        "loss_spans", lambda s: F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), s["length"].cast("int"))
    )
    return formatted.select(
        key, F.transform(pieces, turn).alias("turns"), unescape(F.array_join(masked, "")).alias("loss_text"), "formatted"
    )
