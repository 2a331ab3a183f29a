"""Scalar and array functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rostermill.catalog import query
from rostermill.catalog import tables as B
from rostermill.catalog.reshaping import LABELS
from rostermill.codes import relationship_table
from rostermill.functions import arrays as R
from rostermill.functions import scalars as X
from rostermill.operators.clean import filter_any_present
from rostermill.operators.match import code_lookup


#: how dates are written, by the order's number
_NOTATIONS = [
    "MM/dd/yyyy", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "M/d/yyyy h:mm a", "yyyyMMdd",
    "dd-MMM-yyyy", "MMMM d, yyyy", "M/d/yy",
]


def _dates(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates as text in eight notations; one priority is unreadable."""
    priority, number = F.col("o_orderpriority"), F.col("o_orderkey") % len(_NOTATIONS)
    written = F.coalesce(*[
        F.when(number == i, F.date_format("o_orderdate", form)) for i, form in enumerate(_NOTATIONS)
    ])
    return B.table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(priority != "3-MEDIUM", written).alias("strict"),
        F.when(priority == "3-MEDIUM", F.concat(F.lit("on "), written))
        .when(priority != "5-LOW", written).alias("loose"),
    )


@query(
    """
SELECT o_orderkey, CASE WHEN o_orderpriority <> '3-MEDIUM'
  THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS at
FROM orders
"""
)
def parse_ts_strict(spark: SparkSession, folder: str) -> DataFrame:
    at = X.parse_ts_strict("strict")
    return _dates(spark, folder).select(
        "o_orderkey", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("at")
    )


@query(
    """
SELECT o_orderkey, CASE WHEN o_orderpriority NOT IN ('3-MEDIUM', '5-LOW')
  THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS at
FROM orders
"""
)
def parse_ts_tolerant(spark: SparkSession, folder: str) -> DataFrame:
    at = X.parse_ts_tolerant("loose")
    return _dates(spark, folder).select(
        "o_orderkey", F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("at")
    )


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS day FROM events")
def format_date(spark: SparkSession, folder: str) -> DataFrame:
    return B.table(spark, folder, "events").select("event_id", X.format_date("ts").alias("day"))


@query("SELECT event_id, epoch_us(ts) // 1000 AS ms FROM events")
def epoch_millis(spark: SparkSession, folder: str) -> DataFrame:
    return B.table(spark, folder, "events").select("event_id", X.epoch_millis("ts").alias("ms"))


_NAMES = """
SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS f,
  CASE WHEN c_nationkey > 12 THEN '' WHEN c_nationkey > 5 THEN 'n' || c_nationkey END AS m,
  CASE WHEN c_acctbal > -500 THEN c_name END AS l
FROM customer
"""


def _names(spark: SparkSession, folder: str) -> DataFrame:
    nation, balance = F.col("c_nationkey"), F.col("c_acctbal")
    return B.table(spark, folder, "customer").select(
        "c_custkey",
        F.when(balance > 0, F.col("c_mktsegment")).alias("f"),
        F.when(nation > 12, F.lit(""))
        .when(nation > 5, F.concat(F.lit("n"), B.text("c_nationkey")))
        .alias("m"),
        F.when(balance > -500, F.col("c_name")).alias("l"),
    )


@query(
    f"""
SELECT c_custkey, concat_ws(' ', nullif(f, ''), nullif(m, ''), nullif(l, '')) AS name
FROM ({_NAMES})
"""
)
def full_name(spark: SparkSession, folder: str) -> DataFrame:
    return _names(spark, folder).select("c_custkey", X.full_name("f", "m", "l").alias("name"))


@query(
    f"""
SELECT c_custkey, concat_ws(' ', nullif(f, ''), nullif(m, ''), nullif(l, '')) AS name
FROM ({_NAMES}) WHERE concat_ws(' ', nullif(f, ''), nullif(m, ''), nullif(l, '')) <> ''
"""
)
def filter_nonempty(spark: SparkSession, folder: str) -> DataFrame:
    named = _names(spark, folder).select("c_custkey", X.full_name("f", "m", "l").alias("name"))
    return named.where(F.length("name") > 0)


@query(f"SELECT c_custkey, f, m FROM ({_NAMES}) WHERE f IS NOT NULL OR m IS NOT NULL")
def filter_any_patch(spark: SparkSession, folder: str) -> DataFrame:
    return filter_any_present(_names(spark, folder).select("c_custkey", "f", "m"), "f", "m")


@query(
    """
SELECT l_orderkey, l_partkey, CASE WHEN l_returnflag = 'N' OR l_linenumber = 1
  THEN CAST(l_suppkey AS VARCHAR) ELSE CAST(l_linenumber AS VARCHAR) END AS item
FROM lineitem
"""
)
def fallback_if_empty(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("l_linenumber")
    item = F.when(F.col("l_returnflag") == "N", F.lit("")).when(number != 1, B.text("l_linenumber"))
    lines = B.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", item.alias("a"), B.text("l_suppkey").alias("b")
    )
    return lines.select("l_orderkey", "l_partkey", X.fallback_if_empty("a", "b").alias("item"))


@query(
    """
SELECT c_custkey, CASE lower(substr(c_mktsegment, 1, 1)) WHEN 'f' THEN 'FEMALE' WHEN 'm'
  THEN 'MALE' WHEN 'o' THEN 'OTHER' END AS gender
FROM customer
"""
)
def map_code_to_enum(spark: SparkSession, folder: str) -> DataFrame:
    code = F.substring("c_mktsegment", 1, 1)
    code = F.when(F.col("c_acctbal") > 0, F.lower(code)).otherwise(code)
    return B.table(spark, folder, "customer").select(
        "c_custkey", X.gender_label(code).alias("gender")
    )


@query(
    """
SELECT event_id, CASE event_type WHEN 'click' THEN 'F' WHEN 'view' THEN 'M' WHEN 'signup' THEN 'O'
  END AS code
FROM events
"""
)
def map_enum_to_code(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    label = F.when(kind == "click", "FEMALE").when(kind == "view", "MALE")
    label = label.when(kind == "signup", "OTHER").when(kind == "error", "UNKNOWN")
    return B.table(spark, folder, "events").select("event_id", X.gender_code(label).alias("code"))


@query(
    f"""
WITH labels AS (SELECT * FROM {LABELS}),
coded AS (SELECT event_id, CASE WHEN value < 1 THEN NULL WHEN value < 2 THEN ''
  ELSE CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) END AS c FROM events)
SELECT event_id, coalesce(c, '') AS code, coalesce(label, '') AS label
FROM coded LEFT JOIN labels ON c = labels.code
"""
)
def qualifier_struct(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("value")
    code = F.when(value < 1, F.lit(None)).when(value < 2, F.lit(""))
    code = code.otherwise(F.floor("value").cast("bigint").cast("string"))
    events = B.table(spark, folder, "events").select("event_id", code.alias("c"))
    found = code_lookup(events, relationship_table(spark), "c", "found")
    out = found.select("event_id", X.qualifier_struct("c", "found").alias("q"))
    return out.select("event_id", F.col("q.codeQualifier").alias("code"), "q.label")


@query(
    """
SELECT c_custkey, CASE WHEN c_acctbal > 0 AND c_nationkey > 5 THEN c_name ELSE 'none' END AS name
FROM customer
"""
)
def nested_get_default(spark: SparkSession, folder: str) -> DataFrame:
    inner = F.when(F.col("c_acctbal") > 0, F.struct(
        F.when(F.col("c_nationkey") > 5, F.col("c_name")).alias("name")
    ))
    rows = B.table(spark, folder, "customer").select(
        "c_custkey", F.struct(inner.alias("inner")).alias("doc")
    )
    return rows.select("c_custkey", X.nested_get("doc.inner.name", "none").alias("name"))


@query(
    """
SELECT l_orderkey, l_partkey, md5('4:line#' || length(CAST(l_orderkey AS VARCHAR)) || ':'
  || l_orderkey || '#' || CASE WHEN l_returnflag <> 'N' THEN '1:' || l_returnflag ELSE '-' END) AS id
FROM lineitem
"""
)
def surrogate_key(spark: SparkSession, folder: str) -> DataFrame:
    flag = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    return B.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", X.surrogate_key(F.lit("line"), F.col("l_orderkey"), flag).alias("id")
    )


@query(
    """
SELECT doc_id, CASE WHEN lang = 'en' THEN 'in/' || n_chars || '-' || source || '.txt'
  ELSE 'de/in/' || n_chars || '-' || source || '.txt' END AS key
FROM documents
"""
)
def archive_key(spark: SparkSession, folder: str) -> DataFrame:
    """English files go to environment "in", which their key has already."""
    stored = X.stored_name("n_chars", F.concat("source", F.lit(".txt")))
    key = F.when(F.col("lang") == "en", X.archive_key("in", stored, "in")).otherwise(
        X.archive_key("in", stored, "de")
    )
    return B.table(spark, folder, "documents").select("doc_id", key.alias("key"))


@query(
    """
SELECT page_id, regexp_extract(url, '[^/]*$') AS name,
  regexp_extract(regexp_extract(url, '[^/]*$'), '[^.]([.][^.]+)$', 1) AS suffix
FROM pages
"""
)
def file_parts(spark: SparkSession, folder: str) -> DataFrame:
    pages = B.table(spark, folder, "pages")
    return pages.select(
        "page_id", X.file_name("url").alias("name"),
        X.file_suffix(X.file_name("url")).alias("suffix"),
    )


@query(
    """
SELECT event_id, CASE WHEN event_type = 'error' THEN FALSE ELSE TRUE END AS complete FROM events
"""
)
def default_flag(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    flag = F.when(kind == "error", F.lit(False)).when(kind == "click", F.lit(True))
    return B.table(spark, folder, "events").select(
        "event_id", X.default_flag(flag).alias("complete")
    )


# --- arrays ----------------------------------------------------------------


@query(
    """
SELECT l_orderkey, l_partkey, concat_ws(',', CASE WHEN l_returnflag <> 'N' THEN l_returnflag END,
  CASE WHEN l_linestatus = 'F' THEN l_linestatus END, CAST(l_linenumber AS VARCHAR)) AS other
FROM lineitem
"""
)
def array_drop_nulls(spark: SparkSession, folder: str) -> DataFrame:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    kept = R.array_drop_nulls(
        F.when(flag != "N", flag), F.when(status == "F", status), B.text("l_linenumber")
    )
    out = B.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", kept.alias("a"))
    return out.select("l_orderkey", "l_partkey", F.concat_ws(",", "a").alias("other"))


@query(
    """
SELECT l_orderkey, l_partkey, CASE WHEN l_returnflag IN ('A', 'R') THEN 'A,R'
  ELSE 'A,R,?' END AS codes
FROM lineitem
"""
)
def array_append_if_new(spark: SparkSession, folder: str) -> DataFrame:
    flag = F.col("l_returnflag")

    def code(value):
        return F.struct(value.cast("string").alias("k"))

    old = F.array(code(F.lit("A")), code(F.lit("R")))
    grown = R.array_append_if_new(old, code(F.when(flag != "N", flag)), "k")
    out = B.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", grown.alias("a"))
    shown = F.transform("a", lambda e: F.coalesce(e["k"], F.lit("?")))
    return out.select("l_orderkey", "l_partkey", F.concat_ws(",", shown).alias("codes"))


@query(
    """
SELECT l_orderkey, l_partkey, CASE WHEN l_returnflag = 'N' THEN '' ELSE l_returnflag || ',' END
  || CAST(l_linenumber AS VARCHAR) || ',' || l_linestatus AS items
FROM lineitem
"""
)
def array_concat(spark: SparkSession, folder: str) -> DataFrame:
    flag = F.col("l_returnflag")
    old = F.when(flag != "N", F.array(flag))
    new = F.array(B.text("l_linenumber"), F.col("l_linestatus"))
    out = B.table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", old.alias("o"), new.alias("n"))
    return out.select(
        "l_orderkey", "l_partkey", F.concat_ws(",", R.array_concat("o", "n")).alias("items")
    )


@query(
    """
SELECT c_custkey, upper(c_name) AS name, c_nationkey AS nation, c_mktsegment AS segment
FROM customer
"""
)
def set_nested_field(spark: SparkSession, folder: str) -> DataFrame:
    place = F.struct(F.col("c_nationkey").alias("nation"), F.lit("old").alias("name"))
    rows = B.table(spark, folder, "customer").select(
        "c_custkey", "c_name",
        F.struct(place.alias("place"), F.col("c_mktsegment").alias("segment")).alias("doc"),
    )
    out = rows.withColumn("doc", R.set_nested_fields("doc", {"place.name": F.upper("c_name")}))
    return out.select("c_custkey", "doc.place.name", "doc.place.nation", "doc.segment")
