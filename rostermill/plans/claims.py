"""Claim reports and workbooks: header, diagnoses and service lines.

One input row repeats the claim header beside one diagnosis and one service
line. At rest the three are flat tables, so a claim with a very large number
of lines is spread over the cluster; :func:`assemble_claims` builds the
nested documents from them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostermill.functions.arrays import array_union_by_key, set_nested_fields
from rostermill.functions.scalars import surrogate_key
from rostermill.operators.children import (
    PART_ROWS,
    Heavy,
    collect_ordered,
    heavy_parents,
    merge_lines,
)
from rostermill.operators.classify import classify_always_update
from rostermill.operators.clean import enforce_string_schema
from rostermill.operators.dedup import keep_first, keep_from_last_file, keep_last
from rostermill.operators.match import lookup, without_match
from rostermill.operators.nest import documents, line_values, nest_claim_header
from rostermill.operators.registry import with_lineage
from rostermill.plans.run import LazyRun, Result
from rostermill.schemas import (
    ALTERNATE_ITEM_NUMBER,
    CLAIM_COLUMNS,
    CLAIM_HEADER_COLUMNS,
    CLAIM_REQUIRED,
    DIAGNOSIS_FIELDS,
    LINE_FIELDS,
    LINE_MATCH_KEYS,
    ORDINAL,
)
from rostermill.skew import by_shuffle


def claim_rows(rows: DataFrame) -> DataFrame:
    """Input rows with every column a step reads, absent ones as null."""
    return enforce_string_schema(rows, CLAIM_COLUMNS, CLAIM_REQUIRED)


#: claim id with a stand-in for null. Header rows are wide; grouped and joined
#: by this one column with plain equality they are shuffled by claim once.
_CLAIM_KEY = "coalesce(CLAIM_ID, '\\u0000')"


def claim_headers(rows: DataFrame) -> DataFrame:
    """One header per claim: the last of its rows that are the first of
    their (file, claim, diagnosis)."""
    keys = ["CLAIM_ID", "DIAGNOSIS_CODE"]
    rest = [c for c in CLAIM_HEADER_COLUMNS if c not in keys]
    # One struct for the wide rest: sorts and shuffles move it as a whole.
    packed = rows.selectExpr(
        f"{_CLAIM_KEY} AS _claim", *keys, *ORDINAL, f"struct({', '.join(rest)}) AS _rest"
    )
    header = keep_last(keep_first(packed, ["_claim", "DIAGNOSIS_CODE", "_file"]), ["_claim"])
    return header.select("_claim", *keys, "_rest.*", *ORDINAL)


def claim_sources(rows: DataFrame, lineage: DataFrame) -> DataFrame:
    """(_claim, documents): files of this run that hold the claim, newest
    first. The array is as long as the run has files, not rows."""
    pairs = rows.selectExpr(f"{_CLAIM_KEY} AS _claim", "_file").distinct()
    item = F.struct(F.col("_file").alias("f"), F.col("lineage").alias("d"))
    newest_first = F.reverse(F.array_sort(F.collect_list(item)))
    return (
        with_lineage(pairs, lineage)
        .groupBy("_claim")
        .agg(F.transform(newest_first, lambda x: x["d"]).alias("documents"))
    )


def classify_claims(rows: DataFrame, claims: DataFrame) -> DataFrame:
    headers = claim_headers(rows)
    fields = {"_id": "_id", "ardbDocuments": "ardbDocuments"}
    matched = lookup(
        headers, claims, {"_claim": F.expr(_CLAIM_KEY)}, fields, "_old", null_safe=False
    )
    return matched.withColumns(
        {
            "action": classify_always_update(F.col("_old").isNotNull()),
            "_id": F.coalesce(F.col("_old._id"), surrogate_key(F.lit("claim"), F.col("CLAIM_ID"))),
        }
    )


def new_diagnoses(rows: DataFrame, stored: DataFrame, run_number: int) -> DataFrame:
    """First row of each (claim, diagnosis) that is not stored yet."""
    columns = [*DIAGNOSIS_FIELDS, "CLAIM_ID", *ORDINAL]
    keys = ["CLAIM_ID", "DIAGNOSIS_CODE"]
    first = keep_first(rows.select(*columns), keys)
    fresh = without_match(first, stored, {k: k for k in keys})
    values = {c: c for c in columns}
    values |= {"_id": surrogate_key(F.lit("diagnosis"), *keys), "_run": str(run_number)}
    return documents(fresh, "claim_diagnosis", values)


def new_lines(
    rows: DataFrame, stored: DataFrame, run: LazyRun, single_file: bool = False
) -> DataFrame:
    """Service lines of the incoming claims, missing codes filled from the
    stored line of the same code and date."""
    columns = list(dict.fromkeys(["CLAIM_ID", *LINE_FIELDS, ALTERNATE_ITEM_NUMBER, *ORDINAL]))
    merged = merge_lines(rows.select(*columns), stored, single_file, run.hot)
    values = line_values(merged)
    values |= {c: c for c in ["CLAIM_ID", *ORDINAL]}
    key = surrogate_key(F.lit("line"), "CLAIM_ID", *LINE_MATCH_KEYS)
    return documents(merged, "claim_line", {**values, "_id": key, "_run": str(run.number)})


def load_claims(
    rows: DataFrame, run: LazyRun, lineage: DataFrame, single_file: bool = False
) -> Result:
    """A claim input of one or several files against the stored claims.

    New claims are inserted, known ones replaced: header from the input,
    diagnoses added to, lines replaced, lineage extended.
    """
    result = Result()
    # stored rows of other claims than the incoming ones are not read
    ids = rows.select(F.col("CLAIM_ID").alias("key"))
    classified = classify_claims(rows, run.state("claim", ids))
    result.classified["claim"] = classified
    sources = claim_sources(rows, lineage)
    headers = with_lineage(classified, lineage).join(by_shuffle(sources), "_claim", "left")
    headers = headers.withColumn(
        "documents", array_union_by_key("documents", "_old.ardbDocuments", "documentId")
    )
    result.changes["claim"] = nest_claim_header(headers)
    result.changes["claim_diagnosis"] = new_diagnoses(
        rows, run.state("claim_diagnosis", ids), run.number
    )
    result.changes["claim_line"] = new_lines(
        rows, run.state("claim_line", ids), run, single_file
    )
    for table, changes in result.changes.items():
        result.current[table] = run.save(table, changes)
    return result


def assemble_claims(
    claims: DataFrame, diagnoses: DataFrame, lines: DataFrame, part_rows: int = PART_ROWS
) -> DataFrame:
    """Nested claim documents with DIAGNOSIS_CODES[] and SERVICE_LINES[].

    A row holds up to ``part_rows`` children of each kind. A claim with more
    comes as several rows with the same header, numbered by ``part`` from 0.
    """
    order, claim = ["_run", *ORDINAL], F.expr(_CLAIM_KEY)
    heavy: Heavy = ()

    def parts(children: DataFrame, fields: list[str], alias: str) -> DataFrame:
        nonlocal heavy
        placed = children.withColumn("_claim", claim)
        found = heavy_parents(placed, ["_claim"])
        heavy += found
        return collect_ordered(
            placed, ["_claim"], fields, order, alias, part_rows=part_rows, heavy=found
        )

    codes = parts(diagnoses, DIAGNOSIS_FIELDS, "DIAGNOSIS_CODES")
    items = parts(lines, LINE_FIELDS, "SERVICE_LINES")
    # Both lie by claim and stay there: one under the other, a part's two rows become one.
    both = (
        codes.unionByName(items, allowMissingColumns=True)
        .groupBy("_claim", "part")
        .agg(*[F.first(a, ignorenulls=True).alias(a) for a in ("DIAGNOSIS_CODES", "SERVICE_LINES")])
    )
    hot = reduce(DataFrame.unionByName, heavy).distinct() if heavy else None
    joined = lookup(
        both, claims, {"_claim": claim}, {c: c for c in claims.columns}, "_h", how="inner",
        hot=hot, spread=["_claim", "part"], null_safe=False,
    )
    return joined.select(
        "part",
        "_h.*",
        *[
            F.coalesce(F.col(a), F.filter(F.array(F.col(a)[0]), lambda x: F.lit(False))).alias(a)
            for a in ("DIAGNOSIS_CODES", "SERVICE_LINES")
        ],
    )


def correct_claims(rows: DataFrame, run: LazyRun, lineage: DataFrame) -> Result:
    """Set the insured id of stored claims from a (claim, insured id) sheet.

    Only claims whose id differs are touched; they also get the file's
    lineage. Of several files the last one counts.
    """
    result = Result()
    stored = run.state("claim", rows.select(F.col("CLAIM_ID").alias("key")))
    incoming = with_lineage(keep_from_last_file(rows, ["CLAIM_ID"]), lineage)
    matched = lookup(
        stored, incoming, {"CLAIM_ID": "CLAIM_ID"},
        {"insured": "INSURED_ENROLLEE_ID", "lineage": "lineage"}, "_in", how="inner",
    )
    current = F.col("SUBSCRIBER_INFO.INSURED_ENROLLEE_ID")
    hits = matched.where(~current.eqNullSafe(F.col("_in.insured")))
    entry = F.col("_in.lineage")
    corrected = hits.withColumns(
        {
            "SUBSCRIBER_INFO": set_nested_fields(
                "SUBSCRIBER_INFO", {"INSURED_ENROLLEE_ID": F.col("_in.insured")}
            ),
            "ardbDocuments": F.concat(
                F.coalesce("ardbDocuments", F.array().cast(stored.schema["ardbDocuments"].dataType)),
                F.array(entry),
            ),
            "ardbSourceDocument": entry["fileName"],
            "ardbLastModifiedDate": entry["updatedAt"],
        }
    ).select(*stored.columns)
    result.changes["claim"] = corrected
    result.current["claim"] = run.save("claim", corrected)
    return result
