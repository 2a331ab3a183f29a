"""Backfills over stored tables: one join and the changed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rostermill.functions.arrays import set_nested_fields
from rostermill.functions.scalars import format_date, name_of, parse_ts_tolerant
from rostermill.operators.dedup import keep_last
from rostermill.operators.match import lookup
from rostermill.plans.run import LazyRun, Result


def patient_subscriber_names(
    patients: DataFrame, subscribers: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """Patients whose subscriber's display name is known and not stored yet.

    Patients without a subscriber, with an unknown one or with a nameless
    one are left alone.
    """
    keyed = patients.where(F.col("subscriber.refId") != "").withColumn(
        "_ref", F.col("subscriber.refId")
    )
    matched = lookup(
        keyed, subscribers, {"_ref": "_id"}, {"name": name_of("demographic")}, "_sub",
        how="inner", hot=hot, spread=["_id"],
    )
    named = matched.where(F.length("_sub.name") > 0).where(
        ~F.col("subscriber.name").eqNullSafe(F.col("_sub.name"))
    )
    return named.withColumn(
        "subscriber", set_nested_fields("subscriber", {"name": F.col("_sub.name")})
    ).select(*patients.columns)


def eligibility_products_and_dates(
    eligibilities: DataFrame, products: DataFrame, hot: DataFrame | None = None
) -> DataFrame:
    """Eligibilities whose product name or birth-date text has to change.

    Of several products with one reference id the last (by id) counts. Text
    that is already a plain date stays, so the backfill can be repeated.
    """
    known = keep_last(
        products.where(F.col("product.referenceId").isNotNull()).select(
            "_id", "name", F.col("product.referenceId").alias("ref")
        ),
        ["ref"],
        ["_id"],
    )
    keyed = eligibilities.withColumn("_ref", F.col("product.referenceId"))
    matched = lookup(
        keyed, known, {"_ref": "ref"}, {"name": "name"}, "_product", hot=hot, spread=["_id"]
    )
    name = F.when(F.col("_product").isNotNull(), F.col("_product.name")).otherwise(
        F.col("product.name")
    )
    text = F.col("patient.formattedDob")
    dob = F.coalesce(format_date(parse_ts_tolerant(text)), text)
    wanted = matched.withColumns({"_name": name, "_dob": dob})
    changed = wanted.where(
        ~F.col("_name").eqNullSafe(F.col("product.name")) | ~F.col("_dob").eqNullSafe(text)
    )
    return changed.withColumns(
        {
            "product": set_nested_fields("product", {"name": F.col("_name")}),
            "patient": set_nested_fields("patient", {"formattedDob": F.col("_dob")}),
        }
    ).select(*eligibilities.columns)


def backfill_names(run: LazyRun) -> Result:
    patients = run.state("patient")
    keys = patients.select(F.col("subscriber.refId").alias("_ref"))
    changes = patient_subscriber_names(patients, run.state("subscriber"), run.hot(keys, ["_ref"]))
    return _saved(run, "patient", changes)


def backfill_products_and_dates(run: LazyRun) -> Result:
    eligibilities = run.state("eligibility")
    keys = eligibilities.select(F.col("product.referenceId").alias("_ref"))
    changes = eligibility_products_and_dates(
        eligibilities, run.state("product"), run.hot(keys, ["_ref"])
    )
    return _saved(run, "eligibility", changes)


def _saved(run: LazyRun, table: str, changes: DataFrame) -> Result:
    result = Result(changes={table: changes})
    result.current[table] = run.save(table, changes)
    return result
