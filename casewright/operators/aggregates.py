"""Per-case aggregates. All are partial-aggregated before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casewright import fixed_values as fv
from casewright.functions import ids
from casewright.functions.text import has, number, sorted_list
from casewright.operators.dedup import with_group_count


def is_willing(variant: str = "v3"):
    """Victim status test: the exact text, or any completed step in the older rules."""
    if variant == "v2":
        return has("case_status", fv.STEP_COMPLETE)
    return F.coalesce(F.col("case_status") == fv.VICTIM_WILLING_STATUS, F.lit(False))


def _named(rows: DataFrame, count: str, names: str) -> DataFrame:
    keyed = rows.filter(F.length(F.trim("case_id")) > 0)
    # A cell lists the people of one case. Rows are unique per person id before this step, and a
    # person id is the case plus an interviewee mark or a box number of its forms.
    return keyed.groupBy("case_id").agg(
        F.count(F.lit(1)).alias(count), sorted_list(F.coalesce("name", F.lit(""))).alias(names))


def willing_victims(victims: DataFrame, variant: str = "v3") -> DataFrame:
    """Victims willing to testify, per case: number and names."""
    return _named(victims.filter(is_willing(variant)), "willing_count", "willing_to_testify")


def located_suspects(suspects: DataFrame) -> DataFrame:
    """Suspects identified and located, per case: number and names."""
    return _named(suspects.filter(has("case_status", fv.STEP_COMPLETE)), "located_count", "located")


def total_arrests(forms: DataFrame) -> DataFrame:
    """Arrests per case; the case is read off the suspect id."""
    return (
        forms.groupBy(ids.case_of_suspect("suspect_id").alias("case_id"))
        .agg(F.sum("arrest").alias("total_arrests"))
    )


def arrest_rows(sheet: DataFrame, slots=range(1, 8)) -> DataFrame:
    """Wide arrest sheet to one row per arrested person, with the case's number of arrests."""
    cells = F.array(*[
        F.struct(
            F.col(f"pb{n}_name").alias("name"),
            F.col(f"pb{n}_arrested").alias("arrested"),
            F.col(f"pb{n}_arrest_date").alias("arrest_date"),
            F.concat("irf_number", F.lit(f".PB{n}")).alias("suspect_id"),
        ) for n in slots
    ])
    arrested = (
        sheet.filter(number("outcome_arrest", 0) == 1)
        .select(F.col("irf_number").alias("case_id"), F.inline(cells))
        .filter(has("arrested", "Yes"))
    )
    return with_group_count(arrested, "case_id", "total_arrests", "suspect_id").withColumn(
        "arrest", F.lit(1))


def label_from_arrests(forms: DataFrame, arrests: DataFrame) -> DataFrame:
    """Form rows with ``arrest`` = 1 when the suspect is among the arrested, else 0."""
    arrested = arrests.groupBy("suspect_id").agg(F.max("arrest").alias("arrest"))
    return forms.join(arrested, "suspect_id", "left").withColumn(
        "arrest", F.coalesce("arrest", F.lit(0)))
