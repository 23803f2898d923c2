"""Suspect, police and victim rows built from the scans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from casewright import fixed_values as fv
from casewright.functions import ids
from casewright.functions.narrative import narrative, notes_or_narrative
from casewright.functions.text import null_to_blank
from casewright.operators.dedup import keep_first
from casewright.operators.joins import attach

def suspect_forms(forms: DataFrame) -> DataFrame:
    """Rows about suspects: a box number is known and the role is not an excluded one.

    A missing role counts as a suspect.
    """
    role = F.coalesce(F.col("role"), F.lit(""))
    return (
        forms.filter(~role.isin(*fv.EXCLUDED_ROLES) & F.col("pb_number").isNotNull())
        .withColumn("pb_number", F.col("pb_number").cast("int"))
        .withColumn("suspect_id", ids.suspect_id("cif_number", "pb_number"))
    )


def with_narrative(forms: DataFrame, fill_missing: bool = False,
                   repeat_approached: bool = False) -> DataFrame:
    """Case notes, or the generated narrative where the notes are blank."""
    text = narrative(repeat_approached)
    return forms.withColumn("case_notes", notes_or_narrative("case_notes", text, fill_missing))


def drop_unused_form_columns(forms: DataFrame) -> DataFrame:
    """Form columns the model does not use, by name and by name part."""
    unused = [c for c in forms.columns
              if c in fv.FORM_DROP_V2 or any(word in c for word in fv.FORM_DROP_WORDS_V2)]
    return forms.drop(*unused)


def _first_by_suspect(forms: DataFrame) -> DataFrame:
    boxed = forms.withColumn("pb_number", F.coalesce(F.col("pb_number").cast("int"), F.lit(0)))
    named = boxed.withColumn("suspect_id", ids.suspect_id("cif_number", "pb_number"))
    return keep_first(named, ["suspect_id"], [F.desc("interview_date"), "cif_id", "person_id"])


def suspect_forms_v2(forms: DataFrame) -> DataFrame:
    """One row per suspect id; a missing box counts as box 0; unused columns are gone."""
    return drop_unused_form_columns(_first_by_suspect(forms))


FORM_KEY = ("id", "cif_number", "interview_date")


def suspect_boxes_v2(case_form: DataFrame, person_box: DataFrame) -> DataFrame:
    """The box and form that ``suspect_forms_v2`` keeps of each suspect, with the form's categories and no other column of it."""
    categories = [c for c in fv.CATEGORY_FEATURES_V2 if c in case_form.columns]
    narrow = case_form.select(*FORM_KEY, *categories)
    return _first_by_suspect(narrow.join(person_box, F.col("id") == F.col("cif_id"))).drop("id")


def forms_of_boxes_v2(case_form: DataFrame, boxes: DataFrame) -> DataFrame:
    """``suspect_forms_v2`` from the boxes chosen before: the wide forms meet one row per suspect and are never ranked with them.

    Of forms that repeat id, number and date one is taken.
    """
    form = lambda first: F.struct(first, "cif_number", "interview_date").alias("_form")
    used = [c for c in drop_unused_form_columns(case_form).columns if c not in (*FORM_KEY, *boxes.columns)]
    forms = keep_first(case_form.select(form("id"), *used), ["_form"], used)
    rows = forms.join(boxes.withColumn("_form", form("cif_id")), "_form")
    order = [c for c in case_form.columns if c in rows.columns]
    return drop_unused_form_columns(rows.select(*order, *[c for c in boxes.columns if c not in order]))


def victim_rows(victims: DataFrame) -> DataFrame:
    """One row per victim id, first by name; then rows with a blank name are dropped."""
    social = "social_media" if "social_media" in victims.columns else None
    address = "address" if "address" in victims.columns else "address_notes"
    rows = victims.select(
        ids.case_id("cif_number").alias("case_id"),
        F.col("full_name").alias("name"),
        F.col("phone_contact").alias("phone"),
        F.col(address).alias("address"),
        (F.col(social) if social else F.lit(None).cast("string")).alias("social_media"),
        ids.victim_id("cif_number").alias("victim_id"),
        F.lit("").alias("narrative"),
    )
    order = [F.asc_nulls_last(c) for c in ("name", "phone", "address", "social_media")]
    first = keep_first(rows, ["victim_id"], order)
    return first.filter(F.col("name").isNull() | (F.col("name") != ""))


PERSON_COLUMNS = ["full_name", "phone_contact", "social_media"]


def suspect_rows(forms: DataFrame, persons: DataFrame | None = None,
                 keep_unmatched: bool = False) -> DataFrame:
    """One row per suspect id, from the newest form that names the person in that box.

    ``forms`` hold the form numbers per person. ``persons`` hold the contact columns, one row per
    person id; without them the contact columns are read from ``forms``. ``keep_unmatched`` also
    keeps people without a form (one row with no suspect id).
    """
    source = persons if persons is not None else forms
    address = "address" if "address" in source.columns else "address_notes"
    contact = [*PERSON_COLUMNS, address]
    if persons is not None:
        keys = ["cif_number", "person_id", "pb_number", "case_notes", "interview_date"]
        people = keep_first(persons.select("person_id", *contact), ["person_id"], contact)
        joined = people.join(forms.select(*keys), "person_id", "full" if keep_unmatched else "inner")
    else:
        joined = forms
    order = [F.desc("interview_date"), "cif_number", "person_id", *contact]
    named = joined.withColumn("suspect_id", ids.suspect_id("cif_number", "pb_number"))
    return keep_first(named, ["suspect_id"], order).select(
        ids.case_id("cif_number").alias("case_id"), "suspect_id",
        F.col("full_name").alias("name"), F.col("phone_contact").alias("phone"),
        F.col(address).alias("address"), F.col("social_media").alias("social_media_id"),
        F.col("case_notes").alias("narrative"))


def police_rows(suspects: DataFrame) -> DataFrame:
    """The police list starts as the suspect list under another heading."""
    return suspects.withColumnRenamed("name", "suspect_name")


def in_country(df: DataFrame, uid: str, station_key: DataFrame, country: str) -> DataFrame:
    """Rows whose station code belongs to the country, one per id."""
    stations = station_key.filter(F.col("country_name") == country).select("station_code").distinct()
    rows = df.withColumn("station_code", ids.station_code(uid)).join(stations, "station_code", "left_semi")
    rest = [c for c in df.columns if c != uid]
    return keep_first(rows.select(*df.columns), [uid], rest)


def pick_addresses(addresses: DataFrame) -> DataFrame:
    """The address columns that are used."""
    return addresses.select("address_1", "address2_id", "address_2")


def with_address(people: DataFrame, addresses: DataFrame) -> DataFrame:
    """Address text ``level 2, level 1``; blank where the person has no known address."""
    texts = keep_first(pick_addresses(addresses), ["address2_id"], ["address_2", "address_1"]).select(
        F.col("address2_id").cast("long"), F.concat_ws(", ", "address_2", "address_1").alias("address"))
    ids_filled = people.withColumn("address1_id", F.coalesce(F.col("address1_id").cast("long"), F.lit(0))) \
        .withColumn("address2_id", F.coalesce(F.col("address2_id").cast("long"), F.lit(0)))
    return ids_filled.join(texts, "address2_id", "left").withColumn("address", null_to_blank("address"))


def mentions(df: DataFrame, column: str, location: str, flag: str = "located_in") -> DataFrame:
    """1 where the text mentions the location (a pattern), else 0."""
    found = F.coalesce(F.col(column).rlike(location), F.lit(False))
    return df.withColumn(flag, found.cast("int"))


def case_names(cases: DataFrame) -> DataFrame:
    """The first row of each case of the Cases table."""
    rest = [c for c in ("case_name",) if c in cases.columns]
    return keep_first(cases.select("case_id", *rest), ["case_id"], rest)


def with_case_names(rows: DataFrame, cases: DataFrame, uid: str) -> DataFrame:
    """Case name from the Cases table (first row per case); blank when there is none."""
    named = attach(rows.drop("case_name"), case_names(cases), "case_id", uid)
    return named.withColumn("case_name", null_to_blank("case_name"))


def arrest_label(arrested: Column | str = "arrested") -> Column:
    c = F.col(arrested) if isinstance(arrested, str) else arrested
    return F.when(c == "Yes", 1).otherwise(0)
