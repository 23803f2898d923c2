"""Scans of the relational source: case forms, suspects, victims, notes and addresses.

Tables come from a catalog, so the same scans run over parquet, JDBC or temporary views. Filters are
column predicates, never text pasted into a query, and reach the scan through Catalyst.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewright import fixed_values as fv


def run_query(spark: SparkSession, sql: str, tables: dict[str, DataFrame], **args) -> DataFrame:
    """Run a SQL query over named tables: ``{name}`` is a table, ``:name`` a value."""
    return spark.sql(sql, args=args or None, **tables)


def jdbc_options(url: str, query: str, partition_column: str | None = None,
                 bounds: tuple[int, int] | None = None, partitions: int = 32,
                 fetch_rows: int = 10_000, **secrets: str) -> dict[str, str]:
    """Reader options for one query; with a numeric partition column it is read in parallel."""
    options = {"url": url, "fetchsize": str(fetch_rows), **secrets}
    if partition_column is None:
        return {**options, "query": query}
    if bounds is None:
        raise ValueError("a partitioned read needs the column's bounds")
    return {
        **options,
        "dbtable": f"({query}) source_query",
        "partitionColumn": partition_column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
    }


def read_jdbc(spark: SparkSession, url: str, query: str, **options) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, query, **options)).load()


FORM_COLUMNS = (
    "cif_number", "interview_date", "number_of_victims", "case_notes", "number_of_traffickers",
    *fv.CASE_FORM_FLAGS, "expected_earning", "planned_destination", "legal_action_taken",
    "total_blue_flags", "station_id",
)
BOX_COLUMNS = ("cif_id", "person_id", "pb_number")
PERSON_COLUMNS = ("arrested", "pv_believes", "role")
CONTACT_COLUMNS = ("full_name", "phone_contact", "address_notes", "case_filed_against",
                   "social_media")


def _in_country(forms: DataFrame, station: DataFrame, country: DataFrame, name: str) -> DataFrame:
    """Forms with their station, for one country. The two dimensions meet first, so the big side
    is joined once."""
    wanted = country.filter(F.col("name") == name).select(F.col("id").alias("_country_id"))
    stations = (
        station.join(wanted, station["operating_country_id"] == F.col("_country_id"))
        .select(station["id"].alias("station_id"), "station_name")
    )
    return forms.join(stations, "station_id")


def _boxes(forms: DataFrame, person_box: DataFrame, person: DataFrame) -> DataFrame:
    people = person.withColumnRenamed("id", "person_id")
    return (
        forms.withColumnRenamed("id", "cif_id")
        .join(person_box, "cif_id")
        .join(people, "person_id")
    )


def scan_case_forms(tables, country: str, contacts: bool = False) -> DataFrame:
    """Form, person box, person, station and country, for one country.

    With ``contacts`` the person's contact columns come along, which saves a second pass over the
    same joins when suspect rows are built from the result.
    """
    forms = _in_country(tables.case_form, tables.station, tables.country, country)
    extra = CONTACT_COLUMNS if contacts else ()
    return _boxes(forms, tables.person_box, tables.person).select(
        *FORM_COLUMNS, *BOX_COLUMNS, *PERSON_COLUMNS, "station_name", *extra)


def scan_case_forms_v2(tables) -> DataFrame:
    """Form and person box with all columns, every country."""
    return tables.case_form.join(
        tables.person_box, tables.case_form["id"] == tables.person_box["cif_id"])


def scan_suspects(tables, country: str) -> DataFrame:
    forms = _in_country(tables.case_form, tables.station, tables.country, country)
    return _boxes(forms, tables.person_box, tables.person).select(
        "cif_number", *CONTACT_COLUMNS, "arrested", "person_id")


def scan_suspects_v2(tables) -> DataFrame:
    people = tables.person.withColumnRenamed("id", "person_id")
    return tables.person_box.select("person_id").join(people, "person_id").select(
        "person_id", "full_name", "phone_contact", "social_media", "address1_id", "address2_id")


def scan_victims(tables, country: str) -> DataFrame:
    forms = _in_country(tables.case_form, tables.station, tables.country, country)
    people = tables.pv_person.withColumnRenamed("id", "main_pv_id")
    return forms.join(people, "main_pv_id").select(
        "cif_number", "full_name", "phone_contact", "address_notes", "social_media")


def scan_victims_v2(tables) -> DataFrame:
    people = tables.pv_person.withColumnRenamed("id", "main_pv_id")
    return tables.case_form.join(people, "main_pv_id").select(
        "cif_number", "full_name", "phone_contact", "social_media", "address1_id", "address2_id")


def scan_incident_notes(tables) -> DataFrame:
    return tables.incident_notes.select("irf_number", "case_notes")


def scan_addresses(tables) -> DataFrame:
    """Level-1 with level-2 addresses, all columns of both under distinct names."""
    a1 = tables.address1.select(F.col("id").alias("address1_id"), "address_1")
    a2 = tables.address2.select(F.col("id").alias("address2_id"), "address_2", "address1_id")
    return a1.join(a2, "address1_id")
