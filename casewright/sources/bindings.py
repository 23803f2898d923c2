"""The engine's input tables, derived from the provided star-schema tables.

Each attribute is one input table. Values are plain arithmetic on the keys, so the same table can be
written as SQL for the checks. Nothing is sampled or cut: every row of the base tables takes part.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewright import fixed_values as fv
from casewright.operators.dedup import keep_first

PB_SLOTS = range(1, 8)


def case_number(cn: str) -> str:
    """SQL text of the case id for a case-number expression."""
    return f"concat('N', lpad(cast({cn} % 25 as string), 2, '0'), lpad(cast({cn} as string), 7, '0'))"


def flag_sql(i: int, name: str) -> str:
    if name == "exploitation_organ_removal_occ":
        return f"false as {name}"
    return (f"case when (o_orderkey + {i}) % 41 = 0 then cast(null as boolean) "
            f"else (o_orderkey * {2 * i + 3} + {i * i}) % 97 < {20 + 10 * (i % 5)} end as {name}")


class Bindings:
    """Input tables over one folder of parquet files.

    ``land(name, df)`` may write the cleaned box lines (``boxes``) and the suspects in them
    (``suspect-keys``) down once; queries that read them along many branches ask for that.
    """

    def __init__(self, spark: SparkSession, folder: str, land=lambda name, df: df):
        self.spark = spark
        self.folder = folder
        self.land = land

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # --- relational source ---------------------------------------------------------------------

    @cached_property
    def country(self) -> DataFrame:
        return self.raw("region").selectExpr("r_regionkey as id", "r_name as name")

    @cached_property
    def station(self) -> DataFrame:
        return self.raw("nation").selectExpr(
            "n_nationkey as id", "n_name as station_name", "n_regionkey as operating_country_id")

    @cached_property
    def station_key(self) -> DataFrame:
        """Station code (the first three characters of an id) with its country name."""
        stations = self.station.selectExpr(
            "concat('N', lpad(cast(id as string), 2, '0')) as station_code", "operating_country_id")
        countries = self.country.selectExpr("id as operating_country_id", "name as country_name")
        return stations.join(countries, "operating_country_id").select("station_code", "country_name")

    @cached_property
    def case_form(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey as id",
            f"""concat({case_number('(o_orderkey div 3)')},
                case when o_orderkey % 3 = 0 and (o_orderkey div 3) % 5 = 0 then '.1'
                     when o_orderkey % 3 = 0 then 'A'
                     when o_orderkey % 3 = 1 then 'B' else 'C' end) as cif_number""",
            "cast(o_orderdate as date) as interview_date",
            "cast((o_orderkey div 3) % 25 as int) as station_id",
            "o_custkey as main_pv_id",
            "case when o_orderkey % 11 = 0 then null else cast(1 + o_orderkey % 5 as int) end as number_of_victims",
            "cast(1 + o_orderkey % 4 as int) as number_of_traffickers",
            "cast(floor(o_totalprice / 100000) as int) as total_blue_flags",
            "case when o_orderkey % 4 <> 0 then '' when o_orderkey % 28 = 0 then 'nan' "
            "else concat('note ', cast(o_orderkey as string)) end as case_notes",
            "case when o_orderkey % 13 = 0 then null when o_orderkey % 3 = 0 then '' "
            "else concat(cast(cast(floor(o_totalprice) as bigint) as string), ' USD') end as expected_earning",
            "case o_orderpriority when '1-URGENT' then 'Kampala, city' when '2-HIGH' then 'Dubai (UAE)' "
            "when '3-MEDIUM' then 'Nairobi/Kenya' when '4-NOT SPECIFIED' then 'Does not know' "
            "else '' end as planned_destination",
            "case o_orderstatus when 'F' then 'yes, filed' when 'O' then 'no' end as legal_action_taken",
            *[flag_sql(i, name) for i, name in enumerate(fv.CASE_FORM_FLAGS)],
            "case o_orderkey % 5 when 0 then 'Primary' when 1 then 'Secondary' "
            "when 2 then 'None/Illiterate' when 4 then 'University' end as education",
            "case o_orderkey % 3 when 0 then 'Farmer' when 1 then 'Trader' end as pv_occupation",
            "cast(o_orderkey % 4 as int) as known_broker_years",
            "case when o_orderkey % 6 = 0 then null else concat(cast(1 + o_orderkey % 7 as string), ',', "
            "cast(1 + (o_orderkey div 7) % 7 as string)) end as recruited_broker_pb",
            "case when o_orderkey % 5 = 0 then '' else cast(1 + o_orderkey % 12 as string) end "
            "as how_recruited_broker_online_pb",
            "cast(o_custkey as string) as pv_contact",
            "o_orderpriority as staff_lb_note",
            "o_orderstatus as guardian_name",
        )

    LINE_ORDER = ["l_suppkey", "l_partkey", "l_shipdate", "l_quantity", "l_extendedprice"]

    @property
    def _lines(self) -> DataFrame:
        return self.raw("lineitem").select(*self.LINE_ORDER, "l_orderkey", "l_linenumber", "l_returnflag")

    @cached_property
    def _boxes(self) -> DataFrame:
        """One row per (form, box line): the line table holds copies of its key."""
        # Copies of a line are few: lines go to their order first and are sorted once, there.
        first = keep_first(self._lines.repartition("l_orderkey"), ["l_orderkey", "l_linenumber"], self.LINE_ORDER)
        return self.land("boxes", first.drop("l_quantity", "l_extendedprice"))

    @cached_property
    def person_box(self) -> DataFrame:
        return self._box_cells(self._boxes)

    @property
    def first_boxes(self) -> DataFrame:
        """The rows of ``person_box`` by keep-first alone, which limits groups in each map task."""
        return self._box_cells(keep_first(self._lines, ["l_orderkey", "l_linenumber"], self.LINE_ORDER))

    @staticmethod
    def _box_cells(lines: DataFrame) -> DataFrame:
        return lines.selectExpr(
            "l_orderkey as cif_id",
            "l_orderkey * 10 + l_linenumber as person_id",
            "case when l_partkey % 29 = 0 then null when l_partkey % 31 = 0 then l_linenumber + 9 "
            "else l_linenumber end as pb_number",
        )

    @cached_property
    def person(self) -> DataFrame:
        names = self.raw("supplier").select("s_suppkey", "s_name")
        boxes = self._boxes
        return boxes.join(names, boxes["l_suppkey"] == names["s_suppkey"]).selectExpr(
            "l_orderkey * 10 + l_linenumber as id",
            "concat(s_name, '-', cast(l_linenumber as string)) as full_name",
            "case when l_partkey % 17 = 0 then null else concat('07', lpad(cast(l_suppkey as string), 8, '0')) end as phone_contact",
            "case l_suppkey % 5 when 0 then concat('Plot ', cast(l_partkey as string), ' Kampala') "
            "when 1 then 'Nairobi West' when 2 then '' when 3 then 'Border road' end as address_notes",
            "case when l_partkey % 3 = 0 then 'yes' else '' end as case_filed_against",
            "case when l_partkey % 2 = 0 then concat('fb', cast(l_suppkey as string)) else '' end as social_media",
            "case when l_returnflag = 'R' then 'Yes' else 'No' end as arrested",
            "case l_partkey % 5 when 0 then 'Definitely trafficked many' when 1 then 'Has trafficked some' "
            "when 2 then 'Suspect trafficker' when 3 then \"Don't believe\" end as pv_believes",
            "case l_suppkey % 6 when 0 then 'Broker' when 1 then 'Witness' when 2 then 'Complainant' "
            "when 3 then 'Companion' when 4 then 'Host' end as role",
            "cast(l_suppkey % 25 as int) as address1_id",
            "case when l_partkey % 19 = 0 then null else l_suppkey end as address2_id",
        )

    @cached_property
    def pv_person(self) -> DataFrame:
        return self.raw("customer").selectExpr(
            "c_custkey as id",
            "case when c_custkey % 13 = 0 then '' else c_name end as full_name",
            "concat('08', lpad(cast(c_custkey as string), 8, '0')) as phone_contact",
            "case when c_custkey % 4 = 0 then '' else concat('House ', cast(c_custkey as string)) end as address_notes",
            "case when c_custkey % 2 = 0 then '' else concat('pv', cast(c_custkey as string)) end as social_media",
            "c_nationkey as address1_id",
            "case when c_custkey % 19 = 0 then null else c_custkey % 97 end as address2_id",
        )

    @cached_property
    def incident_notes(self) -> DataFrame:
        """Notes per report number; some report numbers have two notes."""
        return (
            self.raw("orders").filter("o_orderkey % 3 = 0 or o_orderkey % 9 = 1")
            .selectExpr(f"{case_number('(o_orderkey div 3)')} as irf_number",
                        "concat('incident ', cast(o_orderkey as string)) as case_notes")
        )

    @cached_property
    def address1(self) -> DataFrame:
        return self.raw("nation").selectExpr("n_nationkey as id", "n_name as address_1")

    @cached_property
    def address2(self) -> DataFrame:
        return self.raw("supplier").selectExpr(
            "s_suppkey as id", "concat('Area ', cast(s_suppkey as string)) as address_2",
            "s_nationkey as address1_id")

    # --- sheets ----------------------------------------------------------------------------------

    STATUS = (f"array('', '{fv.SUSPECT_LOCATED_STATUS}', '{fv.VICTIM_WILLING_STATUS}', 'In progress')")

    @cached_property
    def _suspect_keys(self) -> DataFrame:
        keys = self.person_box.filter("pb_number is not null") \
            .selectExpr("cif_id div 3 as cn", "pb_number as pb").distinct()
        return (
            self.land("suspect-keys", keys)
            .withColumn("case_id", F.expr(case_number("cn")))
            .withColumn("suspect_id", F.expr("concat(case_id, '.PB', cast(pb as string))"))
        )

    def _suspect_tab(self, condition: str) -> DataFrame:
        return self._suspect_keys.filter(condition).selectExpr(
            "case_id", "concat('Case ', cast(cn as string)) as case_name", "suspect_id",
            "concat('Sheet suspect ', cast(cn as string), '-', cast(pb as string)) as name",
            "'' as phone",
            "case cn % 5 when 0 then 'Kampala road' when 1 then 'Nairobi street' else '' end as address",
            "'' as social_media_id", "concat('kept ', cast(cn as string)) as narrative",
            "'' as irf_case_notes", "'' as victims_willing_to_testify",
            f"{self.STATUS}[cast((cn + pb) % 4 as int)] as case_status",
            "array('', '1', '5', '9', '12')[cast((cn * 3 + pb) % 5 as int)] as eminence",
            "'' as strength_of_case", "'' as solvability", "'' as priority",
            "case when pb % 2 = 0 then 'known' else '' end as bio_and_location",
            "case when cn % 3 = 0 then concat('rel/', suspect_id) else '' end as relationships",
            "array('07/31/2001', '08/01/2001', '06/01/2001', '')[cast(cn % 4 as int)] as date_relationships_updated",
            "case when cn % 17 = 0 then '07/01/2001' else '' end as date_closed",
        )

    def _police_tab(self, condition: str) -> DataFrame:
        return self._suspect_keys.filter(condition).selectExpr(
            "case_id", "concat('Case ', cast(cn as string)) as case_name", "suspect_id",
            "concat('Sheet suspect ', cast(cn as string), '-', cast(pb as string)) as suspect_name",
            "'' as phone", "'' as address", "'' as social_media_id",
            "concat('police ', cast(cn as string)) as narrative", "'' as irf_case_notes",
            "'' as victims_willing_to_testify",
            f"{self.STATUS}[cast((cn + 2 * pb) % 4 as int)] as case_status", "'' as priority",
            "case when cn % 19 = 0 then '07/02/2001' else '' end as date_closed",
        )

    def _victim_tab(self, condition: str) -> DataFrame:
        rows = self.raw("orders").selectExpr("o_orderkey as k", "o_orderkey div 3 as cn").filter(condition)
        return rows.withColumn("case_id", F.expr(case_number("cn"))).selectExpr(
            "case_id", "concat('Case ', cast(cn as string)) as case_name",
            "concat(case_id, '.V', cast(1 + k % 3 as string)) as victim_id",
            "concat('Sheet victim ', cast(k as string)) as name", "'' as phone", "'' as address",
            "'' as social_media", "'' as narrative", "'' as irf_case_notes",
            f"{self.STATUS}[cast((cn div 3 + (k % 3) div 2) % 4 as int)] as case_status",
            "'' as suspects_identified_and_located", "'' as priority",
            "case when k % 23 = 0 then '07/03/2001' else '' end as date_closed",
        )

    @cached_property
    def suspects_sheet(self) -> DataFrame:
        return self._suspect_tab("cn % 10 <= 3")

    @cached_property
    def suspects_closed(self) -> DataFrame:
        return self._suspect_tab("cn % 10 = 4")

    @cached_property
    def police_sheet(self) -> DataFrame:
        return self._police_tab("cn % 10 <= 2")

    @cached_property
    def police_closed(self) -> DataFrame:
        return self._police_tab("cn % 10 = 4 or (cn % 10 = 3 and pb = 1)")

    @cached_property
    def victims_sheet(self) -> DataFrame:
        return self._victim_tab("cn % 10 <= 3")

    @cached_property
    def victims_closed(self) -> DataFrame:
        return self._victim_tab("cn % 10 = 4")

    @cached_property
    def cases_sheet(self) -> DataFrame:
        """Case names typed in by hand, with a few repeated case rows."""
        return (
            self.raw("orders").filter("o_orderkey % 3 = 0 or o_orderkey % 12 = 1")
            .selectExpr(f"{case_number('(o_orderkey div 3)')} as case_id",
                        "case when o_orderkey % 15 = 0 then '' else concat('Name ', cast(o_orderkey as string)) end as case_name")
        )

    @cached_property
    def arrests_sheet(self) -> DataFrame:
        """One row per form; name, arrested and date cells for box slots 1 to 7."""
        cells = {
            "name": "concat('Supplier-', cast(l_suppkey as string), '-', cast(l_linenumber as string))",
            "arrested": "case when l_returnflag = 'R' then 'Yes' else 'No' end",
            "arrest_date": "date_format(l_shipdate, 'MM/dd/yyyy')",
        }
        slots = [
            F.coalesce(F.max(F.expr(f"case when l_linenumber = {n} then {sql} end")), F.lit(""))
            .alias(f"pb{n}_{cell}")
            for n in PB_SLOTS for cell, sql in cells.items()
        ]
        outcome = self.raw("orders").selectExpr(
            "o_orderkey",
            f"{case_number('(o_orderkey div 3)')} as irf_number",
            "case when o_orderkey % 7 = 0 then '' when o_orderstatus = 'F' then '1' else '0' end as outcome_arrest",
        )
        wide = self._boxes.groupBy("l_orderkey").agg(*slots)
        return outcome.join(wide, outcome["o_orderkey"] == wide["l_orderkey"]).drop("o_orderkey", "l_orderkey")

    # --- contact links -----------------------------------------------------------------------------

    @cached_property
    def link_rows(self) -> DataFrame:
        """Link sheets as typed: one sheet per user, name and case only on its first row. A third
        of all rows point at one hub account."""
        events = self.raw("events").select("event_id", "user_id", "event_type")
        first = events.groupBy("user_id").agg(F.min("event_id").alias("first_id"))
        rows = events.join(first, "user_id").selectExpr(
            "*", "user_id div 3 as cn", "(user_id * 31 + event_id) % 300 as t",
            "event_id = first_id as is_first")
        case = case_number("cn")
        return rows.selectExpr(
            "user_id as sheet_id", "event_id as row_no",
            "case when is_first then concat('Suspect ', cast(user_id as string)) else '' end as name",
            "case event_type when 'view' then 'Facebook Friend' when 'click' then 'Facebook Like' "
            "when 'signup' then 'Phone Contact' when 'purchase' then 'Phone Call' else 'SMS' end as relationship_type",
            "case when event_type in ('view', 'click') then concat('facebook.com/u', cast(user_id div 2 as string)) "
            "else concat('07', cast((user_id + 1) div 2 as string)) end as source",
            "case when event_id % 3 = 0 then 'facebook.com/u1' "
            "when t % 2 = 0 then concat('facebook.com/u', cast(t as string)) "
            "else concat('07', cast(t as string)) end as target",
            "case when event_id % 4 = 0 then '' else concat('Label ', cast(event_id % 50 as string)) end as target_label",
            f"case when is_first then {case} else '' end as case_id",
            f"case when is_first then concat({case}, '.PB', cast(1 + user_id % 3 as string)) else '' end as suspect_case_id",
        )

    # --- model -------------------------------------------------------------------------------------

    @cached_property
    def soc_scores(self) -> DataFrame:
        """Stand-in strength-of-case scores per form row, for checking the scoring arithmetic."""
        return self.case_form.join(self.person_box, F.col("id") == F.col("cif_id")).filter(
            "pb_number is not null").selectExpr(
            f"concat({case_number('(cif_id div 3)')}, '.PB', cast(pb_number as string)) as suspect_id",
            "cif_number", "interview_date", "(cif_id * 37 + pb_number * 11) % 997 / 997.0D as soc")
