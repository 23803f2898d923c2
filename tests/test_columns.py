"""Column functions on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from casewright import fixed_values as fv
from casewright.functions import ids, links, text
from casewright.functions.narrative import narrative, notes_or_narrative
from casewright.operators import features


def column(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_ids(spark):
    df = spark.createDataFrame([("X01A", 1), ("X01.1", None), ("X.01B", 10), (None, 2)], "cif string, pb int")
    assert column(df, ids.case_id("cif")) == ["X01", "X01", "X01", None]
    assert column(df, ids.case_id("cif", legacy=True)) == ["X01", "X01.", "X.01", None]
    assert column(df, ids.suspect_id("cif", "pb")) == ["X01.PB1", "X01.PB0", "X01.PB10", None]
    assert column(df, ids.case_of_suspect(ids.suspect_id("cif", "pb"))) == ["X01", "X01", "X01", None]


def test_victim_ids(spark):
    cifs = ["X01A", "X01.1", "X01B", "X01J", "X01K", "X01.2"]
    df = spark.createDataFrame([(c,) for c in cifs], "cif string")
    assert column(df, ids.victim_id("cif")) == ["X01.V1", "X01.V1", "X01.V2", "X01.V10", "X01K", "X01.2"]


def test_text_helpers(spark):
    df = spark.createDataFrame([("",), (None,), ("  ",), ("12 USD",), ("know",)], "t string")
    assert column(df, text.blank_to_null("t")) == [None, None, None, "12 USD", "know"]
    assert column(df, text.digits("t")) == [0, 0, 0, 12, 0]
    assert column(df, text.has("t", "now")) == [False, False, False, False, True]
    assert column(df, text.has("t", "now", null_is_true=True)) == [False, True, False, False, True]
    assert column(df, text.truthy("t", "string")) == [False, False, True, True, True]
    assert column(df, text.truthy("t", "string", null_is_true=True))[1] is True
    assert column(df, text.number("t", 7.0)) == [7, 7, 7, 7, 7]


def form(spark, **values):
    base = {c: False for c in fv.CASE_FORM_FLAGS}
    base.update(expected_earning="", planned_destination="", legal_action_taken="no", pv_believes="", case_notes="")
    base.update(values)
    flags = ", ".join(f"{c} boolean" for c in fv.CASE_FORM_FLAGS)
    schema = flags + ", expected_earning string, planned_destination string, legal_action_taken string, pv_believes string, case_notes string"
    return spark.createDataFrame([tuple(base[n.split()[0]] for n in schema.split(", "))], schema)


def test_narrative_order_and_last_rule_wins(spark):
    row = form(spark, how_recruited_promised_job=True, how_recruited_married=True, recruited_broker=True,
               purpose_for_leaving_education=True, purpose_for_leaving_medical=True, id_made_no=True,
               id_made_real=None, expected_earning="50", planned_destination="Oman",
               legal_action_taken="yes", pv_believes="Definitely, but some")
    assert column(row, narrative()) == [
        "They were recruited by a broker. Recruited by marriage. Recruited by job promise. "
        "Broker said they would be earning 50 per month. Left home for medical reasons. "
        "Planned destination: Oman No ID made. Legal Case Filed. PV believes the suspect has trafficked some. "]


def test_narrative_missing_texts_stay_silent(spark):
    row = form(spark, expected_earning=None, planned_destination=None, legal_action_taken=None, pv_believes=None)
    assert column(row, narrative()) == [""]


def test_narrative_repeats_only_when_asked(spark):
    row = form(spark, how_recruited_broker_approached=True)
    once = "Recruited by broker approaching them. "
    assert column(row, narrative()) == [once]
    assert column(row, narrative(repeat_approached=True)) == [once * 2]


@pytest.mark.parametrize("notes, plain, filled", [("", "N", "N"), ("nan", "", "N"), (None, "", "N"), ("x", "x", "x")])
def test_notes(spark, notes, plain, filled):
    df = spark.createDataFrame([(notes,)], "n string")
    assert column(df, notes_or_narrative("n", F.lit("N"))) == [plain]
    assert column(df, notes_or_narrative("n", F.lit("N"), fill_missing=True)) == [filled]


def test_links(spark):
    df = spark.createDataFrame([("Facebook Friend", "b", "a"), ("Facebook Like", "b", "a"), ("SMS", "b", "a"), (None, "b", "a")],
                               "r string, s string, t string")
    d = links.edge_direction("r")
    assert column(df, d) == [1, 3, 2, 2]
    assert column(df, links.edge_combo_id("s", "t", d)) == ["b<->a", "b<-a", "b->a", "b->a"]
    assert column(df, links.edge_combo_id("s", "t", d, True))[0] == "a<->b"
    accounts = spark.createDataFrame([("www.facebook.com/x",), ("0712",), (None,)], "a string")
    assert column(accounts, links.account_type("a")) == [1, 2, 2]


def test_box_flags(spark):
    df = spark.createDataFrame([(1, "1,2"), (10, "10, 2"), (1, "12"), (0, "1.0"), (2, None)], "pb_number int, broker_pb string")
    assert column(features.box_flags(df), "broker_pb2") == [True, True, False, True, False]
    assert column(features.box_flags(df, as_coded=True), "broker_pb2") == [True, False, True, True, False]


def test_destination_flags(spark):
    df = spark.createDataFrame([("U.A.E",), ("don't know",), (None,)], "planned_destination string")
    out = features.destination_flags(df, ("Kenya",), unknown=True).collect()
    assert [(r.destination_gulf, r.destination_unknown, r.destination_Kenya) for r in out] == [
        (True, False, False), (False, True, False), (False, False, False)]
    missing = features.destination_flags(df, ("Kenya",), null_is_true=True).collect()[2]
    assert missing.destination_gulf and missing.destination_Kenya


def test_category_flags_and_vector_encoding(spark):
    df = spark.createDataFrame([(str(i % 7) if i % 5 else None,) for i in range(40)], "c string")
    flags = features.category_flags(df, features.category_levels(df, ["c"]))
    assert "c_nan" in flags.columns and len(flags.columns) == 8
    assert all(sum(map(bool, row)) == 1 for row in flags.collect())
    vectors = features.encode_categories(df, ["c"]).select("c_vector").collect()
    assert all(v.c_vector.numNonzeros() == 1 for v in vectors)


def test_sheet_dates(spark):
    from casewright.sources.sheets import sheet_date
    df = spark.createDataFrame([("07/31/2001",), ("2001-07-31",), ("soon",), ("",)], "d string")
    assert column(df, sheet_date("d")) == [dt.date(2001, 7, 31)] * 2 + [None, None]
