"""Scores on hand-made rows, one case per known slip of the older rules."""

import datetime as dt
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from casewright import fixed_values as fv
from casewright.config import NetworkWeights, Settings
from casewright.operators import joins, scoring

S = Settings(as_of=dt.date(2001, 8, 1), country="ASIA")


def values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_multiplier(spark):
    df = spark.createDataFrame([(n,) for n in (0, 1, 2, 7, 8, None)], "n int")
    assert values(df, scoring.willing_multiplier(F.col("n"), S)) == [0, .5, .75, 1, 1, 0]
    legacy = replace(S, legacy_multiplier_map=True)
    assert values(df, scoring.willing_multiplier(F.col("n"), legacy)) == [0, .5, .75, 1, 0, 0]
    table = replace(S, willing_multipliers={0: 0, 1: .3})
    assert values(df, scoring.willing_multiplier(F.col("n"), table)) == [0, .3, 0, 0, 0, 0]


def test_recency(spark):
    days = [dt.date(2001, 8, 1), dt.date(2001, 4, 23), dt.date(2001, 9, 1), None, dt.date(2001, 7, 22)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [round(v, 6) for v in values(df, scoring.recency_score("d", S))] == [1, 0, 1.31, 0, .9]
    squared = replace(S, discount_coef=0.001, discount_exp=2.0)
    assert [round(v, 6) for v in values(df, scoring.recency_score("d", squared))] == [1, 0, .039, 0, .9]
    odd = replace(S, discount_exp=1.5)
    assert values(df, scoring.recency_score("d", odd))[2] == 0
    older = replace(S, variant="v2")
    assert [round(v, 6) for v in values(df, scoring.recency_score("d", older))] == [1, 0, 1.31, 0, .9]


@pytest.mark.parametrize("mode, wanted", [("documented", [1, 0, 0]), ("v3", [0, 1, 1]), ("v2", [0, 1, 1])])
def test_bio_known(spark, mode, wanted):
    df = spark.createDataFrame([(fv.SUSPECT_LOCATED_STATUS, ""), ("", "known"), (None, None)],
                               "case_status string, bio_and_location string")
    assert values(df, scoring.bio_known(replace(S, bio_mode=mode))) == wanted


def test_eminence(spark):
    df = spark.createDataFrame([("", .5), (None, .5), ("12", .5), ("8.8", .5), ("abc", .5), ("5", None)],
                               "eminence string, network_weight double")
    assert values(df, scoring.eminence_score(False)) == [1, 1, 12, 8.8, None, 5]
    assert values(df, scoring.eminence_score(True)) == [1.5, 1.5, 9, 9, 0, 0]


def test_network_weight_is_capped(spark):
    df = spark.createDataFrame([(1, 1, 2), (1, 50, 0), (None, None, None)],
                               "first_degree_links int, first_degree_case_links int, second_degree_case_links int")
    first, second = scoring.network_scores()
    weights = NetworkWeights(True, 0.5, 3.0, 0.5)
    assert values(df, scoring.network_weight(first, second, weights)) == [1.0, 3.0, 0.0]


def test_exploitation_is_unbounded_sum(spark):
    df = spark.createDataFrame([tuple(True for _ in fv.EXPLOITATION_WEIGHTS)],
                               ", ".join(f"{c} boolean" for c in fv.EXPLOITATION_WEIGHTS))
    assert round(values(df, scoring.exploitation_weight(df.columns, S))[0], 6) == 7.95


COMPONENTS = "willing_score double, bio_known int, others_arrested int, willing_to_arrest int, recency_score double, belief_score double, exploitation_score double"


def test_solvability_nulls(spark):
    df = spark.createDataFrame([(.5, 1, 1, None, 1.0, None, None), (1.0, 1, 1, 1, 1.0, 1.0, 1.0)], COMPONENTS)
    assert [round(v, 6) for v in values(df, scoring.solvability(S))] == [round(8 / 14, 6), 1]
    assert values(df, scoring.solvability(replace(S, variant="v2")))[0] is None
    assert values(df, scoring.solvability(replace(S, solvability_denominator=7.0, solvability_cap=1.5)))[1] == 1.5


def test_priority_needs_all_parts(spark):
    df = spark.createDataFrame([(1.0, .5, 5.0), (1.0, None, 5.0)], "solvability double, strength_of_case double, eminence_score double")
    assert values(df, scoring.priority(S)) == [0.8, 0]


def test_priority_rises_with_each_score(spark):
    base = (.5, 0, 1, 0, .5, .5, .5)
    rows = [base] + [tuple(v + 1 if i == j else v for j, v in enumerate(base)) for i in range(len(base))]
    first, *raised = values(spark.createDataFrame(rows, COMPONENTS), scoring.solvability(S))
    assert all(v > first for v in raised)


def test_case_measures_and_legacy_key(spark):
    forms = spark.createDataFrame(
        [("X01.1", "X01.PB1", dt.date(2001, 7, 1), 1), ("X01B", "X01.PB12", dt.date(2001, 7, 9), 1)],
        "cif_number string, suspect_id string, interview_date date, arrest int")
    rows = scoring.case_measures(S, forms=forms).collect()
    assert [(r.case_id, r.interview_date, r.others_arrested) for r in rows] == [("X01", dt.date(2001, 7, 9), 2)]
    legacy = {r.case_id: r.others_arrested for r in scoring.case_measures(S, forms=forms, legacy_case_key=True).collect()}
    assert legacy == {"X01.": None, "X01": 2}


def test_own_arrest_can_be_left_out(spark):
    suspects = spark.createDataFrame([("X01", "X01.PB1", "", "", ""), ("X01", "X01.PB2", "", "", ""), ("", "Y.PB1", "", "", ""), (None, "Z.PB1", "", "", "")],
                                     "case_id string, suspect_id string, eminence string, case_status string, bio_and_location string")
    forms = spark.createDataFrame([("X01A", "X01.PB1", dt.date(2001, 7, 1), 1, .5), ("X01A", "X01.PB2", dt.date(2001, 7, 1), 0, .5)],
                                  "cif_number string, suspect_id string, interview_date date, arrest int, soc double")
    police = spark.createDataFrame([("X01", "Step Complete")], "case_id string, case_status string")
    victims = spark.createDataFrame([("X01", fv.VICTIM_WILLING_STATUS)], "case_id string, case_status string")
    settings = replace(S, exclude_own_arrest=True)
    measures = scoring.case_measures(settings, victims, police, forms)
    out = scoring.score_suspects(suspects.withColumns({c: F.lit("") for c in ("strength_of_case", "solvability", "priority")}),
                                 replace(settings, belief_weights=S.belief_weights),
                                 measures.withColumns({"belief_score": F.lit(0.0), "exploitation_score": F.lit(0.0)}),
                                 scoring.suspect_measures(forms))
    got = {r.suspect_id: (r.others_arrested, r.willing_score) for r in out.collect()}
    assert got == {"X01.PB1": (0, .5), "X01.PB2": (1, .5), "Y.PB1": (0, 0), "Z.PB1": (0, 0)}


def test_weights_from_table(spark):
    table = spark.createDataFrame([("a", "2"), ("b", ""), (None, "3")] + [(f"note {i}", "5") for i in range(2000)],
                                  "key string, value string")
    assert scoring.weights_from_table(table, ("a", "b", "c")) == {"a": 2.0, "b": 0.0}
    with pytest.raises(ValueError):
        replace(S, solvability_weights={"a": 1.0})


def test_blank_keys_are_not_searched_for_below_the_joins(spark):
    """A filter on the case or suspect of a form would be worked out on every row that the forms are made of."""
    forms = spark.createDataFrame([("K1A", "K1.PB1", 1), ("A", "", 1), (" A", None, 1), (None, " ", 1), ("K1B", "K1.PB1", 2)],
                                  "cif_number string, suspect_id string, arrest int").withColumn("interview_date", F.lit("2001-07-30").cast("date"))
    measures, known = scoring.case_measures(S, forms=forms), scoring.suspect_measures(forms)
    assert [(r.case_id, r.others_arrested) for r in measures.collect()] == [("K1", 3)]
    suspects = spark.createDataFrame([("K1", "K1.PB1"), ("", ""), (" ", " "), (None, None)], "case_id string, suspect_id string")
    scored = joins.attach(joins.attach(suspects, measures, "case_id", "suspect_id"), known, "suspect_id", "suspect_id")
    plan = scored._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert not [line for line in plan if "Filter" in line and "trim(" in line]
    assert sorted((repr(r.suspect_id), r.others_arrested, r.arrest) for r in scored.collect()) == [
        ("' '", None, None), ("''", None, None), ("'K1.PB1'", 3, 1), ("None", None, None)]
