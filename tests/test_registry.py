"""Every registered query against its SQL, and the plans they run."""

import pytest

import __spark_entry__ as entry
from casewright.plans import oracle, registry
from tests.compare import differences, duck

SQL = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con(folder):
    return duck(folder)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, folder, con, name):
    assert differences(registry.QUERIES[name](spark, folder), con, SQL[name]) == []


@pytest.mark.parametrize("name", ["m1_feature_vector", "m3_split", "m8_save_load"])
def test_model_query_keeps_every_row(spark, folder, name):
    rows = registry.QUERIES[name](spark, folder)
    assert rows.count() == registry.QUERIES["p7_suspect_filter"](spark, folder).count()


def test_entry_contract(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    top = entry.entry(spark)
    assert top.count() == 200 and "priority" in top.columns


PLANNED = ["a1_willing_victims", "a3_total_arrests", "a4_arrest_rows", "a7_multi_match", "c12_priority", "j2_left",
           "l4_incident_notes", "l7_copy_priority", "l8_case_roll_up", "p6_suspect_rows", "p18b_features_v2",
           "t2_top_rows", "u3_first_table_wins", "w1_group_count", "w3_first_row_fill"]


@pytest.mark.parametrize("name", PLANNED)
def test_plan_has_no_cross_join_and_no_python(spark, folder, name):
    plan = registry.QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
                     "MapInPandas", "FlatMapGroupsInPandas"):
        assert operator not in plan


def test_country_filter_reaches_the_scan(spark, folder):
    plan = registry.QUERIES["s4_victim_scan"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(r_name,ASIA)" in plan


def test_keep_first_limits_groups_before_the_shuffle(spark, folder):
    plan = registry.QUERIES["w2_keep_first"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_top_rows_use_no_global_sort(spark, folder):
    plan = registry.QUERIES["t2_top_rows"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan and "rangepartitioning" not in plan
