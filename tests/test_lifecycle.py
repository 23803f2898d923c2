"""Merging, closing and filling, on small lists where the order of steps would show."""

import datetime as dt
import random
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from casewright import fixed_values as fv
from casewright.operators import aggregates, dedup, joins, lifecycle, people, ranking, unions
from casewright.operators.lifecycle import EntityGroup
from casewright.plans import registry
from casewright.session import scratch_path
from casewright.sources import backups, relational, sheets

COLUMNS = ("case_id", "suspect_id", "name", "case_status", "date_closed")
VICTIM = ("case_id", "victim_id", "name", "case_status", "date_closed")


def frame(spark, rows, columns=COLUMNS):
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in columns))


def group(spark, name, sheet, new=(), closed=(), columns=COLUMNS):
    uid = "victim_id" if name == "victims" else "suspect_id"
    return EntityGroup(name, uid, columns, frame(spark, sheet, columns), frame(spark, closed, columns),
                       frame(spark, new, columns))


def ids_of(df, uid="suspect_id"):
    return sorted(r[0] for r in df.select(uid).collect())


def test_sheet_rows_win(spark):
    g = group(spark, "suspects", [("K1", "s1", "edited", "", "")],
              [("K1", "s1", "raw", "", ""), ("K2", "s2", "raw", "", ""), ("K2", "s2", "raw2", "", ""), ("K3", None, "no id", "", "")])
    active = {r.suspect_id: r.name for r in lifecycle.combine(g).active.collect()}
    assert active == {"s1": "edited", "s2": "raw"}


def test_close_finished(spark):
    g = lifecycle.combine(group(
        spark, "suspects", [("K1", "s1", "a", "", "07/01/2001"), ("K1", "s2", "b", "", ""), ("K1", "s5", "e", "", "x")],
        [("K2", "s3", "c", "", ""), ("K2", "s4", "d", "", "")], [("K9", "s4", "old", "kept", "01/01/2000")]))
    arrested = spark.createDataFrame([("s3",), ("s4",)], "suspect_id string")
    out = lifecycle.close_finished(g, arrested)
    closed = {r.suspect_id: (r.name, r.case_status) for r in out.closed.collect()}
    assert closed == {"s1": ("a", ""), "s3": ("c", fv.ALREADY_ARRESTED_STATUS), "s4": ("old", "kept")}
    assert ids_of(out.active) == ["s2", "s5"]


def started(g):
    return lifecycle.close_finished(lifecycle.combine(g), None)


def test_closing_is_judged_on_one_state(spark):
    """K2's only victim closes for lack of police rows; its suspect stays until the next run."""
    suspects = started(group(spark, "suspects", [("K1", "s1", "", "", ""), ("K2", "s2", "", "", ""), ("K3", "s3", "", "", ""), ("", "s4", "", "", ""), (None, "s6", "", "", "")]))
    police = started(group(spark, "police", [("K1", "s1", "", "", "")], closed=[("K3", "s3", "", "", "")]))
    victims = started(group(spark, "victims", [("K1", "v1", "", "", ""), ("K2", "v2", "", "", ""), ("K3", "v3", "", "", "")], columns=VICTIM))
    s, p, v = lifecycle.propagate_closing(suspects, police, victims)
    assert (ids_of(s.active), ids_of(s.closed)) == (["s1", "s2"], ["s3"])
    assert (ids_of(p.active), ids_of(p.closed)) == (["s1"], ["s3"])
    assert (ids_of(v.active, "victim_id"), ids_of(v.closed, "victim_id")) == (["v1"], ["v2", "v3"])


def test_full_state_properties(spark, folder):
    from casewright.plans import registry
    from casewright.sources.bindings import Bindings
    out = lifecycle.propagate_closing(*registry.closed_groups(Bindings(spark, folder)), settle=registry.settle_on(spark))
    for g in out:
        active, closed = ids_of(g.active, g.uid), ids_of(g.closed, g.uid)
        assert len(set(active)) == len(active) and len(set(closed)) == len(closed)
        assert not set(active) & set(closed)
    suspects = out[0]
    kept = suspects.active.join(suspects.sheet.select("suspect_id", F.col("name").alias("typed")), "suspect_id")
    assert kept.filter("name <> typed").count() == 0


def test_hot_and_blank_cases_join_once_each(spark):
    """A case with most rows, and blank cases: every row stays, blank ones find nothing."""
    left = spark.range(2000).selectExpr(
        "cast(id as string) as suspect_id", "case when id < 1200 then 'K1' when id < 1900 then '' else null end as case_id")
    right = spark.createDataFrame([("K1", 1), ("", 2), (None, 3)], "case_id string, n int")
    out = joins.attach(left, right, "case_id", "suspect_id").groupBy("n").count().collect()
    assert {r.n: r["count"] for r in out} == {1: 1200, None: 800}
    counted = dedup.with_group_count(left.filter("case_id = 'K1'"), "case_id", "n", "suspect_id")
    assert counted.filter("n = 1200").count() == 1200


def test_keep_first_of_a_hot_key(spark):
    rows = spark.range(30000).selectExpr("case when id % 3 = 0 then 'hot' else cast(id as string) end as k", "id as v")
    first = dedup.keep_first(rows, ["k"], ["v"])
    assert first.count() == 20001 and first.filter("k = 'hot' and v = 0").count() == 1


def test_null_keys(spark):
    a = spark.createDataFrame([("x",), (None,)], "k string")
    b = spark.createDataFrame([("y",), (None,)], "k string")
    assert joins.rows_in(a, b, "k").count() == 0
    assert joins.rows_not_in(a, b, "k").count() == 2
    assert joins.rows_not_in(a, b, "k", null_matches=True).count() == 1


def test_unions(spark):
    a = spark.createDataFrame([("k", 1)], "a string, b int")
    with pytest.raises(ValueError):
        unions.by_position(a, a.select("a"))
    with pytest.raises(ValueError):
        joins.shared_inner(a, a.toDF("x", "y"))


def test_willing_names_are_sorted_and_keep_blank_names(spark):
    victims = frame(spark, [("K1", "v1", "Zoe", fv.VICTIM_WILLING_STATUS, ""), ("K1", "v2", "Amy", fv.VICTIM_WILLING_STATUS, ""),
                            ("K1", "v3", None, fv.VICTIM_WILLING_STATUS, ""), ("", "v4", "No case", fv.VICTIM_WILLING_STATUS, ""),
                            ("K2", "v5", "Other", "Step Complete: other", "")], VICTIM)
    rows = {r.case_id: (r.willing_count, r.willing_to_testify) for r in aggregates.willing_victims(victims).collect()}
    assert rows == {"K1": (3, ", Amy, Zoe")}
    assert set(r.case_id for r in aggregates.willing_victims(victims, "v2").collect()) == {"K1", "K2"}


def roll_up(spark, police_status, suspect_status, willing):
    suspects = spark.createDataFrame(
        [("K1", "s1", "low", suspect_status, willing, ".1", "", "n1"), ("K1", "s2", "high", "", willing, ".9", "", "n2")],
        "case_id string, suspect_id string, case_name string, case_status string, victims_willing_to_testify string, "
        "priority string, irf_case_notes string, narrative string")
    police = spark.createDataFrame([("K1", police_status)], "case_id string, case_status string")
    (row,) = lifecycle.roll_up_cases(suspects, police).collect()
    assert (row.case_name, row.narrative, row.priority) == ("high", "n2", .9)
    return row.case_status, row.next_action_priority


@pytest.mark.parametrize("police, suspect, willing, status, action", [
    ("Step Complete", "", "", fv.CASE_STATUS_POLICE, fv.NEXT_ACTION_ARREST),
    ("", "Step Complete", "A, B", fv.CASE_STATUS_LOCATED, fv.NEXT_ACTION_POLICE),
    ("", "", "A, B", fv.CASE_STATUS_TWO_WILLING, fv.NEXT_ACTION_LOCATE),
    (None, None, "A", fv.CASE_STATUS_ONE_WILLING, fv.NEXT_ACTION_LOCATE),
    ("", "", None, "", fv.NEXT_ACTION_CONTACT),
])
def test_case_ladder(spark, police, suspect, willing, status, action):
    assert roll_up(spark, police, suspect, willing) == (status, action)


def test_suspect_rows_can_keep_people_without_form(spark):
    persons = spark.createDataFrame([(1, "A", "", "", ""), (2, "B", "", "", "")],
                                    "person_id long, full_name string, phone_contact string, social_media string, address_notes string")
    forms = spark.createDataFrame([("X01A", 1, 3, "n", dt.date(2001, 1, 1)), ("X01B", 1, 3, "newer", dt.date(2001, 2, 1))],
                                  "cif_number string, person_id long, pb_number int, case_notes string, interview_date date")
    assert [(r.suspect_id, r.narrative) for r in people.suspect_rows(forms, persons).collect()] == [("X01.PB3", "newer")]
    kept = people.suspect_rows(forms, persons, keep_unmatched=True)
    assert {r.suspect_id for r in kept.collect()} == {"X01.PB3", None}


def test_victims_with_blank_first_name_vanish(spark):
    victims = spark.createDataFrame([("X01A", "", "1", "", ""), ("X01.1", "Amy", "2", "", ""), ("X02A", "Bea", "3", "", ""), ("X03A", None, "4", "", "")],
                                    "cif_number string, full_name string, phone_contact string, address_notes string, social_media string")
    assert sorted(r.victim_id for r in people.victim_rows(victims).collect()) == ["X01A".replace("A", ".V1")][1:] + ["X02.V1", "X03.V1"]


def test_work_list_takes_the_top_before_the_filter(spark):
    rows = [("s1.PB1", "A", 0.9, "has one"), ("s2.PB1", "B", 0.8, ""), ("s3.PB1", "C", 0.7, "")]
    df = spark.createDataFrame(rows, "suspect_id string, name string, priority double, relationships string")
    (row,) = ranking.link_sheet_work_list(df, 2).collect()
    assert (row.suspect_case_id, row.case_id, row.sheet_id) == ("s2.PB1", "s2", "s2.PB1_relationships")


def test_copy_priority_overrides_narrative(spark):
    suspects = spark.createDataFrame([("K1", "s1", ".5", "low"), ("K1", "s2", ".7", "top"), ("", "s3", "1", "blank")],
                                     "case_id string, suspect_id string, priority string, narrative string")
    victims = spark.createDataFrame([("K1", "v1", "own", ""), ("K2", "v2", "own", ""), ("", "v3", "own", "")],
                                    "case_id string, victim_id string, narrative string, priority string")
    rows = [(r.victim_id, r.priority, r.narrative) for r in lifecycle.copy_priority(suspects, victims, "case_id", "victim_id").collect()]
    assert rows == [("v1", .7, "top"), ("v2", 0, ""), ("v3", 0, "")]
    inner = lifecycle.copy_priority(suspects, victims, "case_id", "victim_id", how="inner")
    assert [r.victim_id for r in inner.collect()] == ["v1"]


def test_close_stamp_on_empty_table(spark):
    (empty,) = lifecycle.stamp_close_date([frame(spark, []).drop("date_closed")], dt.date(2001, 8, 1))
    assert "date_closed" in empty.columns and empty.count() == 0


def test_sheets_round_trip(spark):
    root = scratch_path(spark, "book")
    rows = frame(spark, [("K1", "s1", 'say "hi", now\nthen', "", "")])
    sheets.write_tab(rows, f"{root}/suspects")
    (row,) = sheets.read_tabs(spark, root, ["suspects"])["suspects"].collect()
    assert tuple(row) == ("K1", "s1", 'say "hi", now\nthen', "", "")


def test_backup_touches_its_own_day_only(spark):
    root = scratch_path(spark, "backup")
    one = frame(spark, [("K1", "s1", "", "", "")])
    backups.back_up({"t": one}, root, dt.date(2001, 8, 1))
    backups.back_up({"t": one}, root, dt.date(2001, 8, 2))
    backups.back_up({"t": one.union(one)}, root, dt.date(2001, 8, 2))
    assert [backups.read(spark, root, "t", dt.date(2001, 8, d)).count() for d in (1, 2, 9)] == [1, 2, 2]
    with pytest.raises(FileNotFoundError):
        backups.read(spark, root, "t", dt.date(2001, 7, 31))
    with pytest.raises(ValueError):
        backups.back_up({"t": one}, root, dt.date(2001, 8, 1))


def test_backups_move_only_what_changes(spark, monkeypatch):
    root = scratch_path(spark, "backups")
    rows = [("a", "x")] * 3 + [("b", None), ("c", ""), ("c", "")]
    tab = lambda rows: spark.createDataFrame(rows, "k string, v string")
    read = lambda day: backups.read(spark, root, "t", dt.date(2001, 8, day))
    days = {1: rows, 2: [*rows, ("d", "y"), ("d", "y")], 4: [("a", "x"), ("b", ""), ("c", ""), ("c", ""), ("d", "y")], 5: []}
    for day in (1, 2):
        backups.back_up({"t": tab(days[day])}, root, dt.date(2001, 8, day))
    assert "Exchange" not in read(2)._jdf.queryExecution().executedPlan().toString()
    with monkeypatch.context() as patch:
        patch.setattr(backups, "settle", lambda name, df: pytest.fail("an unchanged tab was written"))
        manifest = backups.back_up({"t": tab(days[2])}, root, dt.date(2001, 8, 3))
    assert manifest.tables["t/2001-08-03/added"] == manifest.tables["t/2001-08-03/removed"] == ()
    for day in (4, 5):
        backups.back_up({"t": tab(days[day])}, root, dt.date(2001, 8, day))
    for day, expected in {**days, 3: days[2]}.items():
        assert sorted(map(tuple, read(day).collect()), key=repr) == sorted(expected, key=repr)


def test_backups_rebuild_every_date_from_changes(spark, monkeypatch):
    monkeypatch.setattr(backups, "FULL_EVERY", 3)
    root, rng = scratch_path(spark, "backup"), random.Random(1)
    rows, told = [], {}
    for day in range(1, 8):
        if day != 3:  # a day without change
            rows = [r for r in rows if rng.random() < .7] + [(f"K{rng.randrange(4)}", rng.choice(["", None, "a"]), day % 2) for _ in range(4)]
        told[day] = sorted(rows, key=repr)
        manifest = backups.back_up({"t": spark.createDataFrame(rows, "k string, v string, n int"), "u": spark.range(2)}, root, dt.date(2001, 8, day))
        if day == 3:
            assert not any(v for k, v in manifest.tables.items() if "/2001-08-03/" in k)
    for day, want in told.items():
        got = backups.read(spark, root, "t", dt.date(2001, 8, day)).collect()
        assert sorted(map(tuple, got), key=repr) == want
    assert {k.split("/")[1] for k in manifest.tables if k.startswith("t/") and k.endswith("full")} == {"2001-08-01", "2001-08-04", "2001-08-07"}


def test_chosen_boxes_give_the_older_forms(spark):
    """Also for repeated forms, forms without a date or a number, and boxes without one."""
    days = [dt.date(2001, 1, 1), dt.date(2001, 2, 1), None]
    forms = spark.createDataFrame(
        [(n % 9, None if n == 4 else f"N01000000{n % 3}{'AB'[n % 2]}", days[n % 3], ["Primary", None][n % 2], n % 9 > 4, "x") for n in range(12)],
        "id long, cif_number string, interview_date date, education string, flag boolean, staff_name string")
    forms = forms.union(forms.limit(3))
    boxes = spark.createDataFrame([(n % 10, n, [1, 2, None][n % 3]) for n in range(40)], "cif_id long, person_id long, pb_number int")
    old = people.suspect_forms_v2(forms.join(boxes, forms["id"] == boxes["cif_id"]))
    chosen = people.suspect_boxes_v2(forms, boxes)
    new = people.forms_of_boxes_v2(forms, chosen)
    assert new.columns == old.columns and "flag" not in chosen.columns
    rows = lambda df: sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=repr)
    assert rows(new) == rows(old) != []


def test_combining_reads_each_table_once(spark):
    one = group(spark, "suspects", [("K1", "s1", "typed", "", ""), ("K1", "s1", "zzz", "", "")], [("K1", "s1", "new", "", ""), ("K2", "s2", "new", "", "")])
    active = lifecycle.combine(one).active
    assert sorted((r.suspect_id, r.name) for r in active.collect()) == [("s1", "typed"), ("s2", "new")]
    assert active._jdf.queryExecution().optimizedPlan().collectLeaves().size() == 2


def test_jdbc_options():
    plain = relational.jdbc_options("jdbc:x", "select 1", user="u")
    assert plain["query"] == "select 1" and plain["user"] == "u"
    split = relational.jdbc_options("jdbc:x", "select id from t", "id", (1, 100), 4)
    assert split["dbtable"].startswith("(select id from t)") and split["numPartitions"] == "4"
    with pytest.raises(ValueError):
        relational.jdbc_options("jdbc:x", "select 1", "id")


def test_closing_writes_down_what_the_groups_read(monkeypatch):
    """Not the 60 columns of the forms, and the new rows of suspects and police once."""
    written = {}

    class Table:
        def __init__(self, *columns):
            self.columns = columns

        def select(self, *columns):
            return Table(*columns)

        def filter(self, condition):
            return self

    def settle(name, df):
        written.setdefault(name, []).append(df.columns)
        return df

    monkeypatch.setattr(registry, "settle_on", lambda spark: settle)
    monkeypatch.setattr(registry, "noted_forms", lambda b: Table(*map(str, range(60))))
    monkeypatch.setattr(registry, "new_victims", lambda b: None)
    monkeypatch.setattr(registry, "F", SimpleNamespace(col=str))
    monkeypatch.setattr(people, "suspect_rows", lambda forms: Table("suspect_id"))
    monkeypatch.setattr(registry.runs, "entity_groups", lambda b, suspects, victims: ())
    assert registry.closed_groups(SimpleNamespace(spark=None)) == []
    assert len(written["forms"]) == len(written["new-suspects"]) == 1 and len(written["forms"][0]) < 15


def test_tables_of_one_key_shuffle_the_rows_once(spark):
    rows = frame(spark, [("K1", "s1"), ("K2", "s2"), ("", "s3"), (None, "s4")], ("case_id", "suspect_id"))
    one = frame(spark, [("K1", "a"), ("", "b"), (None, "c")], ("case_id", "x"))
    two = frame(spark, [("K1", "d"), ("K2", "e"), (" ", "f")], ("irf_number", "y"))
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    for k, v in zip(kept, ("-1", "false"), strict=True):
        spark.conf.set(k, v)
    try:
        both = joins.attach_all(rows, [(one, "case_id"), (two, "irf_number")], "case_id", "suspect_id")
        assert both._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 3
        assert sorted(tuple(r) for r in both.select("suspect_id", "x", "y").collect()) == [
            ("s1", "a", "d"), ("s2", None, "e"), ("s3", None, None), ("s4", None, None)]
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)


def test_closing_with_notes_writes_each_list_twice(spark):
    """Active and judged; what stays and goes is read from the latter, notes come along, and no id is closed twice."""
    columns = (*COLUMNS, "irf_case_notes")
    wide = lambda *rows: [(*r, "typed") for r in rows]
    suspects = group(spark, "suspects", wide(("K1", "s1", "", "", ""), ("K2", "s2", "", "", ""), ("K2", "s2", "", "", "")),
                     wide(("K1", "s4", "", "", "")), wide(("K9", "s9", "", "", ""), ("", "s8", "", "", "")), columns)
    police = group(spark, "police", wide(("K1", "s1", "", "", ""), ("K2", "s2", "", "", "07/01/2001")), (), (), columns)
    victims = group(spark, "victims", wide(("K1", "v1", "", "", ""), ("K2", "v2", "", "", "")),
                    columns=("case_id", "victim_id", *columns[2:]))
    notes = frame(spark, [("K1", "b"), ("K1", "a"), ("K2", "c"), (None, "d")], ("irf_number", "case_notes"))
    arrested = frame(spark, [("s4",)], ("suspect_id",))
    written = []
    done = registry.runs.merge_and_close((suspects, police, victims), arrested, notes, lambda name, df: written.append(name) or df)
    lists = [(sorted((r[1], r.irf_case_notes) for r in g.active.collect()), sorted((r[1], r.irf_case_notes) for r in g.closed.collect()))
             for g in done]
    assert lists == [([("s1", "a")], [("s2", "c"), ("s4", "typed"), ("s9", "typed")]), ([("s1", "a")], [("s2", "typed")]),
                     ([("v1", "a")], [("v2", "c")])]
    assert sorted(written) == sorted(["cases-present", *[f"{n}-{step}" for n in ("suspects", "police", "victims")
                                                         for step in ("closed", "active", "judged")]])
