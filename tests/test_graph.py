"""Contact graph: counts against brute force, numbering, repeated and streamed intake."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from casewright.operators import graph, link_stats, numbering
from casewright.plans import registry
from casewright.session import scratch_path
from casewright.sources import generations, graph_store, tables
from casewright.sources.bindings import Bindings
from casewright.streaming.link_intake import LINK_SCHEMA, take_in_new_sheets


def sheet_rows(sheet, name, case, rows):
    """One link sheet: name and case on the first row only."""
    return [(sheet, i, name if i == 1 else "", kind, source, target, "", case if i == 1 else "",
             f"{case}.PB1" if i == 1 else "") for i, (kind, source, target) in enumerate(rows, 1)]


@pytest.fixture(scope="module")
def small(spark):
    """A has accounts a1, a2; a1 is used in case K1 by A and in K2 by B; C only receives."""
    rows = (
        sheet_rows(1, "A", "K1", [("SMS", "a1", "x"), ("Facebook Friend", "a2", "y"), ("SMS", "a1", "x")])
        + sheet_rows(2, "B", "K2", [("SMS", "a1", "z"), ("Facebook Like", "b", "x")])
        + sheet_rows(3, "C", "K3", [("Phone Call", "c", "a2"), ("Phone Call", "c", "lonely")])
        + sheet_rows(4, "D", "K3", [("", "", "")])
    )
    links = graph.prepare_links(spark.createDataFrame(rows, LINK_SCHEMA))
    dims = {"edge_types": graph.edge_types(spark), "account_types": graph.account_types(spark)}
    return graph.import_links(links, dims)


def test_first_row_fills_the_sheet(spark):
    rows = sheet_rows(1, "Test 1", "K1", [("SMS", "a", "b")] * 4)
    filled = graph.prepare_links(spark.createDataFrame(rows, LINK_SCHEMA)).orderBy("row_no").collect()
    assert [r.name for r in filled] == ["Test 1"] * 4
    assert filled[3].suspect_case_id == "K1.PB1"


def test_import_and_counts(small):
    assert {r.name for r in small["suspects"].collect()} == {"A", "B", "C", "D"}
    assert small["edges"].count() == 6
    stats = {r.name: r for r in link_stats.refresh_link_stats(small).collect()}
    assert {n: r.first_degree_links for n, r in stats.items()} == {"A": 2, "B": 2, "C": 2, "D": 0}
    # x is the target of a1 and of b, so A's and B's edges to it count.
    assert {n: r.second_degree_links for n, r in stats.items()} == {"A": 1, "B": 1, "C": 0, "D": 0}
    assert {n: r.first_degree_case_links for n, r in stats.items()} == {"A": 1, "B": 1, "C": 0, "D": 0}
    assert {n: r.second_degree_case_links for n, r in stats.items()} == {"A": 1, "B": 0, "C": 0, "D": 0}
    coded = {r.name: r.second_degree_links for r in link_stats.refresh_link_stats(small, as_coded=True).collect()}
    assert coded == {"A": 1, "B": 0, "C": 0, "D": 0}


def test_combo_ids_hold_whole_numbers(small):
    assert all("." not in r.edge_combo_id and "-" in r.edge_combo_id for r in small["edges"].collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_other_cases_equal_brute_force(spark, seed):
    """Two hub accounts shared by most suspects, and light ones; case numbers lie across words and at their ends."""
    rng = random.Random(seed)
    holders, members, own = set(), set(), set()
    numbers = [0, 1, 62, 63, 64, 65, 127, 128, 191, 192, 1000, 6400]
    for s in range(30):
        own |= {(s, numbers[rng.randrange(12)]) for _ in range(rng.choice([0, 1, 1, 2]))}
        if rng.random() < .7:
            holders.add((s, 100))
        if rng.random() < .6:
            holders.add((s, 200))
        holders |= {(s, rng.randrange(20)) for _ in range(rng.randrange(3))}
    for k in range(12):
        members |= {(a, numbers[k]) for a in (100, 200) if rng.random() < .7}
        members |= {(rng.randrange(20), numbers[k]) for _ in range(3)}
    cases = defaultdict(set)
    for a, k in members:
        cases[a].add(k)
    wanted = {}
    for s in range(30):
        found = set().union(*[cases[a] for h, a in holders if h == s] or [set()])
        wanted[s] = len(found - {k for h, k in own if h == s})
    got = link_stats.other_cases(
        spark.createDataFrame(list(holders), "suspect_id long, account long"),
        spark.createDataFrame(list(members), "account long, case long"),
        spark.createDataFrame(list(own), "suspect_id long, case long"))
    counts = {r.suspect_id: r.case_links for r in got.collect()}
    assert {s: counts.get(s, 0) for s in range(30)} == wanted


def test_matches_of_a_hub_are_counted_and_listed_once(spark):
    """An account in 2,000 cases: every count is there, and the members are one row per case."""
    df = spark.range(2000).selectExpr("'hub' as source", "'hub' as target", "concat('k', id) as case_id").union(
        spark.createDataFrame([("a", "a", "k1"), ("b", "a", "k2")], "source string, target string, case_id string"))
    counts, members = link_stats.multi_match(df, "source", "target", "case_id")
    got = counts.collect()
    assert len(got) == 2001 and all(r.match_count == (1999 if r.match == "hub" else 1) for r in got)
    assert members.filter("match = 'hub'").count() == 2000 and members.count() == 2002


def test_counts_where_suspects_hold_differing_sets_of_hubs(spark):
    """Three accounts in 2,000 cases; every suspect holds another set of them and of small accounts."""
    rng = random.Random(5)
    cases = {a: set(rng.sample(range(3000), 2000)) for a in (1, 2, 3)}
    cases |= {a: {rng.randrange(3000)} for a in range(10, 60)}
    held = {s: {a for a in (1, 2, 3) if rng.random() < .6} | set(rng.sample(range(10, 60), 2)) for s in range(100)}
    own = {s: set(rng.sample(range(3000), 3)) for s in range(100)}
    rows = lambda d: [(k, v) for k, values in d.items() for v in values]
    got = link_stats.other_cases(
        spark.createDataFrame(rows(held), "suspect_id long, account long"),
        spark.createDataFrame(rows(cases), "account long, case long"),
        spark.createDataFrame(rows(own), "suspect_id long, case long")).collect()
    assert {r.suspect_id: r.case_links for r in got} == {
        s: len(set().union(*[cases[a] for a in held[s]]) - own[s]) for s in held}


def test_numbers_are_dense_and_continue(spark):
    first = numbering.number_rows(spark.range(500).selectExpr("cast(id as string) as k"), ["k"])
    assert sorted(r.id for r in first.collect()) == list(range(1, 501))
    more = numbering.number_rows(spark.range(7).selectExpr("cast(id as string) as k"), ["k"], existing=first)
    assert sorted(r.id for r in more.collect()) == list(range(501, 508))
    again = {r.k: r.id for r in numbering.number_rows(first.select("k").repartition(7), ["k"]).collect()}
    assert again == {r.k: r.id for r in first.collect()}


def table_keys(g):
    keys = {"suspects": "name", "accounts": "account_name", "edges": "edge_combo_id", "cases": "case_number",
            "case_suspects": "suspect_case_id"}
    return {t: sorted(r[0] for r in g[t].select(c).collect()) for t, c in keys.items()}


def named_edges(g):
    """Edges by account names, as ids depend on the order of intake."""
    names = {r.id: r.account_name for r in g["accounts"].collect()}
    return sorted((names[r.source_account_id], names[r.target_account_id], r.edge_direction) for r in g["edges"].collect())


def test_streamed_intake_equals_batch_and_is_repeatable(spark, folder):
    links = Bindings(spark, folder).link_rows
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "graph")
    # A sheet lands as one file here: of its rows that repeat a pair of accounts, the first taken counts.
    links.repartition(3, "sheet_id").sortWithinPartitions("row_no").write.parquet(landing)
    graph_store.create(spark, root)
    for run in ("first", "second"):  # a fresh checkpoint reads every sheet again
        take_in_new_sheets(spark, landing, root, f"{root}/checkpoint-{run}", files_per_batch=2, first_row=None).awaitTermination()
    streamed = graph_store.read(spark, root)
    other = scratch_path(spark, "graph")
    graph_store.create(spark, other)
    graph_store.add_sheets(spark, other, links)
    batch = graph_store.read(spark, other)
    for table in ("suspects", "accounts", "cases", "case_suspects"):
        assert table_keys(streamed)[table] == table_keys(batch)[table]
    assert named_edges(streamed) == named_edges(batch)
    for table in ("suspects", "accounts", "edges", "cases", "case_suspects"):
        ids = [r.id for r in streamed[table].select("id").collect()]
        assert len(ids) == len(set(ids)) and sorted(ids) == list(range(1, len(ids) + 1))


def test_replace_keeps_the_old_version_until_done(spark):
    path = scratch_path(spark, "table")
    tables.replace(spark, path, spark.range(3))
    tables.replace(spark, path, tables.read(spark, path).withColumn("id", F.col("id") * 10))
    assert sorted(r.id for r in tables.read(spark, path).collect()) == [0, 10, 20]
    assert tables.latest_version(spark, path) == 2
    # A version without a finish marker is not seen.
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{path}/version=3")
    assert tables.latest_version(spark, path) == 2
    with pytest.raises(FileNotFoundError):
        tables.read(spark, path + "-none")


def random_sheets(rng, sheet_ids, accounts=12):
    out = []
    for sheet in sheet_ids:
        links = [(rng.choice(["SMS", "Facebook Like", "Facebook Friend"]), f"a{rng.randrange(accounts)}", f"a{rng.randrange(accounts)}")
                 for _ in range(rng.randrange(1, 6))]
        out += sheet_rows(sheet, f"N{rng.randrange(14)}", f"K{rng.randrange(6)}", links)
    return out


@pytest.mark.parametrize("seed", [1])
def test_counts_kept_up_by_increments_equal_a_full_count(spark, seed):
    rng = random.Random(seed)
    root = scratch_path(spark, "graph")
    graph_store.create(spark, root)
    for day in range(3):
        rows = random_sheets(rng, range(day * 5, day * 5 + 5))
        stored = graph_store.add_sheets(spark, root, spark.createDataFrame(rows, LINK_SCHEMA))
        kept = sorted(map(tuple, stored["suspects"].select("id", "name", *link_stats.COUNTS).collect()))
        assert kept == sorted(map(tuple, link_stats.refresh_link_stats(stored).collect()))
    assert any(row[-1] for row in kept) and any(row[-2] for row in kept)


def test_untouched_suspects_are_not_counted_again(spark):
    """Two days that share no account: the second day's touched suspects are its own."""
    root = scratch_path(spark, "graph")
    graph_store.create(spark, root)
    graph_store.add_sheets(spark, root, spark.createDataFrame(sheet_rows(1, "A", "K1", [("SMS", "a", "b")]), LINK_SCHEMA))
    before = graph_store.read(spark, root)
    links = graph.prepare_links(spark.createDataFrame(sheet_rows(2, "B", "K2", [("SMS", "c", "d")]), LINK_SCHEMA))
    added = graph.new_rows(links, before)
    grown = graph.extend(before, added)
    names = {r.id: r.name for r in grown["suspects"].collect()}
    assert [names[r.suspect_id] for r in link_stats.touched_suspects(grown, added).collect()] == ["B"]


def test_rows_united_are_bounded_by_the_smaller_accounts(spark):
    """2,000 suspects of two hubs cost one difference, not one each."""
    held = [(s, a) for s in range(2000) for a in (1, 2)] + [(0, 3)]
    cases = [(1, k) for k in range(3000)] + [(2, k) for k in range(2000, 4000)] + [(3, 3999), (3, 5000)]
    holders, members = spark.createDataFrame(held, "suspect_id long, account long"), spark.createDataFrame(cases, "account long, case long")
    _, others = link_stats.largest_and_others(holders, members)
    extra = link_stats.differences(others, members)
    assert extra.count() == 1000 + 2 <= 2000 + 2
    got = {r.suspect_id: r.case_links for r in link_stats.other_cases(
        holders, members, spark.createDataFrame([(5, 2500), (6, 9999)], "suspect_id long, case long")).collect()}
    assert got == {s: 4001 if s == 0 else 3999 if s == 5 else 4000 for s in range(2000)}


def test_a_commit_that_fails_half_way_changes_nothing(spark, monkeypatch):
    root = scratch_path(spark, "graph")
    graph_store.create(spark, root)
    first = spark.createDataFrame(sheet_rows(1, "A", "K1", [("SMS", "a", "b")]), LINK_SCHEMA)
    second = spark.createDataFrame(sheet_rows(2, "B", "K2", [("SMS", "a", "c")]), LINK_SCHEMA)
    graph_store.add_sheets(spark, root, first)
    before, written = table_keys(graph_store.read(spark, root)), []
    whole = generations._written

    def fails_at_the_third(root, name, df):
        written.append(name)
        if len(written) == 3:
            raise OSError("disk lost")
        return whole(root, name, df)

    monkeypatch.setattr(generations, "_written", fails_at_the_third)
    with pytest.raises(OSError, match="disk lost"):
        graph_store.add_sheets(spark, root, second)
    assert len(written) == 3 and table_keys(graph_store.read(spark, root)) == before
    monkeypatch.undo()
    old = generations.latest(spark, root)
    graph_store.add_sheets(spark, root, second)
    assert table_keys(graph_store.read(spark, root))["suspects"] == ["A", "B"]
    # A writer that started from the older state loses, and changes nothing.
    with pytest.raises(FileExistsError):
        generations.commit(spark, root, old, replaced={"suspects": spark.range(1)})
    assert table_keys(graph_store.read(spark, root))["suspects"] == ["A", "B"]
    generations.clean(spark, root, keep=1)
    assert generations.generations(spark, root) == [3] and table_keys(graph_store.read(spark, root))["edges"]


def test_many_appends_are_joined_to_one_folder(spark, monkeypatch):
    root = scratch_path(spark, "table")
    monkeypatch.setattr(generations, "MOST_FOLDERS", 3)
    manifest = None
    for i in range(7):
        manifest = generations.commit(spark, root, manifest, appended={"t": spark.range(i, i + 1)})
        assert len(manifest.tables["t"]) < 3
    assert sorted(r.id for r in generations.read(spark, root, manifest, "t", "id long").collect()) == list(range(7))


@pytest.mark.parametrize("order", [(0, 1, 2), (2, 1, 0)])
def test_sheets_over_several_files(spark, order):
    """Three files in any order, one sheet of which never gets its first row."""
    rows = [r for sheet, (name, case) in enumerate([("A", "K1"), ("B", "K2")], 1) for r in sheet_rows(
        sheet, name, case, [("SMS", f"{name}{i}", f"t{i}") for i in range(6)])]
    rows[8] = (*rows[8][:2], "C", *rows[8][3:7], "K9", "K9.PB1")  # a typed name stays
    orphan = sheet_rows(3, "D", "K3", [("SMS", "d", "e")] * 3)[1:]
    files = [[r for r in rows + orphan if r[1] % 3 == part] for part in (1, 2, 0)]
    root = scratch_path(spark, "graph")
    graph_store.create(spark, root)
    for part in order:
        graph_store.add_landed(spark, root, spark.createDataFrame(files[part], LINK_SCHEMA))
    graph_store.add_landed(spark, root, spark.createDataFrame(files[1], LINK_SCHEMA))  # a file that lands again
    whole = scratch_path(spark, "graph")
    graph_store.create(spark, whole)
    graph_store.add_sheets(spark, whole, spark.createDataFrame(rows, LINK_SCHEMA))
    cut, one = graph_store.read(spark, root), graph_store.read(spark, whole)
    names = lambda g: {t: table_keys(g)[t] for t in ("suspects", "accounts", "cases", "case_suspects")}
    assert names(cut) == names(one) and named_edges(cut) == named_edges(one) and len(named_edges(cut)) == 12
    state = generations.latest(spark, root)
    waiting = generations.read(spark, root, state, "waiting_rows", LINK_SCHEMA).collect()
    assert {(r.sheet_id, r.row_no) for r in waiting} == {(3, 2), (3, 3)}
