"""A day's run from workbook to published tabs, and what happens when it is ended half-way."""

import os
import time
from dataclasses import replace
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from casewright.operators import features, graph, scoring
from casewright.plans import daily, journal, registry
from casewright.session import cut_lineage, scratch_path
from casewright.sources import backups, generations, graph_store, sinks
from casewright.sources.bindings import Bindings
from casewright.streaming.link_intake import LINK_SCHEMA

TABS = tuple(t for t in daily.SHEETS if t != "arrests")


class Ended(Exception):
    pass


def test_a_run_that_was_ended_goes_on_and_publishes_once(spark, folder, monkeypatch):
    b = Bindings(spark, folder, registry.settle_on(spark))
    places = registry._workbook(b)
    logs, calls = [], []

    class Logged(journal.RunJournal):
        def __init__(self, *args):
            super().__init__(*args)
            logs.append(self)

        def settle(self, name, rows):
            if len(logs) == 1 and name == "scored-forms":
                raise Ended
            return super().settle(name, rows)

    def source(rows):
        calls.append(1)
        return registry._stand_in_scores(rows)

    monkeypatch.setattr(daily, "RunJournal", Logged)
    run = lambda settings=registry.PLAIN: daily.run_day(b, settings, source, places, tabs=TABS)
    with pytest.raises(Ended):
        run()
    first = set(logs[0].written)
    assert {"forms-1", "features-1", "tab-suspects-1", "backup"} <= first and not calls
    assert sinks.published_by(spark, places.published, "v3-2001-08-01") is None
    # Ended once more, while it publishes: the unfinished version is begun anew.
    whole = sinks.with_headings
    monkeypatch.setattr(sinks, "with_headings", lambda df, columns: (_ for _ in ()).throw(Ended()))
    with pytest.raises(Ended):
        run()
    assert set(logs[1].taken) == first and calls == [1]
    monkeypatch.setattr(sinks, "with_headings", whole)
    with pytest.raises(ValueError, match="other inputs"):
        run(replace(registry.PLAIN, published_rows=5))
    assert run() == 1 and calls == [1]
    assert set(logs[2].taken) == first | set(logs[1].written) and not logs[2].written
    assert not spark._jvm.java.io.File(f"{places.journal}/run=v3-2001-08-01".removeprefix("file:")).exists()
    # The same day again publishes nothing new.
    assert run() == 1 and len(logs) == 3
    tabs = {t: sinks.published(spark, places.published, t).count() for t in ("suspects", "cases", "top_suspects")}
    assert tabs["suspects"] > tabs["top_suspects"] > 0 and tabs["cases"] > 0
    assert backups.read(spark, places.backups, "suspects", registry.PLAIN.as_of).count() == b.suspects_sheet.count()
    assert spark.read.csv(f"{places.csv}/v3-2001-08-01/suspects").count() == tabs["suspects"]


def test_the_older_run_keeps_its_graph_and_reads_its_parameters(spark, folder):
    b = Bindings(spark, folder, registry.settle_on(spark))
    weights = spark.createDataFrame([("Recency of Case", "9"), ("Eminence", "")], "key string, value string")
    places = registry._workbook(b, ("arrests", b.arrests_sheet), ("parameters", weights))
    graph_store.create(spark, places.graph)
    settings = replace(registry.PLAIN, variant="v2", bio_mode="v2")
    used = []
    kept, scoring.solvability = scoring.solvability, lambda s: used.append(s) or kept(s)
    try:
        for day in ("one", "two"):  # a second run over the same sheets adds nothing to the graph
            daily.run_day(b, settings, registry._stand_in_scores, places, day, (*daily.SHEETS, "parameters"))
    finally:
        scoring.solvability = kept
    assert used[0].solvability_weights["Recency_of_Case"] == 9 and used[0].priority_weights["Eminence"] == 0
    assert used[0].solvability_weights["Police_Willing_to_Arrest"] == settings.solvability_weights["Police_Willing_to_Arrest"]
    assert [g for g in generations.generations(spark, places.graph)] == [1, 2, 3]
    sizes = [generations.read(spark, places.graph, generations.latest(spark, places.graph, g), "edges", "id long").count() for g in (2, 3)]
    assert sizes[0] == sizes[1] > 0
    assert sinks.published_by(spark, places.published, "two") == 2
    assert sinks.published(spark, places.published, "link_work_list").count() > 0


def test_multipliers_of_a_table(spark):
    rows = spark.createDataFrame([("1", "0.5"), ("2", "0.75"), ("2", "0.7"), ("x", "1"), ("3", "")], "victims_willing string, multiplier string")
    assert scoring.multipliers_from_table(rows) == {1: 0.5, 2: 0.75}
    with pytest.raises(ValueError):
        scoring.multipliers_from_table(rows, 1)


def test_switches_reach_the_runs(spark):
    missing = spark.createDataFrame([(None, None, True)], "planned_destination string, pv_believes string, flag boolean")
    assert features.destination_flags(missing, ("Kampala",), null_is_true=True).first().destination_Kampala
    rows = [(1, 1, "A", "Facebook Friend", "x", "y", "", "K1", "K1.PB1"), (2, 1, "B", "Facebook Friend", "y", "x", "", "K2", "K2.PB1")]
    links = graph.prepare_links(spark.createDataFrame(rows, LINK_SCHEMA))
    for canonical, edges in ((False, 2), (True, 1)):
        root = scratch_path(spark, "graph")
        graph_store.create(spark, root)
        assert graph_store.add_links(spark, root, links, canonical_undirected=canonical)["edges"].count() == edges
    dotted = spark.createDataFrame([("X01.1", "2001-07-30", 1)], "cif_number string, interview_date string, arrest int").withColumn(
        "interview_date", F.col("interview_date").cast("date")).withColumn("suspect_id", F.lit("X01.PB1"))
    keys = {legacy: {r.case_id for r in scoring.case_measures(registry.PLAIN, forms=dotted, legacy_case_key=legacy).collect()}
            for legacy in (False, True)}
    assert keys[False] == {"X01"} != keys[True]


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def _shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for top in folders for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark):
    """Else those of a whole day's run stay on disk together."""
    df = spark.range(5000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    held, before = _shuffle_files(spark), spark.conf.get(CLEANUP, None)
    rows = cut_lineage(spark, "grouped", df)
    until = time.time() + 20
    while _shuffle_files(spark) - held and time.time() < until:
        time.sleep(0.2)
    assert not _shuffle_files(spark) - held
    assert spark.conf.get(CLEANUP, None) == before
    assert {(r.k, r["count"]) for r in rows.collect()} == {(r.k, r["count"]) for r in df.collect()}


def test_days_run_without_keeping_shuffle_files(spark, monkeypatch):
    seen, before = [], spark.conf.get(CLEANUP, None)

    def act(tables, *rest):
        seen.append(spark.conf.get(CLEANUP))
        raise RuntimeError("ended")

    monkeypatch.setattr(daily, "_run_day", act)
    with pytest.raises(RuntimeError):
        daily.run_day(SimpleNamespace(spark=spark), registry.SETTINGS, None, None)
    assert seen == ["true"] and spark.conf.get(CLEANUP, None) == before
