"""The full runs: read, clean, score, merge, close, prioritise, roll up."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, functions as F

from casewright.config import Settings
from casewright.functions.text import null_to_blank
from casewright.operators import (aggregates, features, graph as graph_ops, joins, lifecycle, link_stats,
                                  people, ranking, scoring, strength_model)
from casewright.operators.lifecycle import EntityGroup
from casewright.schemas import POLICE_SHEET, SUSPECT_SHEET, VICTIM_SHEET
from casewright.sources import relational, sheets


@dataclass(frozen=True)
class RunResult:
    """The three groups after the run, the case roll-up (newer rules), and the published top suspects."""

    suspects: EntityGroup
    police: EntityGroup
    victims: EntityGroup
    cases: DataFrame | None
    top_suspects: DataFrame
    scored_forms: DataFrame
    link_work_list: DataFrame | None = None
    graph: dict | None = None

    @property
    def groups(self) -> list[EntityGroup]:
        return [self.suspects, self.police, self.victims]


def entity_groups(tables, suspects: DataFrame, victims: DataFrame) -> tuple[EntityGroup, ...]:
    """Suspect, police and victim groups; the police list starts from the suspect rows."""
    return (
        EntityGroup("suspects", "suspect_id", SUSPECT_SHEET, tables.suspects_sheet,
                    tables.suspects_closed, suspects),
        EntityGroup("police", "suspect_id", POLICE_SHEET, tables.police_sheet,
                    tables.police_closed, people.police_rows(suspects)),
        EntityGroup("victims", "victim_id", VICTIM_SHEET, tables.victims_sheet,
                    tables.victims_closed, victims),
    )


def merge_and_close(groups, arrested: DataFrame, notes: DataFrame | None, settle,
                    keep_blank_cases: bool = False) -> tuple[EntityGroup, EntityGroup, EntityGroup]:
    """Combine sheets with new rows, close what is finished, add incident notes.

    Lists stay grouped by id from the combining to the closing; notes come with what is known of a row's case.
    """
    out = [lifecycle.close_finished(lifecycle.combine(g), None if g.name == "victims" else arrested, settle) for g in groups]
    return lifecycle.propagate_closing(
        *out, settle=settle, keep_blank_cases=keep_blank_cases,
        notes=None if notes is None else lifecycle.first_notes(notes), apart=True)


def model_features(forms: DataFrame, settings: Settings) -> DataFrame:
    """Form rows to model features with their label; the form id stays for ordering."""
    contacts = [c for c in relational.CONTACT_COLUMNS if c in forms.columns]
    labelled = forms.drop(*contacts).withColumn("arrest", people.arrest_label())
    return features.engineer_v3(labelled, places=settings.places, null_is_true=settings.null_is_true)


# Feature rows in; out comes a model (fitted, or a saved one), or the rows with their scores as ``soc``.
ModelSource = Callable[[DataFrame], strength_model.StrengthModel | DataFrame]


def scored_by(source: ModelSource, rows: DataFrame) -> DataFrame:
    found = source(rows)
    return found if isinstance(found, DataFrame) else strength_model.predict(rows, found)


def run_v3(tables, settings: Settings, model_for: ModelSource, settle,
           suspects_with_links: DataFrame | None = None) -> RunResult:
    """Newer rules. ``settle(name, df)`` writes a table (or what a function gives) to shared storage and returns it read
    back; it is used where several results branch off one state. The network stage needs link counts of suspects
    (``link_stats.suspects_with_links``) and is refused without them."""
    if settings.network.enabled and suspects_with_links is None:
        raise ValueError("the network stage needs link counts of suspects")
    scanned = relational.scan_case_forms(tables, settings.country, contacts=True)
    forms = settle("forms", people.with_narrative(people.suspect_forms(scanned), settings.fill_missing))

    feature_rows = settle("features", model_features(forms, settings))
    # The features stay in their own table; what scores are made of is written beside them.
    used = ["suspect_id", "cif_number", "interview_date", "arrest", *settings.belief_weights, *settings.exploitation_weights]
    scored_forms = settle("scored-forms", lambda: scored_by(model_for, feature_rows).select(
        *[c for c in dict.fromkeys(used) if c in feature_rows.columns], "soc"))

    suspects, police, victims = entity_groups(
        tables, settle("new-suspects", people.suspect_rows(forms)),
        people.victim_rows(relational.scan_victims(tables, settings.country)))
    arrested = scored_forms.filter("arrest = 1").select("suspect_id")
    suspects, police, victims = merge_and_close(
        (suspects, police, victims), arrested, relational.scan_incident_notes(tables), settle)

    measures = scoring.case_measures(settings, victims.active, police.active, scored_forms, legacy_case_key=settings.legacy_case_key)
    return finish(tables, settings, suspects, police, victims, measures, scored_forms, settle, suspects_with_links)


def run_v2(tables, settings: Settings, model_for: ModelSource, settle, top_links: int = 3,
           known: dict | None = None, store: Callable[[DataFrame], dict] | None = None) -> RunResult:
    """Older rules: arrests from their own sheet, addresses, box flags, and the contact graph.

    ``known`` is the graph that updated link sheets are added to; without one it starts empty. ``store`` takes the
    links into a stored graph instead, and gives that graph with its counts.
    """
    all_forms = relational.scan_case_forms_v2(tables)
    arrests = settle("arrests", aggregates.arrest_rows(tables.arrests_sheet))
    form_rows = settle("forms", aggregates.label_from_arrests(people.suspect_forms_v2(all_forms), arrests))
    feature_rows = settle("features", features.engineer_v2(form_rows, null_is_true=settings.null_is_true, as_coded=settings.as_coded))
    scored_forms = settle("scored-forms", lambda: scored_by(model_for, feature_rows).select(
        "suspect_id", "cif_number", "interview_date", "arrest", "soc"))

    addresses = people.pick_addresses(relational.scan_addresses(tables))
    boxes = all_forms.select("cif_number", "person_id", "pb_number", "interview_date", F.lit("").alias("case_notes"))
    suspects, police, victims = entity_groups(
        tables,
        settle("new-suspects", people.suspect_rows(
            boxes, people.with_address(relational.scan_suspects_v2(tables), addresses), settings.keep_unmatched)),
        people.victim_rows(people.with_address(relational.scan_victims_v2(tables), addresses)))
    suspects, police, victims = merge_and_close(
        (suspects, police, victims), arrests, None, settle, keep_blank_cases=True)

    # The graph takes the updated sheets in before scoring: with the network stage on, its counts lift eminence.
    links = sheets.recently_updated_links(suspects.active, tables.link_rows, settings.as_of)
    links = settle("links", links)
    if store is not None:
        graph = store(links)
    else:
        before = known or graph_ops.empty_graph(tables.spark)
        added = graph_ops.new_rows(links, before, settle, settings.canonical_undirected)
        graph = graph_ops.extend(before, added)
        graph["suspects"] = settle("link-counts", link_stats.refresh_touched(graph, added, settings.as_coded, settle))

    dates = all_forms.select("cif_number", "interview_date")
    measures = scoring.case_measures(settings, victims.active, police.active, dates, arrests, settings.legacy_case_key)
    result = finish(tables, settings, suspects, police, victims, measures, scored_forms, settle,
                    link_stats.suspects_with_links(graph, graph["suspects"]))
    return replace(result, graph=graph, link_work_list=ranking.link_sheet_work_list(
        result.suspects.active, top_links, settings.as_coded))


def finish(tables, settings: Settings, suspects: EntityGroup, police: EntityGroup,
           victims: EntityGroup, measures: DataFrame, scored_forms: DataFrame, settle,
           suspects_with_links: DataFrame | None = None) -> RunResult:
    """Names across lists, scores and priorities; with the newer rules also case names and the case roll-up."""
    newer = settings.variant == "v3"
    willing = settle("willing", aggregates.willing_victims(victims.active, settings.variant).select("case_id", "willing_to_testify"))
    names = [settle("case-names", people.case_names(tables.cases_sheet))] if newer else []

    def beside(df: DataFrame, uid: str, *cases: DataFrame) -> DataFrame:
        """Rows with the tables of their case and, with the newer rules, its name; shuffled once for all of them."""
        return joins.attach_all(df.drop("case_name") if newer else df, [(t, "case_id") for t in (*cases, *names)], "case_id", uid)

    def filled(df: DataFrame, **cells: str) -> DataFrame:
        """Cells from what was found beside the row; blank when there is none."""
        found = {**cells, **({"case_name": "case_name"} if newer else {})}
        return df.withColumns({cell: null_to_blank(c) for cell, c in found.items()}) if found else df

    scored = scoring.score_suspects(
        suspects.active.drop("case_name") if newer else suspects.active, settings, measures,
        scoring.suspect_measures(scored_forms), suspects_with_links, (willing, *names) if newer else ())
    active = filled(scored, **({"victims_willing_to_testify": "willing_to_testify"} if newer else {})).select(*SUSPECT_SHEET)
    suspects = replace(suspects, active=settle("suspects-scored", active))

    how = "left" if newer else "inner"
    police_rows = filled(beside(police.active, "suspect_id", willing), victims_willing_to_testify="willing_to_testify")
    police_rows = lifecycle.copy_priority(suspects.active, police_rows, "suspect_id", "suspect_id", how, sort=False, narrative=newer)
    of_case = [lifecycle.top_suspects(suspects.active, "case_id")]
    if newer:
        of_case.append(aggregates.located_suspects(suspects.active).select("case_id", "located"))
    victim_rows = lifecycle.with_priority(beside(victims.active, "victim_id", *of_case), how, narrative=newer)
    victim_rows = filled(victim_rows, **({"suspects_identified_and_located": "located"} if newer else {}))
    police = replace(police, active=settle("police-done", police_rows.select(*POLICE_SHEET)))
    victims = replace(victims, active=settle("victims-done", victim_rows.select(*VICTIM_SHEET)))
    return RunResult(
        suspects, police, victims,
        cases=lifecycle.roll_up_cases(suspects.active, police.active) if newer else None,
        top_suspects=ranking.top_rows(suspects.active, "suspect_id", settings.published_rows),
        scored_forms=scored_forms)
