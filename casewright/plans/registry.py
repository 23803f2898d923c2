"""One query per operator over the provided tables. ``oracle.py`` holds the same results as SQL."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from casewright import fixed_values as fv
from casewright.config import NetworkWeights, Settings
from casewright.functions import ids, links as link_columns, text
from casewright.functions.narrative import narrative
from casewright.operators import (aggregates, dedup, features, graph, joins, lifecycle, link_stats,
                                  people, ranking, scoring, strength_model, unions, vocabulary)
from casewright.operators.lifecycle import EntityGroup
from casewright.plans import daily, runs
from casewright.schemas import LINK_SHEET, POLICE_SHEET, SUSPECT_SHEET, VICTIM_SHEET
from casewright.session import cut_lineage, scratch_path
from casewright.sources import backups, graph_store, relational, sheets, sinks, tables
from casewright.sources.bindings import Bindings

SETTINGS = Settings(as_of=date(2001, 8, 1), country="ASIA",
                    network=NetworkWeights(enabled=True))
PLAIN = replace(SETTINGS, network=NetworkWeights(enabled=False))
# The registered search: the grid's forests of 10 trees, in all published folds. The full grid is the default of the
# same function.
SMALL_FORESTS = {**fv.GRID_V3, "num_trees": (10,), "max_depth": (20,), "feature_fraction": ("0.5",)}

QUERIES: dict = {}


def settle_on(spark: SparkSession):
    return lambda name, df: cut_lineage(spark, name, df() if callable(df) else df)


def query(fn):
    """Register a query under the function's name."""
    QUERIES[fn.__name__] = lambda spark, folder: fn(Bindings(spark, folder))
    return fn


def branching_query(fn):
    """Register a query that reads the box lines along many branches: they are written down once."""
    QUERIES[fn.__name__] = lambda spark, folder: fn(Bindings(spark, folder, settle_on(spark)))
    return fn


def tab_query(fn):
    """Register a query that reads the bound tabs several times: the suspects in them are written down once."""
    def run(spark, folder):
        settle = settle_on(spark)
        return fn(Bindings(spark, folder, lambda name, df: settle(name, df) if name == "suspect-keys" else df))

    QUERIES[fn.__name__] = run
    return fn


# --- shared intermediates ------------------------------------------------------------------------


def scanned(b: Bindings) -> DataFrame:
    return relational.scan_case_forms(b, SETTINGS.country, contacts=True)


def suspect_forms(b: Bindings) -> DataFrame:
    return people.suspect_forms(scanned(b))


def noted_forms(b: Bindings) -> DataFrame:
    return people.with_narrative(suspect_forms(b))


def feature_rows(b: Bindings) -> DataFrame:
    return runs.model_features(noted_forms(b), SETTINGS)


def new_suspects(b: Bindings, forms: DataFrame | None = None) -> DataFrame:
    return people.suspect_rows(noted_forms(b) if forms is None else forms)


def new_victims(b: Bindings) -> DataFrame:
    return people.victim_rows(relational.scan_victims(b, SETTINGS.country))


def groups(b: Bindings, forms: DataFrame | None = None):
    return runs.entity_groups(b, new_suspects(b, forms), new_victims(b))


def closed_groups(b: Bindings):
    """The three groups after finished rows were closed."""
    settle = settle_on(b.spark)
    forms = noted_forms(b)
    # What the groups read of the forms, and not their 60 columns; the new rows are those of suspects and police.
    slim = settle("forms", forms.select("interview_date", "cif_number", "person_id", "pb_number", "case_notes", "address_notes",
                                        *people.PERSON_COLUMNS, "suspect_id", "arrested"))
    arrested = slim.filter(F.col("arrested") == "Yes").select("suspect_id")
    suspects = settle("new-suspects", people.suspect_rows(slim))
    return [lifecycle.close_finished(lifecycle.combine(g), None if g.name == "victims" else arrested, settle)
            for g in runs.entity_groups(b, suspects, new_victims(b))]


def case_scores(b: Bindings, settings: Settings = PLAIN, **parts) -> DataFrame:
    return scoring.add_case_scores(
        b.suspects_sheet, scoring.case_measures(settings, **parts), settings)


def prepared_links(b: Bindings) -> DataFrame:
    return graph.prepare_links(b.link_rows)


def dimensions(spark: SparkSession) -> dict:
    return {"edge_types": graph.edge_types(spark), "account_types": graph.account_types(spark)}


def full_graph(b: Bindings) -> dict:
    links = cut_lineage(b.spark, "links", prepared_links(b))
    return graph.import_links(links, dimensions(b.spark), settle_on(b.spark))


def country_graph(b: Bindings) -> tuple[dict, dict]:
    """The graph of one country's sheets, and what the sheets of all countries add to it."""
    links = cut_lineage(b.spark, "links", prepared_links(b))
    stations = b.station_key.filter(F.col("country_name") == SETTINGS.country).select("station_code")
    local = links.withColumn("station_code", ids.station_code("case_id")) \
        .join(stations, "station_code", "left_semi").drop("station_code")
    settle = settle_on(b.spark)
    known = graph.import_links(local, dimensions(b.spark), settle)
    return known, graph.new_rows(links, known, settle)


def one_forest(b: Bindings, rows: DataFrame) -> strength_model.StrengthModel:
    """A model without a search, for queries that are not about searching."""
    return strength_model.train(rows, SETTINGS.as_of, SETTINGS.cutoff_days, grid=None)


def _sound(scored: DataFrame, *keys: str) -> DataFrame:
    """Keys and whether the score is a probability: scores themselves cannot match another library's forest."""
    return scored.select(*keys, F.col("soc").between(0.0, 1.0).alias("in_range"))


# The bound tabs: name, table, layout, uid.
def bound_tabs(b: Bindings) -> dict[str, tuple[DataFrame, tuple[str, ...], str]]:
    return {
        "suspects": (b.suspects_sheet, SUSPECT_SHEET, "suspect_id"), "closed_sus": (b.suspects_closed, SUSPECT_SHEET, "suspect_id"),
        "police": (b.police_sheet, POLICE_SHEET, "suspect_id"), "closed_pol": (b.police_closed, POLICE_SHEET, "suspect_id"),
        "victims": (b.victims_sheet, VICTIM_SHEET, "victim_id"), "closed_vic": (b.victims_closed, VICTIM_SHEET, "victim_id"),
    }


def _tab_rows(name: str, df: DataFrame, uid: str) -> DataFrame:
    return df.select(F.lit(name).alias("tab"), "case_id", F.col(uid).alias("uid"), "case_status", "date_closed")


# --- sources and sinks -----------------------------------------------------------------------------


@query
def s1_relational_query(b):
    sql = """
        SELECT f.cif_number, p.full_name, p.arrested
        FROM {form} f JOIN {box} pb ON f.id = pb.cif_id JOIN {person} p ON p.id = pb.person_id
        WHERE p.arrested = :arrested"""
    return relational.run_query(b.spark, sql, {
        "form": b.case_form, "box": b.person_box, "person": b.person}, arrested="Yes")


@query
def s2_case_form_scan(b):
    return relational.scan_case_forms(b, SETTINGS.country)


@query
def s2b_case_form_scan_all(b):
    return relational.scan_case_forms_v2(b)


@query
def s3_suspect_scan(b):
    return relational.scan_suspects(b, SETTINGS.country)


@query
def s3b_suspect_scan_all(b):
    return relational.scan_suspects_v2(b)


@query
def s4_victim_scan(b):
    return relational.scan_victims(b, SETTINGS.country)


@query
def s4b_victim_scan_all(b):
    return relational.scan_victims_v2(b)


@query
def s5_incident_notes(b):
    return relational.scan_incident_notes(b)


@query
def s6_addresses(b):
    return relational.scan_addresses(b)


@tab_query
def s7_sheet_reader(b):
    root, tabs = scratch_path(b.spark, "workbook"), bound_tabs(b)
    for name, (df, columns, _) in tabs.items():
        sheets.write_tab(df.select(*columns), f"{root}/{name}")
    sheets.write_tab(b.cases_sheet, f"{root}/cases")
    sheets.write_tab(b.arrests_sheet, f"{root}/arrests")
    layouts = {name: columns for name, (_, columns, _) in tabs.items()}
    read = sheets.read_tabs(b.spark, root, [*tabs, "cases", "arrests"], layouts)
    sizes = [read[name].select(F.lit(name).alias("tab"), F.lit("").alias("case_id"), F.lit("").alias("uid"),
                               F.lit("").alias("case_status"), F.lit("").alias("date_closed")) for name in ("cases", "arrests")]
    return unions.by_name(*[_tab_rows(name, read[name], uid) for name, (_, _, uid) in tabs.items()], *sizes)


@tab_query
def s8_backup(b):
    root, tabs = scratch_path(b.spark, "backups"), bound_tabs(b)
    days = [SETTINGS.as_of - timedelta(days=n) for n in (2, 1, 0)]
    tables = {name: df for name, (df, _, _) in tabs.items()}
    backups.back_up({name: df.filter("length(date_closed) <= 1") for name, df in tables.items()}, root, days[0])
    for day in days[1:]:  # the last day changes nothing
        backups.back_up(tables, root, day)
    backups.back_up({"police": b.police_sheet}, root, SETTINGS.as_of)
    return unions.by_name(*[
        _tab_rows(name, backups.read(b.spark, root, name, day).withColumn("date_closed", F.lit(day)), uid)
        for name, (_, _, uid) in tabs.items() for day in days]).withColumnRenamed("date_closed", "snapshot_date")


@tab_query
def s9_csv_sink(b):
    root, tabs = scratch_path(b.spark, "csv"), bound_tabs(b)
    groups_ = [EntityGroup(name, uid, columns, df, tabs[f"closed_{name[:3]}"][0], df, active=df)
               for name, (df, columns, uid) in tabs.items() if not name.startswith("closed")]
    sinks.save_csv(groups_, root)
    return unions.by_name(*[
        b.spark.read.csv(f"{root}/{name}").toDF(*columns).select(F.lit(name).alias("tab"), *[
            text.null_to_blank(c).alias(new) for c, new in (("case_id", "case_id"), (uid, "uid"), ("case_status", "case_status"))])
        for name, (_, columns, uid) in tabs.items()])


@tab_query
def s10_publish(b):
    root, tabs = scratch_path(b.spark, "published"), bound_tabs(b)
    for _ in range(2):  # the second publication replaces the first
        sinks.publish(b.spark, root, {name: (df, columns) for name, (df, columns, _) in tabs.items()})
    return unions.by_name(*[
        sinks.published(b.spark, root, name).select(
            F.lit(name).alias("tab"), "Case_ID", F.col("Victim_ID" if uid == "victim_id" else "Suspect_ID").alias("Uid"),
            "Case_Status", "Date_Closed")
        for name, (_, _, uid) in tabs.items()])


@query
def s11_training_columns(b):
    rows = cut_lineage(b.spark, "features", feature_rows(b))
    model = one_forest(b, rows)
    path = scratch_path(b.spark, "model")
    strength_model.save(b.spark, model, path)
    columns = strength_model.load_columns(b.spark, path)
    used = rows.agg(*[F.sum(F.col(c).cast("double")).alias(c) for c in columns])
    return used.unpivot([], columns, "column", "total")


@query
def s12_graph_store(b):
    root = scratch_path(b.spark, "graph")
    graph_store.create(b.spark, root)
    store = graph_store.read(b.spark, root)
    counts = prepared_links(b).groupBy(F.col("relationship_type").alias("edge_type")).agg(
        F.count(F.lit(1)).alias("links"))
    return store["edge_types"].join(counts, "edge_type", "left").select(
        "id", "edge_type", "edge_type_weight", "links")


@query
def s13_graph_replace(b):
    root = scratch_path(b.spark, "graph")
    graph_store.write(b.spark, root, full_graph(b))
    graph_store.refresh_stats(b.spark, root)
    return graph_store.read(b.spark, root)["suspects"].select(
        "name", "first_degree_links", "second_degree_links", "first_degree_case_links", "second_degree_case_links")


@query
def s14_recent_links(b):
    return sheets.recently_updated_links(b.suspects_sheet, b.link_rows, SETTINGS.as_of).select(
        "sheet_id", "row_no", "suspect_case_id", "source", "target")


# --- projections -------------------------------------------------------------------------------------


@query
def p1_pick_addresses(b):
    return people.pick_addresses(relational.scan_addresses(b))


@query
def p2_drop_columns(b):
    rows = people.drop_unused_form_columns(relational.scan_case_forms_v2(b))
    return rows.withColumns({c: F.col(c).cast("int") for c in fv.CASE_FORM_FLAGS})


@query
def p3_case_id(b):
    return b.case_form.select("cif_number", ids.case_id("cif_number").alias("case_id"))


@query
def p4_suspect_id(b):
    return relational.scan_case_forms_v2(b).select(
        "cif_number", "person_id", ids.suspect_id("cif_number", "pb_number").alias("suspect_id"))


@query
def p5_victim_rows(b):
    return new_victims(b)


@query
def p6_suspect_rows(b):
    return people.suspect_rows(noted_forms(b), relational.scan_suspects(b, SETTINGS.country))


@query
def p7_suspect_filter(b):
    return suspect_forms(b).select("cif_number", "person_id", "pb_number", "role", "suspect_id")


@query
def p8_narrative(b):
    return suspect_forms(b).select("cif_number", "person_id", narrative().alias("narrative"))


@query
def p9_notes(b):
    return noted_forms(b).select("cif_number", "person_id", "case_notes")


@query
def p10_destination_flags(b):
    flagged = features.destination_flags(
        b.case_form.select("id", "planned_destination"), (*fv.PLACES_V3, *fv.PLACES_V2), unknown=True)
    return flagged


@query
def p11_box_flags(b):
    rows = relational.scan_case_forms_v2(b).select(
        "cif_id", "person_id", "pb_number", "recruited_broker_pb", "how_recruited_broker_online_pb")
    return features.box_flags(rows)


@query
def p12_belief_flags(b):
    return features.belief_flags(b.person.select("id", "pv_believes"))


@query
def p13_coerce(b):
    rows = b.case_form.select("id", "number_of_victims", "expected_earning", "legal_action_taken",
                              "recruited_agency", "interview_date")
    return features.coerce_types(rows, ("number_of_victims", "expected_earning"),
                                 ("id", "interview_date"))


@query
def p14_category_flags(b):
    rows = b.case_form.select("id", "education", "pv_occupation")
    return features.category_flags(rows, features.category_levels(rows, ["education", "pv_occupation"]))


@query
def p14b_category_vocabulary(b):
    return _vocabulary(b)


@query
def p14c_category_ids(b):
    columns = ["education", "pv_occupation"]
    return vocabulary.encoded(b.case_form.select("id", *columns), columns, cut_lineage(b.spark, "vocabulary", _vocabulary(b)))


def _vocabulary(b):
    """Levels of education first, occupations as of the next day."""
    first = cut_lineage(b.spark, "vocabulary", vocabulary.extended(None, b.case_form, ["education"], SETTINGS.as_of))
    return vocabulary.extended(first, b.case_form, ["education", "pv_occupation"], SETTINGS.as_of + timedelta(days=1))


@query
def p15_digits(b):
    return b.case_form.select("id", text.digits("expected_earning").alias("earning"))


@query
def p16_defaults(b):
    return features.fill_defaults(b.case_form.select("id", "number_of_victims", "expected_earning"))


@query
def p17_drop_empty(b):
    rows = b.case_form.select("id", "known_broker_years", "exploitation_organ_removal_occ",
                              "exploitation_organ_removal_exp", F.lit(0).alias("always_zero"))
    return features.drop_empty_features(rows, ("id",))


@query
def p18_features(b):
    return features.drop_empty_features(feature_rows(b), (*fv.ROW_IDENTITY_COLUMNS, "arrest")).drop("case_notes")


@query
def p18b_features_v2(b):
    # Read twice: for the values of the categories, and for the features.
    boxes = cut_lineage(b.spark, "suspect-boxes", people.suspect_boxes_v2(b.case_form, b.person_box))
    categories = [c for c in fv.CATEGORY_FEATURES_V2 if c in boxes.columns]
    return features.engineer_v2(people.forms_of_boxes_v2(b.case_form, boxes), features.category_levels(boxes, categories))


@query
def p19_country(b):
    return people.in_country(b.suspects_sheet, "suspect_id", b.station_key, SETTINGS.country).select(
        "suspect_id", "case_id", "name")


@query
def p20_address_text(b):
    return people.with_address(relational.scan_suspects_v2(b), relational.scan_addresses(b)).select(
        "person_id", "address")


@query
def p21_edge_direction(b):
    return b.link_rows.select("sheet_id", "row_no", link_columns.edge_direction("relationship_type").alias("edge_direction"))


@query
def p22_account_type(b):
    return b.link_rows.select("sheet_id", "row_no", link_columns.account_type("source").alias("source_type"),
                              link_columns.account_type("target").alias("target_type"))


@query
def p23_combo_id(b):
    direction = link_columns.edge_direction("relationship_type")
    return b.link_rows.select(
        "sheet_id", "row_no", link_columns.edge_combo_id("source", "target", direction).alias("combo_id"),
        link_columns.edge_combo_id("source", "target", direction, True).alias("canonical_id"))


@query
def p24_link_fill(b):
    return prepared_links(b).select("sheet_id", "row_no", "name", "case_id", "suspect_case_id", "edge_direction")


@query
def p25_close_stamp(b):
    stamped = lifecycle.stamp_close_date([b.suspects_closed, b.police_closed], SETTINGS.as_of)
    return unions.by_name(*[t.select("suspect_id", "date_closed") for t in stamped])


@query
def p26_location_flag(b):
    return people.mentions(b.person, "address_notes", "Kampala").select("id", "located_in")


@query
def p27_arrest_label(b):
    return b.person.select("id", people.arrest_label().alias("arrest"))


@query
def p28_case_name(b):
    return people.with_case_names(b.suspects_sheet, b.cases_sheet, "suspect_id").select(
        "suspect_id", "case_id", "case_name")


# --- joins --------------------------------------------------------------------------------------------


@query
def j1_inner_chain(b):
    return scanned(b).groupBy("station_name", "role").agg(F.count(F.lit(1)).alias("rows"))


@query
def j2_left(b):
    arrests = aggregates.total_arrests(relational.scan_case_forms_v2(b).select(
        ids.suspect_id("cif_number", "pb_number").alias("suspect_id"), (F.col("cif_id") % 3).alias("arrest")))
    return joins.attach(b.suspects_sheet.select("suspect_id", "case_id"), arrests, "case_id", "suspect_id")


@query
def j3_full_outer(b):
    left = b.suspects_sheet.select("suspect_id", F.col("name").alias("suspect_sheet_name"))
    right = b.police_closed.select("suspect_id", F.col("suspect_name").alias("police_closed_name"))
    return joins.full_outer(left, right, "suspect_id")


@query
def j4_label_join(b):
    forms = relational.scan_case_forms_v2(b).select(
        "cif_number", "person_id", ids.suspect_id("cif_number", "pb_number").alias("suspect_id"))
    return aggregates.label_from_arrests(forms, aggregates.arrest_rows(b.arrests_sheet))


@query
def j5_semi(b):
    return joins.rows_in(b.suspects_sheet.select("suspect_id", "name"), b.police_closed, "suspect_id")


@query
def j6_anti(b):
    return joins.rows_not_in(b.suspects_sheet.select("suspect_id", "name"), b.police_sheet, "suspect_id")


@query
def j7_natural(b):
    return joins.shared_inner(b.police_sheet.select("case_id", "suspect_id", "suspect_name"),
                              b.suspects_sheet.select("case_id", "suspect_id", "eminence"))


@query
def j8_right_wins(b):
    return joins.right_wins(
        b.police_sheet.select("suspect_id", "suspect_name", "narrative"),
        b.suspects_sheet.select("suspect_id", "narrative", "eminence"), "suspect_id",
        ["narrative", "eminence"], how="full")


def _account_cases(b: Bindings) -> DataFrame:
    return prepared_links(b).select("source", "target", "case_id")


@query
def j9_other_index(b):
    """Accounts that are a source in one case and a target in other cases: how many others."""
    counts, _ = link_stats.multi_match(_account_cases(b), "source", "target", "case_id")
    return counts.groupBy("match").agg(F.count(F.lit(1)).alias("source_cases"),
                                       F.sum("match_count").alias("case_pairs"))


@query
def j10_lookup(b):
    settings = replace(PLAIN, willing_multipliers={0: 0, 1: 0.4, 2: 0.7, 3: 0.9}, variant="v2")
    return case_scores(b, settings, victims=b.victims_sheet).select("suspect_id", "willing_score")


# --- aggregates, windows ---------------------------------------------------------------------------------


@query
def a1_willing_victims(b):
    return aggregates.willing_victims(b.victims_sheet)


@query
def a1b_willing_victims_v2(b):
    return aggregates.willing_victims(b.victims_sheet, "v2")


@query
def a2_located_suspects(b):
    return aggregates.located_suspects(b.suspects_sheet)


@query
def a3_total_arrests(b):
    return aggregates.total_arrests(suspect_forms(b).withColumn("arrest", people.arrest_label()))


@query
def a4_arrest_rows(b):
    return aggregates.arrest_rows(b.arrests_sheet)


@query
def a5_first_degree(b):
    g = full_graph(b)
    return _named_stats(g, link_stats.first_degree_links(g["edges"]), "first_degree_links")


def _named_stats(g: dict, stats: DataFrame, column: str) -> DataFrame:
    names = g["suspects"].select(F.col("id").alias("suspect_id"), "name")
    return names.join(stats, "suspect_id", "left").select(
        "name", F.coalesce(column, F.lit(0)).cast("long").alias(column))


@query
def a6_second_degree(b):
    g = full_graph(b)
    return _named_stats(g, link_stats.second_degree_links(g["edges"]), "second_degree_links")


@query
def a6b_second_degree_coded(b):
    g = full_graph(b)
    return _named_stats(g, link_stats.second_degree_links(g["edges"], as_coded=True), "second_degree_links")


@query
def a7_multi_match(b):
    return link_stats.multi_match(_account_cases(b), "source", "target", "case_id")[0]


@query
def a7b_multi_match_members(b):
    return link_stats.multi_match(_account_cases(b), "source", "target", "case_id")[1]


@query
def a8_case_links_first(b):
    g = full_graph(b)
    return _named_stats(g, link_stats.case_links(g, "first"), "first_degree_case_links")


@query
def a8b_case_links_second(b):
    g = full_graph(b)
    return _named_stats(g, link_stats.case_links(g, "second"), "second_degree_case_links")


@query
def w1_group_count(b):
    return dedup.with_group_count(b.suspects_sheet.select("suspect_id", "case_id"), "case_id",
                                  "suspects_in_case", "suspect_id")


@query
def w2_keep_first(b):
    return b.first_boxes


@query
def w3_first_row_fill(b):
    return dedup.fill_from_first_row(b.link_rows, "sheet_id", "row_no", ["name"]).select(
        "sheet_id", "row_no", "name")


# --- sorting and sets ---------------------------------------------------------------------------------------


@branching_query
def t1_sort_by_priority(b):
    return ranking.by_priority(_scored(b, PLAIN).select("suspect_id", "priority"), "suspect_id")


@branching_query
def t2_top_rows(b):
    return ranking.top_rows(_scored(b, PLAIN).select("suspect_id", "case_id", "priority"), "suspect_id",
                            PLAIN.published_rows)


@branching_query
def t3_link_work_list(b):
    return ranking.link_sheet_work_list(_scored(b, PLAIN), 200).select(
        "sheet_id", "name", "case_id", "suspect_case_id", "source")


@query
def t4_first_by_name(b):
    return dedup.keep_first(b.person.select("full_name", "phone_contact", "id"), ["phone_contact"],
                            ["full_name", "id"])


@query
def t5_sorted_merge(b):
    return joins.full_outer(
        b.suspects_sheet.select("suspect_id", "eminence"),
        b.police_sheet.select("suspect_id", "case_status"), "suspect_id").orderBy("suspect_id")


@query
def u1_union_by_name(b):
    return unions.by_name(b.suspects_sheet.select("suspect_id", "name", "eminence"),
                          b.police_sheet.select("suspect_id", "case_status"))


@query
def u2_union_by_position(b):
    return unions.by_position(b.suspects_closed.select("case_id", "suspect_id", "name"),
                              b.police_closed.select("case_id", "suspect_id", "suspect_name"))


@query
def u3_first_table_wins(b):
    return unions.first_table_wins(
        [b.suspects_sheet.select("suspect_id", "name"), new_suspects(b).select("suspect_id", "name")],
        "suspect_id", ["name"])


@query
def u4_insert_if_absent(b):
    return unions.insert_if_absent(b.suspects_sheet, new_suspects(b), "suspect_id").select(
        "suspect_id", "case_id", "name")


# --- lifecycle -------------------------------------------------------------------------------------------------


def _slim(group: EntityGroup, df: DataFrame) -> DataFrame:
    name = "suspect_name" if group.name == "police" else "name"
    return df.select(F.lit(group.name).alias("entity"), F.col(group.uid).alias("uid"), "case_id",
                     F.col(name).alias("name"), "case_status", "date_closed")


@branching_query
def l1_combine(b):
    settle = settle_on(b.spark)
    suspects = settle("new-suspects", new_suspects(b))  # the new rows of suspects and of police
    return unions.by_name(*[_slim(g, lifecycle.combine(g).active) for g in runs.entity_groups(b, suspects, new_victims(b))])


@branching_query
def l2_close_finished(b):
    rows = []
    for g in closed_groups(b):
        rows += [_slim(g, g.active).withColumn("part", F.lit("active")),
                 _slim(g, g.closed).withColumn("part", F.lit("closed"))]
    return unions.by_name(*rows)


def _propagated(b: Bindings, keep_blank_cases: bool = False) -> DataFrame:
    rows = []
    for g in lifecycle.propagate_closing(*closed_groups(b), settle=settle_on(b.spark), keep_blank_cases=keep_blank_cases):
        rows += [_slim(g, g.active).withColumn("part", F.lit("active")),
                 _slim(g, g.closed).withColumn("part", F.lit("closed"))]
    return unions.by_name(*rows)


@branching_query
def l3_propagate_closing(b):
    return _propagated(b)


@branching_query
def l3b_propagate_closing_v2(b):
    """The older rules keep closed rows without a case."""
    return _propagated(b, keep_blank_cases=True)


@query
def l4_incident_notes(b):
    return lifecycle.add_incident_notes(b.suspects_sheet, b.incident_notes, "suspect_id").select(
        "suspect_id", "case_id", "irf_case_notes")


@query
def l5_willing_names(b):
    return lifecycle.add_willing_names(b.police_sheet, aggregates.willing_victims(b.victims_sheet),
                                       "suspect_id").select("suspect_id", "victims_willing_to_testify")


@query
def l6_located_names(b):
    return lifecycle.add_located_names(b.victims_sheet, aggregates.located_suspects(b.suspects_sheet),
                                       "victim_id").select("victim_id", "suspects_identified_and_located")


@branching_query
def l7_copy_priority(b):
    return lifecycle.copy_priority(_scored(b, PLAIN), b.victims_sheet, "case_id", "victim_id").select(
        "victim_id", "priority", "narrative")


@branching_query
def l7b_copy_priority_police(b):
    return lifecycle.copy_priority(_scored(b, PLAIN), b.police_sheet, "suspect_id", "suspect_id",
                                   how="inner", narrative=False).select("suspect_id", "priority", "narrative")


@branching_query
def l8_case_roll_up(b):
    suspects = lifecycle.add_willing_names(
        _scored(b, PLAIN), aggregates.willing_victims(b.victims_sheet), "suspect_id")
    return lifecycle.roll_up_cases(suspects, b.police_sheet)


@query
def l9_entity_setup(b):
    return unions.by_name(*[
        g.new.select(F.lit(g.name).alias("entity"), F.col(g.uid).alias("uid"), "case_id",
                     F.col("suspect_name" if g.name == "police" else "name").alias("name"))
        for g in groups(b)])


# --- scoring -----------------------------------------------------------------------------------------------------


def _scored(b: Bindings, settings: Settings, links: DataFrame | None = None) -> DataFrame:
    """All suspects on the sheet, scored from sheet victims and police and the scanned forms."""
    measures = scoring.case_measures(settings, b.victims_sheet, b.police_sheet, feature_rows(b))
    return scoring.score_suspects(b.suspects_sheet, settings, measures,
                                  scoring.suspect_measures(b.soc_scores), links)


@query
def c1_willing_score(b):
    return case_scores(b, victims=b.victims_sheet).select("suspect_id", "willing_score")


@branching_query
def c2_arrest_scores(b):
    scores = case_scores(b, police=b.police_sheet, forms=feature_rows(b))
    return scores.withColumn("bio_known", scoring.bio_known(PLAIN)).select(
        "suspect_id", "bio_known", "others_arrested", "willing_to_arrest")


@query
def c3_recency(b):
    return case_scores(b, forms=feature_rows(b)).select(
        "suspect_id", F.round("recency_score", 6).alias("recency_score"))


@query
def c3b_recency_curve(b):
    settings = replace(PLAIN, discount_coef=0.00001, discount_exp=1.5)
    return case_scores(b, settings, forms=feature_rows(b)).select(
        "suspect_id", F.round("recency_score", 6).alias("recency_score"))


@query
def c3c_recency_v2(b):
    return case_scores(b, replace(PLAIN, variant="v2"), forms=b.case_form.select(
        "cif_number", "interview_date")).select(
        "suspect_id", F.round("recency_score", 6).alias("recency_score"))


@query
def c4_belief(b):
    return case_scores(b, forms=feature_rows(b)).select("suspect_id", "belief_score")


@query
def c5_exploitation(b):
    return case_scores(b, forms=feature_rows(b)).select(
        "suspect_id", F.round("exploitation_score", 6).alias("exploitation_score"))


def _links_by_suspect(b: Bindings) -> DataFrame:
    g = full_graph(b)
    return link_stats.suspects_with_links(g, link_stats.refresh_link_stats(g))


@query
def c6_network_scores(b):
    first, second = scoring.network_scores()
    return _links_by_suspect(b).select(
        "suspect_case_id", F.round(first, 6).alias("first_score"), F.round(second, 6).alias("second_score"))


@query
def c7_network_weight(b):
    return scoring.add_network_weight(b.suspects_sheet, _links_by_suspect(b), SETTINGS.network).select(
        "suspect_id", F.round("network_weight", 6).alias("network_weight"))


@query
def c8_eminence(b):
    weighted = scoring.add_network_weight(b.suspects_sheet, _links_by_suspect(b), SETTINGS.network)
    return weighted.select("suspect_id", scoring.eminence_score(False).alias("plain"),
                           F.round(scoring.eminence_score(True), 6).alias("lifted"))


@query
def c9_strength(b):
    return scoring.add_strength(b.suspects_sheet, scoring.suspect_measures(b.soc_scores)).select(
        "suspect_id", "strength_of_case")


@branching_query
def c10_weights(b):
    """Solvability under weights read from a parameter table with a blank cell."""
    rows = [(k, "" if k == "PV_Believes" else str(v)) for k, v in fv.SOLVABILITY_WEIGHTS.items()]
    table = b.spark.createDataFrame(rows, "key string, value string")
    settings = replace(PLAIN, solvability_weights=scoring.weights_from_table(table))
    return _scored(b, settings).select("suspect_id", F.round("solvability", 6).alias("solvability"))


@branching_query
def c11_solvability(b):
    return _scored(b, PLAIN).select("suspect_id", F.round("solvability", 6).alias("solvability"))


@branching_query
def c12_priority(b):
    return _scored(b, PLAIN).select("suspect_id", "priority")


@branching_query
def c13_all_scores(b):
    return ranking.top_rows(_scored(b, SETTINGS, _links_by_suspect(b)), "suspect_id", SETTINGS.published_rows).select(
        "suspect_id", "priority", "strength_of_case", F.round("solvability", 6).alias("solvability"),
        F.round("eminence_score", 6).alias("eminence_score"))


@branching_query
def c13b_all_scores_v2(b):
    """The older chain: five terms, missing ones make the priority 0; arrests from their sheet."""
    settings = replace(PLAIN, variant="v2", bio_mode="v2")
    measures = scoring.case_measures(
        settings, b.victims_sheet, b.police_sheet, b.case_form.select("cif_number", "interview_date"),
        aggregates.arrest_rows(b.arrests_sheet))
    return scoring.score_suspects(b.suspects_sheet, settings, measures,
                                  scoring.suspect_measures(b.soc_scores)).select(
        "suspect_id", "priority", F.round("solvability", 6).alias("solvability"))


# --- model -----------------------------------------------------------------------------------------------------------


@query
def m1_feature_vector(b):
    rows = feature_rows(b)
    columns = strength_model.feature_columns(rows)
    from pyspark.ml import Pipeline
    fitted = Pipeline(stages=strength_model.transformer_stages(rows, columns)).fit(rows)
    from pyspark.ml.functions import vector_to_array
    types = dict(rows.dtypes)
    flags = [c for c in columns if types[c] == "boolean"]
    numbers = [c for c in columns if c not in flags]
    places = {c: i for i, c in enumerate([*flags, *numbers])}
    vector = fitted.transform(rows).select("suspect_id", "cif_number", vector_to_array("features").alias("v"))
    set_flags = F.array_join(F.array(*[F.when(F.col("v")[places[c]] == 1, F.lit(c)) for c in sorted(flags)]), ",")
    return vector.select("suspect_id", "cif_number", F.size("v").cast("long").alias("places"), set_flags.alias("set_flags"), *[
        (F.round(F.col("v")[places[c]], 6) + 0.0).alias(f"scaled_{c}") for c in numbers])


@query
def m2_training_rows(b):
    return strength_model.training_rows(feature_rows(b), SETTINGS.as_of, SETTINGS.cutoff_days).select(
        "suspect_id", "cif_number", "days", "arrest")


@query
def m3_split(b):
    return strength_model.with_part(feature_rows(b)).select("suspect_id", "cif_number", "arrest", "part")


def _split_rows(b: Bindings) -> tuple[DataFrame, list[str]]:
    rows = cut_lineage(b.spark, "features", strength_model.with_part(
        strength_model.training_rows(feature_rows(b), SETTINGS.as_of, SETTINGS.cutoff_days)))
    return rows, strength_model.feature_columns(rows)


@query
def m4_forest(b):
    rows, columns = _split_rows(b)
    forest = strength_model.forest(numTrees=10, maxDepth=20, seed=3)
    model = strength_model.classifier_pipeline(rows, columns, forest).fit(rows.filter("part = 'train'"))
    return model.transform(rows).select("suspect_id", "cif_number", "part", F.col("prediction").isin(0.0, 1.0).alias("in_range"))


@query
def m5_fit_predict(b):
    rows, columns = _split_rows(b)
    forest = strength_model.forest(numTrees=10, maxDepth=20, seed=3)
    pipeline = strength_model.classifier_pipeline(rows, columns, forest)
    return _sound(strength_model.fit_predict(pipeline, rows.filter("part = 'train'"),
                                             rows.filter("part = 'validation'")), "suspect_id", "cif_number", "part")


@query
def m6_grid_search(b):
    rows, columns = _split_rows(b)
    best, _ = strength_model.grid_search(rows.filter("part = 'train'"), columns, SMALL_FORESTS, fv.GRID_V3_FOLDS)
    return _sound(strength_model.probability_of_one(best.transform(rows)), "suspect_id", "cif_number", "part")


@query
def m7_train(b):
    rows = cut_lineage(b.spark, "features", feature_rows(b))
    return _sound(strength_model.predict(rows, one_forest(b, rows)), "suspect_id", "cif_number")


@query
def m8_save_load(b):
    rows = cut_lineage(b.spark, "features", feature_rows(b))
    path = scratch_path(b.spark, "model")
    settings = (SETTINGS.as_of, SETTINGS.cutoff_days)
    strength_model.train_or_load(b.spark, rows, path, True, *settings, grid=None)
    loaded = strength_model.train_or_load(b.spark, rows, path, False, *settings)
    return _sound(strength_model.predict(rows, loaded), "suspect_id", "cif_number")


@query
def m9_score_new_rows(b):
    """Rows lacking some training columns and having others the model never saw."""
    rows = cut_lineage(b.spark, "features", feature_rows(b))
    model = one_forest(b, rows)
    new = rows.drop("destination_Kampala", "recruited_broker").withColumn("never_seen", F.lit(True))
    return _sound(strength_model.predict(new, model), "suspect_id", "cif_number")


# --- graph ----------------------------------------------------------------------------------------------------------------


@query
def n1_suspects(b):
    return full_graph(b)["suspects"].select("id", "name")


@query
def n2_accounts(b):
    return full_graph(b)["accounts"]


@query
def n3_edges(b):
    return full_graph(b)["edges"]


@query
def n4_cases(b):
    return full_graph(b)["cases"]


@query
def n5_case_suspects(b):
    return full_graph(b)["case_suspects"]


@query
def n6_bulk_import(b):
    """Every edge of the imported graph with its suspect, case and accounts by name."""
    g = full_graph(b)
    account = g["accounts"].groupBy("account_name").agg(F.min("id").alias("account_id"))
    edges = g["edges"].withColumnRenamed("id", "edge_id")
    for end in ("source", "target"):
        named = account.select(F.col("account_id").alias(f"{end}_account_id"), F.col("account_name").alias(end))
        edges = edges.join(named, f"{end}_account_id")
    cases = g["case_suspects"].select("suspect_id", "case_id").join(
        g["cases"].select(F.col("id").alias("case_id"), "case_number"), "case_id")
    return edges.join(cases, edges["source_suspect_id"] == cases["suspect_id"], "left").select(
        "edge_id", "source", "target", "edge_type_id", "edge_direction", "case_number")


@query
def n7_new_suspects(b):
    added = country_graph(b)[1]
    return unions.by_name(
        added["suspects"].select(F.lit("suspects").alias("part"), "id", F.col("name").alias("value")),
        added["cases"].select(F.lit("cases").alias("part"), "id", F.col("case_number").alias("value")),
        added["case_suspects"].select(F.lit("case_suspects").alias("part"), "id", F.col("suspect_case_id").alias("value")))


@query
def n8_new_accounts(b):
    return country_graph(b)[1]["accounts"]


@query
def n9_new_edges(b):
    return country_graph(b)[1]["edges"]


@query
def n10_add_sheets(b):
    """All sheets added to a stored, empty graph, twice: the second time adds nothing."""
    root = scratch_path(b.spark, "graph")
    graph_store.create(b.spark, root)
    for _ in range(2):
        graph_store.add_sheets(b.spark, root, b.link_rows)
    g = graph_store.read(b.spark, root)
    row = lambda part, value, detail: [F.lit(part).alias("part"), F.col(value).alias("value"), detail.cast("string").alias("detail")]
    names = g["accounts"].select("id", "account_name")
    end = lambda name: names.select(F.col("id").alias(f"{name}_account_id"), F.col("account_name").alias(name))
    edges = g["edges"].join(end("source"), "source_account_id").join(end("target"), "target_account_id")
    cases = g["case_suspects"].join(g["cases"].select(F.col("id").alias("case_id"), "case_number"), "case_id").join(
        g["suspects"].select(F.col("id").alias("suspect_id"), "name"), "suspect_id")
    return unions.by_position(
        g["suspects"].select(*row("suspects", "name", F.lit(""))), g["cases"].select(*row("cases", "case_number", F.lit(""))),
        g["accounts"].select(*row("accounts", "account_name", F.col("account_type_id"))),
        cases.select(*row("case_suspects", "name", F.concat_ws(" ", "case_number", "suspect_case_id"))),
        edges.select(*row("edges", "source", F.concat_ws(" ", "target", "edge_direction"))))


@query
def n11_link_stats(b):
    return link_stats.refresh_link_stats(full_graph(b))


# --- full runs -----------------------------------------------------------------------------------------------------------------


def _workbook(b: Bindings, *more: tuple[str, DataFrame]) -> daily.Places:
    """Fresh folders for a run, with the bound sheets as its workbook."""
    root = scratch_path(b.spark, "run")
    tabs = [(name, df.select(*columns)) for name, (df, columns, _) in bound_tabs(b).items()]
    for name, df in (*tabs, ("cases", b.cases_sheet), *more):
        sheets.write_tab(df, f"{root}/workbook/{name}")
    return daily.Places(*[f"{root}/{p}" for p in ("workbook", "backups", "csv", "published", "journal", "graph")])


def _stand_in_scores(rows: DataFrame) -> DataFrame:
    """Scores from a digest of the row's keys, in place of a model: what follows from scores can be checked then."""
    digest = F.left(F.md5(F.concat_ws(":", "suspect_id", "cif_number")), F.lit(7))
    return rows.withColumn("soc", F.conv(digest, 16, 10).cast("long") % 997 / F.lit(997.0))


def _published_rows(b: Bindings, places: daily.Places, tabs: tuple[str, ...]) -> DataFrame:
    """All rows of the published tabs: entity, part, uid, case_id, name, case_status, date_closed, priority."""
    rows = []
    for tab in tabs:
        df = sinks.published(b.spark, places.published, tab)
        have = lambda *names: next((F.col(f"`{n}`") for n in names if n in df.columns), F.lit(None))  # noqa: B023, E731
        cell = lambda *names: F.coalesce(have(*names).cast("string"), F.lit(""))
        priority = have("Priority") if not tab.startswith("closed") else F.lit(None)
        rows.append(df.select(
            F.lit(tab).alias("tab"), cell("Victim_ID", "Suspect_ID", "Case_ID").alias("uid"), cell("Case_ID").alias("case_id"),
            cell("Suspect_Name", "Name").alias("name"), cell("Case_Status").alias("case_status"),
            cell("Next_Action_Priority", "Date_Closed").alias("date_closed"), priority.cast("double").alias("priority")))
    return unions.by_name(*rows)


LISTS = ("suspects", "closed_sus", "police", "closed_pol", "victims", "closed_vic", "top_suspects")


@branching_query
def e1_run_v3(b):
    """A day by the newer rules, with link counts from the stored graph, from its workbook to its published tabs."""
    places = _workbook(b)
    graph_store.write(b.spark, places.graph, full_graph(b))
    graph_store.refresh_stats(b.spark, places.graph)
    daily.run_day(b, SETTINGS, _stand_in_scores, places, tabs=tuple(t for t in daily.SHEETS if t != "arrests"))
    return _published_rows(b, places, (*LISTS, "cases"))


@branching_query
def e2_run_v2(b):
    """A day by the older rules with weights from a parameter tab; updated link sheets go to the stored graph."""
    weights = b.spark.createDataFrame([("Victim Willing to Testify", "2"), ("Recency of Case", "3.5"), ("Eminence", "2")], "key string, value string")
    multipliers = b.spark.createDataFrame([(str(n), str(n / 10)) for n in range(1, 11)], "victims_willing string, multiplier string")
    places = _workbook(b, ("arrests", b.arrests_sheet), ("parameters", weights), ("multipliers", multipliers))
    graph_store.create(b.spark, places.graph)
    settings = replace(PLAIN, variant="v2", bio_mode="v2")
    daily.run_day(b, settings, lambda rows: one_forest(b, rows), places, tabs=(*daily.SHEETS, "parameters", "multipliers"))
    stored = graph_store.read(b.spark, places.graph)["suspects"]
    counts = stored.select(
        F.lit("links").alias("tab"), F.col("name").alias("uid"), F.lit("").alias("case_id"), "name", F.lit("").alias("case_status"),
        F.lit("").alias("date_closed"), F.col("first_degree_case_links").cast("double").alias("priority"))
    return unions.by_name(_published_rows(b, places, (*LISTS, "link_work_list")), counts)
