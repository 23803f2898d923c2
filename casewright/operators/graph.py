"""Contact-link graph: building it from link sheets, and extending it with new sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casewright import fixed_values as fv
from casewright.functions.links import account_type, edge_combo_id, edge_direction
from casewright.functions.text import blank_to_null
from casewright.operators.dedup import fill_from_first_row, keep_first
from casewright.operators.numbering import number_rows
from casewright.operators.unions import by_name, insert_if_absent
from casewright.schemas import GRAPH_TABLES, LINK_HEAD, LINK_SHEET
from casewright.session import settle as write_down

Graph = dict  # table name to DataFrame

ROW_ORDER = ["row_no", "sheet_id"]


def edge_types(spark) -> DataFrame:
    return spark.createDataFrame(list(fv.EDGE_TYPES), GRAPH_TABLES["edge_types"])


def account_types(spark) -> DataFrame:
    return spark.createDataFrame(list(fv.ACCOUNT_TYPES), GRAPH_TABLES["account_types"])


def empty_graph(spark) -> Graph:
    """All tables, empty but for the two seeded dimensions."""
    graph = {name: spark.createDataFrame([], schema) for name, schema in GRAPH_TABLES.items()}
    return {**graph, "edge_types": edge_types(spark), "account_types": account_types(spark)}


def prepare_links(sheets: DataFrame) -> DataFrame:
    """Blank name and case cells take their sheet's first row; the edge direction is added."""
    filled = fill_from_first_row(sheets, "sheet_id", "row_no", ["name", "case_id", "suspect_case_id"])
    return filled.withColumn("edge_direction", edge_direction("relationship_type"))


def await_first_rows(sheets: DataFrame, heads: DataFrame, waiting: DataFrame,
                     first_row: int | None = 1) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows of sheets that land in several files, in any order: (ready links, new heads, rows that wait).

    A sheet's first row is that with the number ``first_row``; where rows are not numbered from a fixed one (None), it is the
    first landed one whose name and cases are all typed, which suits sheets that have them on their first row only. Its
    cells fill the blank ones of all others. Rows wait until it has landed. Of several first rows of a sheet the least counts,
    and one that was taken before stays. A row that has landed and waits already is not taken twice.
    """
    rows = sheets.select(*LINK_SHEET).unionByName(waiting).distinct()
    is_first = F.col("row_no") == first_row if first_row is not None else F.lit(True)
    if first_row is None:
        for c in LINK_HEAD:
            is_first = is_first & blank_to_null(c).isNotNull()
    first = rows.filter(is_first).groupBy("sheet_id").agg(F.min(F.struct("row_no", *LINK_HEAD)).alias("h")).select(
        "sheet_id", *[f"h.{c}" for c in LINK_HEAD])
    new_heads = insert_if_absent(heads, first, "sheet_id")
    known = heads.select("sheet_id", *[F.col(c).alias(f"_{c}") for c in LINK_HEAD]).unionByName(
        new_heads.select("sheet_id", *[F.col(c).alias(f"_{c}") for c in LINK_HEAD]))
    filled = rows.join(known, "sheet_id").withColumns(
        {c: F.coalesce(blank_to_null(c), F.col(f"_{c}")) for c in LINK_HEAD}).select(*LINK_SHEET)
    links = filled.withColumn("edge_direction", edge_direction("relationship_type"))
    return links, new_heads, rows.join(known.select("sheet_id"), "sheet_id", "left_anti").select(*LINK_SHEET)


def _suspects(links: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    names = links.select("name").filter(blank_to_null("name").isNotNull()).distinct()
    if existing is not None:
        names = insert_if_absent(existing, names, "name")
    return number_rows(names, ["name"], existing=existing).select(
        "id", "name", *[F.lit(0).cast("long").alias(c) for c in GRAPH_TABLES["suspects"].names[2:]])


def _cases(links: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    numbers = links.select(F.col("case_id").alias("case_number")) \
        .filter(blank_to_null("case_number").isNotNull()).distinct()
    if existing is not None:
        numbers = insert_if_absent(existing, numbers, "case_number")
    return number_rows(numbers, ["case_number"], existing=existing).withColumn(
        "case_date", F.lit(None).cast("date"))


def _case_suspects(links: DataFrame, suspects: DataFrame, cases: DataFrame,
                   existing: DataFrame | None = None) -> DataFrame:
    """One case per suspect: that of the suspect's first link row."""
    first = keep_first(
        links.select("name", F.col("case_id").alias("case_number"), "suspect_case_id", *ROW_ORDER)
        .filter(blank_to_null("name").isNotNull()), ["name"], ROW_ORDER)
    rows = (
        first.join(suspects.select(F.col("id").alias("suspect_id"), "name"), "name")
        .join(cases.select(F.col("id").alias("case_id"), "case_number"), "case_number", "left")
        .select("case_id", "suspect_id", "suspect_case_id")
    )
    if existing is not None:
        rows = insert_if_absent(existing, rows, "suspect_id")
    return number_rows(rows, ["suspect_id"], existing=existing)


def _target_labels(links: DataFrame) -> DataFrame:
    """Label of each target, from the first row that names it."""
    return (
        links.filter(blank_to_null("target").isNotNull())
        .groupBy(F.col("target").alias("account_name"))
        .agg(F.min_by("target_label", F.struct(*ROW_ORDER)).alias("account_label"))
    )


def _bulk_accounts(links: DataFrame, suspects: DataFrame) -> DataFrame:
    """An account per (source, suspect), then the targets that are no sources."""
    labels = _target_labels(links)
    sources = (
        links.filter(blank_to_null("source").isNotNull()).select("name", F.col("source").alias("account_name"))
        .distinct()
        .join(suspects.select("name", F.col("id").alias("suspect_id")), "name", "left")
        .select("account_name", "suspect_id").distinct()
    )
    labelled = sources.join(labels, "account_name", "left")
    only_targets = labels.join(sources, "account_name", "left_anti").withColumn(
        "suspect_id", F.lit(None).cast("long"))
    rows = by_name(labelled, only_targets).withColumn("account_type_id", account_type("account_name"))
    return number_rows(rows, ["account_name", "suspect_id"]).select(*GRAPH_TABLES["accounts"].names)


def _new_accounts(links: DataFrame, suspects: DataFrame, existing: DataFrame) -> DataFrame:
    """Accounts not in the store: sources with their suspect, then targets; one per name."""
    names = suspects.select("name", F.col("id").alias("suspect_id"))
    sources = keep_first(
        links.filter(blank_to_null("source").isNotNull())
        .select(F.col("source").alias("account_name"), "name", *ROW_ORDER),
        ["account_name"], ROW_ORDER,
    ).join(names, "name", "left").select("account_name", F.lit("").alias("account_label"), "suspect_id")
    targets = _target_labels(links).join(sources, "account_name", "left_anti").withColumn(
        "suspect_id", F.lit(None).cast("long"))
    rows = insert_if_absent(existing, by_name(sources, targets), "account_name").withColumn(
        "account_type_id", account_type("account_name"))
    return number_rows(rows, ["account_name"], existing=existing).select(*GRAPH_TABLES["accounts"].names)


def _edges(links: DataFrame, suspects: DataFrame, accounts: DataFrame, types: DataFrame,
           existing: DataFrame | None = None, canonical_undirected: bool = False) -> DataFrame:
    """Edges of the link rows.

    A bulk import holds one edge per (source, target), as its first row says. New sheets are taken
    sheet by sheet: one edge per (sheet, source, target), then the first of each combo id that the
    store lacks; so the result does not depend on how sheets are spread over batches. An account's id is
    the lowest of its name. The suspect is the one whose sheet holds the row.
    """
    pair = ["source", "target"] if existing is None else ["sheet_id", "source", "target"]
    first = keep_first(
        links.filter(blank_to_null("source").isNotNull() & blank_to_null("target").isNotNull())
        .select("source", "target", "name", "relationship_type", "edge_direction", *ROW_ORDER),
        pair, ROW_ORDER)
    account_ids = accounts.groupBy("account_name").agg(F.min("id").alias("account_id"))

    def resolve(df: DataFrame, column: str) -> DataFrame:
        named = account_ids.select(F.col("account_name").alias(column),
                                   F.col("account_id").alias(f"{column}_account_id"))
        return df.join(named, column, "left")

    rows = resolve(resolve(first, "source"), "target")
    rows = (
        rows.join(suspects.select("name", F.col("id").alias("source_suspect_id")), "name", "left")
        .join(F.broadcast(types.select(F.col("id").alias("edge_type_id"),
                                       F.col("edge_type").alias("relationship_type"))),
              "relationship_type", "left")
        .withColumn("edge_combo_id", edge_combo_id(
            "source_account_id", "target_account_id", "edge_direction", canonical_undirected))
    )
    if existing is not None or canonical_undirected:
        rows = keep_first(rows, ["edge_combo_id"], ROW_ORDER)
    # Numbering reads the rows twice, so they are worked out once.
    rows = write_down("edge-rows", rows.select(*GRAPH_TABLES["edges"].names[1:]))
    if existing is None:
        return number_rows(rows, ["source_account_id", "target_account_id"])
    return number_rows(insert_if_absent(existing, rows, "edge_combo_id"), ["edge_combo_id"],
                       existing=existing)


def import_links(links: DataFrame, dimensions: Graph, settle=write_down,
                 canonical_undirected: bool = False) -> Graph:
    """Build all tables from prepared link rows.

    ``settle`` writes a table down once it is numbered, as later tables read it again.
    """
    suspects = settle("suspects", _suspects(links))
    cases = settle("cases", _cases(links))
    accounts = settle("accounts", _bulk_accounts(links, suspects))
    return {
        **dimensions,
        "suspects": suspects,
        "cases": cases,
        "accounts": accounts,
        "edges": settle("edges", _edges(links, suspects, accounts, dimensions["edge_types"],
                                        canonical_undirected=canonical_undirected)),
        "case_suspects": settle("case_suspects", _case_suspects(links, suspects, cases)),
    }


def new_rows(links: DataFrame, graph: Graph, settle=write_down, canonical_undirected: bool = False) -> Graph:
    """What prepared rows of new sheets add to each table; all sheets in one go."""
    suspects = settle("new-suspects", _suspects(links, graph["suspects"]))
    cases = settle("new-cases", _cases(links, graph["cases"]))
    all_suspects = by_name(graph["suspects"], suspects)
    all_cases = by_name(graph["cases"], cases)
    accounts = settle("new-accounts", _new_accounts(links, all_suspects, graph["accounts"]))
    return {
        "suspects": suspects,
        "cases": cases,
        "accounts": accounts,
        "edges": settle("new-edges", _edges(
            links, all_suspects, by_name(graph["accounts"], accounts), graph["edge_types"],
            existing=graph["edges"], canonical_undirected=canonical_undirected)),
        "case_suspects": settle("new-case-suspects", _case_suspects(
            links, all_suspects, all_cases, graph["case_suspects"])),
    }


def extend(graph: Graph, added: Graph) -> Graph:
    return {**graph, **{name: by_name(graph[name], rows) for name, rows in added.items()}}
