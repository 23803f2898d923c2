"""Link counts of suspects, without ever forming the pairs that share an account.

An account shared by n cases would give n*n pairs. Counts are taken from distinct (account, case) sets
instead: the size of the account's set, minus the part that is the suspect's own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from casewright.session import settle as write_down

# Cases are counted as bits: one 64-bit word per account (or suspect) and block of 64 case numbers.
WORD_BITS = 64


def first_degree_links(edges: DataFrame) -> DataFrame:
    """Edges per suspect."""
    return edges.filter("source_suspect_id is not null").groupBy(
        F.col("source_suspect_id").alias("suspect_id")).agg(
        F.count("source_account_id").alias("first_degree_links"))


def second_degree_links(edges: DataFrame, as_coded: bool = False) -> DataFrame:
    """Per suspect, edges whose target has another source as well.

    ``as_coded`` counts the suspect's own source accounts that are the target of some edge.
    """
    known = edges.filter("source_suspect_id is not null").withColumnRenamed(
        "source_suspect_id", "suspect_id")
    if as_coded:
        own = known.select("suspect_id", "source_account_id").distinct()
        targets = edges.select(F.col("target_account_id").alias("source_account_id")).distinct()
        counted = own.join(targets, "source_account_id", "left_semi").withColumn("n", F.lit(1))
    else:
        shared = edges.groupBy("target_account_id").agg(
            F.countDistinct("source_account_id").alias("sources")).filter("sources >= 2")
        # Edges shrink to one row per (target, suspect) before they meet the targets.
        per_target = known.groupBy("target_account_id", "suspect_id").agg(F.count(F.lit(1)).alias("n"))
        counted = per_target.join(shared.select("target_account_id"), "target_account_id", "left_semi")
    return counted.groupBy("suspect_id").agg(F.sum("n").cast("long").alias("second_degree_links"))


def multi_match(df: DataFrame, match1: str, match2: str, index: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``match1`` value occurs as ``match2`` under other index values.

    Returns counts and members. Counts hold, per (match, idx1), how many other index values there are;
    members hold every (match, idx2). The others of a row are its match's members without idx1 - they are
    listed once per match, never once per row.
    """
    left = df.select(F.col(match1).alias("match"), F.col(index).alias("idx1")).dropna().distinct()
    members = df.select(F.col(match2).alias("match"), F.col(index).alias("idx2")).dropna().distinct()
    sizes = members.groupBy("match").agg(F.count(F.lit(1)).alias("_size"))
    own = members.select("match", F.col("idx2").alias("idx1"), F.lit(1).alias("_own"))
    counts = (
        left.join(sizes, "match").join(own, ["match", "idx1"], "left")
        .select("match", "idx1", (F.col("_size") - F.coalesce("_own", F.lit(0))).alias("match_count"))
        .filter("match_count > 0")
    )
    matched = members.join(counts.select("match").distinct(), "match", "left_semi")
    return counts, matched


def _words(df: DataFrame, *key: str) -> DataFrame:
    """(key, word, bits) of the distinct case numbers of each key."""
    bits = F.array(*[F.lit(1 << b if b < 63 else -(1 << 63)) for b in range(WORD_BITS)])
    return df.groupBy(*key, F.floor(F.col("case") / WORD_BITS).alias("word")).agg(
        F.bit_or(F.element_at(bits, F.pmod("case", F.lit(WORD_BITS)).cast("int") + 1)).alias("bits"))


def largest_and_others(holders: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(suspect_id, big, n): each suspect's account with the most cases; and (suspect_id, big, small) for its other accounts.

    Accounts without cases add nothing and are left out.
    """
    sizes = members.groupBy("account").agg(F.count(F.lit(1)).alias("n"))
    sized = holders.join(sizes, "account")
    largest = sized.groupBy("suspect_id").agg(F.max(F.struct("n", "account")).alias("top")).select(
        "suspect_id", F.col("top.account").alias("big"), F.col("top.n").alias("n"))
    others = sized.select("suspect_id", F.col("account").alias("small")).join(
        largest.select("suspect_id", "big"), "suspect_id").filter("small <> big")
    return largest, others.select("suspect_id", "big", "small")


def differences(others: DataFrame, members: DataFrame) -> DataFrame:
    """(big, small, case): the cases of ``small`` that ``big`` lacks, once for each pair of accounts that any suspect holds."""
    pairs = others.select("big", "small").distinct()
    return pairs.join(members.withColumnRenamed("account", "small"), "small").join(
        members.withColumnRenamed("account", "big"), ["big", "case"], "left_anti").select("big", "small", "case")


def other_cases(holders: DataFrame, members: DataFrame, own: DataFrame, settle=None) -> DataFrame:
    """Distinct cases, other than their own, that suspects share an account with.

    ``holders`` are (suspect_id, account), ``members`` (account, case), ``own`` (suspect_id, case); all
    distinct, cases are numbers. A suspect's largest account counts by its size. What a smaller one adds is worked out once
    for the pair of accounts, so the suspects of two hubs cost one difference and not one each. Only where a suspect holds
    three accounts or more may differences overlap; these are united as bits, 64 case numbers to a row.
    """
    largest, others = largest_and_others(holders, members)
    others = settle("other-accounts", others) if settle else others
    extra = differences(others, members)
    extra = settle("account-differences", extra) if settle else extra
    per_pair = extra.groupBy("big", "small").agg(F.count(F.lit(1)).alias("more"))
    held = others.groupBy("suspect_id").agg(F.count(F.lit(1)).alias("accounts"), F.min("big").alias("big"), F.min("small").alias("small"))
    two = held.filter("accounts = 1").join(per_pair, ["big", "small"]).select("suspect_id", "more")
    several = others.join(held.filter("accounts > 1").select("suspect_id"), "suspect_id", "left_semi")
    many = several.join(_words(extra, "big", "small"), ["big", "small"]).groupBy("suspect_id", "word").agg(
        F.bit_or("bits").alias("bits")).groupBy("suspect_id").agg(F.sum(F.bit_count("bits")).alias("more"))
    taken = holders.join(own, "suspect_id").join(members, ["account", "case"], "left_semi").select("suspect_id", "case").distinct() \
        .groupBy("suspect_id").agg(F.count(F.lit(1)).alias("own_n"))
    counted = largest.join(two.union(many), "suspect_id", "left").join(taken, "suspect_id", "left")
    return counted.select("suspect_id", (
        F.col("n") + F.coalesce("more", F.lit(0)) - F.coalesce("own_n", F.lit(0))).cast("long").alias("case_links"))


def _holdings(graph: dict) -> tuple[DataFrame, DataFrame]:
    """Distinct (suspect, account, side) and (suspect, case) of the graph: what both degrees are made of."""
    numbers = graph["cases"].filter("case_number is not null").groupBy("case_number").agg(F.min("id").alias("case"))
    named = graph["cases"].select(F.col("id").alias("case_id"), "case_number").join(numbers, "case_number")
    own = graph["case_suspects"].select("suspect_id", "case_id").join(named, "case_id") \
        .select("suspect_id", "case").dropna().distinct()
    sides = F.inline(F.array(
        F.struct(F.lit("source").alias("side"), F.col("source_account_id").alias("account")),
        F.struct(F.lit("target").alias("side"), F.col("target_account_id").alias("account"))))
    held = graph["edges"].select(F.col("source_suspect_id").alias("suspect_id"), sides).dropna().distinct()
    return held, own


def case_links(graph: dict, degree: str, settle=None) -> DataFrame:
    """Other cases per suspect.

    First degree: cases in which the suspect's accounts are a source too. Second degree: cases in
    which they are a target. ``settle`` may write down the tables that the counts read several times.
    """
    return _case_links(*_settled(graph, settle), degree, settle)


def _settled(graph: dict, settle) -> tuple[DataFrame, DataFrame]:
    held, own = _holdings(graph)
    return (settle("holdings", held), settle("own-cases", own)) if settle else (held, own)


def _case_links(held: DataFrame, own: DataFrame, degree: str, settle=None, only: DataFrame | None = None) -> DataFrame:
    side = {"first": "source", "second": "target"}[degree]
    holders = held.filter("side = 'source'").select("suspect_id", "account")
    if only is not None:
        holders = holders.join(only, "suspect_id", "left_semi")
    # Edges are distinct (suspect, account) before the case joins them.
    members = held.filter(F.col("side") == side).join(own, "suspect_id").select("account", "case").distinct()
    return other_cases(holders, members, own, settle).withColumnRenamed("case_links", f"{degree}_degree_case_links")


COUNTS = ("first_degree_links", "second_degree_links", "first_degree_case_links", "second_degree_case_links")


def refresh_link_stats(graph: dict, as_coded: bool = False, settle=write_down) -> DataFrame:
    """Suspects with all four counts computed anew; suspects without links have 0."""
    return _counted(graph["suspects"], graph, as_coded, settle)


def _counted(suspects: DataFrame, graph: dict, as_coded: bool, settle, only: DataFrame | None = None) -> DataFrame:
    """``suspects`` with their counts in ``graph``; ``only`` (suspect_id) says whose are wanted, if not everybody's."""
    held, own = _settled(graph, settle)
    stats = [first_degree_links(graph["edges"]), second_degree_links(graph["edges"], as_coded),
             _case_links(held, own, "first", settle, only), _case_links(held, own, "second", settle, only)]
    out = suspects.select("id", "name")
    for table in stats:
        out = out.join(table.withColumnRenamed("suspect_id", "id"), "id", "left")
    return out.select("id", "name", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS])


def touched_suspects(graph: dict, added: dict) -> DataFrame:
    """(suspect_id) of everybody whose counts the rows ``added`` may change; ``graph`` holds them already.

    These are the suspects of new edges and cases, those who hold an account that a new edge names or that a suspect with a
    new case holds (its set of cases grows), and those with an edge to a target of a new edge (it may have a second source now).
    """
    edges, new = graph["edges"], added["edges"]
    changed = added["case_suspects"].select("suspect_id").union(new.select(F.col("source_suspect_id").alias("suspect_id"))) \
        .dropna().distinct()
    ends = F.explode(F.array("source_account_id", "target_account_id")).alias("account")
    of_changed = edges.join(changed.withColumnRenamed("suspect_id", "source_suspect_id"), "source_suspect_id", "left_semi")
    accounts = of_changed.select(ends).union(new.select(ends)).dropna().distinct()
    by = lambda end: edges.join(accounts.withColumnRenamed("account", end), end, "left_semi")
    found = by("source_account_id").unionByName(by("target_account_id")).select(F.col("source_suspect_id").alias("suspect_id"))
    return found.union(changed).dropna().distinct()


def refresh_touched(graph: dict, added: dict, as_coded: bool = False, settle=write_down) -> DataFrame:
    """Suspects with the counts they have in ``graph``, which holds the rows ``added`` since its counts were taken.

    Only touched suspects are counted again. What their counts are made of is read from the edges by semi-joins: their own
    edges, and all edges that name their accounts or reach their targets. Other suspects keep their counts.
    """
    edges, suspects = graph["edges"], graph["suspects"]
    touched = settle("touched-suspects", touched_suspects(graph, added))
    own_edges = settle("touched-edges", edges.join(
        touched.withColumnRenamed("suspect_id", "source_suspect_id"), "source_suspect_id", "left_semi"))
    accounts, targets = [settle(f"touched-{c}", own_edges.select(c).dropna().distinct())
                         for c in ("source_account_id", "target_account_id")]
    mine = accounts.withColumnRenamed("source_account_id", "target_account_id").union(targets).distinct()
    near = settle("near-edges", edges.join(accounts, "source_account_id", "left_semi").unionByName(
        edges.join(mine, "target_account_id", "left_semi")).distinct())
    people = near.select(F.col("source_suspect_id").alias("suspect_id")).union(touched).dropna().distinct()
    of_people = settle("near-cases", graph["case_suspects"].join(people, "suspect_id", "left_semi"))
    # Numbers of cases are shared by rows of one case number: the least id stands for all, so these are read as well.
    numbers = graph["cases"].join(of_people.select(F.col("case_id").alias("id")), "id", "left_semi").select("case_number").distinct()
    near_graph = {"edges": near, "case_suspects": of_people, "cases": graph["cases"].join(numbers, "case_number", "left_semi")}
    again = _counted(suspects.join(touched.withColumnRenamed("suspect_id", "id"), "id", "left_semi"), near_graph, as_coded, settle, touched)
    kept = suspects.join(touched.withColumnRenamed("suspect_id", "id"), "id", "left_anti")
    return kept.select("id", "name", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS]).union(again)


def suspects_with_links(graph: dict, stats: DataFrame) -> DataFrame:
    """Link counts under the suspect-case id that the suspect list uses."""
    ids = graph["case_suspects"].select(F.col("suspect_id").alias("id"), "suspect_case_id")
    return stats.join(ids, "id")
