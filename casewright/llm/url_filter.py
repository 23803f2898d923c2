"""URL filter: fixed rules first, then a tree of path templates per host.

Paths are cut into segments, digits in them made alike, and each host's segments form a tree. A branching point whose
branches are many and thinly used is variable: its segments become one wildcard. What remains are templates. Templates
that differ in one segment and show statistically similar labelled shares are merged, and a template is rejected when its
smoothed labelled purity (share of blocked among labelled urls, towards a prior) is high enough. Labels are given; by
default they are the verdicts of the rules themselves.

Defined cases: a null url or one without ``://`` has an empty host and path, fits no rule and is allowed unless its
(empty) template is rejected. Paths of any depth are cut into all their segments. Rows that repeat are judged each, and count each in the statistics. Without labels
everything outside the rules is allowed. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.llm.common import ascii_lower, settle

ALLOW, BLOCK = "allow", "block"
WILD = "*"
#: A branching point with more distinct segments than this, used fewer than so many times each, is variable.
MOST_BRANCHES = 12
URLS_A_BRANCH = 20
#: Templates are rejected from this share of blocked urls on; the prior counts as so many labelled urls.
REJECTED_SHARE = 0.6
PRIOR_URLS = 4.0
PRIOR_SHARE = 0.25
#: Branches are similar when chi-square does not exceed its mean by more than so many of its deviations.
SIMILAR = 3.0


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule(ALLOW, "com", "/"),
    Rule(BLOCK, "example.com", "/en/"),
    Rule(ALLOW, "www.example.com", "/en/"),
    Rule(BLOCK, "net", "/es/"),
    Rule(BLOCK, "net", "/fr/"),
)


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"\A[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"\A[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The longest rule (as text) that fits, as a struct (rule, verdict), or null. Of equally long ones the first."""
    found = F.lit(None).cast("struct<rule: string, verdict: string>")
    for rule in sorted(reversed(rules), key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(
            found)
    return found


def parsed(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """page_id, host, path, rule, rule_verdict."""
    url = F.col("url")
    parts = pages.select("page_id", F.coalesce(host_of(url), F.lit("")).alias("host"),
                         F.coalesce(path_of(url), F.lit("")).alias("path"))
    return parts.withColumn("r", rule_of(F.col("host"), F.col("path"), rules)).select(
        "page_id", "host", "path", F.col("r.rule").alias("rule"), F.col("r.verdict").alias("rule_verdict"))


def shape_of(path: Column) -> Column:
    """The path with runs of digits, and long hexadecimal words, made alike."""
    return F.regexp_replace(F.regexp_replace(path, r"(?<![0-9A-Za-z])[0-9a-f]{12,}(?![0-9A-Za-z])", "#"), r"[0-9]+", "#")


def templates(urls: DataFrame) -> DataFrame:
    """(host, shape, template, n, labelled, blocked) for each distinct shape, from (host, path, blocked) rows, where
    ``blocked`` is null without a label."""
    segments = F.split("shape", "/")
    now = settle("shapes", urls.groupBy("host", shape_of(F.col("path")).alias("shape")).agg(
        F.count(F.lit(1)).alias("n"), F.count("blocked").alias("labelled"),
        F.sum(F.col("blocked").cast("long")).alias("blocked"))
        .withColumn("blocked", F.coalesce("blocked", F.lit(0)))
        .withColumn("rest", F.slice(segments, 2, F.size(segments))).withColumn("template", F.lit("")))
    done = now.filter("size(rest) = 0")
    now = now.filter("size(rest) > 0")
    with_next = lambda t, step: F.concat(t, F.lit("/"), step)
    while not now.isEmpty():
        # What all shapes of a node share is taken at once (it is what the first and the last in order share), so a
        # round ends at the next place where they differ, however deep, and a shape that is alone in its node ends.
        nodes = now.groupBy("host", "template").agg(F.min("rest").alias("low"), F.max("rest").alias("high"))
        differs = F.array_position(F.zip_with("low", "high", lambda x, y: x.eqNullSafe(y)), False)
        nodes = nodes.select("host", "template", F.when(differs > 0, differs - 1).otherwise(
            F.least(F.size("low"), F.size("high"))).cast("int").alias("shared"))
        along = F.when(F.col("shared") > 0, with_next(F.col("template"), F.array_join(F.slice(
            "rest", 1, F.greatest("shared", F.lit(1))), "/"))).otherwise(F.col("template"))
        here = now.join(nodes, ["host", "template"]).withColumn("template", along).withColumn(
            "rest", F.slice("rest", F.col("shared") + 1, F.size("rest"))).drop("shared").withColumn("segment", F.get("rest", F.lit(0)))
        branches = here.filter("segment is not null").groupBy("host", "template", "segment").agg(F.sum("n").alias("n"))
        variable = (
            branches.groupBy("host", "template").agg(F.count(F.lit(1)).alias("branches"), F.sum("n").alias("uses"))
            .filter((F.col("branches") > MOST_BRANCHES) & (F.col("uses") < F.col("branches") * URLS_A_BRANCH))
            .select("host", "template", F.lit(True).alias("variable"))
        )
        step = F.when(F.col("variable"), F.lit(WILD)).otherwise(F.col("segment"))
        later = settle("shapes", here.join(variable, ["host", "template"], "left").withColumn("template", F.when(
            F.col("segment").isNull(), F.col("template")).otherwise(with_next(F.col("template"), step)))
            .withColumn("rest", F.slice("rest", 2, F.greatest(F.size("rest"), F.lit(1)))).select(*now.columns))
        done, now = done.union(later.filter("size(rest) = 0")), later.filter("size(rest) > 0")
    return done.drop("rest")


def rejected_templates(shapes: DataFrame) -> DataFrame:
    """(host, template) of the templates to reject, after merging similar branches.

    For each place in a template, its siblings are the templates that differ there only. They are merged at the last
    place where at least two labelled siblings exist and chi-square over their labelled shares finds them alike.
    Templates without labels are not merged: nothing says what they are like.
    """
    each = settle("templates", shapes.groupBy("host", "template").agg(
        F.sum("labelled").alias("labelled"), F.sum("blocked").alias("blocked")).filter("labelled > 0"))
    places = F.sequence(F.lit(2), F.size(F.split("template", "/")))
    opened = each.filter(F.col("template") != "").withColumn("place", F.explode(places)).withColumn(
        "around", F.array_join(F.transform(F.split("template", "/"), lambda s, i: F.when(
            i + 1 == F.col("place"), F.lit(WILD)).otherwise(s)), "/"))
    share = F.col("b") / F.col("n")
    chi = F.when((share > 0) & (share < 1), (F.col("bb") - F.col("b") * F.col("b") / F.col("n")) / (
        share * (1 - share))).otherwise(F.lit(0.0))
    families = (
        opened.groupBy("host", "place", "around").agg(
            F.count(F.lit(1)).alias("k"), F.sum("labelled").alias("n"), F.sum("blocked").alias("b"),
            F.sum(F.col("blocked") * F.col("blocked") / F.col("labelled")).alias("bb"))
        .filter(F.col("k") > 1).filter(chi <= F.col("k") - 1 + SIMILAR * F.sqrt(2 * (F.col("k") - 1)))
    )
    merged = (
        opened.join(families, ["host", "place", "around"]).groupBy("host", "template")
        .agg(F.max(F.struct("place", "n", "b")).alias("family"))
        .select("host", "template", "family.n", "family.b")
    )
    pooled = each.join(merged, ["host", "template"], "left").select(
        "host", "template", F.coalesce("n", "labelled").alias("n"), F.coalesce("b", "blocked").alias("b"))
    purity = (F.col("b") + PRIOR_URLS * PRIOR_SHARE) / (F.col("n") + PRIOR_URLS)
    return pooled.filter(purity >= REJECTED_SHARE).select("host", "template")


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES, labels: DataFrame | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, template for each row. ``labels`` (page_id, blocked) replaces the labels that
    the rules give."""
    rows = settle("urls", parsed(pages, rules))
    if labels is None:
        labelled = rows.withColumn("blocked", F.col("rule_verdict") == BLOCK)
    else:
        labelled = rows.join(labels.select("page_id", "blocked").dropDuplicates(["page_id"]), "page_id", "left")
    shapes = templates(labelled.select("host", "path", "blocked"))
    bad = rejected_templates(shapes).withColumn("bad", F.lit(True))
    known = settle("judged-shapes", shapes.join(bad, ["host", "template"], "left").select(
        "host", "shape", "template", F.coalesce("bad", F.lit(False)).alias("bad")))
    return rows.withColumn("shape", shape_of(F.col("path"))).join(known, ["host", "shape"]).select(
        "page_id", "host", "path", "rule",
        F.coalesce("rule_verdict", F.when(F.col("bad"), F.lit(BLOCK)).otherwise(F.lit(ALLOW))).alias("verdict"),
        "template")
