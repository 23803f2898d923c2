"""Scores of a suspect, from willingness to priority.

Everything a case contributes is gathered in one aggregate: victims, police and form rows are stacked
as (case, measures) and grouped once, so a case of any size shuffles one partial row per map task, and
suspects join a table with one row per case.
"""

from __future__ import annotations

import math
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from casewright import fixed_values as fv
from casewright.config import NetworkWeights, Settings
from casewright.functions import ids
from casewright.functions.text import blank_to_null, has, number
from casewright.operators.aggregates import is_willing
from casewright.operators.dedup import keep_first
from casewright.operators.joins import attach, attach_all
from casewright.operators.unions import by_name


# --- column formulas ---------------------------------------------------------------------------


def willing_multiplier(count: Column, settings: Settings) -> Column:
    """0, .5, .75 and so on, halving the gap to 1; a parameter table replaces the formula."""
    n = F.coalesce(count, F.lit(0))
    table = settings.willing_multipliers
    if table is not None:
        if not table:
            raise ValueError("empty multiplier table")
        levels = F.create_map(*[F.lit(x) for k, v in sorted(table.items()) for x in (int(k), float(v))])
        return F.coalesce(F.try_element_at(levels, n.cast("int")), F.lit(0.0))
    beyond = F.when(n == fv.WILLING_SATURATION, 1.0).otherwise(0.0) \
        if settings.legacy_multiplier_map else F.lit(1.0)
    return F.when(n >= fv.WILLING_SATURATION, beyond).otherwise(1 - F.pow(F.lit(0.5), n))


def bio_known(settings: Settings) -> Column:
    """Whether the suspect's identity and location are known."""
    confirmed = F.coalesce(F.col("case_status") == fv.SUSPECT_LOCATED_STATUS, F.lit(False))
    if settings.bio_mode == "v2":
        # A missing cell counts as text, as only '' means unknown there.
        return F.when(F.col("bio_and_location") == "", 0).otherwise(1)
    return F.when(confirmed, 0 if settings.bio_mode == "v3" else 1) \
        .otherwise(1 if settings.bio_mode == "v3" else 0)


def recency_score(interview_date: Column | str, settings: Settings) -> Column:
    """1 for a case of today, falling with age to 0; a missing date gives 0."""
    d = F.col(interview_date) if isinstance(interview_date, str) else interview_date
    days = F.date_diff(F.lit(settings.as_of), d).cast("double")
    if settings.variant == "v2":
        score = F.when(days < fv.RECENCY_V2_MAX_DAYS, 1 - days * fv.RECENCY_DISCOUNT_COEF).otherwise(0.0)
    else:
        power = days if settings.discount_exp == 1 else F.pow(days, F.lit(settings.discount_exp))
        left = 1 - settings.discount_coef * power
        # A future date has no real power for a fractional exponent: the score is then 0.
        score = F.when(~F.isnan(left) & (left > 0), left).otherwise(0.0)
    return F.coalesce(score, F.lit(0.0))


def belief_weight(settings: Settings) -> Column:
    """Weight of the first belief flag that is set."""
    out = F.lit(0.0)
    for flag, weight in reversed(settings.belief_weights.items()):
        out = F.when(F.col(flag), F.lit(float(weight))).otherwise(out)
    return out


def exploitation_weight(columns, settings: Settings) -> Column:
    """Sum of the weights of the exploitation flags that are set; absent flags add nothing."""
    terms = [F.when(F.col(c), F.lit(float(w))).otherwise(0.0)
             for c, w in settings.exploitation_weights.items() if c in columns]
    out = F.lit(0.0)
    for term in terms:
        out = out + term
    return out


def network_scores() -> tuple[Column, Column]:
    """First- and second-degree case links, damped by the log of the suspect's link count."""
    damping = F.log10(F.coalesce(F.col("first_degree_links"), F.lit(0)) + fv.NETWORK_LINK_OFFSET)
    return tuple(F.coalesce(F.col(c), F.lit(0)) / damping
                 for c in ("first_degree_case_links", "second_degree_case_links"))


def network_weight(first: Column, second: Column, weights: NetworkWeights) -> Column:
    """Eminence added by network links, up to a maximum."""
    total = first * weights.one_link_add + second * weights.one_link_add * weights.second_degree_weight
    return F.when(total > weights.max_add, F.lit(float(weights.max_add))).otherwise(total)


def eminence_score(with_network: bool) -> Column:
    """Typed eminence, 1 when blank; network weight lifts it to at most 9."""
    typed = F.when(blank_to_null("eminence").isNull(), 1.0).otherwise(number("eminence"))
    if not with_network:
        return typed
    lifted = typed + F.col("network_weight")
    return F.coalesce(F.when(lifted > fv.EMINENCE_CAP, fv.EMINENCE_CAP).otherwise(lifted), F.lit(0.0))


def solvability(settings: Settings) -> Column:
    """Weighted mean of the sub-scores."""
    w = settings.solvability_weights
    terms = [
        ("willing_score", "Victim_Willing_to_Testify"),
        ("bio_known", "Bio_and_Location_of_Suspect"),
        ("others_arrested", "Other_Suspect(s)_Arrested"),
        ("willing_to_arrest", "Police_Willing_to_Arrest"),
        ("recency_score", "Recency_of_Case"),
    ]
    if settings.variant == "v3":
        terms += [("belief_score", "PV_Believes"), ("exploitation_score", "Exploitation_Reported")]
    total = None
    for column, key in terms:
        part = F.col(column) * F.lit(float(w[key]))
        if settings.variant == "v3":
            part = F.coalesce(part, F.lit(0.0))
        total = part if total is None else total + part
    denominator = settings.solvability_denominator or math.fsum(
        float(v) for k, v in w.items() if k in fv.SOLVABILITY_WEIGHTS)
    score = total / denominator
    cap = settings.solvability_cap
    return score if cap is None else F.when(score > cap, F.lit(float(cap))).otherwise(score)


def priority(settings: Settings) -> Column:
    """Weighted sum of solvability, strength of case and eminence; incomplete gives 0."""
    w = settings.priority_weights
    total = (
        F.col("solvability") * float(w["Solvability"])
        + F.col("strength_of_case") * float(w["Strength_of_Case"])
        + F.col("eminence_score") * 0.1 * float(w["Eminence"])
    )
    return F.coalesce(F.round(total, 3), F.lit(0.0))


# --- weights from a parameter table ----------------------------------------------------------------


def weights_from_table(parameters: DataFrame, keys=(*fv.SOLVABILITY_WEIGHTS, *fv.PRIORITY_WEIGHTS)) -> dict[str, float]:
    """The known keys of a key/value parameter table as a weight dict; blank counts as 0, an absent key is left out."""
    named = F.translate("key", " ", "_")
    found = parameters.agg(*[
        F.max(F.when(named == k, number("value", 0))).alias(f"k{i}") for i, k in enumerate(keys)]).first()
    return {k: found[f"k{i}"] for i, k in enumerate(keys) if found[f"k{i}"] is not None}


def multipliers_from_table(table: DataFrame, most: int = 1000) -> dict[int, float]:
    """The multiplier for each number of willing victims; unreadable rows are left out, of equal numbers the largest counts.

    A typed table of a few rows; one with more than ``most`` numbers is refused.
    """
    rows = table.select(number("victims_willing").cast("int").alias("n"), number("multiplier").alias("m")).dropna().groupBy("n").agg(
        F.max("m").alias("m")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} multipliers")
    return {r["n"]: r["m"] for r in rows}


# --- case measures ------------------------------------------------------------------------------------


def case_measures(settings: Settings, victims: DataFrame | None = None,
                  police: DataFrame | None = None, forms: DataFrame | None = None,
                  arrests: DataFrame | None = None, legacy_case_key: bool = False) -> DataFrame:
    """One row per case with everything its victims, police rows and forms contribute.

    ``legacy_case_key`` reproduces form keys that keep their dots and so miss their case.
    """
    parts = []
    if victims is not None:
        parts.append(victims.filter(is_willing(settings.variant))
                     .select("case_id", F.lit(1).alias("willing_count")))
    if police is not None:
        parts.append(police.select("case_id", has("case_status", fv.STEP_COMPLETE).cast("int")
                                   .alias("willing_to_arrest")))
    if forms is not None:
        measures = [F.col("interview_date")]
        if "arrest" in forms.columns and arrests is None:
            # A suspect id starts with the case of its form, so both keys lead to the same case.
            arrest = F.col("arrest").alias("others_arrested")
            if legacy_case_key:
                parts.append(forms.select(ids.case_of_suspect("suspect_id").alias("case_id"), arrest))
            else:
                measures.append(arrest)
        if set(settings.belief_weights) <= set(forms.columns):
            measures.append(belief_weight(settings).alias("belief_score"))
        if set(settings.exploitation_weights) & set(forms.columns):
            measures.append(exploitation_weight(forms.columns, settings).alias("exploitation_score"))
        parts.append(forms.select(ids.case_id("cif_number", legacy_case_key).alias("case_id"), *measures))
    if arrests is not None:
        parts.append(arrests.select("case_id", F.col("arrest").alias("others_arrested")))
    stacked = by_name(*parts)
    aggregates = {
        "willing_count": F.sum, "willing_to_arrest": F.max, "others_arrested": F.sum,
        "interview_date": F.max, "belief_score": F.max, "exploitation_score": F.max,
    }
    # Blank cases are left out by a measure of theirs: a filter on the case itself would be worked out on every row below the joins.
    return stacked.groupBy("case_id").agg(
        F.max(F.length(F.trim("case_id"))).alias("_length"),
        *[agg(c).alias(c) for c, agg in aggregates.items() if c in stacked.columns]).filter("_length > 0").drop("_length")


def suspect_measures(forms: DataFrame) -> DataFrame:
    """One row per suspect: the model's score on the newest form, and whether arrested.

    A blank id is one more key, which nothing is attached to.
    """
    columns = [c for c in ("soc", "arrest") if c in forms.columns]
    order = [F.desc("interview_date"), "cif_number", *columns]
    return keep_first(forms, ["suspect_id"], order).select("suspect_id", *columns)


# --- attaching scores to suspects --------------------------------------------------------------------


def add_case_scores(suspects: DataFrame, measures: DataFrame, settings: Settings, beside: tuple[DataFrame, ...] = ()) -> DataFrame:
    """Willingness, arrest, recency, belief and exploitation scores of the suspect's case.

    The columns of tables ``beside``, which have one row per ``case_id`` too, are attached in the same shuffle.
    """
    out = attach_all(suspects, [(table, "case_id") for table in (measures, *beside)], "case_id", "suspect_id")
    have = set(measures.columns)
    if "willing_count" in have:
        out = out.withColumn("willing_score", willing_multiplier(F.col("willing_count"), settings))
    if "others_arrested" in have:
        out = out.withColumn("others_arrested", F.coalesce("others_arrested", F.lit(0)))
    if "interview_date" in have:
        out = out.withColumn("recency_score", recency_score("interview_date", settings))
    return out.drop("willing_count", "interview_date")


def add_strength(suspects: DataFrame, per_suspect: DataFrame) -> DataFrame:
    """Strength of case of the suspect's own row, to three places."""
    return _strength(attach(suspects.drop("strength_of_case"), per_suspect, "suspect_id", "suspect_id"))


def _strength(suspects: DataFrame) -> DataFrame:
    return suspects.withColumn("strength_of_case", F.round("soc", 3)).drop("soc")


def network_weights_of(suspects_with_links: DataFrame, weights: NetworkWeights) -> DataFrame:
    """Network weight per suspect-case id."""
    first, second = network_scores()
    return suspects_with_links.filter(blank_to_null("suspect_case_id").isNotNull()).groupBy("suspect_case_id").agg(
        F.max(network_weight(first, second, weights)).alias("network_weight"))


def add_network_weight(suspects: DataFrame, suspects_with_links: DataFrame,
                       weights: NetworkWeights) -> DataFrame:
    """Attach the network weight, when the network stage is switched on."""
    if not weights.enabled:
        return suspects
    return attach(suspects, network_weights_of(suspects_with_links, weights), "suspect_id",
                  "suspect_id", right_key="suspect_case_id")


def score_suspects(suspects: DataFrame, settings: Settings, measures: DataFrame,
                   per_suspect: DataFrame, suspects_with_links: DataFrame | None = None,
                   beside: tuple[DataFrame, ...] = ()) -> DataFrame:
    """All scores, solvability and priority; one row per suspect, every suspect kept. ``beside`` as in ``add_case_scores``.

    Suspects are shuffled twice: to their case, and to what is known of them.
    """
    use_network = settings.network.enabled and suspects_with_links is not None
    scored = add_case_scores(suspects.drop("solvability", "priority", "strength_of_case"), measures, settings, beside)
    known = [(per_suspect, "suspect_id")]
    if use_network:
        known.append((network_weights_of(suspects_with_links, settings.network), "suspect_case_id"))
    scored = _strength(attach_all(scored, known, "suspect_id", "suspect_id")).withColumn("bio_known", bio_known(settings))
    if settings.exclude_own_arrest and "arrest" in scored.columns:
        scored = scored.withColumn(
            "others_arrested", F.col("others_arrested") - F.coalesce("arrest", F.lit(0)))
    return (
        scored.withColumn("eminence_score", eminence_score(use_network))
        .withColumn("solvability", solvability(settings))
        .withColumn("priority", priority(settings))
    )


def days_old(as_of: date, column: str = "interview_date") -> Column:
    return F.date_diff(F.lit(as_of), F.col(column)).cast("double")
