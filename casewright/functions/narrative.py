"""Narrative text of a case form, assembled as one projection from the sentence tables."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from casewright import fixed_values as fv
from casewright.functions.text import _col, has


def _if_flag(rule: tuple[str, str]) -> Column:
    """The sentence when the flag is set; null otherwise (``concat_ws`` skips nulls)."""
    flag, sentence = rule
    return F.when(F.col(flag), F.lit(sentence))


def _if_text(prefix: str, c: str, suffix: str) -> Column:
    return F.when(F.col(c) != "", F.concat(F.lit(prefix), F.col(c), F.lit(suffix)))


def narrative(repeat_approached: bool = False) -> Column:
    """All sentences that apply to the form, in publishing order.

    Recruitment sentences come latest rule first. Of purposes, of identity papers and of beliefs
    only the last rule that applies speaks. ``repeat_approached`` says the broker-approached
    sentence twice, as older texts do.
    """
    recruited = list(fv.NARRATIVE_RECRUITED)
    if repeat_approached:
        at = [flag for flag, _ in recruited].index("how_recruited_broker_approached")
        recruited.insert(at, recruited[at])
    belief = [F.when(has("pv_believes", word), F.lit(s)) for word, s in fv.NARRATIVE_BELIEF]
    legal_word, legal_sentence = fv.NARRATIVE_LEGAL
    return F.concat_ws(
        "",
        _if_flag(fv.NARRATIVE_BROKER),
        *map(_if_flag, reversed(recruited)),
        *map(_if_flag, fv.NARRATIVE_TRAVEL),
        _if_text(fv.NARRATIVE_EARNING[0], "expected_earning", fv.NARRATIVE_EARNING[1]),
        F.coalesce(*map(_if_flag, reversed(fv.NARRATIVE_PURPOSE))),
        _if_text(fv.NARRATIVE_DESTINATION[0], "planned_destination", fv.NARRATIVE_DESTINATION[1]),
        F.coalesce(*map(_if_flag, reversed(fv.NARRATIVE_ID))),
        F.when(has("legal_action_taken", legal_word), F.lit(legal_sentence)),
        F.coalesce(*reversed(belief)),
    )


def notes_or_narrative(notes: Column | str, text: Column, fill_missing: bool = False) -> Column:
    """Keep written notes; a blank cell takes the narrative.

    A missing note (null, or the literal 'nan') stays blank unless ``fill_missing`` is set.
    """
    n = _col(notes)
    missing = n.isNull() | (n == "nan")
    return F.when(n == "", text).when(missing, text if fill_missing else F.lit("")).otherwise(n)
