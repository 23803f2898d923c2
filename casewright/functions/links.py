"""Columns of the contact-link graph."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from casewright import fixed_values as fv
from casewright.functions.text import _col, has


def edge_direction(relationship_type: Column | str) -> Column:
    """Friends point both ways, likes point back, everything else points out."""
    return (
        F.when(has(relationship_type, "Friend"), fv.EDGE_BOTH)
        .when(has(relationship_type, "Like"), fv.EDGE_IN)
        .otherwise(fv.EDGE_OUT)
    )


def account_type(account_name: Column | str) -> Column:
    return F.when(has(account_name, "facebook"), fv.ACCOUNT_FACEBOOK).otherwise(fv.ACCOUNT_PHONE)


def edge_combo_id(source: Column | str, target: Column | str, direction: Column | str,
                  canonical_undirected: bool = False) -> Column:
    """``s<->t``, ``s->t`` or ``s<-t``.

    With ``canonical_undirected`` a two-way edge reads the same from both ends.
    """
    s, t, d = _col(source), _col(target), _col(direction)
    a, b = (F.least(s, t), F.greatest(s, t)) if canonical_undirected else (s, t)
    return (
        F.when(d == fv.EDGE_BOTH, F.concat_ws("<->", a.cast("string"), b.cast("string")))
        .when(d == fv.EDGE_OUT, F.concat_ws("->", s.cast("string"), t.cast("string")))
        .when(d == fv.EDGE_IN, F.concat_ws("<-", s.cast("string"), t.cast("string")))
        .otherwise(F.lit(""))
    )
