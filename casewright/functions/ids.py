"""Identifiers derived from form numbers such as ``N010000012A`` or ``N010000012.1``."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from casewright.functions.text import _col


def case_id(cif_number: Column | str, legacy: bool = False) -> Column:
    """Case of a form: dots removed, interviewee mark (the last character) dropped.

    ``legacy=True`` keeps the dots, which makes ``.1`` forms miss their case.
    """
    c = _col(cif_number)
    plain = c if legacy else F.replace(c, F.lit("."), F.lit(""))
    return F.left(plain, F.length(plain) - 1)


def suspect_id(cif_number: Column | str, pb_number: Column | str) -> Column:
    """Suspect of a form: case, then ``.PB`` and the person-box number (missing box is 0)."""
    box = F.coalesce(_col(pb_number).cast("int"), F.lit(0)).cast("string")
    return F.concat(case_id(cif_number), F.lit(".PB"), box)


def victim_id(cif_number: Column | str) -> Column:
    """Victim of a form: ``.1`` or A gives ``.V1``, B gives ``.V2`` and so on up to J."""
    c = _col(cif_number)
    last = F.right(c, F.lit(1))
    letter_no = (F.ascii(last) - F.ascii(F.lit("A")) + 1).cast("string")
    return (
        F.when(c.endswith(".1"), F.concat(F.left(c, F.length(c) - 2), F.lit(".V1")))
        .when(last.between("A", "J"),
              F.concat(F.left(c, F.length(c) - 1), F.lit(".V"), letter_no))
        .otherwise(c)
    )


def case_of_suspect(sus_id: Column | str) -> Column:
    """Case part of a suspect id, for any number of box digits."""
    return F.replace(F.regexp_replace(_col(sus_id), r"\.?PB\d+$", ""), F.lit("."), F.lit(""))


def station_code(uid: Column | str) -> Column:
    return F.left(_col(uid), F.lit(3))
