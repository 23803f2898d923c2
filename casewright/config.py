"""Run settings. One frozen object carries every threshold, date and variant switch."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date

from casewright import fixed_values as fv


@dataclass(frozen=True)
class NetworkWeights:
    """How far contact-network links may lift a suspect's eminence."""

    enabled: bool = False
    one_link_add: float = 0.5
    max_add: float = 3.0
    second_degree_weight: float = 0.5


@dataclass(frozen=True)
class Settings:
    """Everything a run needs to know besides its tables.

    ``variant`` picks the generation of the rules ("v3" or "v2"). The other switches default to
    the documented behaviour; ``legacy_*`` and ``as_coded`` reproduce known slips of the older rules, ``null_is_true`` lets
    missing texts set flags, ``keep_unmatched`` keeps people without a form, ``canonical_undirected`` makes a two-way link the
    same from both ends, and ``fill_missing`` writes narratives for missing notes too.
    """

    as_of: date
    country: str
    variant: str = "v3"
    priority_weights: dict = field(default_factory=lambda: dict(fv.PRIORITY_WEIGHTS))
    solvability_weights: dict = field(default_factory=lambda: dict(fv.SOLVABILITY_WEIGHTS))
    belief_weights: dict = field(default_factory=lambda: dict(fv.BELIEF_WEIGHTS))
    exploitation_weights: dict = field(default_factory=lambda: dict(fv.EXPLOITATION_WEIGHTS))
    discount_coef: float = fv.RECENCY_DISCOUNT_COEF
    discount_exp: float = fv.RECENCY_DISCOUNT_EXP
    willing_multipliers: dict | None = None
    legacy_multiplier_map: bool = False
    bio_mode: str = "documented"
    exclude_own_arrest: bool = False
    solvability_denominator: float | None = None
    solvability_cap: float | None = None
    published_rows: int = fv.PUBLISHED_ROWS
    legacy_case_key: bool = False
    null_is_true: bool = False
    keep_unmatched: bool = False
    canonical_undirected: bool = False
    as_coded: bool = False
    fill_missing: bool = False
    cutoff_days: int = fv.TRAINING_CUTOFF_DAYS
    network: NetworkWeights = field(default_factory=NetworkWeights)

    def __post_init__(self):
        if self.variant not in ("v2", "v3"):
            raise ValueError(f"unknown variant {self.variant!r}")
        if self.bio_mode not in ("documented", "v2", "v3"):
            raise ValueError(f"unknown bio_mode {self.bio_mode!r}")
        missing = set(fv.SOLVABILITY_WEIGHTS) - set(self.solvability_weights)
        if missing:
            raise ValueError(f"missing solvability weights: {sorted(missing)}")
        missing = set(fv.PRIORITY_WEIGHTS) - set(self.priority_weights)
        if missing:
            raise ValueError(f"missing priority weights: {sorted(missing)}")

    @property
    def places(self) -> tuple[str, ...]:
        return fv.PLACES_V3 if self.variant == "v3" else fv.PLACES_V2
