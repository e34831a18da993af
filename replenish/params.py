"""Versioned business parameters; every default can be replaced by the caller."""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

# The agreed distribution route of the first origin.
ORIGIN_ID = 41
ROUTE_CODE = "41CD"


@dataclass(frozen=True)
class ScopeRule:
    """Which catalog rows make up the distributable universe of one origin."""

    origin_id: int = ORIGIN_ID
    route_code: str = ROUTE_CODE
    supply_mode: int = 0


@dataclass(frozen=True)
class DemandParams:
    recent_days: int = 28
    previous_days: int = 28
    seasonal_days: int = 28
    recent_weight: Decimal = Decimal("0.60")
    previous_weight: Decimal = Decimal("0.25")
    seasonal_weight: Decimal = Decimal("0.15")
    minimum_recent_eligible_days: int = 7
    minimum_total_eligible_days: int = 14
    warning_coverage: Decimal = Decimal("0.70")
    # Column that carries the demand signal; `observed_units` skips the promotion adjustment.
    units_column: str = "basal_units"

    def __post_init__(self) -> None:
        if sum(self.weights.values()) <= 0:
            raise ValueError("the base weights must add up to more than zero")
        if min(self.lengths.values()) < 1:
            raise ValueError("every window needs at least one day")

    @property
    def weights(self) -> dict[str, Decimal]:
        return {
            "recent": self.recent_weight,
            "previous": self.previous_weight,
            "seasonal": self.seasonal_weight,
        }

    @property
    def lengths(self) -> dict[str, int]:
        return {
            "recent": self.recent_days,
            "previous": self.previous_days,
            "seasonal": self.seasonal_days,
        }


@dataclass(frozen=True)
class RiskParams:
    """Stock-out risk scores, from the most to the least urgent band."""

    no_stock: int = 100
    below_lead_time: int = 90
    below_twice_lead_time: int = 50
    below_target: int = 25
    covered: int = 0


@dataclass(frozen=True)
class PromoParams:
    """Promotion scores relative to the monthly median of the pair.

    The score of a row is the highest band whose price and unit conditions both hold.
    """

    # score, price at most this share of the median, units at least this multiple of the median
    bands: tuple[tuple[int, str, str], ...] = field(
        default=((100, "0.80", "2.0"), (70, "0.90", "1.5"), (40, "0.95", "1.2"))
    )
    split_from: int = 70


# External execution states and what they mean here.
STATUS_MAP = {
    "GEN": "IMPORTED",
    "ACO": "IN_PROCESS",
    "CUR": "IN_PROCESS",
    "PRG": "IN_PROCESS",
    "REV": "IN_PROCESS",
    "TER": "PREPARED",
    "EXP": "DISPATCHED",
    "CAR": "IN_PROCESS",
    "ANU": "CANCELLED",
    "AGR": "GROUPED",
}
UNKNOWN_STATUS = "UNKNOWN"

# Need types, mandatory ones first.
MANDATORY_TYPES = ("D", "E", "C")
OPTIONAL_TYPES = ("A", "S")
NEED_TYPES = MANDATORY_TYPES + OPTIONAL_TYPES
