"""Business rules as data: labels, thresholds and weights of the rental domain."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# They must equal the published labels, thresholds and domains.
ENTIRE_HOME = "Entire home/apt"
PRIVATE_ROOM = "Private room"
HOTEL_ROOM = "Hotel room"
SHARED_ROOM = "Shared room"
ROOM_TYPES = (
    (1, ENTIRE_HOME, "Vivienda completa", True),
    (2, PRIVATE_ROOM, "Habitación privada", False),
    (3, HOTEL_ROOM, "Habitación de hotel", False),
    (4, SHARED_ROOM, "Habitación compartida", False),
)

LOW_AVAILABILITY = "Casi sin disponibilidad"
PARTIAL_AVAILABILITY = "Uso parcial"
FULL_AVAILABILITY = "Alta disponibilidad"
AVAILABILITY_PROFILES = (LOW_AVAILABILITY, PARTIAL_AVAILABILITY, FULL_AVAILABILITY)

SINGLE_HOST = "Host individual"
MULTI_HOST = "Multipropiedad"
PROFESSIONAL_HOST = "Operador profesional"
HOST_PROFILES = (SINGLE_HOST, MULTI_HOST, PROFESSIONAL_HOST)

UNASSIGNED_NEIGHBOURHOOD = "no asignado"

# Texts of the reconciliation.
COUNT_MESSAGE = "listings: fact={fact} vs mart={mart} (diff {diff}% > {limit}%)"
COVERAGE_MESSAGE = "cobertura revenue: {filled}/{all} hosts ({pct}% < {limit}%)"

# City names as shown.
CITY_LABELS = {
    "barcelona": "Barcelona",
    "euskadi": "Euskadi",
    "girona": "Girona",
    "madrid": "Madrid",
    "malaga": "Málaga",
    "mallorca": "Mallorca",
    "menorca": "Menorca",
    "sevilla": "Sevilla",
    "valencia": "Valencia",
}


@dataclass(frozen=True)
class RentalRules:
    """Every number a run can change. ``as_of=None`` means the run date.

    Fixed values: the defaults equal the published thresholds and weights.
    """

    as_of: dt.date | None = None
    cap_percentile: float = 0.95
    low_availability_days: int = 60
    high_availability_days: int = 180
    multi_host_homes: int = 2
    professional_host_homes: int = 5
    activity_months: int = 6
    window_days: int = 30
    entire_home_weight: float = 0.5
    high_availability_weight: float = 0.3
    multihost_weight: float = 0.2
    max_count_diff_pct: float = 5.0
    min_revenue_coverage_pct: float = 40.0
    cities: tuple[str, ...] = tuple(CITY_LABELS)

    def resolved(self, spark: SparkSession) -> RentalRules:
        """The rules with the run date filled in, so that all jobs of a run agree on it."""
        if self.as_of is not None:
            return self
        return replace(self, as_of=spark.range(1).select(F.current_date()).first()[0])

    @property
    def today(self) -> Column:
        return F.current_date() if self.as_of is None else F.lit(self.as_of)
