"""Distance and emission formulas of the flight-emission mart (S-17, S-18,
D-01..D-05)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the reference.
EARTH_RADIUS_KM = 6371
SHORT_HAUL_KM = 785
MEDIUM_HAUL_KM = 3700
UPLIFT = 1.09
FACTOR_SHORT = 0.16685
FACTOR_MEDIUM_ECONOMY = 0.09074
FACTOR_MEDIUM_OTHER = 0.13612
FACTOR_LONG_ECONOMY = 0.07954
FACTOR_LONG_FIRST = 0.31816
FACTOR_LONG_OTHER = 0.23066
ROUND_TRIP_TYPE = 1


def _rad(c: Column) -> Column:
    return c * F.lit(math.pi) / F.lit(180)


def central_cosine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Spherical law of cosines, before ``acos`` (S-17)."""
    return (F.sin(_rad(lat1)) * F.sin(_rad(lat2))
            + F.cos(_rad(lat1)) * F.cos(_rad(lat2)) * F.cos(_rad(lon2 - lon1)))


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle km; the cosine is clamped to [-1, 1] (S-18), so rounding
    just above 1 for identical points gives 0, not NaN."""
    x = F.greatest(F.least(central_cosine(lat1, lon1, lat2, lon2), F.lit(1.0)), F.lit(-1.0))
    return F.acos(x) * F.lit(EARTH_RADIUS_KM)


def segment_km(lat1, lon1, lat2, lon2, trip_type: Column) -> Column:
    """Booking segment km: 0 if any coordinate is NULL; x2 for round trips (D-01)."""
    missing = lat1.isNull() | lat2.isNull() | lon1.isNull() | lon2.isNull()
    factor = F.when(trip_type == ROUND_TRIP_TYPE, F.lit(2)).otherwise(F.lit(1))
    return F.when(missing, F.lit(0.0)).otherwise(great_circle_km(lat1, lon1, lat2, lon2) * factor)


def leg_km(lat1, lon1, lat2, lon2) -> Column:
    """One leg of a multi-leg route: NULL coordinates count 0 (D-02)."""
    return F.coalesce(great_circle_km(lat1, lon1, lat2, lon2), F.lit(0.0))


def emission_kg(km: Column, cabin: Column) -> Column:
    """Emission by distance band and cabin (D-03)."""
    cab = F.lower(cabin)
    economy = cab.like("%economy%")
    first = cab.like("%first%")
    base = km * F.lit(UPLIFT)
    return (F.when(km <= SHORT_HAUL_KM, base * F.lit(FACTOR_SHORT))
            .when((km > SHORT_HAUL_KM) & (km <= MEDIUM_HAUL_KM),
                  F.when(economy, base * F.lit(FACTOR_MEDIUM_ECONOMY))
                  .otherwise(base * F.lit(FACTOR_MEDIUM_OTHER)))
            .when(km > MEDIUM_HAUL_KM,
                  F.when(economy, base * F.lit(FACTOR_LONG_ECONOMY))
                  .when(first, base * F.lit(FACTOR_LONG_FIRST))
                  .otherwise(base * F.lit(FACTOR_LONG_OTHER))))


def ticket_status(amount: Column, is_domestic: Column, status_id: Column) -> Column:
    """Ticket status from amount, domestic flag and status id (D-04)."""
    return (F.when(amount < 0, F.lit("Cancelled"))
            .when((is_domestic == F.lit(True)) & (amount < 100), F.lit("Changed"))
            .when((is_domestic == F.lit(False)) & (amount < 250), F.lit("Changed"))
            .otherwise(status_id.cast("string")))


# Fixed values of the reference: flight service types and cabin rules in order.
FLIGHT_SERVICE_TYPES = (13, 15)
SERVICE_CABIN_RULES = (("%eco%", "Economy class"), ("%busi%", "Business class"),
                       ("%first%", "First class"), ("%premium%", "Premium economy class"))


def service_cabin(service_type: Column, service_class: Column) -> Column:
    """Cabin class of a flight service from free text; first rule wins (D-05)."""
    flight = service_type.isin(*FLIGHT_SERVICE_TYPES)
    cls = F.lower(service_class)
    expr = None
    for pattern, label in SERVICE_CABIN_RULES:
        cond = flight & cls.like(pattern)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit("Other"))
