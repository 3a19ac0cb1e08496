"""Distances and regions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shopsight.functions.values import as_column

EARTH_RADIUS_KM = 6371.0

# States by region.
REGION_STATES = {
    "SE": ["SP", "RJ", "MG", "ES"],
    "S": ["PR", "SC", "RS"],
    "NE": ["BA", "PE", "CE", "MA", "PB", "RN", "AL", "SE", "PI"],
    "N": ["AM", "PA", "AC", "RO", "RR", "AP", "TO"],
    "CO": ["GO", "MT", "MS", "DF"],
}


def great_circle_km(lat1: Column | str, lng1: Column | str, lat2: Column | str, lng2: Column | str) -> Column:
    """Haversine distance; null when any coordinate is null. The chord term is kept inside [0, 1]."""
    phi1, phi2 = F.radians(as_column(lat1)), F.radians(as_column(lat2))
    half_dphi = (phi2 - phi1) / 2
    half_dlambda = (F.radians(as_column(lng2)) - F.radians(as_column(lng1))) / 2
    chord = F.pow(F.sin(half_dphi), 2) + F.cos(phi1) * F.cos(phi2) * F.pow(F.sin(half_dlambda), 2)
    chord = F.when(chord.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(1.0), chord)))
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.atan2(F.sqrt(chord), F.sqrt(F.lit(1.0) - chord))


def region_of(state: Column | str, regions: dict[str, list[str]] | None = None) -> Column:
    """Region of a state code, any letter case; 'unknown' when null or not listed."""
    code = F.upper(as_column(state))
    expr = None
    for region, states in (regions or REGION_STATES).items():
        expr = F.when(code.isin(states), region) if expr is None else expr.when(code.isin(states), region)
    return expr.otherwise("unknown")


def same_place(left: Column | str, right: Column | str) -> Column:
    """1 when equal as text; two missing values count as equal."""
    return as_column(left).eqNullSafe(as_column(right)).cast("int")
