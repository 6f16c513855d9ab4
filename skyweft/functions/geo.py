"""Distances and weights as column expressions: everything stays inside generated code, nothing is a Python function at run time."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

EARTH_KM = 6371.0
TINY = 1e-12


def degrees_apart(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Euclidean distance in degrees, the metric of neighbour searches."""
    dy, dx = lat1 - lat2, lon1 - lon2
    return F.sqrt(dy * dy + dx * dx)


def geo_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Equirectangular distance in km, at the mean latitude."""
    dx = EARTH_KM * F.radians(lon2 - lon1) * F.cos(F.radians((lat1 + lat2) / 2.0))
    dy = EARTH_KM * F.radians(lat2 - lat1)
    return F.sqrt(dx * dx + dy * dy)


def aniso_km(horizontal_km: Column, altitude1: Column, altitude2: Column, beta: float = 10.0) -> Column:
    """Horizontal km with the height difference (m) exaggerated beta times."""
    vertical = beta * F.abs(altitude1 - altitude2) / 1000.0
    return F.sqrt(horizontal_km * horizontal_km + vertical * vertical)


def power_weight(distance: Column, power: float = 2.0) -> Column:
    near = F.greatest(distance, F.lit(TINY))
    return 1.0 / (near * near) if power == 2.0 else 1.0 / F.power(near, F.lit(power))


def humidity_weight(rh: Column, other: Column) -> Column:
    d = F.greatest(F.abs(rh - other), F.lit(0.1))
    return 1.0 / (d * d)


def degree_weight(distance: Column) -> Column:
    d = F.greatest(distance, F.lit(0.001))
    return 1.0 / (d * d)


def register_sql(spark: SparkSession) -> None:
    """geo_km(lat1, lon1, lat2, lon2) and aniso_km(km, alt1, alt2, beta) as SQL functions, which Catalyst inlines."""
    km = "sqrt(power(6371.0D * radians(lon2 - lon1) * cos(radians((lat1 + lat2) / 2.0D)), 2) + power(6371.0D * radians(lat2 - lat1), 2))"
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION geo_km(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE RETURN {km}")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION aniso_km(km DOUBLE, alt1 DOUBLE, alt2 DOUBLE, beta DOUBLE) RETURNS DOUBLE RETURN sqrt(km * km + power(beta * abs(alt1 - alt2) / 1000.0D, 2))")
