"""Cleaning and deduplication of station rows.

Missing is NULL inside the engine. Texts are taken apart with try_cast, so a bad value is missing and never an error.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SENTINELS = (9999.0, 999999.0)
MEASURES = ("lon", "lat", "altitude", "rh", "vis")
#: Wire names of the station feed and their names here.
WIRE_NAMES = {"V01301": "code", "VF01015_CN": "name", "V_CITY": "city", "V_COUNTY": "county", "V06001": "lon", "V05001": "lat", "V07001": "altitude", "V13003": "rh"}
VISIBILITY_FIELDS = {"national": "V20001", "regional": "V20001_701_01"}
UPDATE_FIELD = "D_UPDATE_TIME"


def code(text: Column) -> Column:
    """A station code: trimmed, without a trailing ".0"; empty is missing."""
    return F.nullif(F.regexp_replace(F.trim(text), r"\.0$", ""), F.lit(""))


def is_sentinel(text: Column, sentinels: Sequence[float] = SENTINELS) -> Column:
    return F.coalesce(F.trim(text).try_cast("double").isin(*sentinels), F.lit(False))


def number(text: Column, sentinels: Sequence[float] = SENTINELS) -> Column:
    """A number without its sentinels and NaN."""
    value = F.trim(text.cast("string")).try_cast("double")
    return F.when(value.isin(*sentinels) | F.isnan(value), None).otherwise(value)


def first_present(*texts: Column) -> Column:
    """The first text that is neither missing nor a sentinel, before any number is made of it: a primary value that is no number doesn't
    fall back to the next field."""
    present = [F.when(is_sentinel(t) | (F.trim(t) == ""), None).otherwise(t) for t in texts]
    return F.coalesce(*present)


def usable(stations: DataFrame, with_vis: bool) -> DataFrame:
    """Stations that have all of code, place, altitude and humidity (and visibility); absent columns count as missing."""
    wanted = ["code", "lon", "lat", "altitude", "rh"] + ["vis"] * with_vis
    for c in wanted:
        if c not in stations.columns:
            stations = stations.withColumn(c, F.lit(None).cast("string" if c == "code" else "double"))
    return stations.na.drop(subset=wanted)


def quality(columns: Sequence[str] = MEASURES) -> Column:
    """How many of the columns are present."""
    return reduce(lambda a, b: a + b, (F.col(c).isNotNull().cast("int") for c in columns))


def best_by_quality(rows: DataFrame, key: str = "code", order: Sequence[str] = ("seq",), update: str | None = None, measures: Sequence[str] = MEASURES, partition: Sequence[str] = ()) -> DataFrame:
    """Of each key's rows the most complete, then the latest, then the first. Rows without a key are dropped."""
    by = [F.col("__q").desc(), *([F.col(update).desc_nulls_last()] if update else []), *(F.col(c) for c in order)]
    w = Window.partitionBy(*partition, key).orderBy(*by)
    return rows.where(F.col(key).isNotNull()).withColumn("__q", quality(measures)).withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__q", "__n")


def first_wins(frames: Sequence[DataFrame], key: str = "code", order: Sequence[str] = ("seq",), partition: Sequence[str] = ()) -> DataFrame:
    """The union of frames by name; of rows with equal keys that of the earliest frame, then the first in order."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (f.withColumn("__f", F.lit(i)) for i, f in enumerate(frames)))
    w = Window.partitionBy(*partition, key).orderBy("__f", *order)
    return union.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__f", "__n")


def common_union(a: DataFrame, b: DataFrame) -> DataFrame:
    """The union over the columns that both have."""
    both = [c for c in a.columns if c in b.columns]
    return a.select(*both).unionByName(b.select(*both))


def sample_counts(national: DataFrame, regional: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct codes: national stations with everything, regional ones with humidity, regional ones with visibility too."""
    both = national.withColumn("__n", F.lit(True)).unionByName(regional.withColumn("__n", F.lit(False)), allowMissingColumns=True)
    base = reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in ("code", "lon", "lat", "altitude", "rh")))
    vis = base & F.col("vis").isNotNull()
    counted = lambda cond: F.count_distinct(F.when(cond, F.col("code")))
    return both.groupBy(*by).agg(counted(F.col("__n") & vis).alias("national_valid"), counted(~F.col("__n") & base).alias("regional_valid_rh"), counted(~F.col("__n") & vis).alias("regional_valid_vis"))


def marker_sum(marker: Column) -> Column:
    """The sum of all markers, NULL if there are none or one is missing."""
    return F.when((F.count(F.lit(1)) == F.count(marker)) & (F.count(F.lit(1)) > 0), F.sum(marker))
