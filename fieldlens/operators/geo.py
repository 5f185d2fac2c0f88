"""Map points of trials and their facets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.operators.aggregates import entities

# --- fixed values: the map box and the regions outside the home country -------
LAT_RANGE = (40, 55)
LON_RANGE = (-5, 12)
ABROAD = {"Hongrie": ["TOLNA", "BARANYA"]}
HOME = "France"
# ------------------------------------------------------------------------------


def in_map_box(lat: str = "lat", lon: str = "lon") -> Column:
    """Located and inside the box (FLT-14)."""
    return F.col(lat).between(*LAT_RANGE) & F.col(lon).between(*LON_RANGE)


def country_of(region: str, abroad: Mapping[str, Sequence[str]] = ABROAD, home: str = HOME) -> Column:
    """Country from lists of regions (PRJ-13)."""
    out = F.lit(home)
    for country, regions in abroad.items():
        out = F.when(F.upper(F.col(region)).isin(*regions), F.lit(country)).otherwise(out)
    return out


def map_points(fact: DataFrame, key: str, columns: Sequence[str], trait: str = "trait",
               region: str = "region", abroad: Mapping[str, Sequence[str]] = ABROAD,
               home: str = HOME) -> DataFrame:
    """One point per located trial: attributes, number of measures, sorted traits (GEO-1).

    Traits fold to one row per (trial, trait) first, so a trial with very many
    measures never meets in one task; attributes come from the smallest row.
    """
    folded = fact.filter(F.col(key).isNotNull()).groupBy(key, trait).agg(
        F.count(F.lit(1)).alias("n"))
    sums = folded.groupBy(key).agg(
        F.sum("n").alias("n_measures"),
        F.sort_array(F.collect_set(trait)).alias("traits"))   # one entry per trait name
    located = entities(fact.filter(in_map_box()), key, columns)
    return located.join(sums, key).withColumn("country", country_of(region, abroad, home))


def facet_values(points: DataFrame, plain: Sequence[str], arrays: Sequence[str] = ()) -> DataFrame:
    """Distinct values of every facet in one pass (GEO-2)."""
    def cell(facet: str, value: Column) -> Column:
        return F.struct(F.lit(facet).alias("facet"), value.cast("string").alias("value"))

    def cells_of(facet: str) -> Column:
        return F.transform(F.col(facet), lambda v: cell(facet, v))

    cells = [F.array(cell(c, F.col(c))) for c in plain] + [cells_of(c) for c in arrays]
    return points.select(F.inline(F.concat(*cells))).filter("value IS NOT NULL").distinct()


def select_facets(points: DataFrame, equal: Mapping[str, object],
                  contains: Mapping[str, object] | None = None) -> DataFrame:
    """Points that match every chosen facet, array facets by membership (GEO-3, FLT-12)."""
    out = points
    for c, v in equal.items():
        out = out.filter(F.col(c) == F.lit(v))
    for c, v in (contains or {}).items():
        out = out.filter(F.array_contains(c, v))
    return out
