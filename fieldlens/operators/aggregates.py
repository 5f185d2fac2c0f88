"""Grouped summaries, rankings, cross-tabs and profiles of the fact table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.operators.ranking import described, first_per_key


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join two summaries of the same groups; null keys are groups too."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"__{k}"])
    return left.join(renamed, condition).drop(*[f"__{k}" for k in keys])


def describe_groups(df: DataFrame, keys: Sequence[str], value: str, *, min_count: int = 1,
                    percentiles: Mapping[str, float] | None = None, digits: int | None = 4,
                    drop_null_keys: bool = True) -> DataFrame:
    """count, mean, std, min and max per group, with exact percentiles on request.

    AGG-2, 3, 12, 22, 23, 29. Standard deviation is the sample one.
    """
    rows = df.filter(F.col(value).isNotNull()).select(*keys, value)
    if drop_null_keys:
        rows = rows.dropna(subset=list(keys))
    if percentiles:
        out = described(rows, keys, value, dict(percentiles))
    else:
        out = rows.groupBy(*keys).agg(
            F.count(value).alias("count"), F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"), F.min(value).alias("min"), F.max(value).alias("max"))
    out = out.filter(F.col("count") >= min_count)
    if digits is None:
        return out
    fixed = {*keys, "count"}
    return out.select(*[c if c in fixed else F.round(c, digits).alias(c) for c in out.columns])


def top_means(df: DataFrame, keys: Sequence[str], value: str, *, min_count: int, n: int,
              digits: int = 4) -> DataFrame:
    """Groups with the highest mean (AGG-4, AGG-13). Ties follow the keys."""
    means = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count(value).alias("count"), F.round(F.avg(value), digits).alias("mean"),
        F.round(F.stddev_samp(value), digits).alias("std")).filter(F.col("count") >= min_count)
    return means.orderBy(F.col("mean").desc_nulls_last(), *keys).limit(n)


def distinct_counts(df: DataFrame, columns: Mapping[str, str], rows: str = "n_rows") -> DataFrame:
    """Distinct values of several columns and the row count, in one row (AGG-1).

    Each distinct value of each column is a row of the shuffle, so no task holds
    a whole column's values.
    """
    return df.agg(*[F.countDistinct(c).alias(name) for name, c in columns.items()],
                  F.count(F.lit(1)).alias(rows))


def value_counts(df: DataFrame, column: str, top: int | None = None) -> DataFrame:
    """Frequency of each value, most frequent first (AGG-15)."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(
        F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), column)
    return counts.limit(top) if top else counts


def entities(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """One row per entity of the fact table (AGG-20): smallest attributes win."""
    return first_per_key(df.filter(F.col(key).isNotNull()).select(key, *columns), [key],
                         list(columns))


def entity_counts(df: DataFrame, key: str, by: Sequence[str], name: str = "n_trials") -> DataFrame:
    """Entities per group, null groups left out (AGG-6, 25, 27, 28)."""
    return entities(df, key, by).dropna(subset=list(by)).groupBy(*by).agg(
        F.count(F.lit(1)).alias(name))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str], top: int) -> DataFrame:
    """Counts of row by column with zeros filled, the ``top`` rows by total (AGG-19).

    ``total`` counts all rows; values outside ``values`` and nulls are in ``other``.
    """
    counted = df.filter(F.col(row).isNotNull()).groupBy(row).agg(
        *[F.count_if(F.col(column) == v).alias(v) for v in values],
        F.count_if(F.coalesce(~F.col(column).isin(*values), F.lit(True))).alias("other"), F.count(F.lit(1)).alias("total"))
    return counted.orderBy(F.col("total").desc(), row).limit(top)
