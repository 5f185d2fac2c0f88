"""Wide rows: a text key and one struct per column family."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.functions.clean import composite_key


def wide_rows(df: DataFrame, key_parts: Sequence[Column | str],
              families: Mapping[str, Sequence[str]], sep: str = "#") -> DataFrame:
    """``row_key`` plus a struct column per family (KV-1 to KV-3).

    ``ids`` keeps the parts of the key as they are, so that a join on one of them need not take the text apart.
    """
    ids = [F.col(k) if isinstance(k, str) else k for k in key_parts]
    return df.select(composite_key(*key_parts, sep=sep).alias("row_key"), F.struct(*ids).alias("ids"),
                     *[F.struct(*columns).alias(name) for name, columns in families.items()])


def scan(wide: DataFrame, condition: Column, columns: Mapping[str, str],
         limit: int | None = None) -> DataFrame:
    """Filtered scan of named cells; only the touched cells are read (KV-4)."""
    out = wide.filter(condition).select(
        "row_key", *[F.col(cell).alias(name) for name, cell in columns.items()])
    return out.orderBy("row_key").limit(limit) if limit else out


def key_part(position: int, sep: str = "#", key: str = "row_key") -> Column:
    """Part of a composite key, counted from zero."""
    return F.split_part(F.col(key), F.lit(sep), F.lit(position + 1))


def join_on_key_part(left: DataFrame, left_part: int, right: DataFrame, right_part: int) -> DataFrame:
    """Join two wide tables on ids inside their keys: an equality, not a pattern match (JN-9).

    For tables from elsewhere, whose keys are text alone; rows from ``wide_rows`` carry their ``ids``.
    """
    a = left.drop("ids").withColumn("__id", key_part(left_part)).withColumnRenamed("row_key", "left_key")
    b = right.drop("ids").withColumn("__id", key_part(right_part)).withColumnRenamed("row_key", "right_key")
    return a.join(b, "__id").drop("__id")
