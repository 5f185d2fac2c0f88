"""Distinct counts by mergeable sketches, per file and column (AGG-16, QLT-1, CAT-2).

A file is sketched once, in one pass that makes no row per cell; the sketches of files merge into those of a table, and
a new file adds its own. The exact way is ``quality.distinct_values``.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldlens.operators.quality import cell_value

# Registers of a sketch as a power of two, and with them the relative standard error of an estimate.
LOG_REGISTERS = 14
STANDARD_ERROR = 1.04 / sqrt(2 ** LOG_REGISTERS)


def file_sketches(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per source file and column: rows, nulls and the sketch of its values.

    ``df`` is a table as it was read, so that its rows still know their files. Null is no value; a file without
    rows has no row here.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    rows = df.select(F.col("_metadata.file_path").alias("__file"), *[F.xxhash64(cell_value(f)).alias(f"v{i}") for i, f in enumerate(fields)],
                     *[F.col(f"`{f.name}`").isNull().alias(f"n{i}") for i, f in enumerate(fields)])
    facts = rows.groupBy("__file").agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(f"n{i}")).alias(f"n{i}") for i in range(len(fields))],
        *[F.hll_sketch_agg(F.when(~F.col(f"n{i}"), F.col(f"v{i}")), LOG_REGISTERS).alias(f"s{i}") for i in range(len(fields))])
    return facts.select(F.col("__file").alias("file"), F.inline(F.array(*[F.struct(
        F.lit(f.name).alias("column_name"), F.col("n_rows"), F.col(f"n{i}").alias("nulls"), F.col(f"s{i}").alias("sketch"))
        for i, f in enumerate(fields)])))


def merged(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """Sketches of the same groups as one each, with their rows and nulls."""
    return sketches.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), F.sum("nulls").alias("nulls"),
                                     F.hll_union_agg("sketch").alias("sketch"))


def with_estimate(sketches: DataFrame, name: str = "distinct_estimate") -> DataFrame:
    """The estimate in place of the sketch."""
    return sketches.withColumn(name, F.hll_sketch_estimate("sketch")).drop("sketch")


def within_error(estimate: Column, exact: Column, deviations: float = 4.0) -> Column:
    """Whether an estimate is as near to the exact count as its error allows."""
    return F.abs(estimate - exact) <= deviations * STANDARD_ERROR * exact + 0.5
