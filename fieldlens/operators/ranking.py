"""Ordered computations that stay distributed when one group holds most of the rows.

A window over a group runs in one task. That is fine for groups that were
aggregated down to a handful of rows, but not for raw groups, where one key may
own a third of the table. The helpers below deal the entries (usually already
folded to one row per group and value) into ranges of their sorted order first:
every range is sorted in its own task and shifted by the total of the ranges
before it. Spark's range partitioner samples the cuts; the session's shuffle width
is the number of ranges, so it grows with the input that the session is sized for.

The dealt entries are written to the shared folder once, with the number of their
range. That cuts the lineage and fixes the ranges: a lost stage finds the same ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlens.session import stored

_SINGLE = "__all"


def _with_keys(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    if keys:
        return df, list(keys)
    return df.withColumn(_SINGLE, F.lit(0)), [_SINGLE]


def _join_ranges(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys that treats null as a value, as grouping does."""
    renamed = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & left[key].eqNullSafe(renamed[f"__{key}"])
    return left.join(renamed, condition).drop(*[f"__{k}" for k in keys])


def _ranged(entries: DataFrame, keys: list[str], order: str, measures: Sequence[str]) -> DataFrame:
    """Deal entries into value ranges and add the measure totals around each of them.

    ``entries`` has one row per (keys, order). All entries, sorted by key and value,
    are cut into ranges of about equal length, so a large group spans many ranges.
    Columns added: ``range_no``, ``before_<m>`` (the group's total in earlier
    ranges), ``inside_<m>`` (in this range) and ``total_<m>`` (everywhere).
    """
    ranges = max(2, int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    placed, _ = stored(entries.repartitionByRange(ranges, *keys, order).withColumn(
        "range_no", F.spark_partition_id()), "ranges")
    # one row per group and range
    group = Window.partitionBy(*keys)
    ahead = group.orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*keys, "range_no").agg(
        *[F.sum(m).alias(f"inside_{m}") for m in measures])
    totals = totals.select(
        *keys, "range_no", *[f"inside_{m}" for m in measures],
        *[F.coalesce(F.sum(f"inside_{m}").over(ahead), F.lit(0)).alias(f"before_{m}")
          for m in measures],
        *[F.sum(f"inside_{m}").over(group).alias(f"total_{m}") for m in measures])
    return _join_ranges(placed, totals, [*keys, "range_no"])


def prefix_sums(entries: DataFrame, keys: Sequence[str], order: str, measures: Sequence[str],
                ) -> DataFrame:
    """Sum each measure over the group's entries that sort strictly before the row.

    ``entries`` must hold one row per (keys, order). Adds ``prior_<m>`` and
    ``total_<m>``; with no keys the whole table is one group.
    """
    base, by = _with_keys(entries, keys)
    ranged = _ranged(base, by, order, measures)
    inside = Window.partitionBy(*by, "range_no").orderBy(order).rowsBetween(
        Window.unboundedPreceding, -1)
    out = ranged.select(
        *[c for c in entries.columns],
        *[(F.col(f"before_{m}") + F.coalesce(F.sum(m).over(inside), F.lit(0))).alias(f"prior_{m}")
          for m in measures],
        *[f"total_{m}" for m in measures],
    )
    return out


def row_positions(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                  name: str = "position") -> DataFrame:
    """Zero-based position of each row inside its group; ``order`` must be a total order.

    The same as ``row_number() - 1``, without one task per group. Only keys and order are dealt into ranges and
    stored; the positions are joined back to the rows, on keys and order, which no two rows share.
    """
    ordered = df.withColumn("__ord", F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])
                            if len(order) > 1 else order[0])
    narrow = ordered.select(*keys, "__ord").withColumn("__one", F.lit(1))
    placed = prefix_sums(narrow, keys, "__ord", ["__one"]).select(*keys, "__ord", F.col("prior___one").alias(name))
    return _join_ranges(ordered, placed, [*keys, "__ord"]).drop("__ord")


def exact_percentiles(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float],
                      weight: str | None = None, folded: bool = False) -> DataFrame:
    """Exact percentiles with linear interpolation, one row per group.

    ``probs`` maps an output column to a probability. Equal values are counted
    before the shuffle, and only value ranges that hold a wanted rank are sorted.
    ``weight`` names a column that says how many equal rows each row stands for. ``folded`` says that few rows of a
    group are equal any more: they are dealt as they are, because counting again would hold a task's rows in memory.
    """
    ranged, by = _folded_ranges(df, keys, value, weight, ["__n"], folded)
    return _picked(ranged, by, value, probs).select(*keys, *probs)


def described(df: DataFrame, keys: Sequence[str], value: str, probs: dict[str, float],
              weight: str | None = None) -> DataFrame:
    """count, mean, sample deviation, min, max and exact percentiles, one row per group; null keys are groups.

    Everything comes from one table of (group, value, count), which is dealt out and stored once.
    """
    ranged, by = _folded_ranges(df, keys, value, weight, ["__n", "__s"])
    mean = F.col("total___s") / F.col("total___n")
    n = F.sum("__n")
    moments = ranged.groupBy(*by).agg(
        n.alias("count"), F.max(mean).alias("mean"),
        F.when(n > 1, F.sqrt(F.sum(F.col("__n") * F.pow(F.col(value) - mean, F.lit(2))) / (n - 1))).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"))
    return _join_ranges(moments, _picked(ranged, by, value, probs), by).select(
        *keys, "count", "mean", "std", "min", "max", *probs)


def _folded_ranges(df, keys, value, weight, measures, folded=False):
    """Equal values counted (and summed) unless they are, dealt into ranges; and the keys that group them."""
    base, by = _with_keys(df.select(*keys, value, *([weight] if weight else [])), keys)
    known = base.filter(F.col(value).isNotNull())
    counted = known.withColumnRenamed(weight, "__n") if folded else known.groupBy(*by, value).agg(
        (F.sum(weight) if weight else F.count(F.lit(1))).alias("__n"))
    if "__s" in measures:
        counted = counted.withColumn("__s", F.col("__n") * F.col(value).cast("double"))
    return _ranged(counted, by, value, measures), by


def _picked(ranged, by, value, probs):
    """Percentiles of folded and ranged values; only ranges that hold a wanted rank are sorted."""
    def low(p: float) -> Column:
        return F.floor(F.lit(float(p)) * (F.col("total___n") - 1))

    def high(p: float) -> Column:
        return F.ceil(F.lit(float(p)) * (F.col("total___n") - 1))

    def holds(rank: Column, start: str, size: str) -> Column:
        return (rank >= F.col(start)) & (rank < F.col(start) + F.col(size))

    wanted = F.lit(False)
    for p in probs.values():
        wanted = wanted | holds(low(p), "before___n", "inside___n") | holds(
            high(p), "before___n", "inside___n")
    inside = Window.partitionBy(*by, "range_no").orderBy(value).rowsBetween(
        Window.unboundedPreceding, -1)
    ranked = ranged.filter(wanted).withColumn(
        "__start", F.col("before___n") + F.coalesce(F.sum("__n").over(inside), F.lit(0)))
    picked = ranked.groupBy(*by).agg(
        F.max("total___n").alias("total___n"),
        *[F.max(F.when(holds(rank(p), "__start", "__n"), F.col(value))).alias(f"{side}_{name}")
          for name, p in probs.items() for side, rank in (("lo", low), ("hi", high))],
    )
    return picked.select(
        *by,
        *[(F.col(f"lo_{name}") + (F.col(f"hi_{name}") - F.col(f"lo_{name}"))
           * (F.lit(float(p)) * (F.col("total___n") - 1) - low(p))).alias(name)
          for name, p in probs.items()],
    )


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the last by ``order``. An aggregate, so copies combine map-side."""
    return _edge_per_key(df, keys, order, F.max)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order``."""
    return _edge_per_key(df, keys, order, F.min)


def _edge_per_key(df, keys, order, edge):
    rest = [c for c in df.columns if c not in keys and c not in order]
    packed = df.groupBy(*keys).agg(edge(F.struct(*order, *rest)).alias("__row"))
    return packed.select(*[F.col(c) if c in keys else F.col(f"__row.`{c}`").alias(c)
                           for c in df.columns])


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int,
                  rank: str = "rk") -> DataFrame:
    """First k rows of each group by a total order; tasks keep k rows before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)


def keep_large_groups(df: DataFrame, keys: Sequence[str], minimum: int) -> DataFrame:
    """Rows of groups with at least ``minimum`` rows, by semi join on the group counts."""
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(
        F.col("__n") >= minimum).select(*keys)
    return df.join(large, list(keys), "left_semi")


def top_ranks(df: DataFrame, score: str, ranks: int) -> DataFrame:
    """Rows whose dense rank by descending score is at most ``ranks``."""
    best = df.select(score).distinct().orderBy(F.col(score).desc_nulls_last()).limit(ranks)
    return df.join(best, score, "left_semi")
