"""Assembly of the long fact table: unpivot, pivots and the chain of left joins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fieldlens.operators.ranking import first_per_key


def unpivot_traits(wide: DataFrame, traits: Mapping[str, str], trait: str = "trait",
                   value: str = "result_num") -> DataFrame:
    """One row per measured trait. ``traits`` maps the trait name to its column.

    A single trait needs no row expansion and stays a projection, so filters and
    column pruning reach the scan.
    """
    rest = [c for c in wide.columns if c not in traits.values()]
    if len(traits) == 1:
        (name, column), = traits.items()
        return wide.select(*rest, F.lit(name).alias(trait), F.col(column).alias(value))
    pairs = [F.struct(F.lit(n).alias(trait), F.col(c).alias(value)) for n, c in traits.items()]
    return wide.select(*rest, F.inline(F.array(*pairs)))


def attach(base: DataFrame, dim: DataFrame, keys: Sequence[str],
           null_safe: bool = False) -> DataFrame:
    """Left join that keeps every base row; a missing key matches nothing unless ``null_safe``."""
    if not null_safe:
        return base.join(dim, list(keys), "left")
    renamed = dim.withColumnsRenamed({k: f"__{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & base[k].eqNullSafe(renamed[f"__{k}"])
    return base.join(renamed, condition, "left").drop(*[f"__{k}" for k in keys])


def pivot_first(df: DataFrame, keys: Sequence[str], column: str, value: str,
                names: Sequence[str] | None = None) -> DataFrame:
    """Attribute rows to columns, keeping the smallest value of repeats (AGG-17).

    Null attribute names are dropped. Name the columns when they are known: it
    saves the pass that looks for them.
    """
    named = df.filter(F.col(column).isNotNull())
    grouped = named.groupBy(*keys)
    pivoted = grouped.pivot(column, list(names)) if names else grouped.pivot(column)
    return pivoted.agg(F.min(value))


def pivot_mean(df: DataFrame, keys: Sequence[str], column: str, value: str,
               names: Sequence[str] | None = None) -> DataFrame:
    """Trait rows to columns, averaging repeats (AGG-18).

    With ``names``, all traits of a unit fold into one row before the only shuffle; without, each trait is a row of it.
    """
    grouped = df.filter(F.col(value).isNotNull()).groupBy(*keys)
    if not names:
        return grouped.pivot(column).agg(F.avg(value))
    return grouped.agg(*[F.avg(F.when(F.col(column) == n, F.col(value))).alias(n) for n in names])


def assemble_fact(results: DataFrame, trials: DataFrame, plots: DataFrame, materials: DataFrame,
                  qualifications: DataFrame, *, trial_key: Sequence[str],
                  plot_keys: Sequence[str], material_key: Sequence[str],
                  qualification_keys: Sequence[str]) -> DataFrame:
    """Results left-joined to trials, plots, materials and qualifications (JN-1 to JN-5).

    No result row is lost. Plots may hold several materials for one key: that
    fan-out is part of the data and is kept. Materials are cut to one row per
    key in a fixed order. Small dimensions are broadcast by Spark when their
    measured size allows; otherwise the joins shuffle and split skewed keys.

    The results stay narrow as long as they move: plots and materials come first, and the trials last, with their
    qualifications joined to them before, where the keys of these are columns of the trials.
    """
    rest = [c for c in materials.columns if c not in material_key]
    late = [c for c in qualifications.columns if c not in qualification_keys]
    of_trials = all(k in trials.columns and k not in trial_key for k in qualification_keys)
    if of_trials:
        trials = attach(trials, qualifications, qualification_keys)
    alone = plots.repartition(*plot_keys).distinct()       # dealt out once, by what the join needs
    first = all(k in results.columns for k in plot_keys) and not set(material_key) & set(trials.columns)
    fact = results if first else attach(results, trials, trial_key)
    fact = attach(fact, alone, plot_keys)
    fact = attach(fact, first_per_key(materials, material_key, rest), material_key)
    if first:
        fact = attach(fact, trials, trial_key)
    if not of_trials:
        fact = attach(fact, qualifications, qualification_keys)
    middle = [c for c in trials.columns if c not in trial_key and c not in late]
    own = [c for c in plots.columns if c not in plot_keys]
    return fact.select(*results.columns, *middle, *own, *[c for c in rest if c not in own], *late)
