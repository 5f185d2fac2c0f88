"""Data contracts: required columns and values, duplicates, quarantine, profiles, integrity."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fieldlens.functions.clean import blank_to_null, clean_names, promote_numeric


@dataclass(frozen=True)
class Contract:
    """What a table must satisfy. ``invalid`` marks rows whose values break a rule."""
    dataset: str
    required_columns: Sequence[str]
    not_null: Sequence[str]
    unique_key: Sequence[str]
    invalid: Sequence[Column] = field(default_factory=tuple)


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions],
                  F.lit(False))


def require_columns(df: DataFrame, columns: Sequence[str], dataset: str = "table") -> DataFrame:
    """The table itself, or an error that names the missing columns (QLT-3)."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{dataset}: required columns are missing: {', '.join(missing)}")
    return df


def missing_required(contract: Contract) -> Column:
    return _any([F.col(c).isNull() for c in contract.not_null])


def outside(value: Column, low: float, high: float) -> Column:
    """Present but not within the closed range."""
    return value.isNotNull() & ~value.between(low, high)


def flagged(df: DataFrame, contract: Contract) -> DataFrame:
    """Rows with ``required_null`` and ``invalid_value`` marks (QLT-4, QLT-7)."""
    require_columns(df, contract.required_columns, contract.dataset)
    return df.withColumns({"required_null": missing_required(contract),
                           "invalid_value": _any(contract.invalid)})


def quarantine(df: DataFrame, contract: Contract, sep: str = "|") -> DataFrame:
    """Rejected rows with their reasons; the source is left as it is (QLT-8)."""
    marks = flagged(df, contract).filter("required_null OR invalid_value")
    reason = F.concat_ws(sep, F.when(F.col("required_null"), F.lit("required_null")),
                         F.when(F.col("invalid_value"), F.lit("invalid_value")))
    return marks.withColumn("quality_reason", reason).drop("required_null", "invalid_value")


def accepted(df: DataFrame, contract: Contract) -> DataFrame:
    """The rows that pass; with the quarantine they make up the source."""
    return flagged(df, contract).filter("NOT (required_null OR invalid_value)").drop(
        "required_null", "invalid_value")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by several rows, with the number of rows (QLT-5)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def rows_with_duplicate_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose key is not unique; null counts as a key value.

    A join on the repeated keys, not a window: skewed keys can be split.
    """
    repeated = duplicate_keys(df, keys).select(*[F.col(k).alias(f"__{k}") for k in keys])
    condition = reduce(lambda a, b: a & b, [df[k].eqNullSafe(repeated[f"__{k}"]) for k in keys])
    return df.join(repeated, condition, "left_semi")


def digest(columns: Sequence[str | Column]) -> Column:
    """128 bits that stand for a list of values, nulls included: long values never enter a shuffle key."""
    parts = []
    for c in columns:
        c = F.col(f"`{c}`") if isinstance(c, str) else c
        parts += [c, c.isNull()]
    return F.struct(*[F.xxhash64(F.lit(seed), *parts).alias(name) for seed, name in ((1, "a"), (2, "b"))])


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Excess copies of fully equal rows, in one row (QLT-6)."""
    copies = df.select(digest(df.columns).alias("row")).groupBy("row").agg(F.count(F.lit(1)).alias("__n"))
    return copies.agg(F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).alias("full_duplicates"))


def contract_report(df: DataFrame, contract: Contract) -> DataFrame:
    """One row of counts for one table (QLT-9).

    Equal rows are folded into one with their count first; duplicate rows, duplicate keys and broken
    rules are then sums over the folded rows. Rows and keys are shuffled as digests.
    """
    marked = flagged(df, contract).select(
        digest(df.columns).alias("row"), digest(contract.unique_key).alias("key"), "invalid_value", "required_null")
    folded = marked.groupBy(*marked.columns).agg(F.count(F.lit(1)).alias("__n"))
    n = F.col("__n")

    def rows(condition: Column) -> Column:
        return F.sum(F.when(condition, n).otherwise(0))

    bad, gone = F.col("invalid_value"), F.col("required_null")
    per_key = folded.groupBy("key").agg(
        F.sum(n).alias("__rows"), F.sum(n - 1).alias("__copies"), rows(gone).alias("__null"),
        rows(bad).alias("__bad"), rows(gone | bad).alias("__held"))

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0).cast("bigint"))

    return per_key.agg(
        total(F.col("__rows")).alias("n_rows"), total(F.col("__copies")).alias("full_duplicates"),
        total(F.when(F.col("__rows") > 1, F.col("__rows"))).alias("duplicate_key_rows"),
        total(F.col("__null")).alias("required_null_rows"),
        total(F.col("__bad")).alias("invalid_value_rows"),
        total(F.col("__held")).alias("quarantined_rows"),
    ).select(
        F.lit(contract.dataset).alias("dataset"), F.lit(len(df.columns)).alias("n_columns"), "*",
        F.round(F.try_divide("quarantined_rows", "n_rows"), 6).alias("quarantine_rate"),
        F.when(F.col("quarantined_rows") == 0, "PASS").otherwise("QUARANTINE").alias("status"))


def contract_totals(reports: DataFrame) -> DataFrame:
    """Sums over all tables."""
    return reports.agg(*[F.sum(c).alias(c) for c in (
        "n_rows", "full_duplicates", "duplicate_key_rows", "quarantined_rows")])


def null_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Nulls and NaNs of the listed columns, in one pass, as rows (QLT-14)."""
    types = dict(df.dtypes)

    def missing(c: str) -> Column:
        gone = F.col(c).isNull()
        return gone | F.isnan(c) if types[c] in ("double", "float") else gone

    counts = df.agg(F.count(F.lit(1)).alias("n_rows"),
                    *[F.count_if(missing(c)).alias(c) for c in columns])
    return counts.unpivot("n_rows", list(columns), "column_name", "nulls").select(
        "column_name", "nulls",
        F.round(F.try_divide(F.lit(100.0) * F.col("nulls"), "n_rows"), 1).alias("pct"))


def sparse_columns(df: DataFrame, share: float = 0.95) -> DataFrame:
    """Columns that are null in more than ``share`` of the rows (QLT-10)."""
    rates = df.agg(F.count(F.lit(1)).alias("n_rows"),
                   *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return rates.unpivot("n_rows", list(df.columns), "column_name", "nulls").filter(
        F.col("nulls") > share * F.col("n_rows")).select(
        "column_name", F.round(F.lit(100.0) * F.col("nulls") / F.col("n_rows"), 1).alias("pct"))


# Types of at most 64 bits: a 64-bit hash that can be inverted stands for the value itself.
_SHORT = ("boolean", "byte", "short", "integer", "long", "float", "double", "date", "timestamp", "timestamp_ntz")


def cell_value(f) -> Column:
    """The value of a field as it counts among distinct values: one zero, not two."""
    value = F.col(f"`{f.name}`")
    return value + 0.0 if f.dataType.typeName() in ("double", "float") else value


def _cells(number: int, df: DataFrame) -> DataFrame:
    """Number of the table, number of the column and one or two hashes of the typed value, never text; null has no hash.

    Values of up to 64 bits need one hash, which is exact; others have 128 bits.
    """
    def cell(i: int, f) -> Column:
        value = cell_value(f)
        second = F.lit(0).cast("long") if f.dataType.typeName() in _SHORT else F.xxhash64(F.lit(2), value)
        return F.struct(F.lit(number).alias("d"), F.lit(i).alias("i"), F.when(value.isNotNull(), F.xxhash64(value)).alias("a"),
                        F.when(value.isNotNull(), second).alias("b"))
    return df.select(F.inline(F.array(*[cell(i, f) for i, f in enumerate(df.schema.fields)])))


def column_counts(tables: Mapping[str, DataFrame], empty_is_null: bool = False) -> DataFrame:
    """Type, rows, nulls and distinct values of every column of every table: dataset, column_name, dtype, n_rows, nulls, uniques.

    Each table is scanned once and all of them go through one shuffle, in which equal cells of a task are one row with
    their number; rows, nulls and distinct values follow from these. With ``empty_is_null`` an empty
    text counts as missing too (and still as a value). Columns of an empty table have zeros.
    """
    spark = next(iter(tables.values())).sparkSession
    cells = reduce(lambda a, b: a.unionByName(b), [_cells(k, df) for k, df in enumerate(tables.values())])
    counted = cells.groupBy("d", "i", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    blank = F.lit(False)
    if empty_is_null:
        texts = F.array(*[F.struct(F.lit(k).alias("d"), F.lit(i).alias("i")) for k, df in enumerate(tables.values())
                          for i, f in enumerate(df.schema.fields) if f.dataType.simpleString() == "string"] or [F.lit(None)])
        blank = F.array_contains(texts, F.struct("d", "i")) & (F.col("a") == F.xxhash64(F.lit(""))) & (F.col("b") == F.xxhash64(F.lit(2), F.lit("")))
    facts = counted.groupBy("d", "i").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(F.col("a").isNull() | blank, F.col("n")).otherwise(0)).alias("nulls"),
        F.count("a").alias("uniques"))
    names = [(k, i, name, f.name, f.dataType.simpleString()) for k, (name, df) in enumerate(tables.items()) for i, f in enumerate(df.schema.fields)]
    known = spark.createDataFrame(names, "d int, i int, dataset string, column_name string, dtype string")
    return known.join(facts, ["d", "i"], "left").fillna(0, ["n_rows", "nulls", "uniques"]).drop("d", "i")


def distinct_values(df: DataFrame) -> DataFrame:
    """Distinct values of every column that has any (column_name, uniques)."""
    return column_counts({"": df}).filter("uniques > 0").select("column_name", "uniques")


def profile_columns(df: DataFrame) -> DataFrame:
    """Nulls and empties, their share, and distinct values per column (QLT-1, AGG-16).

    Numeric columns also get min, max and mean; see ``top_values`` for text columns.
    """
    out = column_counts({"": df}, empty_is_null=True).drop("dataset")
    numeric = [f.name for f in df.schema.fields if f.dataType.typeName() in (
        "byte", "short", "integer", "long", "float", "double", "decimal")]
    if numeric:
        ranges = df.agg(*[F.struct(F.lit(c).alias("column_name"),
                                   F.min(c).cast("double").alias("min"),
                                   F.max(c).cast("double").alias("max"),
                                   F.round(F.avg(c), 4).alias("mean")).alias(c) for c in numeric])
        ranges = ranges.select(F.inline(F.array(*[F.col(f"`{c}`") for c in numeric])))
        out = out.join(ranges, "column_name", "left")
    return out.withColumn("pct_null", F.round(F.try_divide(F.lit(100.0) * F.col("nulls"), "n_rows"), 2))


def top_values(df: DataFrame, k: int = 5) -> DataFrame:
    """Most frequent values of each text column, ties in text order."""
    from fieldlens.operators.ranking import top_per_group
    texts = [f for f in df.schema.fields if f.dataType.simpleString() == "string"]
    cells = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col(f"`{f.name}`").alias("value")) for f in texts])
    counted = df.select(F.inline(cells)).filter(F.col("value").isNotNull()).groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n"))
    return top_per_group(counted, ["column_name"], [F.col("n").desc(), F.col("value")], k)


def orphan_keys(child: DataFrame, child_keys: Sequence[str], parent: DataFrame,
                parent_keys: Sequence[str], relation: str) -> DataFrame:
    """Distinct child keys without a parent, in one row (JN-10, JN-11, SET-1).

    Keys are reduced to their distinct values before the anti join.
    """
    names = [f"k{i}" for i in range(len(child_keys))]
    kids = child.select(*[F.col(c).alias(n) for c, n in zip(child_keys, names)]).dropna().distinct()
    parents = parent.select(*[F.col(c).alias(n) for c, n in zip(parent_keys, names)])
    known = parents.distinct().withColumn("known", F.lit(1))
    return kids.join(known, names, "left").agg(
        F.count(F.lit(1)).alias("n_keys"), F.count_if(F.col("known").isNull()).alias("orphans"),
    ).select(F.lit(relation).alias("relation"), "n_keys", "orphans")


def unknown_codes(df: DataFrame, column: str, labels: Mapping[str, str]) -> DataFrame:
    """Codes met in the data, with a mark for those outside the dictionary (QLT-13)."""
    code = F.upper(F.trim(F.col(column).cast("string")))
    return df.filter(F.col(column).isNotNull()).groupBy(code.alias("code")).agg(
        F.count(F.lit(1)).alias("n_rows")).withColumn("known", F.col("code").isin(*labels))


def route(df: DataFrame, column: str, routes: Mapping[str, str],
          name: str = "route") -> DataFrame:
    """Name the destination of each row; what matches nothing is ``unmatched`` (QLT-11)."""
    label = F.lit("unmatched")
    for value, target in routes.items():
        label = F.when(F.col(column) == value, F.lit(target)).otherwise(label)
    return df.withColumn(name, label)


def write_routes(routed: DataFrame, folder: str, name: str = "route") -> None:
    """One Parquet folder per route in a single job; unmatched rows stop it."""
    checked = routed.withColumn(name, F.when(F.col(name) != "unmatched", F.col(name)).otherwise(
        F.raise_error(F.lit("rows without a route"))))
    checked.write.mode("overwrite").partitionBy(name).parquet(folder)


def run_flow(df: DataFrame, steps: Sequence[tuple[str, Callable[[DataFrame], DataFrame]]],
             path: str) -> dict[str, int]:
    """Apply the steps in order, write the result once, return the rows seen by each (QLT-12).

    A failing step raises and nothing is written.
    """
    seen = [("source", Observation("source"))]
    current = df.observe(seen[0][1], F.count(F.lit(1)).alias("rows"))
    for label, step in steps:
        watch = Observation(label)
        current = step(current).observe(watch, F.count(F.lit(1)).alias("rows"))
        seen.append((label, watch))
    current.write.mode("overwrite").parquet(path)
    return {label: watch.get["rows"] for label, watch in seen}


def light_transform(df: DataFrame) -> DataFrame:
    """Upper-case names, empty text to null, mostly numeric text to numbers."""
    named = clean_names(df, upper=True)
    blanks = named.select(*[
        blank_to_null(F.col(f"`{f.name}`")).alias(f.name)
        if f.dataType.simpleString() == "string" else F.col(f"`{f.name}`")
        for f in named.schema.fields])
    return promote_numeric(blanks)


def row_key_report(df: DataFrame, key: str) -> DataFrame:
    """Rows received, rejected for a null key, inserted, and key collisions (QLT-15, SNK-8)."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("bigint")
    return per_key.agg(
        F.coalesce(F.sum("n"), zero).alias("received"),
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), zero).alias("rejected"),
        F.coalesce(F.sum(F.when(F.col(key).isNotNull(), F.col("n"))), zero).alias("inserted"),
        F.coalesce(F.sum(F.when(F.col(key).isNotNull(), F.col("n") - 1)), zero)
        .alias("collisions"))


def require_no_duplicates(df: DataFrame) -> DataFrame:
    """The table itself, or an error when it has equal rows (QLT-16)."""
    copies = duplicate_rows(df).first()["full_duplicates"]
    if copies:
        raise ValueError(f"{copies} duplicate rows in the export")
    return df


def shared_groups(left: DataFrame, right: DataFrame, group: str) -> DataFrame:
    """Groups present on both sides, counted (JN-12, SET-2, QLT-17)."""
    both = left.select(group).dropna().distinct().join(
        right.select(group).distinct(), group, "left_semi")
    return both.agg(F.count(F.lit(1)).alias("overlap"))


def require_disjoint_groups(train: DataFrame, test: DataFrame, group: str) -> None:
    overlap = shared_groups(train, test, group).first()["overlap"]
    if overlap:
        raise ValueError(f"{overlap} groups appear in both training and test rows")
