"""Writing results: layers, delimited text, JSON, keyed tables, ingestion jobs."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fieldlens.operators.quality import Contract, accepted, quarantine
from fieldlens.sources.keyed import KeyedTable
from fieldlens.sources.tables import path_exists, read_delimited


def save_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a Parquet table (SNK-1).

    With partition columns the rows are rebalanced on them: Spark merges small
    partition values and splits a large one over several tasks by size (SNK-6).
    """
    if not partition_by:
        df.write.mode("overwrite").parquet(path)
        return
    spread = df.hint("rebalance", *[F.col(c) for c in partition_by])
    spread.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_delimited(df: DataFrame, path: str, sep: str = ";", bom: bool = False) -> None:
    """Delimited text with a header in every part file, with or without a byte-order mark (SNK-2)."""
    named = df.withColumnRenamed(df.columns[0], "\ufeff" + df.columns[0]) if bom else df
    named.write.mode("overwrite").option("sep", sep).option("header", True).option(
        "encoding", "UTF-8").csv(path)


def write_report(df: DataFrame, path: str) -> None:
    """A one-row report as a JSON document (SNK-3). More or fewer rows are an error, and nothing is written."""
    rows = df.take(2)
    if len(rows) != 1:
        raise ValueError("a report has exactly one row")
    df.sparkSession.createDataFrame(rows, df.schema).coalesce(1).write.mode("overwrite").json(path)


def write_json_array(df: DataFrame, path: str, first: int, order: Sequence[str]) -> None:
    """The first rows as one JSON array; the cap is the point of this file (SNK-4)."""
    capped = df.orderBy(*order).limit(first)
    array = capped.agg(F.to_json(F.array_sort(F.collect_list(F.struct(*df.columns)))).alias("value"))
    array.coalesce(1).write.mode("overwrite").text(path)


def append_json_lines(df: DataFrame, path: str) -> None:
    """Add rows to a JSON-lines history (SNK-5)."""
    df.write.mode("append").json(path)


def put_last(df: DataFrame, keys: Sequence[str], order: Sequence[str], path: str) -> None:
    """Keyed put: the last write per key remains, and keys outside the batch stay (SNK-7).

    Within the batch ``order`` decides; a batch row replaces a stored one. ``read_last`` reads the table.
    """
    KeyedTable(df.sparkSession, path, keys).put(df, order)


def read_last(spark: SparkSession, keys: Sequence[str], path: str) -> DataFrame:
    """The table that ``put_last`` writes."""
    return KeyedTable(spark, path, keys).read()


def _same_keys(left: DataFrame, renamed: DataFrame, keys: Sequence[str]):
    condition = F.lit(True)
    for k in keys:
        condition = condition & left[k].eqNullSafe(renamed[f"__{k}"])
    return condition


def append_keyed(df: DataFrame, keys: Sequence[str], path: str) -> int:
    """Append rows whose keys are new, or refuse them all (SNK-8). Returns the rows written.

    Null is a key like any other. A target that is there but cannot be read is an error.
    """
    spark = df.sparkSession
    repeated = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count()
    if repeated:
        raise ValueError("row-key collisions inside the batch")
    if path_exists(spark, path):
        old = spark.read.parquet(path).select(*[F.col(k).alias(f"__{k}") for k in keys])
        if df.join(old, _same_keys(df, old, keys), "left_semi").limit(1).count():
            raise ValueError("row keys are stored already")
    watch = Observation("append")
    df.observe(watch, F.count(F.lit(1)).alias("rows")).write.mode("append").parquet(path)
    return watch.get["rows"]


def write_split(df: DataFrame, contract: Contract, folder: str) -> None:
    """Accepted rows and quarantine, the latter also as delimited text (SNK-10)."""
    accepted(df, contract).write.mode("overwrite").parquet(f"{folder}/accepted")
    quarantine(df, contract).write.mode("overwrite").parquet(f"{folder}/quarantine")
    write_delimited(df.sparkSession.read.parquet(f"{folder}/quarantine"),
                    f"{folder}/quarantine_csv", bom=True)


def ingest(spark: SparkSession, sources: Mapping[str, str], folder: str, sep: str = ";",
           tasks: int | None = None) -> DataFrame:
    """Import delimited sources to Parquet and report each job (SRC-2).

    The rows are counted while they are written. A missing source stops the run.
    """
    report = []
    for name, path in sources.items():
        start = time.time()
        df = read_delimited(spark, path, sep)
        df = df.repartition(tasks) if tasks else df
        watch = Observation(name)
        target = f"{folder}/{name}"
        df.observe(watch, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(target)
        report.append((name, path, target, watch.get["rows"], len(df.columns),
                       round(time.time() - start, 3), "SUCCEEDED"))
    return spark.createDataFrame(
        report, "name string, source string, target string, n_rows long, n_columns int, "
                "seconds double, status string")
