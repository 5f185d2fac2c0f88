"""Reading files and describing them: delimited text, Parquet, JSON, named workspaces."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fieldlens.functions.clean import clean_name, null_tokens


def read_delimited(spark: SparkSession, path: str, sep: str = ";",
                   schema: T.StructType | None = None, nulls: bool = True) -> DataFrame:
    """Delimited text with a header; every column is text unless a schema is given.

    Names lose the byte-order mark and blanks, bad bytes are replaced, and the
    usual spellings of a missing value become null (SRC-1, SRC-6).
    """
    reader = spark.read.option("sep", sep).option("header", True).option("encoding", "UTF-8")
    df = (reader.schema(schema) if schema else reader).csv(path)
    df = df.toDF(*[clean_name(c) for c in df.columns])
    return null_tokens(df) if nulls else df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table (SRC-3)."""
    return spark.read.parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, by the file system it belongs to; other errors come through."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def mark(spark: SparkSession, paths: Sequence[str]) -> str:
    """A mark that changes when one of the paths, its size, its number of files or its time changes.

    Reads no data and lists no file names, so it stays small however many files there are.
    """
    facts = []
    for path in paths:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        size = files.getContentSummary(target)
        facts.append((files.makeQualified(target).toString(), size.getLength(), size.getFileCount(),
                      files.getFileStatus(target).getModificationTime()))
    return hashlib.sha256(repr(facts).encode()).hexdigest()[:24]


def read_json_document(spark: SparkSession, path: str,
                       schema: T.StructType | None = None) -> DataFrame:
    """One JSON document per file (SRC-7)."""
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def describe(df: DataFrame) -> DataFrame:
    """Position, name and type of each column; reads no data (SRC-8)."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields, 1)]
    return df.sparkSession.createDataFrame(
        rows, "position int, column_name string, column_type string")


def open_workspace(spark: SparkSession, folders: Mapping[str, str]) -> DataFrame:
    """Bind names to Parquet paths as temp views and report which exist (SRC-4)."""
    report = []
    for name, path in folders.items():
        exists = path_exists(spark, path)
        if exists:
            spark.read.parquet(path).createOrReplaceTempView(name)
        report.append((name, path, exists))
    return spark.createDataFrame(report, "name string, path string, present boolean")


def register_table(spark: SparkSession, name: str, path: str, columns: Mapping[str, str],
                   partitioned_by: tuple[str, ...] = (),
                   properties: Mapping[str, str] | None = None) -> None:
    """External Parquet table with location, partition columns and properties (SRC-5, SNK-6)."""
    cols = ", ".join(f"`{c}` {t}" for c, t in columns.items())
    parts = f" PARTITIONED BY ({', '.join(partitioned_by)})" if partitioned_by else ""
    props = ", ".join(f"'{k}' = '{v}'" for k, v in (properties or {}).items())
    tail = f" TBLPROPERTIES ({props})" if props else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{parts} "
              f"LOCATION '{path}'{tail}")
    if partitioned_by:
        spark.catalog.recoverPartitions(name)


def footer_summary(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Rows, smallest and largest value of a numeric column of a Parquet table, from the files' footers (SRC-9).

    The aggregates go into the scan, so no data page is read. A session of its own reads the table by the
    reader that can do so; other queries keep theirs.
    """
    reader = spark.newSession()
    reader.conf.set("spark.sql.sources.useV1SourceList", "")
    reader.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return reader.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"), F.min(column).alias("lowest"), F.max(column).alias("highest"))


def file_rows(df: DataFrame) -> DataFrame:
    """Rows per source file, from the scan's own metadata (SRC-9)."""
    return df.select(F.col("_metadata.file_path").alias("file_path")).groupBy("file_path").agg(
        F.count(F.lit(1)).alias("n_rows"))
