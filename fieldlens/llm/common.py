"""Shared pieces: the words of the contracts, reading tables, row identity, batches of bounded size."""

from __future__ import annotations

import gc
import itertools
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Fixed values of the contracts: a word is a run of characters other than these six.
BLANKS = " \t\n\x0b\x0c\r"
WORD = "[^\\x20\\x09-\\x0D]+"

# Texts handed to numpy at once; a longer text is a batch of its own.
BATCH_BYTES = 1 << 19


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def n_words(text: Column) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_key(text: Column) -> Column:
    """Tells apart different texts under one doc_id, and rows without one."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has."""
    while name.lower() in (c.lower() for c in df.columns):
        name += "_"
    return name


def pieces(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Slices of a batch that hold at most BATCH_BYTES characters, or one text."""
    begin = size = 0
    for i, t in enumerate(texts):
        more = len(t) if t else 0
        if i > begin and size + more > BATCH_BYTES:
            yield begin, i
            begin, size = i, 0
        size += more
    if begin < len(texts):
        yield begin, len(texts)


def map_texts(df: DataFrame, fn: Callable[[list[list]], list], schema: str) -> DataFrame:
    """Apply ``fn`` to slices of the columns of ``df``; ``text`` bounds the slices.

    ``fn`` gets one list per column of ``df`` and returns one list or array per output column.
    """
    names = df.columns
    at = names.index("text")
    out = pa_schema(df.sparkSession, schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for a, b in pieces(texts):
                cols = [texts[a:b] if k == at else batch.column(k).slice(a, b - a).to_pylist()
                        for k in range(len(names))]
                made = fn(cols)
                arrays = [x if isinstance(x, pa.Array) else pa.array(x, type=f.type)
                          for x, f in zip(made, out)]
                yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return df.mapInArrow(run, schema)


def pa_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def sorted_groups(batches: Iterable[pa.RecordBatch], n_keys: int) -> Iterator[tuple[tuple, list[list]]]:
    """Groups of a partition whose rows are sorted by their first ``n_keys`` columns, which are returned
    as the key, with lists of the other columns. One group is held at a time."""
    key, held = None, []
    for batch in batches:
        cols = [c.to_pylist() for c in batch.columns]
        keys = list(zip(*cols[:n_keys]))
        begin = 0
        for i in range(1, len(keys) + 1):
            if i < len(keys) and keys[i] == keys[begin]:
                continue
            part = [c[begin:i] for c in cols[n_keys:]]
            if key == keys[begin] and held:
                for have, more in zip(held, part):
                    have.extend(more)
            else:
                if held:
                    yield key, held
                key, held = keys[begin], part
            begin = i
    if held:
        yield key, held


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished plans now, not when the driver next collects its
    garbage: with intermediate results stored, nothing reads them again."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}


def ddl(fields: tuple[tuple[str, str], ...]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in fields)


def batched(rows: Iterable[tuple], fields: tuple[tuple[str, str], ...], size: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Record batches of up to ``size`` rows."""
    names, kinds = [n for n, _ in fields], [_ARROW[k] for _, k in fields]
    rows = iter(rows)
    while held := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
