"""Line dedup over overlapping three-line windows.

A window is three consecutive lines of a document, compared as trimmed text. The first place of a
window (smallest doc_id, then text hash, then line) stays; at every later place its three lines are
removed. Lines that several windows cover are removed once. Windows are judged on the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm.common import fresh, query, table, text_key

LINES = 3


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row."""
    return F.transform(F.array(value), body)[0]


def window_keys(text: Column) -> Column:
    """Keys of the windows of a text in order: two independent 64-bit hashes; null for blank windows."""
    def keys(lines: Column) -> Column:
        count = F.size(lines) - (LINES - 1)

        def key(i: Column) -> Column:
            parts = [F.trim(F.get(lines, i + k)) for k in range(LINES)]
            blank = F.concat(*parts) == ""
            return F.when(~blank, F.struct(F.xxhash64(*parts).alias("a"),
                                           F.xxhash64(F.lit(7), *parts).alias("b")))
        return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), key))
    return let(F.split(text, "\n"), keys)


def removed_lines(docs: DataFrame) -> DataFrame:
    """Lines to remove (0 is the first): doc_id, text_key, lines array<int>, for documents that lose any.

    Only window keys are shuffled. Counting is map-side combined, so a window that a third of all
    documents share is a few rows per task; its places join the few repeated keys, a join whose hot
    key Spark can split.
    """
    places = docs.select("doc_id", text_key(F.col("text")).alias("text_key"),
                         F.posexplode(window_keys(F.col("text"))).alias("line", "key")).filter("key IS NOT NULL")
    places = places.select("doc_id", "text_key", "line", "key.a", "key.b")
    place = F.struct("doc_id", "text_key", "line")
    first = places.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last")) \
        .filter("first != last").select(F.col("a").alias("first_a"), F.col("b").alias("first_b"), "first")
    later = places.join(first, (F.col("a") == F.col("first_a")) & (F.col("b") == F.col("first_b"))) \
        .filter(place != F.col("first"))
    return later.groupBy("doc_id", "text_key").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_set(
        F.sequence(F.col("line"), F.col("line") + (LINES - 1)))))).alias("lines"))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated windows cut from ``text``, plus n_lines and n_removed_lines.

    A null text stays null with no lines; a text of fewer than three lines stays as it is, as do
    windows of blank lines. A text whose lines all go becomes empty. Rows that repeat doc_id and text
    are one document: all of them keep what the document keeps. Different texts under one doc_id, or
    without one, count in the order of their text hash; null ids come first. Other columns pass through; if one
    has the name of a count, the count is named with underscores behind (``fresh`` tells the name).
    """
    cut = removed_lines(docs).select(F.col("doc_id").alias("cut_id"), F.col("text_key").alias("cut_key"),
                                     F.col("lines").alias("cut_lines"))
    joined = docs.join(cut, docs["doc_id"].eqNullSafe(cut["cut_id"]) & (text_key(docs["text"]) == cut["cut_key"]), "left")
    # A map of the removed lines, for a lookup per line whose cost does not grow with their number.
    kept = let(F.map_from_arrays(cut["cut_lines"], cut["cut_lines"]),
               lambda gone: F.filter(F.split(docs["text"], "\n"), lambda _, i: F.element_at(gone, i).isNull()))
    text = F.when(cut["cut_lines"].isNull(), docs["text"]).otherwise(F.array_join(kept, "\n"))
    return joined.select(
        *[text.alias(c) if c == "text" else docs[c] for c in docs.columns],
        F.coalesce(F.size(F.split(docs["text"], "\n")), F.lit(0)).cast("long").alias(fresh(docs, "n_lines")),
        F.coalesce(F.size(cut["cut_lines"]), F.lit(0)).cast("long").alias(fresh(docs, "n_removed_lines")))


_SQL = """
WITH l AS (
  SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
p AS (
  SELECT doc_id, lines, unnest(range(0, greatest(len(lines) - 2, 0))) AS line FROM l),
k AS (
  SELECT doc_id, line, [trim(lines[line + 1], ' '), trim(lines[line + 2], ' '), trim(lines[line + 3], ' ')] AS w FROM p),
n AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY w ORDER BY doc_id, line) AS nth
  FROM k WHERE array_to_string(w, '') <> ''),
g AS (
  SELECT DISTINCT doc_id, line + unnest([0, 1, 2]) AS line FROM n WHERE nth > 1),
c AS (
  SELECT doc_id, list(line ORDER BY line) AS gone FROM g GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(l.lines), 0) AS BIGINT) AS n_lines,
       CAST(coalesce(len(c.gone), 0) AS BIGINT) AS n_removed_lines,
       CASE WHEN c.gone IS NULL THEN d.text ELSE
         array_to_string([l.lines[i + 1] FOR i IN range(0, len(l.lines)) IF NOT list_contains(c.gone, i)], chr(10)) END AS text
FROM documents d JOIN l ON d.doc_id = l.doc_id LEFT JOIN c ON d.doc_id = c.doc_id
"""


@query("op2_line_windows", _SQL)
def op2_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_removed_lines", "text")
