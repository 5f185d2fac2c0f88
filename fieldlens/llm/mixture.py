"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies: its source's target over its
source's size. Documents are put in a fixed order within the source, expected copies are summed
along it, one random offset per source is added, and a document is emitted once for each integer
the running sum crosses. Copies of a document therefore differ from the expectation by less than
one, and any stretch of the order by less than one document. Ordering by size first makes every
size class get its share of copies, so words come as near their target as copies do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldlens.llm.common import WORD, fresh, n_words, query, table

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2


def offset(source: Column) -> Column:
    """The source's random offset in [0, 1), from a digest: reruns agree."""
    digits = F.substring(F.md5(F.concat(F.lit("offset:"), F.coalesce(source, F.lit("\u0001null")))), 1, 8)
    return F.conv(digits, 16, 10).cast("long") / F.lit(4294967296.0)


def order_key(doc_id: Column, text: Column) -> Column:
    return F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"),
                          F.coalesce(text, F.lit(""))))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Targets per source (columns source, source_size, target).

    Sources by code point, null last, weigh ``weights`` in turn and divide ``share`` of all words.
    A target above ``cap`` times its source's size stops there; the excess goes to the others by
    weight. With sources ordered by size per weight, those that stop are the first ones, and the
    level is found by running sums. The windows hold one row per source, never documents.
    """
    everything = Window.orderBy(F.col("source").isNull(), "source")
    n = len(weights)
    numbered = sizes.withColumn("place", F.row_number().over(everything) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % n + 1).cast("int")))
    rising = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(0))
    level = (numbered
             .withColumn("total", F.sum("source_size").over(whole).cast("double"))
             .withColumn("weights", F.sum("weight").over(whole))
             .withColumn("full", F.coalesce(F.sum("source_size").over(before), F.lit(0)) * float(cap))
             .withColumn("past", F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
             .withColumn("level", (F.col("total") * float(share) - F.col("full"))
                         / (F.col("weights") - F.col("past")))
             .withColumn("room", F.col("source_size") * float(cap) / F.col("weight"))
             .withColumn("open_level", F.when(F.col("level") <= F.col("room"), F.col("level")))
             .withColumn("final", F.first("open_level", ignorenulls=True).over(
                 rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    bound = F.col("source_size") * float(cap)
    return level.select("source", "source_size", F.when(
        F.col("final").isNull() | (F.col("final") > F.col("room")), bound).otherwise(
        F.least(F.col("final") * F.col("weight"), bound)).alias("target"))


def systematic_copies(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source): doc_id, mix_source, size, source_size, target, copies.

    A null text has size 0, a null source is a source of its own. Rows equal in doc_id, source and
    text take neighbouring places; which of them gets the additional copy makes no difference.
    Documents without words take places but no words. No rows in, no rows out.

    The place of a document is a sum of three bounded windows: over the distinct sizes of a source,
    over at most 4096 digest prefixes of one size, and over the rows of one prefix. A source with a
    third of all rows is thus never sorted in one task.
    """
    slim = docs.select(
        F.col("doc_id"), F.col("source").alias("mix_source"), n_words(F.col("text")).alias("size"),
        order_key(F.col("doc_id"), F.col("text")).alias("digest"))
    slim = slim.withColumn("cell", F.substring("digest", 1, 3))
    keys = ["mix_source", "size"]
    cells = slim.groupBy(*keys, "cell").agg(F.count(F.lit(1)).alias("rows"))
    sizes = cells.groupBy(*keys).agg(F.sum("rows").alias("rows"))
    sources = sizes.groupBy("mix_source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    targets = source_targets(sources.withColumnRenamed("mix_source", "source"), weights, share, cap)
    earlier = (Window.unboundedPreceding, -1)
    by_size = sizes.select(*keys, F.coalesce(F.sum("rows").over(
        Window.partitionBy("mix_source").orderBy("size").rowsBetween(*earlier)), F.lit(0)).alias("at_size"))
    by_cell = cells.select(*keys, "cell", F.coalesce(F.sum("rows").over(
        Window.partitionBy(*keys).orderBy("cell").rowsBetween(*earlier)), F.lit(0)).alias("at_cell"))
    same = lambda a, b, names: [a[k].eqNullSafe(b[k]) for k in names]
    start = by_cell.join(by_size, same(by_cell, by_size, keys)).select(
        by_cell["mix_source"], by_cell["size"], by_cell["cell"],
        (F.col("at_size") + F.col("at_cell")).alias("before"))
    rated = start.join(targets, start["mix_source"].eqNullSafe(targets["source"])).drop("source")
    placed = slim.withColumn("nth", F.row_number().over(
        Window.partitionBy(*keys, "cell").orderBy("digest", "doc_id")))
    full = placed.join(rated, same(placed, rated, [*keys, "cell"])).select(
        placed["doc_id"], placed["mix_source"], placed["size"], placed["digest"],
        "source_size", "target", (F.col("before") + F.col("nth")).alias("place"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = lambda k: F.floor(k * rate + offset(F.col("mix_source")))
    return full.select("doc_id", "mix_source", "size", "source_size", "target", "digest",
                       (crossed(F.col("place")) - crossed(F.col("place") - 1)).cast("long").alias("copies"))


def mixed(docs: DataFrame, **settings) -> DataFrame:
    """The mix itself: the columns of ``docs`` plus ``copy_no``, each document once per copy.

    Rows that repeat doc_id, source and text are one document here, with the copies of them all. If ``docs`` has
    a column copy_no already, the new one is named with underscores behind.
    """
    name, copies = fresh(docs, "mix_key"), fresh(docs, "mix_copies")
    key = lambda digest, source: F.md5(F.concat(digest, F.coalesce(F.concat(F.lit(":"), source), F.lit("")))).alias(name)
    own = docs.withColumn(name, key(order_key(F.col("doc_id"), F.col("text")), F.col("source")))
    counts = systematic_copies(docs, **settings).groupBy(key(F.col("digest"), F.col("mix_source"))).agg(
        F.sum("copies").cast("int").alias(copies)).filter(F.col(copies) > 0)
    return own.dropDuplicates([name]).join(counts, name).select(
        *docs.columns, F.explode(F.sequence(F.lit(1), F.col(copies))).alias(fresh(docs, "copy_no")))


_SQL = f"""
WITH d AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')) AS digest
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY (source IS NULL), source) - 1) AS place
  FROM d GROUP BY source),
w AS (
  SELECT *, CAST([3, 1, 2][CAST(place % 3 AS INTEGER) + 1] AS DOUBLE) AS weight FROM s),
levels AS (
  SELECT a.place, a.weight, a.source_size,
         ((SELECT sum(source_size) FROM w) * 1.5
          - coalesce((SELECT sum(b.source_size) * 2.0 FROM w b WHERE (b.source_size / b.weight, b.place) < (a.source_size / a.weight, a.place)), 0.0))
         / (SELECT sum(b.weight) FROM w b WHERE (b.source_size / b.weight, b.place) >= (a.source_size / a.weight, a.place)) AS level
  FROM w a),
final AS (
  SELECT max_by(level, -source_size / weight) AS level FROM levels WHERE level <= source_size * 2.0 / weight),
t AS (
  SELECT source, source_size, least((SELECT level FROM final) * weight, source_size * 2.0) AS target,
         (('0x' || substr(md5('offset:' || coalesce(source, chr(1) || 'null')), 1, 8))::BIGINT) / 4294967296.0 AS shift
  FROM w),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.shift,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.digest, d.doc_id) AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(size * (floor(k * rate + shift) - floor((k - 1) * rate + shift)) AS BIGINT) AS taken
FROM p
"""


@query("op10_mixture", _SQL)
def op10_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return systematic_copies(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))
