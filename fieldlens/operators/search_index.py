"""A search index that is built once, kept, found again, and grows by segments (CAT-4, CAT-5).

A segment holds the postings of its entities, sorted by token, the entities themselves, sorted by id, and the ids of
earlier segments that it replaces. A version of the index is a list of segments, so a search reads a
fixed version while others are written. An entity that is added again counts in its newest segment only.
Compaction writes the live rows of all segments as one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.operators import catalog as cat
from fieldlens.sources.snapshots import Snapshots, Version, VersionTaken

# Goes up when the folders of a segment change, so that a kept index of another kind is not read.
FORMAT = 1
ENTITY = ["entity_type", "entity_id"]
POSTINGS = "token string, entity_type string, entity_id string, tf long, places array<int>"
ENTITIES = "entity_type string, entity_id string, title string, description string"
REPLACED = "segment string, entity_type string, entity_id string"


class KeptIndex:
    """One version of the index below ``root``."""

    def __init__(self, spark: SparkSession, root: str, version: Version) -> None:
        self.spark, self.root, self.version = spark, root, version

    @property
    def segments(self) -> list[dict]:
        return self.version.content["segments"]

    def _all(self, part: str, schema: str) -> DataFrame:
        """A part of all segments with the segment's name."""
        return reduce(DataFrame.unionByName, [
            self.spark.read.schema(schema).parquet(f"{s['folder']}/{part}").withColumn("segment", F.lit(s["name"]))
            for s in self.segments])

    def _live(self, rows: DataFrame) -> DataFrame:
        """Without rows of entities that a later segment replaces."""
        later = [s for s in self.segments if s["replaced"]]
        if not later:
            return rows
        gone = reduce(DataFrame.unionByName, [self.spark.read.schema(REPLACED).parquet(f"{s['folder']}/replaced") for s in later])
        return rows.join(gone.distinct(), ["segment", *ENTITY], "left_anti")

    def postings(self) -> DataFrame:
        """token, entity_type, entity_id, tf, places of every live entity."""
        return self._live(self._all("postings", POSTINGS)).select("token", *ENTITY, "tf", "places")

    def entities(self) -> DataFrame:
        """Every live entity with title and description."""
        return self._live(self._all("entities", ENTITIES)).select(*ENTITY, "title", "description")

    def hits(self, query: str, limit: int = 25) -> DataFrame:
        """The best entities with their score; the tokens of the query reach the scan of the postings."""
        terms = cat.parse_query(query)
        found = cat.matching(self._all("postings", POSTINGS), terms, ["segment", *ENTITY])
        return cat.page(self._live(found).drop("segment"), limit)

    def search(self, query: str, limit: int = 25) -> DataFrame:
        """Hits with title, description and score, best first. The page of hits is found now, its texts when they are read."""
        return cat.page(cat.with_titles(self.hits(query, limit), self.entities()), limit)


def open_index(spark: SparkSession, root: str, version: int | None = None) -> KeptIndex | None:
    """The newest version of the index, or a given one; None if none was ever built."""
    found = Snapshots(spark, root).read(version)
    return found and KeptIndex(spark, root, found)


def _segment(versions: Snapshots, entities: DataFrame, old: KeptIndex | None) -> dict:
    """Write a segment: entities once per id, what they replace, their postings."""
    spark = entities.sparkSession
    folder = versions.folder("segment")
    one = entities.filter("entity_type IS NOT NULL AND entity_id IS NOT NULL").groupBy(*ENTITY).agg(
        F.min(F.struct("title", "description")).alias("t")).select(*ENTITY, "t.title", "t.description")
    one.repartitionByRange(*ENTITY).sortWithinPartitions(*ENTITY).write.parquet(f"{folder}/entities")
    own = spark.read.schema(ENTITIES).parquet(f"{folder}/entities")
    cat.write_index(cat.token_index(own), f"{folder}/postings")
    replaced = 0
    if old:
        gone = old._live(old._all("entities", ENTITIES)).join(own.select(*ENTITY), ENTITY, "left_semi").select("segment", *ENTITY)
        gone.write.parquet(f"{folder}/replaced")
        replaced = spark.read.schema(REPLACED).parquet(f"{folder}/replaced").count()
    return {"name": folder.rsplit("/", 1)[1], "folder": folder, "replaced": replaced}


def add(entities: DataFrame, root: str, after: KeptIndex | None) -> KeptIndex:
    """The version after ``after`` (None: the first), with a segment of ``entities`` added.

    Null titles and descriptions have no words, entities without type or id are left out, of several rows of one
    id the smallest counts. If another writer was faster, the segment is removed and VersionTaken raised.
    """
    spark = entities.sparkSession
    versions = Snapshots(spark, root)
    made = _segment(versions, entities, after)
    try:
        version = versions.commit({"segments": [*(after.segments if after else []), made]}, after and after.version)
    except VersionTaken:
        versions.drop(made["folder"])
        raise
    return KeptIndex(spark, root, version)


def compact(index: KeptIndex) -> KeptIndex:
    """The next version, with the live entities of all segments in one."""
    versions = Snapshots(index.spark, index.root)
    made = _segment(versions, index.entities(), None)
    return KeptIndex(index.spark, index.root, versions.commit({"segments": [made]}, index.version))
