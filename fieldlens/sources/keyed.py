"""Keyed tables: the last write per key remains, in versions that one rename commits (SNK-7).

A put writes its rows as a run, once per key, and commits a version that lists the runs; it costs as much as its
rows, not as the table. A read takes each key from its newest run. After RUNS runs they are compacted into
one, so a read never has more than RUNS + 1 folders to merge, however many puts there were. A put that
breaks before its commit leaves the version before as it was.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.operators.ranking import latest_per_key
from fieldlens.sources.snapshots import Snapshots, Version, VersionTaken

RUNS = 8
# Versions that stay readable after a compaction.
KEEP = 4
_RUN = "__run"


class KeyedTable:
    """The table below ``root``, one row per value of ``keys``; null is a key like any other."""

    def __init__(self, spark: SparkSession, root: str, keys: Sequence[str], runs: int = RUNS) -> None:
        self.spark, self.keys, self.runs = spark, list(keys), runs
        self.versions = Snapshots(spark, root)

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version or a given one; a table that was never written is an error."""
        found = self.versions.read(version)
        if found is None:
            raise ValueError(f"no version of a keyed table below {self.versions.root}")
        return self._merged(found)

    def _merged(self, version: Version) -> DataFrame:
        runs = version.content["runs"]
        parts = [self.spark.read.schema(r["schema"]).parquet(r["folder"]).withColumn(_RUN, F.lit(k)) for k, r in enumerate(runs)]
        whole = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
        return (latest_per_key(whole, self.keys, [_RUN]) if len(runs) > 1 else whole).drop(_RUN)

    def _run(self, rows: DataFrame) -> dict:
        folder = self.versions.folder("run")
        rows.write.parquet(folder)
        return {"folder": folder, "schema": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)}

    def put(self, df: DataFrame, order: Sequence[str] = (), writer: str | None = None, batch: int | None = None) -> Version:
        """Write ``df``; of rows with one key the last by ``order`` counts (by all columns, if none is given).

        ``writer`` and ``batch`` name a numbered series of puts: one that was committed before changes nothing.
        """
        now = self.versions.read()
        if self._has(now, writer, batch):
            return now
        made = self._run(latest_per_key(df, self.keys, order or [c for c in df.columns if c not in self.keys]))
        while True:
            content = now.content if now else {"runs": [], "batches": {}}
            batches = {**content["batches"], **({writer: batch} if writer is not None else {})}
            try:
                done = self.versions.commit({"runs": [*content["runs"], made], "batches": batches}, now)
                break
            except VersionTaken:        # somebody else's run goes first
                now = self.versions.read()
                if self._has(now, writer, batch):
                    self.versions.drop(made["folder"])
                    return now
        return self.compact(done) if len(done.content["runs"]) > self.runs else done

    @staticmethod
    def _has(version: Version | None, writer: str | None, batch: int | None) -> bool:
        return version is not None and writer is not None and version.content["batches"].get(writer, -1) >= batch

    def compact(self, version: Version) -> Version:
        """The next version, with one run; older versions than KEEP go. A faster writer makes it a later put's work."""
        made = self._run(self._merged(version))
        try:
            done = self.versions.commit({"runs": [made], "batches": version.content["batches"]}, version)
        except VersionTaken:
            self.versions.drop(made["folder"])
            return self.versions.read()
        self.versions.expire(KEEP)
        return done
