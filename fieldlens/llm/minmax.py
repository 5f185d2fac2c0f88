"""Near duplicates by min-max hashing, confirmed on full shingle sets.

A document's set holds its distinct two-word shingles. Under each of 100 hash functions the smallest
and the largest value are both kept: 200 signature values for 100 evaluations. Five values make a
band; documents that agree in one of 40 bands are candidates. Two sets of similarity 0.8 share no
band with probability (1 - 0.8**5)**40, about 1e-7; at 0.5 they share one with 0.7.

Candidates of a band are not paired with each other. All documents that share a band with the same
smallest document (the leader) form one group; a group is cut into blocks of bounded size, and a
block finds its confirmed links in one task with the full sets: everything is compared with the
leader, then every document that is still apart with the whole block. That is exact, because a link
between two documents already joined cannot change a component. Groups of several blocks get a
second pass: the documents outside the group's largest component meet every block.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm.common import fresh, map_texts, query, sorted_groups, table, text_key
from fieldlens.llm.links import components
from fieldlens.llm.wordscan import U, Words, gram_hashes, mix
from fieldlens.session import stored

FUNCTIONS = 100
BAND = 5
NUMERATOR, DENOMINATOR = 80, 100
# Words of a shingle, by the operator's contract.
WIDTH = 2
# Shingles of a block, 8 bytes each; a larger set is a block of its own.
BLOCK_SHINGLES = 1_000_000


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct hashes of the shingles of ``width`` words of each text; all its words if they are fewer."""
    words = Words(texts, lower=True)
    single = words.hashes()
    grams = gram_hashes(single, width)
    out = []
    for a, b in zip(words.first[:-1], words.first[1:]):
        if b - a >= width:
            out.append(np.unique(grams[a:b - width + 1]))
        else:
            out.append(gram_hashes(single[a:b], b - a) if b - a > 1 else mix(single[a:b]))
    return out


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, 2 * FUNCTIONS + 1, dtype=U) * U(0x9E3779B97F4A7C15))
    return seeds[:FUNCTIONS] | U(1), seeds[FUNCTIONS:]


def _signature_rows(cols: list[list], width: int = WIDTH) -> list:
    ids, text_keys, texts = cols
    sets = shingle_sets(texts, width)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    full = np.flatnonzero(sizes)
    bands = [[] for _ in sets]
    name = [b""] * len(sets)
    if len(full):
        values = np.concatenate([sets[i] for i in full])
        begin = np.cumsum(sizes[full]) - sizes[full]
        low = np.empty((2 * FUNCTIONS, len(full)), U)
        for k, (times, plus) in enumerate(zip(*_multipliers())):
            hashed = values * times + plus
            np.minimum.reduceat(hashed, begin, out=low[2 * k])
            np.maximum.reduceat(hashed, begin, out=low[2 * k + 1])
        keys = np.zeros((2 * FUNCTIONS // BAND, len(full)), U)
        for k in range(BAND):
            keys = mix(keys * U(0x9E3779B97F4A7C15) + low[k::BAND])
        keys = mix(keys + np.arange(len(keys), dtype=U)[:, None]).view(np.int64).T
        sums = [np.add.reduceat(mix(values + U(seed)), begin) for seed in (1, 2)]
        both = np.ascontiguousarray(np.stack([mix(s + sizes[full].astype(U)) for s in sums], axis=1))
        for j, i in enumerate(full):
            bands[i] = keys[j]
            name[i] = both[j].tobytes()
    return [ids, text_keys, sizes, name, pa.array(bands, type=pa.list_(pa.int64()))]


def link_block(ids: list[int], sets: list[np.ndarray], parts: list[int] | None = None,
               asked: list[bool] | None = None) -> list[tuple[int, int]]:
    """Confirmed links that join what is apart in a block; one per join.

    ``parts`` are components known before. With ``asked``, only those are compared with the block.
    """
    m = len(ids)
    root = list(range(m))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    seen: dict[int, int] = {}
    for i, part in enumerate(parts or []):
        root[i] = seen.setdefault(part, i)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    begin = np.cumsum(sizes) - sizes
    distinct, place, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    flag = np.zeros(len(distinct), dtype=bool)
    found = []

    def join(x: int, others: np.ndarray, both: np.ndarray) -> None:
        near = DENOMINATOR * both >= NUMERATOR * (sizes[others] + sizes[x] - both)
        for y in others[near]:
            a, b = find(x), find(int(y))
            if a != b:
                root[max(a, b)] = min(a, b)
                found.append((ids[x], ids[y]))

    if asked is None:       # everything is compared with the leader
        flag[place[:sizes[0]]] = True
        join(0, np.arange(m), np.add.reduceat(flag[place].astype(np.int64), begin))
        flag[place[:sizes[0]]] = False
    alone = [x for x in range(m) if (asked[x] if asked is not None else find(x) != find(0))]
    if not alone:
        return found
    rare, holders, bounds = _rare_shingles(place, often, sizes, begin)
    for x in alone:
        if asked is None and find(x) == find(0):
            continue
        shared = [holders[bounds[s]:bounds[s + 1]] for s in rare[x]]
        others = np.unique(np.concatenate(shared))
        least, most = np.minimum(sizes[others], sizes[x]), np.maximum(sizes[others], sizes[x])
        others = others[(others != x) & (DENOMINATOR * least >= NUMERATOR * most)]
        if not len(others):
            continue
        own = place[begin[x]:begin[x] + sizes[x]]
        flag[own] = True
        spread = np.cumsum(sizes[others]) - sizes[others]
        at = np.arange(sizes[others].sum()) + np.repeat(begin[others] - spread, sizes[others])
        join(x, others, np.add.reduceat(flag[place[at]].astype(np.int64), spread))
        flag[own] = False
    return found


def _rare_shingles(place: np.ndarray, often: np.ndarray, sizes: np.ndarray, begin: np.ndarray):
    """The rarest shingles of each set, and for each shingle the sets that have it among theirs.

    Two sets that are near share at least 0.8 of the larger one; with all shingles in one order, by rarity, they then
    share one of the first ``n - ceil(0.8 n) + 1`` of either. Sets that have only common shingles in
    common never meet, so a group of texts from one template costs little.
    """
    m = len(sizes)
    doc = np.repeat(np.arange(m), sizes)
    rank = np.empty(len(often), np.int64)
    rank[np.lexsort((np.arange(len(often)), often))] = np.arange(len(often))
    order = np.lexsort((rank[place], doc))
    first = sizes - -(-NUMERATOR * sizes // DENOMINATOR) + 1
    taken = order[np.arange(len(place)) - np.repeat(begin, sizes) < np.repeat(first, sizes)]
    ends = np.cumsum(first)
    rare = [place[taken[e - f:e]] for e, f in zip(ends, first)]
    by_shingle = taken[np.argsort(place[taken], kind="stable")]
    bounds = np.searchsorted(place[by_shingle], np.arange(len(often) + 1))
    return rare, doc[by_shingle], bounds


def _links_of_groups(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, (ids, lead, sets) in sorted_groups(batches, 2):
        once: dict[int, np.ndarray] = {}
        for i in sorted(range(len(ids)), key=lambda i: not lead[i]):
            once.setdefault(ids[i], np.frombuffer(sets[i], U))
        if len(once) > 1:
            yield _pairs(link_block(list(once), list(once.values())))


def _links_across(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, (ids, asked, parts, sets) in sorted_groups(batches, 3):
        once: dict[int, tuple] = {}
        for i, ask, part, held in zip(ids, asked, parts, sets):
            old = once.get(i)
            once[i] = (part, ask or (old is not None and old[1]), np.frombuffer(held, U))
        if len(once) > 1:
            part, ask, held = zip(*once.values())
            yield _pairs(link_block(list(once), list(held), list(part), list(ask)))


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    left, right = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def _set_rows(cols: list[list], width: int = WIDTH) -> list:
    ids, texts = cols
    return [ids, [s.tobytes() for s in shingle_sets(texts, width)]]


def near_duplicates(docs: DataFrame, block_shingles: int = BLOCK_SHINGLES, width: int = WIDTH) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text_key, n_shingles, component_id, kept.

    A null text, or one without words, has an empty set, links with nothing and is its own component.
    Documents of equal sets are one node of the graph. Different texts under one doc_id are different
    nodes; rows without a doc_id can be joined with others but never name a component, unless all of
    it is without (then its component_id is null and its rows are kept). Rows that repeat are alike.
    ``width`` is the number of words of a shingle; a shorter text has one shingle of all its words.
    """
    slim = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    signed, _ = stored(map_texts(
        slim, lambda cols: _signature_rows(cols, width), "doc_id long, text_key long, n_shingles long, name binary, bands array<long>"), "signatures")
    nodes, _ = stored(signed.filter("n_shingles > 0").dropDuplicates(["name"]).withColumn(
        "node", F.monotonically_increasing_id()), "sets")
    keys = nodes.select("node", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("leader"), F.max("node").alias("last")) \
        .filter("leader < last").drop("last")
    pairs, _ = stored(keys.join(shared, "key").select("leader", "node").distinct(), "groups")

    sized = pairs.join(nodes.select("node", "n_shingles"), "node")
    blocks = sized.groupBy("leader").agg(F.ceil(F.sum("n_shingles") / float(block_shingles)).cast("int").alias("blocks"))
    wanted = pairs.select("node").distinct().join(nodes.select(
        "node", F.col("doc_id").alias("set_id"), F.col("text_key").alias("set_key")), "node")
    sets, _ = stored(map_texts(slim.join(wanted, slim["doc_id"].eqNullSafe(wanted["set_id"])
                                         & (slim["text_key"] == wanted["set_key"])).select("node", "text"),
                               lambda cols: _set_rows(cols, width), "node long, shingles binary"), "shingles")
    member = pairs.join(blocks, "leader").withColumn("lead", F.col("node") == F.col("leader")).withColumn(
        "block", F.explode(F.when(F.col("lead"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(
            F.array(F.pmod(F.hash("node"), F.col("blocks"))))))
    rows = member.select("leader", "block", "node", "lead").join(sets, "node").select(
        "leader", "block", "node", "lead", "shingles")
    links, _ = stored(rows.repartition("leader", "block").sortWithinPartitions("leader", "block").mapInArrow(
        _links_of_groups, "a long, b long"), "links")
    parts, _ = stored(components(links), "parts")

    # Groups of several blocks: who is outside the largest component meets every block of the group.
    wide = pairs.join(blocks.filter("blocks > 1"), "leader").join(
        parts.withColumnRenamed("root", "part"), "node", "left").withColumn("part", F.coalesce("part", "node"))
    share = wide.groupBy("leader", "part").agg(F.count(F.lit(1)).alias("n"))
    main = share.groupBy("leader").agg(F.max(F.struct("n", "part")).alias("m")).select("leader", F.col("m.part").alias("main"))
    wide = wide.join(main, "leader").withColumn("block", F.pmod(F.hash("node"), F.col("blocks"))).withColumn(
        "asked", F.col("part") != F.col("main"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    asking = wide.filter("asked")
    sides = asking.select("leader", "node", "part", F.lit(True).alias("asked"), F.explode(every).alias("block"),
                          F.col("block").alias("asking")).unionByName(
        wide.join(asking.select("leader", F.col("block").alias("asking")).distinct(), "leader").select(
            "leader", "node", "part", F.lit(False).alias("asked"), "block", "asking"))
    rows = sides.join(sets, "node").select("leader", "block", "asking", "node", "asked", "part", "shingles")
    across = rows.repartition("leader", "block", "asking").sortWithinPartitions("leader", "block", "asking").mapInArrow(
        _links_across, "a long, b long")
    more, n_more = stored(across, "links")
    if n_more:
        parts, _ = stored(components(links.unionByName(more)), "parts")

    rooted = nodes.select("name", "node").join(parts, "node", "left").select(
        "name", F.coalesce("root", "node").alias("root"))
    full = signed.select("doc_id", "text_key", "n_shingles", "name").join(rooted, "name", "left")
    smallest = full.filter("root IS NOT NULL").groupBy("root").agg(F.min("doc_id").alias("smallest"))
    return full.join(smallest, "root", "left").select(
        "doc_id", "text_key", "n_shingles",
        F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("smallest")).alias("component_id"),
        F.col("root").alias("root")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with one document of each component: the one that names it; a repeated row stays once."""
    keep = near_duplicates(docs, **settings).filter("kept")
    best = keep.filter("root IS NOT NULL").groupBy("root").agg(F.min(F.struct("doc_id", "text_key")).alias("k")).select("k.*") \
        .unionByName(keep.filter("root IS NULL").select("doc_id", "text_key").distinct())
    names = [fresh(docs, k) for k in ("k1", "k2", "k3")]
    parts = lambda i, key: [c.alias(n) for c, n in zip((F.coalesce(i, F.lit(0)), key, i.isNull()), names)]
    best = best.select(*parts(F.col("doc_id"), F.col("text_key")))
    own = docs.select("*", *parts(F.col("doc_id"), text_key(F.col("text"))))
    return own.join(best, names).dropDuplicates(names).select(docs.columns)


@query("op6_minmax")
def op6_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs).select("doc_id", "n_shingles", "component_id", "kept")
