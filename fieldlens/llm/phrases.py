"""Repeated passages: find, confirm, and locate every occurrence with Aho-Corasick automata.

A window is 20 consecutive words of one document. A window whose word sequence starts earlier
somewhere (smaller doc_id, then text hash, then place) is a repeat, and its words are removed.

1. *Anchors.* Of the 13 eight-word phrases in a window, the one with the smallest hash is its anchor:
   equal windows have equal anchors, and neighbours mostly share theirs, so a document has one anchor
   run for seven words. Runs whose anchor occurs once are done with. Exact copies of a document
   count once: all their windows start earlier in the first copy.
2. *Confirmed passages.* The words of the remaining runs meet by anchor, in order of place, and are
   compared as words. Windows seen before make up passages, with the place where each starts first.
   An anchor whose runs have more than HOT_WORDS words is resolved by window instead, with map-side combining.
3. *Automata.* Documents are dealt to shards of about SHARD_WORDS words. The passages that matter in a
   shard are compiled into one automaton over word numbers, and all its documents are streamed
   through it. Every occurrence but the first place of a passage is removed.

Nothing is collected to the driver; an automaton is bounded by its shard, whose number follows the input.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm.common import batched, ddl, map_texts, query, release, sorted_groups, table, text_key
from fieldlens.llm.wordscan import U, Words, _power, gram_hashes, mix, sliding_min
from fieldlens.session import discard, stored

WINDOW = 20
ANCHOR = 8
# Words of the runs of one anchor that a task holds together.
HOT_WORDS = 500_000
SHARD_WORDS = 1_000_000


def _lists(per_doc: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(per_doc)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def _anchor_rows(cols: list[list]) -> list:
    ids, keys, texts = cols
    words = Words(texts)
    h = words.hashes()
    count = np.diff(words.first)
    names = []
    for seed in (1, 2):  # a document's name: polynomial of its word hashes, from running sums
        total = np.concatenate([np.zeros(1, U), np.cumsum(mix(h + U(seed)) * _power("up", len(h)))])
        down = _power("down", len(h) + 1)[words.first[:-1]]
        names.append(mix((total[words.first[1:]] - total[words.first[:-1]]) * down + count.astype(U)))
    n = len(h) - WINDOW + 1
    empty = np.zeros(0, np.int64)
    anchor = start = length = where = empty
    again = np.zeros(0, dtype=bool)
    if n > 0:
        phrase = gram_hashes(h, ANCHOR)
        inside = WINDOW - ANCHOR + 1
        anchors = sliding_min(phrase, inside)[:n]
        at = np.flatnonzero(words.doc[:n] == words.doc[WINDOW - 1:])
        if len(at):
            doc, value = words.doc[at], anchors[at]
            new = np.ones(len(at), dtype=bool)
            new[1:] = (doc[1:] != doc[:-1]) | (value[1:] != value[:-1])
            begin = np.flatnonzero(new)
            length = np.diff(np.append(begin, len(at)))
            where = doc[begin]
            start = at[begin] - words.first[where]
            anchor = value[begin].view(np.int64)
            # Does the anchor start at two places of the run? Then equal windows can be inside it.
            reach = length + inside - 1
            offset = np.cumsum(reach) - reach
            place = np.arange(reach.sum()) + np.repeat(at[begin] - offset, reach)
            again = np.add.reduceat(phrase[place] == np.repeat(value[begin], reach), offset, dtype=np.int32) > 1
    per_doc = np.bincount(where, minlength=len(texts))
    both = np.ascontiguousarray(np.stack(names, axis=1))
    return [ids, keys, count, [r.tobytes() for r in both], _lists(per_doc, anchor, pa.int64()),
            _lists(per_doc, start, pa.int32()), _lists(per_doc, length, pa.int32()),
            _lists(per_doc, again, pa.bool_())]


def _run_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of every candidate run of the documents."""
    def rows():
        for batch in batches:
            for doc_id, key, text, anchors, starts, lengths in zip(*(c.to_pylist() for c in batch.columns)):
                words = text.encode("utf-8", "surrogatepass").split()
                for anchor, start, length in zip(anchors, starts, lengths):
                    yield anchor, doc_id, key, start, b" ".join(words[start:start + length + WINDOW - 1])
    return batched(rows(), RUNS)


def _window_places(run: str) -> list[int]:
    """Where each word of a run begins, and one place past the end."""
    places, at = [0], run.find(" ")
    while at >= 0:
        places.append(at + 1)
        at = run.find(" ", at + 1)
    places.append(len(run) + 1)
    return places


def _passages(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages of runs sorted by anchor and place: maximal stretches of windows seen before whose
    first places are consecutive."""
    def rows():
        for _, (ids, keys, starts, runs) in sorted_groups(batches, 1):
            first: dict[str, tuple] = {}
            known: dict[str, list] = {}
            before = None
            for doc_id, key, start, run in zip(ids, keys, starts, runs):
                if (doc_id, key, start) == before:  # a repeated row
                    continue
                before = (doc_id, key, start)
                made = known.get(run)
                if made is None:
                    at = _window_places(run)
                    seen = len(first)
                    places = []
                    for i in range(len(at) - WINDOW):
                        here = (doc_id, key, start + i)
                        place = first.setdefault(run[at[i]:at[i + WINDOW] - 1], here)
                        places.append(None if place is here else place)
                    made = _stretches(run, at, places)
                    if len(first) == seen:
                        known[run] = made
                for passage, place in made:
                    yield doc_id, key, passage, *place
    return batched(rows(), PASSAGES)


def _stretches(run: str, at: list[int], places: list[tuple | None]) -> list[tuple]:
    made = {}
    i = 0
    while i < len(places):
        if places[i] is None:
            i += 1
            continue
        first_id, first_key, start = places[i]
        j = i + 1
        while j < len(places) and places[j] == (first_id, first_key, start + j - i):
            j += 1
        made[run[at[i]:at[j + WINDOW - 1] - 1]] = places[i]
        i = j
    return list(made.items())


def _windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per window of the runs of hot anchors."""
    def rows():
        for batch in batches:
            for _, doc_id, key, start, run in zip(*(c.to_pylist() for c in batch.columns)):
                at = _window_places(run)
                for i in range(len(at) - WINDOW):
                    yield doc_id, key, start + i, run[at[i]:at[i + WINDOW] - 1]
    return batched(rows(), WINDOWS)


RUNS = (("anchor", "long"), ("doc_id", "long"), ("text_key", "long"), ("start", "int"), ("words", "string"))
WINDOWS = (("doc_id", "long"), ("text_key", "long"), ("start", "int"), ("passage", "string"))
PASSAGES = (("doc_id", "long"), ("text_key", "long"), ("passage", "string"), ("first_id", "long"), ("first_key", "long"), ("first_start", "int"))


def _locate(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed word ranges of the documents of each shard. Passages (kind 0) come before documents (kind 1)."""
    def rows():
        shard, ready = None, False
        for batch in batches:
            for here, kind, text, doc_id, key, start in zip(*(c.to_pylist() for c in batch.columns)):
                if here != shard:
                    shard, ready, numbers = here, False, {}
                    automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
                if kind == 0:
                    words = tuple([numbers.setdefault(w, len(numbers) + 1) for w in text.encode("utf-8", "surrogatepass").split()])
                    automaton.add_word(words, (len(words), doc_id, key, start))
                    continue
                if not len(automaton):
                    continue
                if not ready:
                    automaton.make_automaton()
                    ready = True
                found = _occurrences(automaton, numbers, text, (doc_id, key))
                if len(found[0]):
                    yield doc_id, key, *found
    return batched(rows(), RANGES)


def _occurrences(automaton, numbers: dict[bytes, int], text: str, own: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the word ranges that later occurrences of passages cover."""
    words = text.encode("utf-8", "surrogatepass").split()
    begins, ends = [], []
    for end, (size, first_id, first_key, first_start) in automaton.iter(tuple([numbers.get(w, 0) for w in words])):
        begin = end - size + 1
        if begin != first_start or own != (first_id, first_key):
            begins.append(begin)
            ends.append(end + 1)
    step = np.bincount(begins, minlength=len(words) + 1) - np.bincount(ends, minlength=len(words) + 1)
    gone = np.diff(np.concatenate([[0], np.cumsum(step) > 0, [0]]).astype(np.int8))
    return np.flatnonzero(gone == 1).astype(np.int32), np.flatnonzero(gone == -1).astype(np.int32)


RANGES = (("doc_id", "long"), ("text_key", "long"), ("begins", "array<int>"), ("ends", "array<int>"))


def repeated_ranges(docs: DataFrame, hot_words: int = HOT_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Word ranges to remove: doc_id, text_key, begins, ends (exclusive), for documents that lose words.

    Documents are told apart by doc_id and text; rows that repeat both are one document.
    """
    spark = docs.sparkSession
    slim = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    scanned, _ = stored(map_texts(
        slim, _anchor_rows, "doc_id long, text_key long, n_words long, name binary, "
        "anchors array<long>, starts array<int>, lengths array<int>, again array<boolean>").withColumn(
        "row", F.monotonically_increasing_id()), "anchors")
    own = ["row", "doc_id", "text_key", "n_words"]
    long = scanned.filter(F.col("n_words") >= WINDOW)
    firsts = long.groupBy("name").agg(F.min(F.struct("doc_id", "text_key", "row")).alias("f"))
    copies, _ = stored(long.select(*own, "name").join(firsts, "name").filter(
        F.struct("doc_id", "text_key") != F.struct("f.doc_id", "f.text_key")).select(
        "doc_id", "text_key", F.array(F.lit(0)).alias("begins"), F.array(F.col("n_words").cast("int")).alias("ends")), "copies")
    runs = long.join(firsts.select("f.row"), "row").select("row", F.explode(
        F.arrays_zip("anchors", "starts", "lengths", "again")).alias("r")).select(
        F.col("r.anchors").alias("anchor"), "row", F.col("r.starts").alias("start"),
        F.col("r.lengths").alias("length"), F.col("r.again").alias("again"))
    shared = runs.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.max("again").alias("again"),
                                        F.sum(F.col("length") + (WINDOW - 1)).alias("words")).filter(
        "n > 1 OR again").select("anchor", (F.col("words") > hot_words).alias("hot"))
    of_row = runs.join(shared, "anchor").groupBy("row").agg(
        F.collect_list(F.struct("anchor", "hot", "start", "length")).alias("runs"))
    candidates, _ = stored(of_row.join(long.select(*own), "row"), "candidates")
    discard(scanned)
    release(spark)

    keyed = candidates.select(F.col("doc_id").alias("run_id"), F.col("text_key").alias("run_key"), "runs", "n_words")
    texts, _ = stored(slim.join(keyed, slim["doc_id"].eqNullSafe(keyed["run_id"]) & (slim["text_key"] == keyed["run_key"]))
                      .select("doc_id", "text_key", "text", "runs", "n_words"), "texts")
    discard(candidates)
    release(spark)

    def runs_of(hot: bool) -> DataFrame:
        chosen = texts.select("doc_id", "text_key", "text", F.filter("runs", lambda r: r["hot"] == F.lit(hot)).alias("runs"))
        return chosen.filter(F.size("runs") > 0).select(
            "doc_id", "text_key", "text", "runs.anchor", "runs.start", "runs.length").mapInArrow(_run_rows, ddl(RUNS))

    by_anchor = runs_of(False).repartition("anchor").sortWithinPartitions("anchor", "doc_id", "text_key", "start").mapInArrow(
        _passages, ddl(PASSAGES))
    windows = runs_of(True).mapInArrow(_windows, ddl(WINDOWS))
    place = F.struct("doc_id", "text_key", "start")
    first = windows.groupBy(F.col("passage").alias("p")).agg(F.min(place).alias("f"), F.max(place).alias("l")).filter("f < l")
    by_window = windows.join(first, F.col("passage") == F.col("p")).filter(place != F.col("f")).select(
        "doc_id", "text_key", "passage", F.col("f.doc_id").alias("first_id"),
        F.col("f.text_key").alias("first_key"), F.col("f.start").alias("first_start"))
    shards = texts.agg(F.ceil(F.coalesce(F.sum("n_words"), F.lit(0)) / float(shard_words))).first()[0] or 1
    shard = F.pmod(F.hash("doc_id", "text_key"), F.lit(int(shards))).alias("shard")
    passages, _ = stored(by_anchor.unionByName(by_window).select(
        shard, "passage", "first_id", "first_key", "first_start").dropDuplicates(["shard", "passage"]), "passages")
    release(spark)
    stream = passages.select("shard", F.lit(0).alias("kind"), F.col("passage").alias("text"), F.col("first_id").alias("doc_id"),
                             F.col("first_key").alias("text_key"), F.col("first_start").alias("start")).unionByName(
        texts.select(shard, F.lit(1).alias("kind"), "text", "doc_id", "text_key", F.lit(None).cast("int").alias("start")))
    located = stream.repartition("shard").sortWithinPartitions("shard", "kind").mapInArrow(_locate, ddl(RANGES))
    ranges, _ = stored(located.unionByName(copies).dropDuplicates(["doc_id", "text_key"]), "ranges")
    discard(texts)
    discard(passages)
    release(spark)
    return ranges


def _cut(cols: list[list]) -> list:
    texts, begins, ends = cols
    kept, count, gone = [], [], []
    for text, b, e in zip(texts, begins, ends):
        words = (text or "").encode("utf-8", "surrogatepass").split()
        n = len(words)
        if b:
            stay = np.ones(n, dtype=bool)
            for x, y in zip(b, e):
                stay[x:y] = False
            words = [words[i] for i in np.flatnonzero(stay)]
        kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        count.append(n)
        gone.append(n - len(words))
    return [kept, count, gone]


def cut_repeats(docs: DataFrame, **settings) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, text (kept words joined by one space), n_words, n_removed.

    A null or empty text has no words and an empty kept text. Texts of fewer than 20 words lose nothing.
    Rows that repeat doc_id and text keep the same; different texts under one doc_id, or without one
    (null ids first), count in the order of their text hash. Very long texts are one row of a batch.
    """
    ranges = repeated_ranges(docs, **settings).select(F.col("doc_id").alias("cut_id"), F.col("text_key").alias("cut_key"), "begins", "ends")
    slim = docs.select("doc_id", "text")
    joined = slim.join(ranges, slim["doc_id"].eqNullSafe(ranges["cut_id"]) & (text_key(slim["text"]) == ranges["cut_key"]), "left")
    cut = map_texts(joined.select("text", "begins", "ends", "doc_id"),
                    lambda cols: [cols[3], *_cut(cols[:3])], "doc_id long, text string, n_words long, n_removed long")
    return cut


@query("op5_phrases")
def op5_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = cut_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
