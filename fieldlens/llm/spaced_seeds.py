"""Benchmark decontamination with spaced seeds.

Texts are compared as tokens: lower case, runs of letters and digits. A mask selects seven of up to
eleven neighbouring tokens and ignores the others, so a substituted token does not hide a match;
the masks were chosen so that substitutions at every fifth or sixth token still leave one of them
whole. Hashes of the selected tokens are joined between benchmark items and documents. Around every
hit the two texts are laid side by side, and the longest stretch in which at least 80 % of the
tokens agree decides: 16 tokens (or the whole item, if shorter) are an overlap.

Items of fewer than SHORT tokens have masks of their own length, laid on the whole item: with one substitution allowed,
every mask that leaves out one token; with two, three of five blocks. One of them always avoids the
substitutions. They cost work only for lengths that the benchmark has. Items of fewer than LEAST tokens are
everyday phrases: they are found where they are a whole document, word by word.

Documents are read once. A bit table of fixed size, filled from the items' hashes, drops positions that
cannot match; what passes goes into an ordinary join, so a large benchmark costs time but no result.
Only tokens within REACH of a hit are carried along, never whole documents.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm.common import map_texts, query, table, text_key
from fieldlens.llm.wordscan import ALNUM, U, Words, mix
from fieldlens.session import stored

MASKS = ("1111111", "11110111", "11111011", "11011001011", "11101001101")
MIN_TOKENS = 16
# Agreeing tokens per differing one: 4 means 80 %.
AGREE = 4
REACH = 64
# Items below SHORT tokens have masks of their own; those below LEAST must be the whole document.
SHORT, LEAST = 12, 5
BLOOM_BITS = 1 << 26


def tokens_of(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts and the number of tokens before each text."""
    words = Words([t.lower() if t else "" for t in texts], ALNUM)
    return words.hashes(), words.first


def short_masks(size: int) -> list[list[tuple[int, int]]]:
    """Masks of an item of ``size`` tokens, each as runs (offset, length) of selected tokens.

    One of them is whole after size // (AGREE + 1) substitutions at any places.
    """
    missing = size // (AGREE + 1)
    if missing == 0:
        return [[(0, size)]]
    blocks = size if missing == 1 else 2 * missing + 1
    cuts = [size * k // blocks for k in range(blocks + 1)]
    return [[(cuts[k], cuts[k + 1] - cuts[k]) for k in range(blocks) if k not in gone]
            for gone in itertools.combinations(range(blocks), missing)]


def short_seeds(tokens: np.ndarray, first: np.ndarray, sizes: Iterable[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each mask of items of these sizes, the places where it fits into one text and the hashes there."""
    last, begin = np.repeat(first[1:], np.diff(first)), np.repeat(first[:-1], np.diff(first))
    for size in sizes:
        n = len(tokens) - size + 1
        if n <= 0:
            continue
        at = np.flatnonzero(np.arange(n) + size <= last[:n])
        if size < LEAST:
            at = at[(at == begin[at]) & (at + size == last[at])]
        if not len(at):
            continue
        grams = [np.zeros(len(tokens), U)]      # hashes of 0, 1, 2, ... tokens from each place on
        for k in range(size):
            longer = grams[-1] * U(0x9E3779B97F4A7C15)
            longer[:len(tokens) - k] += tokens[k:]
            grams.append(longer)
        for number, mask in enumerate(short_masks(size)):
            total = np.full(len(at), 64 * size + number, U)
            for offset, length in _joined(mask):
                total = mix(total + U(offset)) + grams[length][at + offset]
            yield at, mix(total)


def _joined(mask: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Neighbouring runs as one."""
    out: list[tuple[int, int]] = []
    for offset, length in mask:
        if out and sum(out[-1]) == offset:
            out[-1] = (out[-1][0], out[-1][1] + length)
        else:
            out.append((offset, length))
    return out


def seeds_of(tokens: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each mask, the places where it fits into one text and the hashes there."""
    last = np.repeat(first[1:], np.diff(first))
    for number, mask in enumerate(MASKS):
        span = len(mask)
        n = len(tokens) - span + 1
        if n <= 0:
            continue
        total = np.full(n, number + 1, U)
        for k, bit in enumerate(mask):
            if bit == "1":
                total = total * U(0x9E3779B97F4A7C15) + tokens[k:k + n]
        at = np.flatnonzero(np.arange(n) + span <= last[:n])
        yield at, mix(total[at])


def _item_rows(cols: list[list]) -> list:
    ids, texts = cols
    tokens, first = tokens_of(texts)
    seeds, places = [[] for _ in ids], [[] for _ in ids]
    size = np.diff(first)
    shorts = short_seeds(tokens, first, sorted(set(size[size < SHORT].tolist()) - {0}))
    for short, (at, value) in itertools.chain(((False, s) for s in seeds_of(tokens, first)), ((True, s) for s in shorts)):
        item = np.searchsorted(first, at, side="right") - 1
        # Short items have the masks of their size, from their first token on; longer ones the others.
        own = (size[item] < SHORT) & (at == first[item]) if short else size[item] >= SHORT
        for i, p, v in zip(item[own], (at - first[item])[own], value.view(np.int64)[own]):
            seeds[i].append(int(v))
            places[i].append(int(p))
    return [ids, [tokens[a:b].tobytes() for a, b in zip(first[:-1], first[1:])], seeds, places]


def _bits(seed, words: int):
    """Word and bit of the two marks of a seed."""
    seed = seed.astype(U)
    for shift in (0, 29):
        x = seed >> U(shift)
        yield ((x >> U(6)) % U(words)).astype(np.int64), x & U(63)


def _bloom(seeds: DataFrame, bits: int) -> np.ndarray:
    """The bit table as 64-bit words: at most bits / 64 rows reach the driver, however many seeds there are."""
    words = bits // 64
    rows = []
    for shift in (0, 29):
        x = F.shiftrightunsigned("seed", shift)
        rows.append(seeds.select(F.pmod(F.shiftrightunsigned(x, 6), F.lit(words)).alias("word"),
                                 F.expr(f"shiftleft(1L, cast(shiftrightunsigned(seed, {shift}) & 63 as int))").alias("bit")))
    found = rows[0].unionByName(rows[1]).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    table_ = np.zeros(words, U)
    table_[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(U)
    return table_


CLUSTERS = "doc_id long, text_key long, cluster int, tokens binary, seeds array<long>, places array<int>"


def _clusters(bloom, sizes: list[int]):
    """Documents to clusters of hits: the tokens around them, the hashes and their places.

    ``sizes`` are the token counts of the benchmark's short items.
    """
    def run(cols: list[list]) -> list:
        ids, keys, texts = cols
        tokens, first = tokens_of(texts)
        marks = bloom.value
        found = []
        for at, value in itertools.chain(seeds_of(tokens, first), short_seeds(tokens, first, sizes)):
            hit = np.ones(len(value), dtype=bool)
            for word, bit in _bits(value, len(marks)):
                hit &= ((marks[word] >> bit) & U(1)).astype(bool)
            if hit.any():
                found.append((at[hit], value[hit].view(np.int64)))
        out: list[list] = [[] for _ in range(6)]
        if found:
            at, value = (np.concatenate(x) for x in zip(*found))
            order = np.argsort(at, kind="stable")
            at, value = at[order], value[order]
            doc = np.searchsorted(first, at, side="right") - 1
            cut = np.flatnonzero((np.diff(at) > 2 * REACH) | (np.diff(doc) > 0)) + 1
            for a, b in zip(np.append(0, cut), np.append(cut, len(at))):
                d = doc[a]
                lo = max(first[d], at[a] - REACH)
                hi = min(first[d + 1], at[b - 1] + REACH)
                for column, x in zip(out, (ids[d], keys[d], int(lo - first[d]), tokens[lo:hi].tobytes(),
                                           value[a:b], (at[a:b] - first[d]).astype(np.int32))):
                    column.append(x)
        return out
    return run


def longest_stretch(same: np.ndarray) -> tuple[int, int]:
    """The longest [begin, end) with at least AGREE agreeing places per differing one; the first of several."""
    total = np.concatenate([[0], np.cumsum(np.where(same, 1, -AGREE))])
    lows = [0]
    for i in range(1, len(total)):
        if total[i] < total[lows[-1]]:
            lows.append(i)
    best = (0, 0)
    j = len(total) - 1
    while j >= 0 and lows:
        while lows and total[j] >= total[lows[-1]]:
            i = lows.pop()
            if (j - i, -i) > (best[1] - best[0], -best[0]):
                best = (i, j)
        j -= 1
    return best


OVERLAPS = "doc_id long, text_key long, item_id long, doc_begin int, doc_end int, item_begin int, agreeing int"


def _overlaps(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for doc_id, key, item_id, shift, begin, doc_tokens, item_tokens in zip(*(c.to_pylist() for c in batch.columns)):
            doc, item = np.frombuffer(doc_tokens, U), np.frombuffer(item_tokens, U)
            # Place q of the item lies at place q + shift of the document.
            lo, hi = max(0, begin - shift), min(len(item), begin + len(doc) - shift)
            if hi <= lo:
                continue
            same = doc[lo + shift - begin:hi + shift - begin] == item[lo:hi]
            a, b = longest_stretch(same)
            if b - a >= min(MIN_TOKENS, len(item)):
                out.append((doc_id, key, item_id, lo + a + shift, lo + b + shift, lo + a, int(same[a:b].sum())))
        if out:
            cols = zip(*out)
            kinds = (pa.int64(), pa.int64(), pa.int64(), *[pa.int32()] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["doc_id", "text_key", "item_id", "doc_begin", "doc_end", "item_begin", "agreeing"])


def overlaps(docs: DataFrame, benchmark: DataFrame, bloom_bits: int = BLOOM_BITS) -> DataFrame:
    """The longest overlap of every document with every benchmark item it overlaps with.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text. Places are tokens, ends exclusive.
    Items of equal tokens are one item, named by the smallest id. Null and empty texts overlap with
    nothing; items of fewer than LEAST tokens overlap with documents that are the same tokens. Rows that
    repeat doc_id and text are one document. An empty table on either side gives an empty result.
    """
    items, _ = stored(map_texts(benchmark.select("item_id", "text"), _item_rows,
                                "item_id long, tokens binary, seeds array<long>, places array<int>")
                      .groupBy("tokens").agg(F.min(F.struct("item_id", "seeds", "places")).alias("i"))
                      .select("i.*", "tokens"), "items")
    seeds = items.select("item_id", F.explode(F.arrays_zip("seeds", "places")).alias("s")).select(
        "item_id", F.col("s.seeds").alias("seed"), F.col("s.places").alias("item_place")).distinct()
    bloom = docs.sparkSession.sparkContext.broadcast(_bloom(seeds, bloom_bits))
    slim = docs.select("doc_id", text_key(F.col("text")).alias("text_key"), "text")
    tokens_each = F.octet_length("tokens") / 8
    sizes = [int(r["n"]) for r in items.select(tokens_each.alias("n")).filter((F.col("n") > 0) & (F.col("n") < SHORT)).distinct().collect()]
    clusters, _ = stored(map_texts(slim, _clusters(bloom, sorted(sizes)), CLUSTERS), "clusters")
    bloom.destroy()  # the clusters are stored: nothing computes them again
    clusters = clusters.dropDuplicates(["doc_id", "text_key", "cluster"])
    hits = clusters.select("doc_id", "text_key", "cluster", F.explode(F.arrays_zip("seeds", "places")).alias("h")).select(
        "doc_id", "text_key", "cluster", F.col("h.seeds").alias("seed"), F.col("h.places").alias("place"))
    aligned = hits.join(seeds, "seed").select("doc_id", "text_key", "cluster", "item_id",
                                              (F.col("place") - F.col("item_place")).alias("shift")).distinct()
    beside = clusters.select(F.col("doc_id").alias("d"), F.col("text_key").alias("t"), F.col("cluster").alias("c"), "tokens")
    rows = aligned.join(beside, aligned["doc_id"].eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("t"))
                        & (F.col("cluster") == F.col("c"))).join(
        items.select("item_id", F.col("tokens").alias("item_tokens")), "item_id")
    found = rows.select("doc_id", "text_key", "item_id", "shift", "cluster", "tokens", "item_tokens").mapInArrow(_overlaps, OVERLAPS)
    best = F.max(F.struct((F.col("doc_end") - F.col("doc_begin")).alias("n"), "agreeing", (-F.col("doc_begin")).alias("b"),
                          (-F.col("item_begin")).alias("i"))).alias("m")
    return found.groupBy("doc_id", "text_key", "item_id").agg(best).select(
        "doc_id", "text_key", "item_id", (-F.col("m.b")).alias("doc_begin"), (F.col("m.n") - F.col("m.b")).alias("doc_end"),
        (-F.col("m.i")).alias("item_begin"), F.col("m.agreeing").alias("agreeing"))


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that overlap with an item; all columns, repeated rows included."""
    bad = overlaps(docs, benchmark).select(F.col("doc_id").alias("bad_id"), F.col("text_key").alias("bad_key")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["bad_id"]) & (text_key(docs["text"]) == bad["bad_key"]), "left_anti")


@query("op1_spaced_seeds")
def op1_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return overlaps(docs, table(spark, sf_dir, "benchmark")).drop("text_key")
