"""Groups of spelling variants: words one edit apart, found by asymmetric chunks.

Of two words the shorter (or, of equal length, the smaller) gives two disjoint chunks, its first half and the
rest; the other gives its positional grams. One inserted, deleted or replaced code point leaves one of the
two chunks whole, and moves it by no more than the difference of the lengths, which is one at most: the first chunk
stays where it was, the second keeps its distance from the end. Only grams at these places can meet a
chunk, so only they are made. Chunks and grams join by hash of length, side and letters; what meets is verified
by edit distance. A pair whose first chunk agrees is not looked at by its second, so every pair comes once.

A chunk that many words share ("un", "inter") would give the square of their number. If a chunk times its grams is
beyond PAIRS, its words meet by what the edit leaves of the other half too: that half with one place blanked
out, or, against a longer word, whole against the longer half with one code point left out. Words that agree in that
are one edit apart, so this costs rows by the length of the words and makes only real pairs. Both ways find
the same pairs; PAIRS only says which costs less.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm.common import query, table
from fieldlens.session import discard, sent_if_small, stored

# Fixed values of the operator's contract.
RUN = re.compile("[a-zÀ-ÿ]+")
NO_LETTER = re.compile("[^a-zÀ-ÿ]")
TYPO_EVERY = 97
LEAST_LETTERS, LEAST_COUNT, FORM_TIMES = 5, 3, 2

# Words of a chunk times words with the gram, beyond which their other halves decide.
PAIRS = 1 << 14
# Characters looked at together, and distinct words that a task counts before it hands them on.
PART_CHARS, HELD_WORDS = 1 << 20, 200_000


def runs_of(doc_id: int | None, text: str | None) -> Counter:
    """Occurrences of the words of one text; a long text is read in parts cut between words.

    In every run of a document whose hash TYPO_EVERY divides, one code point is left out.
    """
    out: Counter = Counter()
    if not text:
        return out
    text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # bytes: A to Z only
    of_doc = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    begin = 0
    while begin < len(text):
        end = begin + PART_CHARS
        if end < len(text):
            cut = NO_LETTER.search(text, end)
            end = cut.start() if cut else len(text)
        for run, n in Counter(RUN.findall(text, begin, end)).items():
            h = zlib.crc32(run.encode(), of_doc)
            if h % TYPO_EVERY == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            if len(run) >= LEAST_LETTERS:
                out[run] += n
        begin = end
    return out


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def flush() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held.clear()
        return made

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for word, n in runs_of(doc_id, text.as_py()).items():
                held[word] += n
            if len(held) >= HELD_WORDS:
                yield flush()
    if held:
        yield flush()


def word_counts(docs: DataFrame) -> DataFrame:
    """Words of all texts with their number of occurrences, those below LEAST_COUNT left out."""
    return docs.select("doc_id", "text").mapInArrow(_counted, "word string, n long").groupBy("word").agg(
        F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def _pieces(words: DataFrame) -> DataFrame:
    """Chunks and grams: key, side, short (length of the word that gives the chunk), the word and the rest of it.

    Rows whose ``short`` is the word's own length are its chunks and also its grams for words of that length.
    """
    length = F.length("word")

    def piece(shorter: int, side: int) -> Column:
        short = length - shorter
        half = F.floor(short / 2).cast("int")
        begin = half + shorter
        first, last = (F.substr(F.col("word"), F.lit(1), half), F.substr(F.col("word"), half + 1)) if side == 0 else (
            F.substr(F.col("word"), F.lit(1), begin), F.substr(F.col("word"), begin + 1))
        chunk, rest = (first, last) if side == 0 else (last, first)
        return F.struct(F.xxhash64(short, F.lit(side), chunk).alias("key"), F.lit(side).alias("side"),
                        F.lit(shorter).alias("shorter"), rest.alias("rest"))

    return words.select("word", "n", F.explode(F.array(*[piece(a, b) for a in (0, 1) for b in (0, 1)])).alias("p")).select(
        "p.key", "p.side", "p.shorter", "word", "n", "p.rest")


def _met(chunks: DataFrame, grams: DataFrame, key: str) -> DataFrame:
    """Verified pairs of rows that agree in ``key``."""
    a = chunks.filter("shorter = 0").select(key, F.col("word").alias("a"), F.col("n").alias("a_n"))
    b = grams.select(key, "side", "shorter", F.col("word").alias("b"), F.col("n").alias("b_n"))
    half = F.floor(F.length("a") / 2).cast("int")
    seen_before = (F.col("side") == 1) & (F.substr(F.col("a"), F.lit(1), half) == F.substr(F.col("b"), F.lit(1), half))
    return a.join(b, key).filter((F.length("b") == F.length("a") + F.col("shorter")) & ((F.col("shorter") == 1) | (F.col("a") < F.col("b")))
                                 & ~seen_before & (F.levenshtein("a", "b", 1) == 1)).select("a", "a_n", "b", "b_n")


def _blanked(c: Column, kind: int) -> Column:
    """``c`` with each place blanked out (0) or left out (1); equal results once."""
    made = F.transform(F.sequence(F.lit(1), F.length(c)), lambda i: F.concat(
        F.substr(c, F.lit(1), i - 1), F.lit("" if kind else "\0"), F.substr(c, i + 1)))
    return F.array_distinct(made) if kind else made


def near_pairs(words: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """All pairs of different words one edit apart, once each: a, a_n, b, b_n.

    ``words`` has distinct words (at least two code points each) and their n.
    """
    pieces, _ = stored(_pieces(words), "pieces")
    own = F.count(F.when(F.col("shorter") == 0, True))
    hot = sent_if_small(pieces.groupBy("key").agg(own.alias("c"), F.count(F.lit(1)).alias("g")).filter(
        F.col("c") * F.col("g") > pairs).select("key"), "shared-pieces")
    cold = pieces.join(hot, "key", "left_anti")
    shared = pieces.join(hot, "key", "left_semi")
    # What is left of the other half: as it is for the chunk of a longer word, blanked out for an equally long one.
    left = F.when(F.col("shorter") == 1, _blanked(F.col("rest"), 1)).otherwise(F.concat(_blanked(F.col("rest"), 0), F.array("rest")))
    finer = shared.select("side", "shorter", "word", "n", "key", F.explode(left).alias("left")).select(
        "side", "shorter", "word", "n", F.xxhash64("key", "left").alias("finer"))
    return _met(cold, cold, "key").unionByName(_met(finer, finer, "finer"))


def roots(forms: DataFrame) -> DataFrame:
    """The end of every chain of ``forms`` (word, form; no cycles): word, root.

    Every round doubles the reach of the pointers, so their number is the logarithm of the longest chain.
    """
    reached, _ = stored(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = reached.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved, _ = stored(reached.join(further, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("on")), "roots")
        discard(reached)
        reached = moved.select("word", "root")
        reached.stored_path = moved.stored_path
        if moved.filter("on").isEmpty():
            return reached


def variants(docs: DataFrame, pairs: int = PAIRS) -> DataFrame:
    """One row per word of ``docs`` (doc_id, text): word, n, n_near, form, form_n, root.

    A null or empty text has no words; a null doc_id counts as an empty one in the hash of a run. Every row of
    ``docs`` counts, repeated ones too. A word's form is the near word of largest n, of several the smallest, if
    it is FORM_TIMES as frequent; the chain of forms ends at the root. An empty table gives an empty result; other columns
    are not read.
    """
    words, _ = stored(word_counts(docs), "words")
    found, _ = stored(near_pairs(words, pairs), "near-pairs")
    sides = words.select("word", "n", F.lit(None).cast("string").alias("near"), F.lit(None).cast("long").alias("near_n")).unionByName(
        found.select(F.col("a").alias("word"), F.col("a_n").alias("n"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))).unionByName(
        found.select(F.col("b").alias("word"), F.col("b_n").alias("n"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    best = F.min(F.when(F.col("near").isNotNull(), F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w")))).alias("best")
    told = sides.groupBy("word", "n").agg(F.count("near").alias("n_near"), best)
    is_form = -F.col("best.m") >= FORM_TIMES * F.col("n")
    told, _ = stored(told.select("word", "n", "n_near", F.when(is_form, F.col("best.w")).alias("form"),
                                 F.when(is_form, -F.col("best.m")).alias("form_n")), "forms")
    discard(found)
    discard(words)
    ends = roots(told.filter("form IS NOT NULL"))
    return told.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))


@query("op12_spelling")
def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(table(spark, sf_dir, "documents"))
