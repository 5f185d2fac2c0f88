"""Contaminated documents against every alignment of every item."""

import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F

from fieldlens.llm.spaced_seeds import (AGREE, LEAST, MASKS, MIN_TOKENS, SHORT, decontaminate, longest_stretch, overlaps,
                                        short_masks, short_seeds, tokens_of)


def tokens(text):
    return re.findall(r"[0-9a-z\u0080-\U0010ffff]+", (text or "").lower())


def longest(same):
    return max(((j - i, -i) for i in range(len(same)) for j in range(i + 1, len(same) + 1)
                if sum(same[i:j]) >= AGREE * (j - i - sum(same[i:j]))), default=(0, 0))


def brute(docs, items):
    out = set()
    for i, t in docs:
        d = tokens(t)
        for k, u in items:
            w = tokens(u)
            if 0 < len(w) < LEAST and d == w:
                out.add((i, k))
            for shift in range(-len(w) + 1, len(d)) if len(w) >= LEAST else ():
                lo, hi = max(0, -shift), min(len(w), len(d) - shift)
                same = [d[q + shift] == w[q] for q in range(lo, hi)]
                if longest(same)[0] >= min(MIN_TOKENS, len(w)):
                    out.add((i, k))
    return out


def found_by_a_mask(size, gone):
    """Whether a mask of an item of ``size`` tokens, all of it in a document, avoids the substituted places."""
    if size < SHORT:
        return any(all(not set(range(o, o + n)) & gone for o, n in mask) for mask in short_masks(size))
    return any(all(p + k not in gone for k, bit in enumerate(mask) if bit == "1")
               for mask in MASKS for p in range(size - len(mask) + 1))


def test_recall_by_length():
    """Of all ways to substitute as many tokens as the rule allows, the share that a mask survives."""
    for size in range(1, 21):
        ways = list(itertools.combinations(range(size), size // (AGREE + 1)))
        recall = sum(found_by_a_mask(size, set(w)) for w in ways) / len(ways)
        assert recall == 1 if size < SHORT else recall >= 0.9, (size, recall)


def test_short_masks_and_seeds():
    for size in range(1, SHORT):
        for mask in short_masks(size):
            assert mask and all(n > 0 for _, n in mask) and sum(mask[-1]) <= size
            assert sum(n for _, n in mask) >= size - 2 * -(-size // 5)
    tokens, first = tokens_of(["a b c d e f", "x b c d e f", "a b c d e", "", "a b", "a b c"])
    seen = {}
    for at, value in short_seeds(tokens, first, [2, 6]):
        for p, v in zip(at, value):
            seen.setdefault(int(v), []).append(int(p))
    assert sorted(len(p) for p in seen.values()).count(2) == 1      # the two texts of six tokens share the mask without the first
    assert [p for p in seen.values() if p == [17]] == [[17]]         # "a b" as a whole text only


def test_short_items_with_random_substitutions(spark, make):
    rng = random.Random(7)
    vocabulary = [f"{a}{b}" for a in "bcdfghklmn" for b in ("a", "en", "or", "ish", "ung", "et", "is", "om")]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(n))) for k, n in enumerate([1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 5, 8, 10] * 2)]
    docs = []
    for k, (item, text) in enumerate(items * 4):
        words = text.split()
        for p in rng.sample(range(len(words)), rng.randint(0, len(words) // 5)):
            words[p] = "other"
        around = [rng.choice(vocabulary) for _ in range(rng.choice([0, 0, 30]))]
        at = rng.randint(0, len(around))
        docs.append((k, " ".join([*around[:at], *words, *around[at:]])))
    got = {(r.doc_id, r.item_id) for r in overlaps(make(docs), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = brute(docs, items)
    same = {t: min(k for k, u in items if u == t) for _, t in items}      # equal items are one
    assert got == {(i, same[dict(items)[k]]) for i, k in want} and len(got) > 80


def corpus():
    rng = random.Random(2)
    vocabulary = [f"{a}{b}" for a in "bcdfgh" for b in ("a", "en", "or", "ish", "ung", "et", "is")] + ["the", "of"]
    items = [(k, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([9, 18, 30, 60])))) for k in range(12)]
    docs = []
    for k in range(60):
        text = [rng.choice(vocabulary) for _ in range(rng.randint(0, 90))]
        if k % 3 == 0:
            passage = rng.choice(items)[1].split()
            every = rng.choice([0, 5, 6, 9])
            for p in range(every - 1, len(passage), every) if every else ():
                passage[p] = f"new{p}"
            at = rng.randint(0, len(text))
            text[at:at] = passage
        docs.append((k, ", ".join(text).title()))
    return docs, items


def test_as_by_all_alignments(spark, make):
    docs, items = corpus()
    found = overlaps(make(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = brute(docs, items)
    assert {(r.doc_id, r.item_id) for r in found} == want
    assert len(want) >= 15
    for r in found:
        assert r.agreeing * (AGREE + 1) >= AGREE * (r.doc_end - r.doc_begin)


def test_bloom_of_few_bits_changes_nothing(spark, make):
    docs, items = corpus()
    bench = spark.createDataFrame(items, "item_id long, text string")
    key = ["doc_id", "item_id", "doc_begin", "doc_end"]
    a = {tuple(r[c] for c in key) for r in overlaps(make(docs), bench).collect()}
    assert a == {tuple(r[c] for c in key) for r in overlaps(make(docs), bench, bloom_bits=64).collect()}


def test_odd_rows_and_empty_tables(spark, make, odd, empty):
    items = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(5, 40))), (2, None), (3, ""), (None, "x y"),
                                   (4, " ".join(f"W{k}" for k in range(5, 40)))], "item_id long, text string")
    df = make(odd).withColumns({c: F.lit(0) for c in ("item_id", "tokens", "seed", "bad_id")})
    got = {(r.doc_id, r.item_id) for r in overlaps(df, items).collect()}
    assert got == {(None, 1), (4, 1), (5, 1), (10, 1)}
    clean = decontaminate(df, items)
    assert clean.columns == df.columns
    assert clean.count() == len(odd) - 6
    assert overlaps(empty, items).count() == 0
    assert overlaps(df, items.limit(0)).count() == 0


def test_longest_stretch():
    rng = random.Random(4)
    for _ in range(300):
        same = np.array([rng.random() < 0.75 for _ in range(rng.randint(0, 25))], dtype=bool)
        a, b = longest_stretch(same)
        n, minus = longest(same.tolist())
        assert (b - a, a if b > a else 0) == (n, -minus)


def test_planted_items_are_found(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    bench = spark.read.parquet(f"{small}/benchmark.parquet")
    texts = [(r.doc_id, r.text) for r in docs.collect()]
    whole = {(i, b.item_id) for b in bench.collect() for i, t in texts if b.text in t}
    assert whole and whole <= {(r.doc_id, r.item_id) for r in overlaps(docs, bench).collect()}
