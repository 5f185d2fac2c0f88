"""Near duplicates against all pairs."""

import random
import string
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldlens.llm.links import components
from fieldlens.llm.wordscan import U
from fieldlens.llm.minmax import keep_one, link_block, near_duplicates, shingle_sets


def shingles(text):
    low = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
    ws = (text or "").translate(low).encode().split()
    return frozenset(zip(ws, ws[1:])) if len(ws) > 1 else frozenset((w,) for w in ws)


def brute(rows):
    sets = {(i, t or ""): shingles(t) for i, t in rows}
    keys = list(sets)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k
    for a in range(len(keys)):
        for b in range(a):
            x, y = sets[keys[a]], sets[keys[b]]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                root[find(keys[a])] = find(keys[b])
    smallest = {}
    for k in keys:
        if k[0] is not None:
            smallest[find(k)] = min(k[0], smallest.get(find(k), k[0]))
    return {k: (len(sets[k]), k[0] if not sets[k] else smallest.get(find(k))) for k in keys}


def compare(df, **settings):
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    want = brute(rows)
    found = near_duplicates(df, **settings).select("doc_id", "n_shingles", "component_id", "kept").collect()
    assert sorted((tuple(r)[:3] for r in found), key=str) == sorted(((i, *want[(i, t or "")]) for i, t in rows), key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    return found


@pytest.mark.parametrize("block", [1_000_000, 150])
def test_as_by_all_pairs(make, crowd, block):
    found = compare(make(crowd), block_shingles=block)
    assert sum(not r.kept for r in found) > 30


def test_template_texts_that_do_not_link_cost_little():
    """Sets that share two thirds of their shingles meet in bands but not in a block, whose work stays near its size."""
    rng = np.random.default_rng(4)
    shared = rng.integers(0, 1 << 60, 12).astype(U)
    took = {}
    for m in (4_000, 16_000):
        sets = [np.unique(np.concatenate([shared, rng.integers(0, 1 << 60, 6).astype(U)])) for _ in range(m)]
        sets[5] = np.unique(np.concatenate([sets[4][:-1], sets[4][:1] + U(1)]))     # one pair that does
        start = time.process_time()
        assert {frozenset(p) for p in link_block(list(range(m)), sets)} == {frozenset((4, 5))}
        took[m] = time.process_time() - start
    assert took[16_000] < 8 * max(took[4_000], 0.05) and took[16_000] < 5


def test_blocks_equal_all_pairs():
    rng = np.random.default_rng(8)
    for _ in range(60):
        pool = rng.integers(0, 60, 60).astype(U)
        sets = [np.unique(rng.choice(pool[:rng.integers(1, 40)], rng.integers(1, 25))) for _ in range(rng.integers(2, 30))]
        near = lambda a, b: 100 * len(np.intersect1d(a, b)) >= 80 * len(np.union1d(a, b))
        want, got = list(range(len(sets))), list(range(len(sets)))

        def merge(root, a, b):
            x, y = root[a], root[b]
            root[:] = [min(x, y) if r in (x, y) else r for r in root]
        for a in range(len(sets)):
            for b in range(a):
                if near(sets[a], sets[b]):
                    merge(want, a, b)
        for a, b in link_block(list(range(len(sets))), sets):
            assert near(sets[a], sets[b])
            merge(got, a, b)
        assert got == want


def test_large_group_in_blocks(make):
    rng = random.Random(3)
    base = [f"w{k}" for k in range(80)]
    texts = []
    for _ in range(120):
        t = list(base)
        for _ in range(rng.randint(0, 9)):
            t[rng.randrange(80)] = f"x{rng.randrange(30)}"
        texts.append(" ".join(t))
    compare(make(texts), block_shingles=700)


def test_odd_rows(make, odd):
    compare(make([r for r in odd if r[0] is not None]))
    df = make(odd)
    found = near_duplicates(df).collect()
    assert len(found) == len(odd)
    assert {r.component_id for r in found if r.doc_id is None and r.n_shingles} == {4}
    kept = keep_one(df)
    assert kept.columns == df.columns
    assert sum(r.doc_id == 4 for r in kept.collect()) == 1
    ids = [r.doc_id for r in kept.collect()]
    assert 8 in ids and 9 not in ids and {1, 2, 3} <= set(ids)


def test_empty_table(empty):
    assert near_duplicates(empty).count() == 0 and keep_one(empty).count() == 0


def test_extra_columns_with_clashing_names(make):
    df = make(["a b c", "a b c", "d"]).withColumns({c: F.lit("x") for c in ("root", "node", "k1", "text_key", "kept")})
    kept = keep_one(df)
    assert kept.columns == df.columns and kept.count() == 2
    assert kept.first().k1 == "x"


def test_whole_table(spark, small):
    compare(spark.read.parquet(f"{small}/documents.parquet"))


def test_components_of_long_chains(spark):
    links = [(k, k + 1) for k in range(199) if k % 50 != 49] + [(7, 7), (None, 3)]
    random.Random(1).shuffle(links)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: k // 50 * 50 for k in range(200)}


def test_link_block_skips_what_is_joined():
    import numpy as np
    sets = [np.arange(10, dtype=np.uint64), np.arange(10, dtype=np.uint64), np.arange(100, 110, dtype=np.uint64)]
    assert link_block([1, 2, 3], sets) == [(1, 2)]
    assert link_block([1, 2, 3], sets, parts=[5, 5, 6]) == []


def test_shingle_width(make):
    words = [f"w{k}" for k in range(60)]
    near = list(words)
    near[15], near[40] = "other", "words"      # 55 of 63 pairs in common, 46 of 66 fives
    df = make([" ".join(words), " ".join(near), "one two three", "one two three", "one two four"])
    kept = lambda **s: sorted({r.doc_id for r in near_duplicates(df, **s).filter("kept").collect()})
    assert kept() == kept(width=2) == [0, 2, 4]
    assert kept(width=5) == [0, 1, 2, 4]
    assert [len(s) for s in shingle_sets(["a b c", "a", "", "a b c d e f"], 5)] == [1, 1, 0, 2]
