"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest

from fieldlens.llm.queries import QUERIES
from fieldlens.llm.spelling import near_pairs, roots, runs_of, variants


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((i for i, c in enumerate(a) if c != b[i]), len(a))
    return a[k:] == b[k + 1:] if len(a) < len(b) else a[k + 1:] == b[k + 1:]


def counted(rows):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode()) & 0xFFFFFFFF
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                out[run] += 1
    return {w: n for w, n in out.items() if n >= 3}


def brute(rows):
    words = counted(rows)
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    near = {w: [v for m in (-1, 0, 1) for v in by_length.get(len(w) + m, []) if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, n, len(near[w]), form[w], words.get(form[w]), root))
    return out


def rows_of(df):
    return [(r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()]


def test_query_equals_all_pairs(spark, small):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rows = rows_of(QUERIES["op12_spelling"](spark, small))
    assert len(rows) == len(set(rows)) > 100 and set(rows) == brute(given)
    assert any(r[3] for r in rows)


def made(n, seed=1):
    """Texts of words that are close to each other: few letters, common beginnings and ends."""
    rng = random.Random(seed)
    stems = ["".join(rng.choice("abéÿ×") for _ in range(rng.randint(4, 9))) for _ in range(40)]
    words = []
    for _ in range(n):
        w = rng.choice(["", "inter", "un"]) + rng.choice(stems) + rng.choice(["", "ation", "s"])
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            at = rng.randrange(len(w))
            w = w[:at] + rng.choice(["", "a", "b", "é" + w[at]]) + w[at + 1:]
        words += [w.title() if rng.random() < 0.1 else w] * rng.choice([1, 2, 3, 4, 9, 30])
    rng.shuffle(words)
    return [(k, " ".join(words[k::50])) for k in range(50)]


@pytest.mark.parametrize("pairs", [0, 30, 1 << 40])
def test_both_ways_find_the_same(make, pairs):
    rows = made(400)
    got = rows_of(variants(make(rows), pairs))
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_every_single_edit(spark):
    """Each place of a word deleted, doubled or replaced, at both ways of joining."""
    word = "abcdefghij"
    edits = {word[:k] + c + word[k + e:] for k in range(11) for e in (0, 1) for c in ("", "q", word[k:k + 1])} - {word}
    df = spark.createDataFrame([(w, 3) for w in {word, *edits, "abc", "abcdefghijkl"}], "word string, n long")
    for pairs in (0, 1 << 40):
        found = {(r.a, r.b) for r in near_pairs(df, pairs).collect()}
        assert {b if a == word else a for a, b in found if word in (a, b)} == {w for w in edits if one_edit(w, word)}


def test_long_texts_are_cut_between_words(monkeypatch):
    rows = made(300, seed=4)
    text = " ".join(t for _, t in rows) + " " + "x" * 5000
    whole = runs_of(7, text)
    monkeypatch.setattr("fieldlens.llm.spelling.PART_CHARS", 50)
    assert runs_of(7, text) == whole and whole["x" * 5000] == 1


def test_odd_rows(make, odd, empty):
    assert set(rows_of(variants(make(odd)))) == brute([(i, t) for i, t in odd])
    assert variants(empty).count() == 0
    clash = make([(k, "colour colour colour color colors") for k in range(3)]).selectExpr("*", "1 AS word", "2 AS n", "'x' AS `key`")
    got = {r[0]: r for r in rows_of(variants(clash))}
    assert got["colour"][3] is None and got["color"][3] == "colour" and got["colors"][5] == "colors"


def test_ties_and_chains(spark):
    chain = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(37)] + [("x", "w5")], "word string, form string")
    assert {(r.word, r.root) for r in roots(chain).collect()} == {(f"w{k}", "w37") for k in range(37)} | {("x", "w37")}
    assert roots(chain.limit(0)).collect() == []
