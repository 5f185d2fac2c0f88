"""Language spans: the path against plain Viterbi, labels against held-out documents."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from fieldlens.llm import language as lg


def plain_path(scores, first, switch):
    out = []
    for a, b in zip(first[:-1], first[1:]):
        v = None
        back = []
        for s in scores[a:b]:
            if v is None:
                v = s.astype(float)
                back.append(None)
                continue
            top = v.argmax()
            floor = v.max() - switch
            back.append([k if v[k] >= floor else top for k in range(len(s))])
            v = np.maximum(v, floor) + s
        path = []
        if b > a:
            k = int(v.argmax())
            for step in back[::-1]:
                path.append(k)
                k = step[k] if step else k
        out += path[::-1]
    return out


@pytest.mark.parametrize("step", [4, 256])
def test_stretches_give_the_same_path(monkeypatch, step):
    monkeypatch.setattr(lg, "STEP", step)
    rng = np.random.default_rng(1)
    for n in (1, 2, 4):
        sizes = [0, 1, 3, 4, 5, 9, 40, 0, 17]
        first = np.concatenate([[0], np.cumsum(sizes)])
        scores = rng.integers(-40, 40, (first[-1], n)).astype(np.float32) / 8 + np.repeat(rng.integers(0, 3, (first[-1] // 6 + 1, n)), 6, 0)[:first[-1]]
        scores = scores.astype(np.float32)
        got = lg.best_path(scores, first, 2.0)
        want = plain_path(scores, first, 2.0)
        value = lambda p: sum(scores[i, k] for i, k in enumerate(p)) - 2.0 * sum(
            p[i] != p[i - 1] for a, b in zip(first[:-1], first[1:]) for i in range(a + 1, b))
        assert len(got) == len(want) and abs(value(list(got)) - value(want)) < 1e-3


@pytest.mark.parametrize("cells", [1, 500, 1 << 23])
def test_groups_of_texts_give_the_same_path(monkeypatch, cells):
    rng = np.random.default_rng(2)
    sizes = rng.choice([0, 1, 2, 5, 300, 700], 80)
    first = np.concatenate([[0], np.cumsum(sizes)])
    scores = rng.normal(size=(first[-1], 7)).astype(np.float32) * 3
    want = lg._paths(scores, first, 4.0, lg.STEP)
    monkeypatch.setattr(lg, "PATH_CELLS", cells)
    assert (lg.best_path(scores, first, 4.0) == want).all()


def test_memory_of_many_languages_is_bounded():
    import tracemalloc
    rng = np.random.default_rng(3)
    first = np.arange(10_001)
    scores = rng.normal(size=(10_000, 150)).astype(np.float32)
    tracemalloc.start()
    labels = lg.best_path(scores, first)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (labels == scores.argmax(axis=1)).all() and peak < 300e6


def by_hand(text, langs, logs, open_):
    """Scores word by word: trigrams of letters with breaks around, the word as a whole, open scripts."""
    letter, script = lg._character_tables()
    mixed = lambda v: int(lg.mix(np.array([v], lg.U))[0])
    rows, words = [], []
    for word in re.findall(r"[^\W\d_]+", text):
        low = [int(letter[ord(c)]) for c in word]
        total = np.zeros(len(langs))
        for a, b, c in zip([0, *low], low, [*low[1:], 0]):
            total += logs[mixed((a << 42) | (b << 21) | c) % lg.BUCKETS]
        whole = sum(mixed(c + (k << 22)) for k, c in enumerate(low)) % (1 << 64)
        total += logs[mixed((whole + 7) % (1 << 64)) % lg.BUCKETS]
        may = open_[script[ord(word[0])]]
        rows.append([t if m or not may.any() else -1e4 for t, m in zip(total, may)])
        words.append(word)
    return words, rows


def test_scores_and_query_word_by_word(spark, small, model):
    """The score of every word, the script rule, and from them the query's columns, without numpy over whole batches."""
    langs, logs, open_ = model
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    texts = [t[:600] for _, t in docs[:25]] + ["Привет мир", "the и le", "日本 x", "straße ǅ ÿ"]
    batch = lg.LetterWords(texts)
    scores = lg.word_scores(batch, logs, open_)
    for d, text in enumerate(texts):
        words, rows = by_hand(text, langs, logs, open_)
        assert batch.first[d + 1] - batch.first[d] == len(words)
        assert np.allclose(scores[batch.first[d]:batch.first[d + 1]], rows, atol=1e-2) if words else True
    said = {r.doc_id: r for r in lg.op9_language(spark, small).collect()}
    for i, text in docs[::10]:
        words, rows = by_hand(text or "", langs, logs, open_)
        path = plain_path(np.array(rows, np.float32), [0, len(rows)], lg.SWITCH)
        letters = Counter()
        for word, k in zip(words, path):
            letters[k] += len(word)
        if not words:
            assert (said[i].lang_pred, said[i].score) == (lg.UNKNOWN, 0.0)
            continue
        most = max(letters.values())
        assert said[i].lang_pred in [langs[k] for k, n in letters.items() if n == most]
        assert abs(said[i].score - most / sum(letters.values())) < 0.02


@pytest.fixture(scope="module")
def model(spark, small):
    return lg.learned(spark.read.parquet(f"{small}/documents.parquet"))


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.filter(lg.held_out(docs.doc_id, 4, 2)).collect()}
    found = {r.doc_id: r.lang_pred for r in lg.identify(docs, model).collect()}
    assert sum(found[i] == x for i, x in truth.items()) >= 0.97 * len(truth)


def test_spans_of_mixed_text(spark, small, make, model):
    docs = {r.lang: r.text for r in spark.read.parquet(f"{small}/documents.parquet").filter("length(text) > 1500").collect()}
    en, de = docs["en"][:800], docs["de"][:400]
    row = lg.identify(make([en + "\n" + de]), model).first()
    assert row.lang_pred == "en" and 0.5 < row.score < 0.9
    assert [s.lang for s in row.spans] == ["en", "de"]
    assert abs(row.spans[1].begin - 801) < 40 and row.spans[-1].end <= 1201


def test_scripts_narrow_candidates(spark, make):
    rng = random.Random(1)
    word = lambda letters: "".join(rng.choice(letters) for _ in range(5))
    texts = [(k, " ".join(word("абвгдежз" if k % 2 else "abcdefgh") for _ in range(40))) for k in range(30)]
    from pyspark.sql import functions as F
    df = make(texts).withColumn("lang", F.when(F.col("doc_id") % 2 == 1, "ru").otherwise("en"))
    model = lg.learned(df)
    rows = {r.doc_id: r for r in lg.identify(make([(1, "зззз"), (2, "hhhh"), (3, "中文"), (4, "hhh бббб")]), model).collect()}
    assert rows[1].lang_pred == "ru" and rows[2].lang_pred == "en" and rows[3].lang_pred in ("en", "ru")


def test_odd_rows(make, odd, empty, model):
    df = make(odd)
    rows = lg.identify(df, model).collect()
    assert len(rows) == len(odd)
    assert all((r.lang_pred == "und") == (r.score == 0) for r in rows)
    assert {r.doc_id for r in rows if r.lang_pred == "und"} >= {1, 2, 3, 12}
    assert lg.identify(empty, model).count() == 0
    none = lg.learned(empty)
    assert {r.lang_pred for r in lg.identify(df, none).collect()} == {"und"}
    kept = lg.keep_identified(df, model)
    assert kept.columns == df.columns and not {1, 2, 3, 12} & {r.doc_id for r in kept.collect()}


def test_letter_places_survive_odd_casing():
    words = lg.LetterWords(["İstanbul ẞ", None, "x"])
    assert words.start.tolist() == [0, 9, 12] and words.first.tolist() == [0, 2, 2, 3]
