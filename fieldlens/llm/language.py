"""Language identification of mixed text: scripts narrow the candidates, Viterbi labels the words.

A word is a run of letters. Its score in a language is the log-probability of its letter trigrams and
of the word as a whole, learned from labelled documents. Words are only open to languages that write
at least 1 % of their letters in the word's script. The path through the words with the best total,
where every change of language costs SWITCH, labels spans of the text. A document's language is the
one whose spans hold most letters; its score is that share.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm.common import map_texts, pieces, query, table
from fieldlens.llm.wordscan import U, mix

BUCKETS = 1 << 16
FIT_DOCS = 5_000
SMALL_LIST = 10_000
SWITCH = 12.0
SMOOTH = 0.5
SCRIPT_SHARE = 0.01
STEP = 256
PATH_CELLS = 1 << 23
MIN_SHARE = 0.5
UNKNOWN = "und"

# First and last code point of Unicode blocks by script; other letters are script 0.
SCRIPTS = (
    ("latin", 0x0041, 0x024F), ("latin", 0x1E00, 0x1EFF), ("greek", 0x0370, 0x03FF), ("greek", 0x1F00, 0x1FFF),
    ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F), ("hebrew", 0x0590, 0x05FF),
    ("arabic", 0x0600, 0x077F), ("devanagari", 0x0900, 0x097F), ("bengali", 0x0980, 0x09FF),
    ("tamil", 0x0B80, 0x0BFF), ("telugu", 0x0C00, 0x0C7F), ("thai", 0x0E00, 0x0E7F),
    ("georgian", 0x10A0, 0x10FF), ("hangul", 0x1100, 0x11FF), ("hangul", 0xAC00, 0xD7AF),
    ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x4DBF), ("han", 0x4E00, 0x9FFF), ("han", 0x20000, 0x33FFF),
)
N_SCRIPTS = 1 + len(dict.fromkeys(name for name, _, _ in SCRIPTS))
_LAST = 0x34000  # no letters above

_tables: dict[str, np.ndarray] = {}


def _character_tables() -> tuple[np.ndarray, np.ndarray]:
    """Lower-case letter (0: no letter) and script of every code point; made once per worker."""
    if not _tables:
        letter = np.zeros(_LAST + 1, np.uint32)
        for i in range(_LAST):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                letter[i] = ord(low) if len(low) == 1 else i
        script = np.zeros(_LAST + 1, np.int8)
        names = list(dict.fromkeys(name for name, _, _ in SCRIPTS))
        for name, lo, hi in SCRIPTS:
            script[lo:hi + 1] = names.index(name) + 1
        _tables.update(letter=letter, script=script)
    return _tables["letter"], _tables["script"]


class LetterWords:
    """Words of texts as runs of letters: code point places, features and scripts."""

    def __init__(self, texts: list[str | None]) -> None:
        letter_of, script_of = _character_tables()
        joined = "\n".join(t or "" for t in texts) + "\n"
        code = np.minimum(np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), _LAST)
        low = letter_of[code]
        sizes = np.array([len(t) + 1 if t else 1 for t in texts], dtype=np.int64)
        self.text_begin = np.cumsum(sizes) - sizes
        inside = np.zeros(len(low) + 2, np.int8)
        inside[1:-1] = low > 0
        step = np.diff(inside)
        self.start, self.end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
        self.first = np.concatenate([np.searchsorted(self.start, self.text_begin), [len(self.start)]])
        self.size = self.end - self.start
        at = np.flatnonzero(low)
        self.offset = np.cumsum(self.size) - self.size  # of each word among the letters
        wide = np.concatenate([[0], low]).astype(U)  # never used past its ends: the text ends with a break
        before, here = wide[at], wide[at + 1]
        after = low[np.minimum(at + 1, len(low) - 1)].astype(U)
        self.trigram = (mix((before << U(42)) | (here << U(21)) | after) & U(BUCKETS - 1)).astype(np.int32)
        if len(self.start):
            whole = np.add.reduceat(mix(here + (np.arange(len(at)) - np.repeat(self.offset, self.size)).astype(U) * U(1 << 22)), self.offset)
            self.whole = (mix(whole + U(7)) & U(BUCKETS - 1)).astype(np.int32)
            self.script = script_of[code[self.start]]
        else:
            self.whole, self.script = np.zeros(0, np.int32), np.zeros(0, np.int8)


def _count_features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per language of one task: features, then letters per script, in a table of fixed size."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for a, b in pieces(texts):
            for lang in sorted(set(langs[a:b])):
                words = LetterWords([t for t, own in zip(texts[a:b], langs[a:b]) if own == lang])
                total = counts.setdefault(lang, np.zeros(BUCKETS + N_SCRIPTS, np.int64))
                total[:BUCKETS] += np.bincount(words.trigram, minlength=BUCKETS) + np.bincount(words.whole, minlength=BUCKETS)
                total[BUCKETS:] += np.bincount(words.script, weights=words.size, minlength=N_SCRIPTS).astype(np.int64)
    for lang, total in counts.items():
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(used), pa.string()), pa.array(used.astype(np.int32)),
                                          pa.array(total[used])], names=["lang", "feature", "n"])


def fit(labelled: DataFrame, fit_docs: int = FIT_DOCS) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log-probabilities (feature, language) and open scripts (script, language).

    ``labelled`` has doc_id, lang and text. Of a language with more than ``fit_docs`` documents, about
    that many are used, chosen by a hash of doc_id. The driver gets one table of BUCKETS rows per
    language, whatever the input.
    """
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    if sizes.count() <= SMALL_LIST:  # else a plain join
        sizes = F.broadcast(sizes)
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    chosen = labelled.join(sizes, "lang").filter(share < F.lit(float(fit_docs)) / F.col("n")).select("lang", "text")
    found = chosen.mapInArrow(_count_features, "lang string, feature int, n long").groupBy("lang", "feature").agg(
        F.sum("n").alias("n")).toArrow()
    names = found.column("lang").to_pylist()
    langs = sorted(set(names))
    counts = np.zeros((BUCKETS + N_SCRIPTS, len(langs)))
    number = {lang: i for i, lang in enumerate(langs)}
    counts[found.column("feature").to_numpy(), [number[n] for n in names]] = found.column("n").to_numpy()
    features, scripts = counts[:BUCKETS], counts[BUCKETS:]
    logs = np.log(features + SMOOTH) - np.log(features.sum(axis=0) + SMOOTH * BUCKETS)
    logs -= logs.mean(axis=1, keepdims=True) if langs else 0
    return langs, logs.astype(np.float32), scripts >= SCRIPT_SHARE * np.maximum(scripts.sum(axis=0), 1)


def word_scores(words: LetterWords, logs: np.ndarray, open_: np.ndarray) -> np.ndarray:
    """Score of each word (rows) in each language. A word in a script that no language uses is neutral."""
    scores = np.add.reduceat(logs[words.trigram], words.offset, axis=0) + logs[words.whole]
    may = open_[words.script]
    may |= ~may.any(axis=1, keepdims=True)
    return np.where(may, scores, np.float32(-1e4))


def best_path(scores: np.ndarray, first: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Labels of the best path of each text; text d has the words first[d] to first[d + 1].

    Texts of like length are worked off together, as many as keep the tables below PATH_CELLS numbers, however
    many languages there are; a longer text is a group of its own.
    """
    n = scores.shape[1]
    size = np.diff(first)
    labels = np.empty(len(scores), np.int16)
    order = np.argsort(size, kind="stable")
    order = order[size[order] > 0]
    step = np.minimum(size[order], STEP)        # of a group that ends with this text
    cells = -(-size[order] // STEP) * (n * n + 2 * n * step)
    begin = 0
    while begin < len(order):
        # Lengths rise, so a group costs its texts times what its longest text costs each.
        many = np.arange(1, len(order) - begin + 1)
        end = begin + max(1, int(np.searchsorted(many * cells[begin:], PATH_CELLS, side="right")))
        group = order[begin:end]
        own = np.concatenate([[0], np.cumsum(size[group])])
        words = np.arange(own[-1]) + np.repeat(first[group] - own[:-1], size[group])
        labels[words] = _paths(scores[words], own, switch, int(step[end - 1]))
        begin = end
    return labels


def _paths(scores: np.ndarray, first: np.ndarray, switch: float, step: int) -> np.ndarray:
    """The paths of a group of texts.

    Texts are cut into stretches of ``step`` words that are worked off side by side: first the best
    total of each stretch from every label to every label, then the labels at the seams, text by
    text, then the path inside each stretch. The result is that of one pass over each text.
    """
    n_words, n = scores.shape
    size = np.diff(first)
    per_text = -(-size // step)
    seam = np.cumsum(per_text) - per_text
    total = int(per_text.sum())
    text = np.repeat(np.arange(len(size)), size)
    inside = np.arange(n_words) - first[text]
    row, col = seam[text] + inside // step, inside % step
    padded = np.zeros((step, n, total), np.float32)
    padded[col, :, row] = scores
    across = np.empty((n, n, total), np.float32)  # [to, from, stretch]
    block = max(1, (1 << 20) // (n * n))
    for a in range(0, total, block):
        v = np.repeat(np.where(np.eye(n, dtype=bool), 0, -switch).astype(np.float32)[:, :, None], min(block, total - a), axis=2)
        v += padded[0, :, None, a:a + block]
        for t in range(1, step):
            np.maximum(v, v.max(axis=0) - np.float32(switch), out=v)
            v += padded[t, :, None, a:a + block]
        across[:, :, a:a + block] = v
    came = np.zeros((n, total), np.int16)
    best = np.zeros((n, len(size)))
    for k in range(int(per_text.max(initial=0))):
        live = np.flatnonzero(per_text > k)
        sums = best[None, :, live] + across[:, :, seam[live] + k]
        came[:, seam[live] + k] = sums.argmax(axis=1)
        best[:, live] = sums.max(axis=1)
    end, start = np.zeros(total, np.int64), np.zeros(total, np.int64)
    state = best.argmax(axis=0)
    for k in range(int(per_text.max(initial=0)) - 1, -1, -1):
        live = np.flatnonzero(per_text > k)
        here = seam[live] + k
        end[here] = state[live]
        state[live] = start[here] = came[state[live], here]
    labels = np.empty((step, total), np.int16)
    for a in range(0, total, block):
        b = min(a + block, total)
        each = np.arange(b - a)
        v = np.full((n, b - a), -switch, np.float32)
        v[start[a:b], each] = 0
        v += padded[0, :, a:b]
        stay, top = np.zeros((step, n, b - a), bool), np.zeros((step, b - a), np.int16)
        for t in range(1, step):
            floor = v.max(axis=0) - np.float32(switch)
            top[t] = v.argmax(axis=0)
            stay[t] = v >= floor
            v = np.maximum(v, floor) + padded[t, :, a:b]
        label = end[a:b]
        for t in range(step - 1, 0, -1):
            labels[t, a:b] = label
            label = np.where(stay[t, label, each], label, top[t, each])
        labels[0, a:b] = label
    return labels[col, row]


def _spans_of(model):
    def run(cols: list[list]) -> list:
        ids, texts = cols
        langs, logs, open_ = model.value
        words = LetterWords(texts)
        named, score, spans = [UNKNOWN] * len(texts), np.zeros(len(texts)), [[] for _ in texts]
        if len(words.start) and langs:
            label = best_path(word_scores(words, logs, open_), words.first)
            text = np.repeat(np.arange(len(texts)), np.diff(words.first))
            letters = np.bincount(text * len(langs) + label, weights=words.size, minlength=len(texts) * len(langs)).reshape(len(texts), -1)
            most, all_ = letters.argmax(axis=1), letters.sum(axis=1)
            for i in np.flatnonzero(all_):
                named[i] = langs[most[i]]
            score[all_ > 0] = letters.max(axis=1)[all_ > 0] / all_[all_ > 0]
            new = np.flatnonzero(np.append(True, (np.diff(text) > 0) | (np.diff(label) != 0)))
            last = np.append(new[1:], len(text)) - 1
            for a, b in zip(new, last):
                begin = words.text_begin[text[a]]
                spans[text[a]].append((int(words.start[a] - begin), int(words.end[b] - begin), langs[label[a]]))
        return [ids, named, score, [[{"begin": a, "end": b, "lang": x} for a, b, x in s] for s in spans]]
    return run


def identify(docs: DataFrame, model: tuple) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, lang_pred, score, spans (characters, ends exclusive).

    A text that is null, empty or without a letter is ``und`` with score 0 and no spans, and so is
    everything under a model without languages. Equal totals go to the language first in order.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_texts(docs.select("doc_id", "text"), _spans_of(shared), "doc_id long, lang_pred string, score double, "
                     "spans array<struct<begin:int,end:int,lang:string>>")


def held_out(doc_id, parts: int, rest: int):
    """Whether a document is kept from learning; one without a doc_id is not held out, nor learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == rest, F.lit(False))


def learned(docs: DataFrame) -> tuple:
    """A model from all documents of ``docs`` with a text and a lang, except the held-out ones."""
    known = docs.filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL")
    return fit(known.filter(~held_out(F.col("doc_id"), 4, 2)).select("doc_id", "lang", "text"))


def keep_identified(docs: DataFrame, model: tuple, min_share: float = MIN_SHARE) -> DataFrame:
    """``docs`` (all columns) without those that are ``und`` or in no language to at least ``min_share``.

    A model without languages tells nothing of a text: then only those without a letter go.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_filtering(shared, docs.columns.index("text"), min_share), docs.schema)


def _filtering(shared, at: int, min_share: float):
    spans = _spans_of(shared)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for a, b in pieces(texts):
                if shared.value[0]:
                    _, named, score, _ = spans([[None] * (b - a), texts[a:b]])
                    keep = [n != UNKNOWN and s >= min_share for n, s in zip(named, score)]
                else:
                    keep = np.diff(LetterWords(texts[a:b]).first) > 0
                yield batch.slice(a, b - a).filter(pa.array(keep, pa.bool_()))
    return run


@query("op9_language")
def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs.select("doc_id", "text"), learned(docs))
    return found.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")
