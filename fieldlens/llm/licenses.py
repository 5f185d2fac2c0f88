"""License scan: ordered signature rules behind a keyword gate.

A text is a row of words (letters, digits, everything beyond ASCII; A to Z in lower case). The gate looks for the rules'
rarest keywords among the hashes of all words; only stretches of REACH words around a hit become text again, and
only rules whose keywords all stand in the stretch are tried on it. As every match holds its keywords within
REACH words, nothing is missed. Detections that overlap are resolved by order: one whose words lie within those of a
detection of higher priority, or of a longer one of the same priority, goes; of the same words the earlier rule stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm.common import map_texts, query, table
from fieldlens.llm.license_rules import REACH, RULES, WEIGHT, Rule
from fieldlens.llm.wordscan import ALNUM, Words

# Label of phrases that lead to a license ("licensed under"); it counts where no other is found.
UNSTATED = "unstated"
WORD_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")


class Gate:
    """Which words may begin the search of which rules."""

    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        self.by_word: dict[str, list[int]] = {}
        for number, rule in enumerate(rules):
            for word in rule.keywords[0]:
                self.by_word.setdefault(word, []).append(number)
        self.hashes = np.sort(Words([" ".join(self.by_word)], ALNUM).hashes())

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Places of words that are keywords."""
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.flatnonzero(self.hashes[at] == hashes)

    def tried(self, words: set[str]) -> Iterator[int]:
        for word in words & self.by_word.keys():
            for number in self.by_word[word]:
                if all(not group.isdisjoint(words) for group in self.rules[number].keywords[1:]):
                    yield number


def matches(words: list[str], gate: Gate) -> set[tuple[int, int, int]]:
    """Matches in a row of words: rule, first word, word after the last."""
    text = " ".join(words)
    begins = np.cumsum([0] + [len(w) + 1 for w in words])
    found = set()
    for number in set(gate.tried(set(words))):
        for m in gate.rules[number].pattern.finditer(text):
            a, b = np.searchsorted(begins, (m.start(), m.end() + 1))
            found.add((number, int(a), int(b)))
    return found


def resolved(found: list[tuple[int, int, int]], rules: tuple[Rule, ...] = RULES) -> list[bool]:
    """For each detection (sorted by first word), whether it stays.

    One pass: what covers a detection begins no later, so the farthest ends seen so far, by priority, decide.
    """
    stays = [True] * len(found)
    farthest: dict[int, int] = {}
    order = sorted(range(len(found)), key=lambda i: (found[i][1], -rules[found[i][0]].priority, -found[i][2], found[i][0]))
    # At equal begins: higher priorities first, then longer ones, then earlier rules; who comes first covers who follows.
    for i in order:
        number, _, end = found[i]
        priority = rules[number].priority
        stays[i] = all(end > far for p, far in farthest.items() if p >= priority)
        farthest[priority] = max(end, farthest.get(priority, 0))
    return stays


FOUND = "array<struct<label: string, rule: int, priority: int, first: long, end: long, base: boolean, stays: boolean>>"
_gates: list[Gate] = []


def _gate() -> Gate:
    """The rules are compiled once in a worker."""
    if not _gates:
        _gates.append(Gate())
    return _gates[0]


def _rows(cols: list[list]) -> list:
    ids, texts = cols
    gate = _gate()
    words = Words(texts, ALNUM, lower=True)
    hits = gate.places(words.hashes())
    found: list[list] = [[] for _ in texts]
    if len(hits):
        doc = words.doc[hits]
        cut = np.flatnonzero((np.diff(hits) > 2 * REACH) | (np.diff(doc) > 0)) + 1
        for a, b in zip(np.append(0, cut), np.append(cut, len(hits))):
            d = int(doc[a])
            lo = max(int(words.first[d]), int(hits[a]) - REACH)
            hi = min(int(words.first[d + 1]), int(hits[b - 1]) + REACH + 1)
            stretch = [w.decode("utf-8", "surrogatepass") for w in WORD_BYTES.findall(words.blob, words.start[lo], words.end[hi - 1])]
            shift = lo - int(words.first[d])
            found[d] += [(number, x + shift, y + shift) for number, x, y in matches(stretch, gate)]
    out = []
    for one in found:
        one = sorted(set(one), key=lambda m: (m[1], m[2], m[0]))
        out.append([{"label": gate.rules[r].label, "rule": r, "priority": gate.rules[r].priority, "first": a, "end": b,
                     "base": gate.rules[r].base, "stays": s} for (r, a, b), s in zip(one, resolved(one, gate.rules))])
    return [ids, np.diff(words.first), out]


def find_licenses(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_words, found.

    ``found`` has all detections, sorted by their first word: label, number of the rule, priority, first word, word after
    the last, whether the rule is a base phrase, whether it stays. A null or empty text has no words and no
    detection. Rows that repeat are alike, a null doc_id stays null, an empty table gives an empty result;
    other columns are not read.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return map_texts(docs.select("doc_id", "text"), _rows, f"doc_id {kind}, n_words long, found {FOUND}")


def digest(licenses: DataFrame) -> DataFrame:
    """Places of base phrases, labels and a score of every row of ``find_licenses``.

    The score is the probability that one of the texts that stay is what its rule says, as if they were independent.
    """
    base = F.filter("found", lambda m: m["base"])
    shown = F.filter("found", lambda m: m["base"] | m["stays"])
    named = F.filter(shown, lambda m: m["label"] != UNSTATED)
    shown = F.when(F.size(named) > 0, named).otherwise(shown)
    weights = F.create_map(*[F.lit(x) for pair in WEIGHT.items() for x in pair])

    def labels(found):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(found, lambda m: m["label"]))), ",")

    def doubt(found):
        return F.aggregate(found, F.lit(1.0), lambda left, m: left * (1 - F.element_at(weights, m["priority"])))

    return licenses.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda m: m["first"])).alias("first_word"),
        F.array_max(F.transform(base, lambda m: m["first"])).alias("last_word"),
        labels(base).alias("base_labels"), labels(shown).alias("labels"), (1 - doubt(shown)).alias("score"))


@query("op13_licenses")
def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_licenses(table(spark, sf_dir, "documents")))
