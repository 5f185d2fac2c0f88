"""Secrets by pattern, and passwords by guess cost.

Three patterns find assigned secrets, access keys and hexadecimal keys. Beyond them, every value that
follows a credential word is rated by the number of guesses that a cracker who knows words, dates,
repeats, sequences and keyboard walks would need: dynamic programming finds the cheapest way to cut
the value into such pieces and brute-force characters. Values of GUESS_BITS or more are spans of
their own kind; a credential context with an easily guessed value (a placeholder, a word) is none.

Words are priced by rank: first the fixed list, then the words of the documents themselves by the number
of documents that have them. Three steps keep this exact and small: a value that stays above the bound
even if all its letters made up words of the best rank needs no lookup; of the others, every piece of
letters is joined with the ranked words; the values that are easy then lose their spans. Words inside
credential values do not count, so that a secret does not make itself a word.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fieldlens.llm.common import map_texts, query, table
from fieldlens.session import stored

KINDS = ("assign", "access", "hex", "guess")
GUESS_BITS = 34.0

# Fixed values of the contract: the base patterns and the least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # runs that are too short fail anyway
ASSIGN_VALUE, ACCESS_ALL = 12, 18

CONTEXT = re.compile(r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|api[_ -]?key|credentials?|authorization)["']?"""
                     r"""\x20*(?:is\x20|:=|=>|[:=])\x20*["']?([^\s"']{6,})""", re.I | re.A)
CONTEXT_WORDS = ("pass", "pwd", "secret", "token", "api", "credential", "authorization")

# Words that lists of common passwords begin with, commonest first, and a keyboard's rows.
COMMON = ("password", "qwerty", "dragon", "monkey", "letmein", "football", "iloveyou", "admin", "welcome",
          "login", "princess", "sunshine", "master", "shadow", "hello", "freedom", "whatever", "baseball",
          "superman", "batman", "trustno", "secret", "summer", "winter", "spring", "autumn", "love", "test",
          "user", "root", "guest", "default", "change", "please", "example", "sample", "your", "here", "token",
          "key", "none", "null", "true", "false", "undefined", "placeholder", "redacted", "hidden", "company",
          "computer", "internet", "service", "server", "system", "database", "access", "public", "private")
ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
LEET = str.maketrans("013457@$!", "oieastasi")
DATE = re.compile(r"(?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])(?:[-/.]?(?:0[1-9]|[12]\d|3[01]))?)?"
                  r"|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:(?:19|20)\d\d)?")

# Words of the documents: letters, from the shortest to the longest, in so many documents at least.
SHORTEST_WORD, LONGEST_WORD, LEAST_DOCS = 3, 32, 2

_RANK = {word: rank for rank, word in enumerate(COMMON, 1)}
_LONGEST = max(map(len, COMMON))
assert _LONGEST <= LONGEST_WORD
_PLACE = {c: (r, k) for r, row in enumerate(ROWS) for k, c in enumerate(row)}
_CLASSES = ((str.isdigit, 10), (str.islower, 26), (str.isupper, 26))


def character_bits(c: str) -> float:
    if not c.isascii():
        return math.log2(5000)
    return math.log2(next((n for test, n in _CLASSES if test(c)), 33))


def _adjacent(a: str, b: str) -> bool:
    p, q = _PLACE.get(a), _PLACE.get(b)
    return p is not None and q is not None and p != q and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1


def _best_rank(piece: str) -> int | None:
    """The rank of a piece if every run of letters were a word of the documents."""
    return _RANK.get(piece) or (len(COMMON) + 1 if piece.isalpha() else None)


def guess_bits(value: str, rank_of: Callable[[str], int | None] = _RANK.get, longest: int = _LONGEST) -> float:
    """Logarithm to base 2 of the guesses for the cheapest segmentation of ``value``.

    ``rank_of`` gives the rank of a word of up to ``longest`` letters, or None. Runs (repeats, sequences,
    keyboard walks) are taken from their longest start, so the work grows with the length times the
    longest word.
    """
    n = len(value)
    low = value.lower()
    plain = low.translate(LEET)
    best = [0.0] + [math.inf] * n
    run = {"same": 0, "up": 0, "down": 0, "walk": 0}  # steps of each kind that end at the present character
    period: dict[int, int] = {}
    for i in range(n):
        end = i + 1
        cost = best[i] + character_bits(value[i])
        if i:
            step = ord(low[i]) - ord(low[i - 1])
            alike = low[i].isalnum() and low[i - 1].isalnum()
            run["same"] = run["same"] + 1 if step == 0 else 0
            run["up"] = run["up"] + 1 if step == 1 and alike else 0
            run["down"] = run["down"] + 1 if step == -1 and alike else 0
            run["walk"] = run["walk"] + 1 if _adjacent(low[i - 1], low[i]) else 0
            for kind, steps in run.items():
                if steps >= 2:
                    # A walk may turn at each key (two bits); the other runs are named by first and length.
                    bits = character_bits(value[i]) + math.log2(steps + 1) + (2 * steps if kind == "walk" else 1)
                    cost = min(cost, best[i - steps] + bits)
        for size in range(2, 9):  # a repeated block of up to eight characters
            period[size] = period.get(size, 0) + 1 if i >= size and low[i] == low[i - size] else 0
            times = period[size] // size
            if times:
                begin = end - (times + 1) * size
                cost = min(cost, best[begin + size] + math.log2(times + 1) + 1)
        for size in range(SHORTEST_WORD, min(longest, end) + 1):
            own = rank_of(low[end - size:end])
            rank = own or rank_of(plain[end - size:end])
            if rank:
                piece = value[end - size:end]
                cost = min(cost, best[end - size] + math.log2(rank + 1) + (piece != piece.lower()) * 2
                           + (own is None) * 2)
        for size in (4, 6, 7, 8, 10):
            if size <= end and DATE.fullmatch(value, end - size, end):
                cost = min(cost, best[end - size] + (7 if size == 4 else 16))
        best[end] = cost
    return best[n]


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all spans of a text, in order."""
    found = []
    low = text.lower()
    credential = any(w in low for w in CONTEXT_WORDS)
    if credential:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_ALL]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    if credential:
        for m in CONTEXT.finditer(text):
            value = m[1].rstrip(".,;:!?)]}>")
            if len(value) >= 6 and guess_bits(value) >= GUESS_BITS:
                found.append((m.start(1), 3, m.start(1) + len(value)))
    return sorted(found)


def _open_value(value: str) -> str | None:
    """The value if words of the documents could still make it easy."""
    return value if guess_bits(value, _best_rank, LONGEST_WORD) < GUESS_BITS else None


def _rows(cols: list[list]) -> list:
    ids, texts = cols
    return [ids, [[{"kind": KINDS[k], "begin": a, "end": b, "value": _open_value(t[a:b]) if KINDS[k] == "guess" else None}
                   for a, k, b in spans_of(t or "")] for t in texts]]


def pieces_of(value: str) -> list[str]:
    """Every run of letters of ``value`` that can be a word, also with digits read as letters."""
    found = set()
    for text in (value.lower(), value.lower().translate(LEET)):
        for run in re.finditer(r"[^\W\d_]+", text):
            word = run[0]
            found.update(word[a:b] for a in range(len(word))
                         for b in range(a + SHORTEST_WORD, min(a + LONGEST_WORD, len(word)) + 1))
    return sorted(found)


def _easy_rows(cols: list[list]) -> list:
    values, words = cols
    ranks = [{**{w["word"]: w["rank"] for w in known}, **_RANK} for known in words]
    return [values, [guess_bits(v, r.get, LONGEST_WORD) < GUESS_BITS for v, r in zip(values, ranks)]]


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n: in how many rows of ``docs`` each word occurs outside of credential values."""
    outside = F.regexp_replace("text", "(?i)" + CONTEXT.pattern, " ")
    words = docs.select(F.explode(F.array_distinct(F.split(F.lower(outside), "[^\\p{L}]+"))).alias("word"))
    return words.filter(F.length("word").between(SHORTEST_WORD, LONGEST_WORD)).groupBy("word").agg(
        F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_DOCS)


def easy_values(docs: DataFrame, values: DataFrame) -> DataFrame:
    """Those rows of ``values`` (text, distinct) that the words of ``docs`` make easy to guess.

    The rank of a word is the number of words that are in as many documents or more, after the fixed list.
    """
    counts, _ = stored(word_counts(docs), "secret-words")
    # One row per number of documents: far fewer than words.
    ranks = counts.groupBy("n").agg(F.count(F.lit(1)).alias("alike")).select(
        "n", (F.sum("alike").over(Window.orderBy(F.col("n").desc())) + len(COMMON)).alias("rank"))
    pieces = map_texts(values, lambda cols: [cols[0], [pieces_of(v) for v in cols[0]]], "text string, words array<string>").select(
        "text", F.explode("words").alias("word"))
    known = pieces.join(counts, "word").join(ranks, "n").groupBy("text").agg(F.collect_list(F.struct("word", "rank")).alias("words"))
    return map_texts(known, _easy_rows, "text string, easy boolean").filter("easy").select("text")


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, spans (kind, begin, end) by place, then kind.

    Places are characters (code points), ends exclusive. A null or empty text has no spans. Whole
    texts are searched; the cost of a value grows with its length. Repeated rows are alike. The words
    that make a value easy are those of ``docs``; they are counted if a value depends on them.
    """
    found, _ = stored(map_texts(
        docs.select("doc_id", "text"), _rows, "doc_id long, spans array<struct<kind:string,begin:int,end:int,value:string>>").withColumn(
        "row_no", F.monotonically_increasing_id()), "secret-spans")
    bare = lambda s: F.struct(s["kind"].alias("kind"), s["begin"].alias("begin"), s["end"].alias("end"))
    undecided = found.select("row_no", F.explode("spans").alias("s")).filter("s.value IS NOT NULL").select(
        "row_no", "s.begin", F.col("s.value").alias("text"))
    if undecided.isEmpty():
        return found.select("doc_id", F.transform("spans", bare).alias("spans"))
    easy = easy_values(docs, undecided.select("text").distinct())
    dropped = undecided.join(easy, "text", "left_semi").groupBy("row_no").agg(F.collect_list("begin").alias("easy"))
    kept = lambda s: s["value"].isNull() | F.col("easy").isNull() | ~F.array_contains("easy", s["begin"])
    return found.join(dropped, "row_no", "left").select("doc_id", F.transform(F.filter("spans", kept), bare).alias("spans"))


@query("op7_secrets")
def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    listed = lambda spans: F.array_join(F.transform(
        spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                        F.sha2(listed(base).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"),
                        count("guess").alias("n_guess"))
