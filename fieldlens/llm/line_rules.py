"""Line-first cleaning: rules decide on every line, and a document that loses too much goes.

A line fails if it is navigation (separators between short items), boilerplate (mostly fixed phrases of four
languages), mostly symbols, mostly exclamation marks, or a sentence that nothing ends: four words or more without closing
punctuation. Failing lines are removed. The document is rejected if less than half of its words are
left, if it has fewer than 20 words, or if eight-word windows that occur twice cover more than 30 % of it.

All of it is column expressions, row by row: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldlens.llm.common import BLANKS, query, table
from fieldlens.llm.line_windows import let

WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30
MIN_KEPT = 50

# What counts as a symbol, a separator, an end of a sentence, a boilerplate phrase.
SYMBOLS = "#*$%&|<>"
SEPARATORS = "|»›•·>"
ENDINGS = ".!?…:;\"'”’»)]。！？"
BOILERPLATE = ("all rights reserved", "privacy policy", "terms of use", "terms of service", "terms and conditions",
               "cookie policy", "cookie settings", "accept cookies", "accept all cookies", "uses cookies", "use cookies",
               "copyright", "licensed under", "is licensed", "released under", "sign up", "sign in", "log in", "subscribe",
               "click here", "read more", "enable javascript", "skip to content", "skip to main content", "back to top",
               "alle rechte vorbehalten", "datenschutzerklärung", "nutzungsbedingungen", "impressum", "cookies akzeptieren",
               "jetzt anmelden", "newsletter abonnieren", "hier klicken", "weiterlesen", "zum inhalt springen",
               "tous droits réservés", "politique de confidentialité", "mentions légales", "conditions d'utilisation",
               "accepter les cookies", "se connecter", "s'inscrire", "cliquez ici", "lire la suite", "aller au contenu",
               "todos los derechos reservados", "política de privacidad", "aviso legal", "términos de uso", "aceptar cookies",
               "iniciar sesión", "suscríbete", "haga clic aquí", "leer más", "saltar al contenido")
# A line is boilerplate if such phrases, as whole words, are at least a quarter of its characters.
PHRASES = f"(^|[^\\p{{L}}\\p{{N}}])({'|'.join(BOILERPLATE)})([^\\p{{L}}\\p{{N}}]|$)"


def count_of(text: Column, characters: str) -> Column:
    """How often any of ``characters`` (none of them a sign of character classes) stands in the text."""
    return F.regexp_count(text, F.lit(f"[{characters}]"))


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def size_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+"))


def repeated_words(text: Column) -> Column:
    """Words that lie in an eight-word window found twice or more in the text, first places included.

    Windows are compared by 64-bit hashes within one text. A hash set tells whether any is there twice; only such
    a text goes on to places. Sorted arrays and neighbours keep their cost near n log n for any length.
    """
    def covered(keys: Column) -> Column:
        placed = F.sort_array(F.transform(keys, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(p: Column) -> Column:
            same = lambda x, i: F.coalesce(F.get(p, i)["h"] == x["h"], F.lit(False))
            return F.sort_array(F.transform(F.filter(p, lambda x, i: same(x, i - 1) | same(x, i + 1)), lambda x: x["i"]))
        gaps = lambda at: F.aggregate(
            F.transform(at, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW)))),
            F.lit(0), lambda a, x: a + x)
        return let(let(placed, twice), gaps)

    def with_keys(keys: Column) -> Column:
        return F.when(F.size(F.array_distinct(keys)) < F.size(keys), covered(keys)).otherwise(F.lit(0))

    def windows(hashes: Column) -> Column:
        count = F.size(hashes) - (WINDOW - 1)
        return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.xxhash64(
            *[F.get(hashes, i + k) for k in range(WINDOW)])))

    keys = let(F.transform(words_of(text), lambda w: F.xxhash64(w)), windows)
    return F.coalesce(let(keys, with_keys), F.lit(0)).cast("long")


def line_fails(line: Column) -> Column:
    """The verdict of the rules on one line; lines without words never fail."""
    def boilerplate(low: Column) -> Column:
        said = F.length(low) - F.length(F.regexp_replace(low, PHRASES, ""))
        return low.rlike(PHRASES) & (4 * said >= F.length(low))

    def verdict(n: Column) -> Column:
        navigation = let(count_of(line, SEPARATORS), lambda k: (k >= 2) & (5 * k >= n))
        symbols = 10 * count_of(line, SYMBOLS) > F.length(line)
        shouting = (n >= 3) & (2 * count_of(line, "!") > n)
        open_end = (n >= 4) & ~F.right(F.rtrim(line), F.lit(1)).isin(*ENDINGS)
        # The dearest rule comes last: what failed before is not looked at again.
        return (n > 0) & (open_end | shouting | symbols | navigation | let(F.lower(line), boilerplate))
    return let(size_of(line), verdict)


def apply_rules(docs: DataFrame) -> DataFrame:
    """``docs`` plus cleaned (text of the lines left), n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_kept_words, base_failed, kept.

    A null text counts as empty: all counts 0, base_failed true, kept false, cleaned empty. Repeated
    rows are judged alike, other columns pass through (a column named like a result is replaced).
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.split(text, "\n")
    worded = F.filter(lines, lambda x: F.translate(x, BLANKS, "") != "")
    out = docs.withColumns({
        "cleaned": F.array_join(F.filter(lines, lambda x: ~line_fails(x)), "\n"),
        "n_words": size_of(text).cast("long"),
        "word_chars": F.length(F.translate(text, BLANKS, "")).cast("long"),
        "n_symbols": count_of(text, SYMBOLS).cast("long"),
        "n_dup_lines": let(worded, lambda w: F.size(w) - F.size(F.array_distinct(w))).cast("long"),
        "n_repeat_words": repeated_words(text)})
    out = out.withColumns({
        "n_kept_words": size_of(F.col("cleaned")).cast("long"),
        "base_failed": (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))})
    return out.withColumn("kept", ~F.col("base_failed") & (100 * F.col("n_kept_words") >= MIN_KEPT * F.col("n_words")))


_W = "[^\\x20\\x09-\\x0D]+"
_PHRASES = PHRASES.replace("'", "''")
_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '{_W}') AS ws, string_split(text, chr(10)) AS ls FROM t),
p AS (SELECT doc_id, i, ws[i + 1:i + 8] AS win FROM (SELECT doc_id, ws, unnest(range(0, len(ws) - 7)) AS i FROM w WHERE len(ws) >= 8)),
r AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, win) AS n FROM p) WHERE n > 1),
c AS (SELECT doc_id, count(*) AS n FROM (SELECT DISTINCT doc_id, i + unnest(range(0, 8)) AS k FROM r) GROUP BY doc_id),
l AS (SELECT doc_id, line, len(regexp_extract_all(line, '{_W}')) AS n, lower(line) AS low,
             len(line) - len(translate(line, '{SEPARATORS}', '')) AS sep,
             len(line) - len(translate(line, '{SYMBOLS}', '')) AS sym, len(line) - len(replace(line, '!', '')) AS bang
      FROM (SELECT doc_id, unnest(ls) AS line FROM w)),
k AS (SELECT doc_id, sum(n) AS kept_words,
             count(*) FILTER (WHERE worded) - count(DISTINCT line) FILTER (WHERE worded) AS dup
      FROM (SELECT doc_id, line, n > 0 AS worded,
                   CASE WHEN n > 0 AND ((regexp_matches(low, '{_PHRASES}') AND 4 * (len(low) - len(regexp_replace(low, '{_PHRASES}', '', 'g'))) >= len(low)) OR (sep >= 2 AND 5 * sep >= n) OR 10 * sym > len(line)
                        OR (n >= 3 AND 2 * bang > n)
                        OR (n >= 4 AND NOT contains('{ENDINGS.replace("'", "''")}', right(rtrim(line, ' '), 1)))) THEN 0 ELSE n END AS n
            FROM l) GROUP BY doc_id),
f AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(len(text) - len(translate(text, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
             CAST(coalesce(k.dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
             coalesce(k.kept_words, 0) AS kept_words
      FROM w LEFT JOIN c ON w.doc_id = c.doc_id LEFT JOIN k ON w.doc_id = k.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND 100 * kept_words >= 50 * n_words AS kept
FROM f
"""


@query("op8_line_rules", _SQL)
def op8_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
