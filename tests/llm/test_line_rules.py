"""Line rules and counts against direct computations."""

import re

from pyspark.sql import functions as F

from fieldlens.llm.line_rules import apply_rules, line_fails, repeated_words


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repeated(text):
    ws = words(text)
    at = {}
    for i in range(len(ws) - 7):
        at.setdefault(tuple(ws[i:i + 8]), []).append(i)
    return len({i + k for places in at.values() if len(places) > 1 for i in places for k in range(8)})


def test_counts(make, crowd, odd):
    rows = crowd + ["na " * 50, "a b c d e f g h " * 2, "a b c d e f g h i a b c d e f g h"]
    for r in apply_rules(make(list(enumerate(rows)) + [(i, t) for i, t in odd if i])).collect():
        t = r.text or ""
        lines = [x for x in t.split("\n") if words(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words(t)), sum(map(len, words(t))), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), repeated(t))
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.kept and r.base_failed)


def test_lines(make):
    good = "This is a sentence of some words, and it ends.\n" * 1 + "Here another one follows with further words in it.\nAnd a third one that is not the same."
    text = good + "\nHome | About | Contact\nAll rights reserved.\nfour words without end\n### *** $$$ %%%\nWOW!! NOW!! YES!!"
    row = apply_rules(make([text])).first()
    assert row.cleaned == good and row.kept
    junk = "\n".join("item | other | more | things" for _ in range(10)) + "\n" + good
    assert not apply_rules(make([junk])).first().kept


def test_boilerplate_is_whole_phrases_and_most_of_a_line(spark):
    fails = ["Log in", "Sign up | Log in", "We use cookies.", "Alle Rechte vorbehalten.", "Tous droits réservés.", "Iniciar sesión",
             "Copyright 2020", "Released under the MIT License.", "Click here!", "Read more: click here."]
    stays = ["He sat down to have a dialog in the garden.", "Fortune cookies were on the table.", "", "   ",
             "They had to sign up every single child of the village before the long summer had even begun.",
             "The log indicates nothing.", "Une copyrightée."]
    df = spark.createDataFrame([(t,) for t in [*fails, *stays]], "line string").select("line", line_fails(F.col("line")).alias("fails"))
    assert {r.line for r in df.collect() if r.fails} == set(fails)


def test_labels_agree(spark, small):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = apply_rules(docs).join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").select("quality", "kept", "n_words").collect()
    good = [r.kept for r in rows if r.quality == 1 and r.n_words >= 20]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_empty_and_plan(spark, empty, make):
    assert apply_rules(empty).count() == 0
    df = make(["x"]).withColumns({c: F.lit(0) for c in ("kept", "n_words", "lines")})
    plan = apply_rules(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange hash" not in plan
    assert df.select(repeated_words(F.lit(None).cast("string"))).first()[0] == 0
