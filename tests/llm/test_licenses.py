"""License scan: the contract's counts by plain Python, the rules by texts made from their patterns."""

import random
import re
from re import _constants as op, _parser as parser

import pytest

from fieldlens.llm.license_rules import BASE, REACH, RULES, Rule
from fieldlens.llm.licenses import Gate, digest, find_licenses, matches, resolved
from fieldlens.llm.queries import QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def made(tree, rng, most):
    """A random text that a parsed pattern matches; ``most``: every repeat as often as it may."""
    out = []
    for kind, arg in tree:
        if kind is op.LITERAL:
            out.append(chr(arg))
        elif kind is op.IN:
            if arg[0][0] is op.NEGATE:
                out.append("q")
            else:
                a, b = rng.choice([(x, x) if k is op.LITERAL else x for k, x in arg])
                out.append(chr(rng.randint(a, b)))
        elif kind in (op.ANY, op.NOT_LITERAL):
            out.append("q")
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT):
            low, high, part = arg
            high = min(high, 60)
            out += [made(part, rng, most) for _ in range(high if most else rng.randint(low, min(high, low + 2)))]
        elif kind is op.SUBPATTERN:
            out.append(made(arg[3], rng, most))
        elif kind is op.BRANCH:
            out.append(made(rng.choice(arg[1]), rng, most))
        elif kind not in (op.ASSERT, op.ASSERT_NOT, op.AT):
            raise ValueError(kind)
    return "".join(out)


def test_hundreds_of_rules_with_sound_gates():
    assert len(RULES) >= 280 and len({r.label for r in RULES}) > 90
    rng = random.Random(3)
    gate = Gate()
    for number, rule in enumerate(RULES):
        tree = parser.parse(rule.pattern.pattern)
        for k in range(25):
            text = made(tree, rng, most=k % 3 == 0)
            words = text.split(" ")
            assert words == words_of(text), (rule, text)
            assert len(words) <= REACH and all(not g.isdisjoint(words) for g in rule.keywords), (rule, text)
            assert (number, 2, 2 + len(words)) in matches(["some", "words", *words, "behind"], gate) or any(
                n == number for n, *_ in matches(words, gate)), (rule, text)


def base_of(text):
    words = words_of(text)
    places = [(i, label) for phrase, label, _ in BASE for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return len(words), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def check(rows, texts):
    assert len(rows) == len(texts)
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows), key=repr)
    assert got == sorted(((i is None, i or 0, *base_of(t)) for i, t in texts), key=repr)
    for r in rows:
        labels = r.labels.split(",") if r.labels else []
        assert labels == sorted(set(labels)) and set(filter(None, r.base_labels.split(","))) <= set(labels)
        assert 0 <= r.score <= 1 and (r.score > 0) == bool(labels)


def test_query_base_columns(spark, small):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rows = QUERIES["op13_licenses"](spark, small).collect()
    check(rows, texts)
    assert any(r.n_base for r in rows)


CASES = [
    ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
    ("Released under the MIT License.", "mit"),
    ("mit Lizenz; er kam mit der license nicht", ""),
    ("SPDX-License-Identifier: GPL-2.0-or-later", "gpl-2.0-or-later"),
    ("SPDX-License-Identifier: MIT", "mit"),
    ("https://creativecommons.org/licenses/by-nc-sa/4.0/", "cc-by-nc-sa"),
    ("CC-BY-SA 4.0", "cc-by,cc-by-sa"),
    ("CC BY 4.0 and CC0", "cc-by,cc-by-4.0,cc0"),
    ("GNU Lesser General\nPublic License version 2.1", "lgpl-2.1"),
    ("Mozilla Public License, v. 2.0; BSD 3-Clause License", "bsd-3-clause,mpl-2.0"),
    ("in the public domain", "public-domain"),
    ("It is licensed under the terms of our agreement", "unstated"),
    ("All rights reserved.", "all-rights-reserved"),
    ("A common database of open development, commons and users", ""),
    ("the gnu general public licenses cc bye apache's licence", ""),
]


def test_labels(make):
    rows = {r.doc_id: r.labels for r in digest(find_licenses(make([t for t, _ in CASES]))).collect()}
    got = [(t, rows[i]) for i, (t, _) in enumerate(CASES)]
    assert got == CASES


def brute_stays(found, rules):
    out = []
    for i, (n, a, b) in enumerate(found):
        covered = False
        for j, (m, c, d) in enumerate(found):
            if j != i and c <= a and b <= d:
                p, q = rules[n].priority, rules[m].priority
                covered |= q > p or q == p and ((d - c) > (b - a) or (c, d) == (a, b) and m < n)
        out.append(not covered)
    return out


def test_suppression_equals_all_pairs():
    rng = random.Random(8)
    rules = tuple(Rule("x", rng.randint(1, 4), (frozenset("x"),), re.compile("x")) for _ in range(12))
    for _ in range(400):
        found = {(rng.randrange(12), a, a + rng.randint(1, 6)) for a in (rng.randrange(10) for _ in range(rng.randint(0, 9)))}
        found = sorted(found, key=lambda m: (m[1], m[2], m[0]))
        assert resolved(found, rules) == brute_stays(found, rules)


@pytest.mark.parametrize("gap", [0, 1, 60, 63, 64, 65, 127, 128, 129, 400])
def test_stretches_miss_nothing(make, gap):
    """Matches between other keywords at every distance are found as on the whole text."""
    fill = ["wort"] * gap
    text = " ".join([*fill, "gnu", *fill, "gnu general public license version 2", *fill, "apache", *fill, "mit license", "license", *fill])
    (row,) = find_licenses(make([text], parts=1)).collect()
    whole = sorted(matches(words_of(text), Gate()), key=lambda m: (m[1], m[2], m[0]))
    assert [(d.rule, d.first, d.end) for d in row.found] == whole and len(whole) >= 4


def test_odd_rows(make, odd, empty):
    rows = [*odd, (20, "MIT License " * 3000), (21, "cc by cc by ccby cc\x00by"), (21, "gnu general public license"), (None, "mit license")]
    check(digest(find_licenses(make(rows))).collect(), rows)
    assert digest(find_licenses(empty)).collect() == []
    clash = make(rows).selectExpr("*", "1 AS n_words", "'x' AS found", "2 AS labels")
    check(digest(find_licenses(clash)).collect(), rows)
