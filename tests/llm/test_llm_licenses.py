"""The licence scan against plain Python over every rule."""

from __future__ import annotations

import random
import re

import cases
from tillflow.llm import licenses
from tillflow.llm.license_rules import BASE, rules

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(cases.normal(text))


def found(text):
    """All matches of all rules, without keywords: rule, priority, label, first and last word."""
    w = words(text)
    spaced = " " + "".join(f"{x} " for x in w)
    out = []
    for r in rules():
        for m in re.finditer(f" ({r.expression})(?= )", spaced):
            first = spaced[: m.start()].count(" ")
            out.append((r, first, first + m[1].count(" ")))
    return w, out


def expected(text):
    w, dets = found(text)

    def better(x, y):
        return (x[0].priority, x[2] - x[1], -x[0].number) > (y[0].priority, y[2] - y[1], -y[0].number)

    kept = [d for d in dets if not any(e[1] <= d[1] and e[2] >= d[2] and e[0].priority >= d[0].priority and better(e, d) for e in dets)]
    places = sorted(
        k for phrase in BASE for p in [phrase.split()] for k in range(len(w) - len(p) + 1) if w[k : k + len(p)] == p
    )
    base = {label for phrase, label in BASE.items() if f" {phrase} " in f" {' '.join(w)} "}
    labels = base | {d[0].label for d in kept}
    score = max([licenses.SURE[d[0].priority] for d in kept], default=0.0)
    ends = (places[0], places[-1]) if places else (None, None)
    return len(w), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), score


def example(rule, rng):
    """A text that an expression matches."""
    text = re.sub(r"\(\?:[^()]*\)(\?|\{\d+,\d+\}\?)", lambda m: "acme " if m[1] != "?" else "", rule.expression)
    text = re.sub(r"\(\?:([^()|]*)[^()]*\)", r"\1", text)
    text = re.sub(r"\[([^\]])[^\]]*\]", r"\1", text).replace(r"\d", "4")
    text = re.sub(r"\w\?", "", text)
    return " ".join(rng.choice([str.upper, str.title, str.lower])(x) for x in text.split())


TEXTS = [
    None, "", " \n\t", "no such words here", "MIT License", "mit license mit license, MIT-License!",
    "Licensed under the Apache License, Version 2.0.", "Apache License", "cc by", "CC BY-NC 4.0 and cc by cc by",
    "This work is licensed under the GNU General Public License, version 3.",
    "gnu general public\nlicense v2 or later; GNU Lesser General Public License v2.1",
    "SPDX-License-Identifier: MIT OR Apache-2.0", "https://www.apache.org/licenses/LICENSE-2.0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\")", "x\x01cc\x02by\x01", "ÄCC BY cc byÖ cc by",
    "mit license " * 3000, "(mit) [license] (c) all rights reserved $1 \\1",
]


def test_texts_like_plain_python(spark):
    rng = random.Random(3)
    texts = list(TEXTS)
    for rule in rules():
        texts.append(f"{cases.prose(rule.number, 20)}. {example(rule, rng)}, {cases.prose(rule.number + 1, 5)}")
    for seed in range(60):  # several licences side by side, some touching
        picked = rng.sample(rules(), 4)
        texts.append(rng.choice([" ", ". "]).join(example(r, rng) for r in picked))
    data = [(k, t, None, None, None, *["clash"] * len(cases.CLASHING)) for k, t in enumerate(texts)]
    data += [data[4], (None, TEXTS[6], None, None, None, *["clash"] * len(cases.CLASHING))]
    got = licenses.scan_licenses(cases.frame(spark, data)).collect()
    assert len(got) == len(data)
    quick = {k: expected(t) for k, t in enumerate(texts) if t is None or len(t) < 5000}
    for r in got:
        if r.doc_id in quick:
            assert tuple(r)[1:] == quick[r.doc_id], texts[r.doc_id]
    none = next(r for r in got if r.doc_id is None)
    assert none.labels == "apache,apache-2.0" and none.score == 0.8
    long = next(r for r in got if r.doc_id == TEXTS.index("mit license " * 3000))
    assert (long.n_words, long.n_base, long.first_word, long.last_word, long.labels) == (6000, 3000, 0, 5998, "mit")


def test_every_rule_finds_its_example():
    rng = random.Random(1)
    assert len(rules()) > 300
    for rule in rules():
        w, dets = found(example(rule, rng))
        assert rule in [d[0] for d in dets], rule
        assert set(rule.keywords) <= set(w), rule


def test_suppression(spark):
    data = [(1, "GNU General Public License version 3. GNU General Public License", *cases.rows()[0][2:])]
    scan = licenses.scanned(cases.frame(spark, data))
    got = {(r.label, r.start, r.end): r.kept for r in licenses.detections(scan).collect()}
    assert got == {
        ("gpl", 0, 3): False, ("gpl-3.0", 0, 5): True, ("gpl", 6, 9): True,
    }


def test_empty_table(spark):
    got = licenses.scan_licenses(cases.frame(spark, []))
    assert got.count() == 0
    assert got.columns == "doc_id n_words n_base first_word last_word base_labels labels score".split()
