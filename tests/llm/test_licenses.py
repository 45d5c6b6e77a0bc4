"""Licences inside lines, sentences and code, against a plain version without bounds."""

import random
import re

import pytest

from ebbtide.llm import licenses
from ebbtide.llm.license_texts import TEMPLATES
from test_documents import awkward, frame

WORD = "[^\\W_]+"


def words(text):
    return re.findall(WORD, text.lower())


def pairs(found):
    return set(zip(found, found[1:]))


TEMPLATE_PAIRS = {name: pairs(words(text)) for name, text in TEMPLATES.items()}
KNOWN = set().union(*TEMPLATE_PAIRS.values())


def plain_scan(text, least=0.8):
    text = text or ""
    parts = (text.split("\n") + re.split("\n(?:[^\\w\n]*\n)+", text) + [text]
             + re.split("[.!?]+[ \t-\r]+", text.lower()))
    found = {tuple(words(p)) for p in parts} - {()}
    listed = words(text)
    places = [i for i, pair in enumerate(zip(listed, listed[1:])) if pair in KNOWN]
    for gap in licenses.GAPS:
        run = []
        for at in places + [None]:
            if run and (at is None or at - run[-1] > gap):
                if run[-1] - run[0] >= 1:
                    found.add(tuple(listed[run[0]:run[-1] + 2]))
                run = []
            run.append(at)
    hits = []
    for part in found:
        own = pairs(part)
        for name, other in TEMPLATE_PAIRS.items():
            dice = 2.0 * len(own & other) / (len(own) + len(other))
            if dice >= least:
                hits.append((-dice, name))
    best = min(hits, default=(None, None))
    return len(found), len(hits), best[1], best[0] and -best[0]


def scan(spark, texts):
    out = licenses.scan_licenses(frame(spark, list(enumerate(texts))), inside=True).collect()
    return [tuple(r)[1:] for r in sorted(out, key=lambda r: r["doc_id"])]


CODE = "\n".join(f"    value{i} = compute(value{i - 1}, {i})" for i in range(60))
CASES = [
    ("/*\n" + TEMPLATES["MIT-permission"] + "\n*/\n" + CODE, "MIT-permission"),
    ("A sentence before it. This document is licensed under the Apache License, Version 2.0.",
     "Apache-2.0-line"),
    ("Copyright by some firm, all rights reserved worldwide by them", "All-Rights-Reserved"),
    (TEMPLATES["GPL-2.0-notice"], "GPL-2.0-notice"),
    (TEMPLATES["LGPL-3.0-notice"], "LGPL-3.0-notice"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 "
     "International License.", "CC-BY-NC-SA-4.0-notice"),
    ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 "
     "International License.", "CC-BY-ND-4.0-notice"),
    ("# SPDX-License-Identifier: GPL-2.0-only\nimport os\n" + CODE, "GPL-2.0-only-identifier"),
    (" ".join(f"w{i}" for i in range(50)) + " " + TEMPLATES["BSD-3-Clause-text"]
     + " ".join(f" x{i}" for i in range(200)), "BSD-3-Clause-text"),
    ("The library of the town is open on all days of the week.", None)]


@pytest.mark.parametrize("number", range(len(CASES)))
def test_cases_of_the_plain_version(number):
    assert plain_scan(CASES[number][0])[2] == CASES[number][1]


def test_cases(spark):
    got = scan(spark, [text for text, _ in CASES])
    assert [g[2] for g in got] == [name for _, name in CASES]
    assert got == [plain_scan(text) for text, _ in CASES]


def test_every_template_finds_itself_inside_other_words(spark):
    names = sorted(TEMPLATES)
    got = scan(spark, [f"zz{i} yy{i} {TEMPLATES[name]} xx{i} vv{i}"
                       for i, name in enumerate(names)])
    same = {frozenset(p): n for n, p in sorted(TEMPLATE_PAIRS.items(), reverse=True)}
    assert [(g[2], g[3]) for g in got] == [(same[frozenset(TEMPLATE_PAIRS[n])], 1.0)
                                           for n in names]


def test_damaged_texts_against_the_plain_version(spark):
    draw = random.Random(11)
    texts = [t if t is None or len(t) < 100_000 else t[:3000] for _, t in awkward()]
    for _ in range(60):
        made = []
        for _ in range(draw.randint(1, 4)):
            part = TEMPLATES[draw.choice(sorted(TEMPLATES))].split()
            for _ in range(draw.randint(0, max(1, len(part) // 8))):
                part[draw.randrange(len(part))] = draw.choice(["of", "the", "other", "2", "x"])
            made.append(draw.choice([" ", "\n", "\n\n", ". ", " and "]).join(
                [" ".join(part[:20]), " ".join(part[20:])]))
        texts.append(draw.choice([" ", "\n", "\n\n", ". ", "; foo bar "]).join(made))
    assert scan(spark, texts) == [plain_scan(t) for t in texts]


def test_repeated_and_null_rows(spark):
    rows = [(1, "MIT"), (1, "MIT"), (None, None), (None, "All rights reserved"), (2, "")]
    out = licenses.scan_licenses(frame(spark, rows), inside=True).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_matches"]) for r in out) == [
        (False, 1, 0), (False, 1, 0), (False, 2, 0), (True, 0, 0), (True, 0, 1)]
    assert licenses.scan_licenses(frame(spark, []), inside=True).count() == 0
