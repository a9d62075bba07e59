"""The scan against a plain form: every rule on every text, suppression over all pairs."""

import random
import re

import pytest

from cumulus.llm import license_rules as L
from cumulus.llm import license_scan as S
from tests.llm.conftest import DOCS, prose

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RULES = [(a, b, c, re.compile(L.regex(p))) for a, b, c, _, p in L.rules()]
UP = str.maketrans(S.UPPER, S.LOWER)


def plain(text):
    words = WORD.findall((text or "").translate(UP))
    places, base = [], set()
    for phrase, label in S.BASE:
        p = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(p)] == p:
                places.append(i)
                base.add(label)
    norm = "".join(f" {w} " for w in words)
    found = []
    for i, (label, prio, conf, rx) in enumerate(RULES):
        for m in rx.finditer(norm):
            s = norm[:m.start()].count(" ") // 2
            found.append((s, s + m.group().count(" ") // 2, prio, i, label, conf))
    kept = [d for d in found if not any(
        o[0] <= d[0] and o[1] >= d[1] and o[2] >= d[2] and (o[:2] != d[:2] or (-o[2], o[3]) < (-d[2], d[3])) for o in found)]
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | {d[4] for d in kept})), max([d[5] for d in kept] + [0.5 if base else 0.0]))


NOTICES = ["Licensed under the Apache License, Version 2.0 (the \"License\")", "Released under the MIT License.",
           "CC-BY-SA 4.0 or cc by", "SPDX-License-Identifier: GPL-3.0", "GNU Lesser General Public License v2.1",
           "the GNU General Public License as published by the FSF; either version 2 of the License, or (at your option) any later version",
           "Copyright (c) 2019 Someone. ALL RIGHTS RESERVED", "3-clause BSD", "mit licence", "Creative Commons Attribution-ShareAlike 3.0",
           "https://creativecommons.org/licenses/by/4.0/", "public domain", "in the public\ndomain", "CC0 1.0 Universal Public Domain Dedication",
           "may be used to endorse or promote products derived from this software", "Mozilla Public License, v. 2.0",
           "all rights reserved all rights reserved", "cc by cc by-nc", "unlicensed", "_cc_by_", "GPLv3", "reserved all rights"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    out = [*NOTICES, " ".join(NOTICES), "\n".join(NOTICES * 5), None, "", "...", "é cc by ü", prose(rng, 3000) + NOTICES[0]]
    for _ in range(60):
        words = prose(rng, 40).split()
        for _ in range(rng.randint(0, 3)):
            words.insert(rng.randrange(len(words)), rng.choice(NOTICES))
        out.append(" ".join(words))
    return out


def test_hundreds_of_rules_with_valid_prefilters():
    rules = L.rules()
    assert len(rules) > 200
    for _, prio, conf, keyword, pattern in rules:
        assert 1 <= prio <= S.LEVELS and 0 < conf <= 1 and " " not in keyword
        words = [re.sub(r"[(?:|)]", " ", re.sub(r"\[.*?\]|\{.*?\}", "", w)).split() for w in pattern.split(" ")
                 if not w.startswith("..") and not w.endswith("?")]
        assert any(ws and all(x.startswith(keyword) for x in ws) for ws in words), (keyword, pattern)
        assert any(ws and all(any(r in x for r in L.ROOTS) for x in ws) for ws in words) or "commercial" in pattern, pattern


def test_scan_matches_plain_form(spark, texts):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], DOCS)
    got = {r["doc_id"]: tuple(r)[1:] for r in S.digest(S.scan(docs)).collect()}
    for i, t in enumerate(texts):
        assert got[i] == plain(t), t


def test_edges(edge, empty, clashing):
    got = sorted((tuple(r) for r in S.digest(S.scan(edge)).collect()), key=repr)
    assert got == sorted(((r["doc_id"], *plain(r["text"])) for r in edge.collect()), key=repr)
    scanned = S.scan(clashing)
    assert [c for c in scanned.columns if c in clashing.columns and c not in ("n_words", "found", "kept")] == [
        c for c in clashing.columns if c not in ("n_words", "found", "kept")]
    assert sorted((tuple(r) for r in S.digest(scanned).collect()), key=repr) == got
    assert S.scan(empty).count() == 0


def test_no_python_in_the_plan(edge):
    plan = S.digest(S.scan(edge))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
