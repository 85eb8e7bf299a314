"""The license scan against a plain version with Python's regular expressions."""

import re

from sifter.llm.license_scan import ALONE, BASE, BASE_SCORE, FORMS, NAMES, SENTENCES, license_spans, rules, scan_licenses

COLUMNS = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "n_detections"]
TEXTS = [
    "Released under the MIT License. licensed under CC BY-NC 4.0, and again: under the mit license",
    "This work is licensed under the GNU General Public License, version 3.",
    "Licensed under the Apache License, Version 2.0; SPDX-License-Identifier: Apache-2.0",
    "GNU Lesser General Public License v2.1 or the GNU GPL v2 or later, BSD 3-Clause License",
    "Redistribution and use in source and binary forms, with or without modification, are permitted. All rights reserved.",
    "ich komme mit under the mitlicense; CC BY NC CC BY NC-SA cc by", "CC BY-NC" * 3, "Kelvin under the MİT license",
    "cc by nc " * 3000, "under the mit license", "é under the mit license é", None, "", " \t ", "...", "under the mit\x01license",
    "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 license. see license MIT. license apache license version 2",
]


def plain(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    starts, labels = [], set()
    for phrase, label in BASE.items():
        own = phrase.split()
        at = [k for k in range(len(words)) if words[k : k + len(own)] == own]
        starts += at
        labels |= {label} if at else set()
    norm = " " + " ".join(words) + " "
    found = []
    for r in rules():
        for m in re.finditer(r["regex"].replace("(?i)", ""), norm):
            a = norm[: m.start()].count(" ") - 1
            found.append((a, a + m[0].count(" ") + 1, r["priority"], r["label"], r["score"]))
    found.sort(key=lambda x: (x[0], -x[1], x[2]))
    kept = [x for k, x in enumerate(found) if not any(y[1] >= x[1] and y[2] <= x[2] for y in found[:k])] if len(found) < 99 else None
    base = ",".join(sorted(labels))
    if kept is None:
        return len(words), len(starts), min(starts), max(starts), base
    score = max([x[4] for x in kept] + [BASE_SCORE] * bool(labels) + [0.0])
    both = ",".join(sorted(labels | {x[3] for x in kept}))
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), base, both, score, len(kept)


def test_against_plain_version(spark, odd):
    docs = spark.createDataFrame([(k, t, "l", 1) for k, t in enumerate(TEXTS)], "doc_id long, text string, labels string, low int")
    small = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for df in (docs, small, odd):
        texts = [(r.doc_id, r.text) for r in df.collect()]
        got = sorted((tuple(r[c] for c in COLUMNS) for r in scan_licenses(df).collect()), key=repr)
        want = [(i, *plain(t)) for i, t in texts]
        assert len(got) == len(want)
        long = {w[0] for w in want if len(w) < len(COLUMNS)}
        assert [g for g in got if g[0] not in long] == sorted((w for w in want if w[0] not in long), key=repr)
        assert [g[:6] for g in got if g[0] in long] == [w for w in want if w[0] in long]


def test_spans(spark):
    docs = spark.createDataFrame([(1, TEXTS[1]), (2, TEXTS[0])], "doc_id long, text string")
    spans = license_spans(docs).collect()
    best = {(r.doc_id, r.label) for r in spans if not r.suppressed}
    assert best == {(1, "gpl-3"), (2, "mit"), (2, "cc-by-nc")}
    assert any(r.label == "gpl" and r.suppressed for r in spans)
    assert {(r.first_word, r.last_word) for r in spans if r.doc_id == 1 and not r.suppressed} == {(3, 11)}


def test_empty(spark, none):
    assert scan_licenses(none).collect() == [] and license_spans(none).collect() == []


def test_rules():
    table = rules()
    assert len(table) == len(NAMES) * len(FORMS) + len(SENTENCES) + sum(x[3] for x in NAMES) > 300
    assert len({r["regex"] for r in table}) == len(table) and ALONE[0] == max(r["priority"] for r in table)
    for r in table:  # the gate loses nothing: no match without the keyword
        assert r["keyword"] in r["regex"]
