"""License scans: ordered signature rules over whole texts, DataFrame functions only.

A rule is a regular expression for the way a license is named (``NAMES``) within a form in which
licenses are given (``FORMS``), or a sentence that licenses are known by (``SENTENCES``); names times
forms make some hundreds. Texts are reduced to words between single spaces. A rule is tried only
where its keyword is among the text's words. Every place of every rule is a detection, an interval of
words; one that lies within another of the same or a better priority is suppressed: with intervals in
order of start, longest first, that is a running maximum of ends for each priority.

All of it happens inside the row: no shuffle, no Python worker, and work in proportion to the text.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases that give a base label wherever their words stand one after another.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Anything that is no word character (words are of ASCII letters, digits and all else beyond ASCII).
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

VERSION = r"(?: version| v)? ?"
GPL = r"(?:gnu )?general public licen[cs]e"
#: (label, keyword that stands in every match, name as words between single spaces, unmistakable alone)
NAMES = [
    ("mit", "mit", "mit(?: x11| expat)?", False),
    ("mit-0", "mit", "mit (?:0|no attribution)", True),
    ("x11", "x11", "x11", False),
    ("apache-1", "apache", rf"apache(?: software)?(?: licen[cs]e)?{VERSION}1(?: [01])?", True),
    ("apache-2", "apache", rf"apache(?: software)?(?: licen[cs]e)?{VERSION}2(?: 0)?", True),
    ("apache", "apache", "apache(?: software)?", False),
    ("bsd-0", "0bsd", "0bsd", True),
    ("bsd-1", "bsd", "(?:bsd 1 clause|1 clause bsd)", True),
    ("bsd-2", "bsd", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)", True),
    ("bsd-3", "bsd", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)", True),
    ("bsd-4", "bsd", "(?:bsd 4 clause|4 clause bsd|original bsd|old bsd)", True),
    ("bsd", "bsd", "bsd(?: style)?", False),
    ("gpl-1", "general", rf"{GPL}{VERSION}1(?: 0)?", True),
    ("gpl-2", "general", rf"{GPL}{VERSION}2(?: 0)?", True),
    ("gpl-3", "general", rf"{GPL}{VERSION}3(?: 0)?", True),
    ("gpl", "general", GPL, True),
    ("gpl-1", "gpl", rf"(?:gnu )?gpl{VERSION}1(?: 0)?(?: only| or later)?", True),
    ("gpl-2", "gpl", rf"(?:gnu )?gpl{VERSION}2(?: 0)?(?: only| or later)?", True),
    ("gpl-3", "gpl", rf"(?:gnu )?gpl{VERSION}3(?: 0)?(?: only| or later)?", True),
    ("gpl", "gpl", "(?:gnu )?gpl", True),
    ("gpl-2", "gplv2", "(?:gnu )?gplv2", True),
    ("gpl-3", "gplv3", "(?:gnu )?gplv3", True),
    ("lgpl-2", "lesser", rf"(?:gnu )?lesser general public licen[cs]e{VERSION}2(?: [01])?", True),
    ("lgpl-3", "lesser", rf"(?:gnu )?lesser general public licen[cs]e{VERSION}3(?: 0)?", True),
    ("lgpl", "lesser", "(?:gnu )?lesser general public licen[cs]e", True),
    ("lgpl-2", "library", rf"(?:gnu )?library general public licen[cs]e(?:{VERSION}2(?: 0)?)?", True),
    ("lgpl-2", "lgpl", rf"(?:gnu )?lgpl{VERSION}2(?: [01])?(?: only| or later)?", True),
    ("lgpl-3", "lgpl", rf"(?:gnu )?lgpl{VERSION}3(?: 0)?(?: only| or later)?", True),
    ("lgpl", "lgpl", "(?:gnu )?lgpl", True),
    ("agpl-3", "affero", rf"(?:gnu )?affero general public licen[cs]e{VERSION}3(?: 0)?", True),
    ("agpl", "affero", "(?:gnu )?affero general public licen[cs]e", True),
    ("agpl-3", "agpl", rf"(?:gnu )?agpl{VERSION}3(?: 0)?(?: only| or later)?", True),
    ("agpl", "agpl", "(?:gnu )?agpl", True),
    ("gfdl", "gfdl", rf"(?:gnu )?gfdl(?:{VERSION}1(?: [123])?)?", True),
    ("gfdl", "documentation", rf"(?:gnu )?free documentation licen[cs]e(?:{VERSION}1(?: [123])?)?", True),
    ("mpl-1", "mozilla", rf"mozilla public licen[cs]e{VERSION}1(?: [01])?", True),
    ("mpl-2", "mozilla", rf"mozilla public licen[cs]e{VERSION}2(?: 0)?", True),
    ("mpl", "mozilla", "mozilla public licen[cs]e", True),
    ("mpl-2", "mpl", rf"mpl{VERSION}2(?: 0)?", True),
    ("epl-1", "eclipse", rf"eclipse public licen[cs]e{VERSION}1(?: 0)?", True),
    ("epl-2", "eclipse", rf"eclipse public licen[cs]e{VERSION}2(?: 0)?", True),
    ("epl", "eclipse", "eclipse public licen[cs]e", True),
    ("cddl", "cddl", rf"cddl(?:{VERSION}1(?: [01])?)?", True),
    ("cddl", "distribution", "common development and distribution licen[cs]e", True),
    ("cpl", "common", rf"common public licen[cs]e(?:{VERSION}1(?: 0)?)?", True),
    ("eupl", "european", rf"european union public licen[cs]e(?:{VERSION}1(?: [012])?)?", True),
    ("eupl", "eupl", rf"eupl(?:{VERSION}1(?: [012])?)?", True),
    ("isc", "isc", "isc", False),
    ("zlib", "zlib", "zlib(?: libpng)?", False),
    ("unlicense", "unlicense", "unlicense", True),
    ("wtfpl", "wtfpl", "wtfpl", True),
    ("boost", "boost", rf"boost(?: software)?(?: licen[cs]e)?(?:{VERSION}1(?: 0)?)?", False),
    ("boost", "bsl", "bsl 1(?: 0)?", True),
    ("artistic-1", "artistic", rf"artistic(?: licen[cs]e)?{VERSION}1(?: 0)?", True),
    ("artistic-2", "artistic", rf"artistic(?: licen[cs]e)?{VERSION}2(?: 0)?", True),
    ("python", "python", "(?:python software foundation|psf)", False),
    ("php", "php", rf"php(?: licen[cs]e)?{VERSION}3(?: 01?)?", False),
    ("openssl", "openssl", "openssl", False),
    ("ofl", "ofl", rf"(?:sil )?ofl(?:{VERSION}1(?: [01])?)?", True),
    ("ofl", "font", "(?:sil )?open font licen[cs]e", True),
    ("odbl", "odbl", "odbl", True),
    ("odbl", "database", "open (?:data commons open )?database licen[cs]e", True),
    ("cc0", "cc0", "cc0(?: 1 0)?", True),
    ("public-domain", "domain", "public domain", False),
    ("cc-by", "cc", r"cc by(?! (?:nc|nd|sa)\b)(?: \d 0)?", True),
    ("cc-by-sa", "cc", r"cc by sa(?: \d 0)?", True),
    ("cc-by-nd", "cc", r"cc by nd(?: \d 0)?", True),
    ("cc-by-nc", "cc", r"cc by nc(?! (?:nd|sa)\b)(?: \d 0)?", True),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: \d 0)?", True),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: \d 0)?", True),
    ("cc-by", "commons", r"creative commons attribution(?! (?:non|no|share))(?: \d 0)?", True),
    ("cc-by-sa", "commons", r"creative commons attribution share ?alike(?: \d 0)?", True),
    ("cc-by-nd", "commons", r"creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: \d 0)?", True),
    ("cc-by-nc", "commons", r"creative commons attribution non ?commercial(?! (?:no|share))(?: \d 0)?", True),
    ("cc-by-nc-sa", "commons", r"creative commons attribution non ?commercial share ?alike(?: \d 0)?", True),
    ("cc-by-nc-nd", "commons", r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: \d 0)?", True),
    ("cc", "commons", "creative commons", False),
    ("proprietary", "proprietary", "proprietary", False),
]
#: (priority, confidence, form around a name); the best priority is 1.
FORMS = [
    (1, 1.0, "spdx licen[cs]e identifier {}"),
    (2, 0.95, "(?:licen[cs]ed|released|distributed|published|provided|available|covered|redistribute it|use) (?:to you )?under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?{}(?: licen[cs]e)?"),
    (3, 0.8, "(?:the )?{} licen[cs]e(?: agreement)?"),
    (3, 0.8, "licen[cs]e (?:is |type |name )?(?:the )?{}"),
]
#: A name that is unmistakable counts without a form.
ALONE = (4, 0.5, "{}")
#: Sentences that licenses are known by: (label, keyword, pattern), priority and confidence below.
SENTENCES = [
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", "hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("apache-2", "apache", "you may not use this file except in compliance with the license .{0,80}apache"),
    ("gpl", "gnu", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "gnu", "you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl", "gnu", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("mpl-2", "mozilla", "this source code form is subject to the terms of the mozilla public license"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("zlib", "altered", "altered source versions must be plainly marked as such"),
    ("boost", "boost", "permission is hereby granted .{0,200}boost"),
    ("wtfpl", "fuck", "do what the fuck you want to"),
    ("all-rights-reserved", "reserved", "all rights reserved"),
]
SENTENCE = (2, 0.9)
BASE_SCORE = 0.8
PRIORITIES = 4
RULE = "array<struct<label: string, keyword: string, regex: string, priority: int, score: double>>"


def rules() -> list[dict]:
    """All rules, best priority first; patterns stand between single spaces, ASCII case ignored."""
    made = [(label, word, form.format(name), p, s) for p, s, form in FORMS for label, word, name, _ in NAMES]
    made += [(label, word, pattern, *SENTENCE) for label, word, pattern in SENTENCES]
    made += [(label, word, ALONE[2].format(name), *ALONE[:2]) for label, word, name, clear in NAMES if clear]
    made.sort(key=lambda x: x[3])
    return [
        {"label": label, "keyword": word, "regex": f"(?i)(?<= )(?:{pattern})(?= )", "priority": p, "score": s}
        for label, word, pattern, p, s in made
    ]


def words_of(text: Column) -> Column:
    """The text's words between single spaces, one before and one after; two spaces if there are none."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), GAP, " ")), F.lit(" "))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _detections(table: list[dict]) -> Column:
    """Array of (start, -end, priority, label, score) in order, from columns ``norm`` and ``known``."""
    rule = F.from_json(F.lit(json.dumps(table)), RULE)

    def places(r: Column) -> Column:
        mark = F.lit("\x01")  # no word holds it
        marked = F.split(F.regexp_replace(F.col("norm"), r["regex"], F.lit("\x01$0\x01")), " ")
        at = lambda test: F.filter(F.transform(marked, lambda w, i: F.when(test(w), i - 1)), lambda i: i.isNotNull())
        both = F.arrays_zip(at(lambda w: F.startswith(w, mark)).alias("a"), at(lambda w: F.endswith(w, mark)).alias("b"))
        return F.transform(
            both,
            lambda z: F.struct(
                z["a"].alias("start"), (-1 - z["b"]).alias("back"), r["priority"].alias("priority"), r["label"].alias("label"), r["score"].alias("score")
            ),
        )

    tried = F.filter(rule, lambda r: F.array_contains(F.col("known"), r["keyword"]) & F.regexp_like(F.col("norm"), r["regex"]))
    none = F.array().cast("array<struct<start: int, back: int, priority: int, label: string, score: double>>")
    return F.when(F.size("known") == 0, none).otherwise(F.array_sort(F.flatten(F.transform(tried, places))))


def _prepared(docs: DataFrame, table: list[dict], doc_id: str, text: str) -> DataFrame:
    keywords = F.array(*[F.lit(k) for k in sorted({r["keyword"] for r in table})])
    norm = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), words_of(F.col(f"`{text}`")).alias("norm"))
    # lower() may touch more than ASCII, so it only says what is worth trying
    known = norm.withColumn("low", F.lower("norm")).withColumn("known", F.array_intersect(keywords, F.split("low", " ")))
    return known.withColumn("found", _detections(table))


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", table: list[dict] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score, n_detections (those not suppressed). ``score`` is the highest confidence of what
    was found, 0 if nothing was.

    A null text is empty: no words, no labels, score 0, null places. Rows that repeat, and rows
    without an id, are rows of their own; texts of any length are read whole; an empty table gives no
    rows; other columns are ignored.
    """
    rows = _prepared(docs, rules() if table is None else table, doc_id, text)
    n_words = F.when(F.col("norm") == "  ", 0).otherwise(_spaces(F.col("norm")) - 1).cast("long")
    pieces = {}
    for k, phrase in enumerate(BASE):
        cut = F.split("norm", f"(?i)(?<= ){phrase}(?= )", -1)
        pieces[f"cut{k}"] = F.when(F.contains(F.col("low"), F.lit(f" {phrase} ")), cut).otherwise(F.array(F.lit("")))
    rows = rows.withColumns({"n_words": n_words} | pieces)

    counts = {f"n{k}": F.size(f"cut{k}") - 1 for k in range(len(BASE))}
    first, last = [], []
    for k, phrase in enumerate(BASE):
        there = F.size(f"cut{k}") > 1
        first.append(F.when(there, _spaces(F.element_at(f"cut{k}", 1)) - 1))
        last.append(F.when(there, F.col("n_words") - (_spaces(F.element_at(f"cut{k}", -1)) - 1) - len(phrase.split())))
    base = F.array_compact(F.array(*[F.when(F.size(f"cut{k}") > 1, F.lit(label)) for k, label in enumerate(BASE.values())]))
    rows = rows.withColumns(counts | {"base": base, "first_word": F.least(*first).cast("long"), "last_word": F.greatest(*last).cast("long")})

    reach = [f"r{p}" for p in range(1, PRIORITIES + 1)]  # furthest end among that priority and better ones

    def step(acc: Column, x: Column) -> Column:
        end = -x["back"]
        own = acc[reach[-1]]
        for p in range(PRIORITIES - 1, 0, -1):
            own = F.when(x["priority"] == p, acc[f"r{p}"]).otherwise(own)
        kept = own < end
        return F.struct(
            *(F.when(x["priority"] <= p, F.greatest(acc[f"r{p}"], end)).otherwise(acc[f"r{p}"]).alias(f"r{p}") for p in range(1, PRIORITIES + 1)),
            F.when(kept, F.array_union(acc["labels"], F.array(x["label"]))).otherwise(acc["labels"]).alias("labels"),
            F.when(kept, F.greatest(acc["score"], x["score"])).otherwise(acc["score"]).alias("score"),
            (acc["kept"] + kept.cast("long")).alias("kept"),
        )

    zero = F.struct(
        *(F.lit(0).alias(r) for r in reach), F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("kept")
    )
    rows = rows.withColumn("sum", F.aggregate("found", zero, step))
    n_base = sum(F.col(f"n{k}") for k in range(len(BASE)))
    score = F.greatest(F.col("sum.score"), F.when(F.size("base") > 0, BASE_SCORE).otherwise(0.0))
    return rows.select(
        "doc_id", "n_words", n_base.cast("long").alias("n_base"), "first_word", "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", "sum.labels")), ",").alias("labels"),
        score.alias("score"), F.col("sum.kept").alias("n_detections"),
    )


def license_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", table: list[dict] | None = None) -> DataFrame:
    """Every detection: doc_id, label, first_word and last_word of the place, priority, score, and
    whether it is ``suppressed``. Rows are handled as in ``scan_licenses``."""
    rows = _prepared(docs, rules() if table is None else table, doc_id, text)
    rows = rows.withColumn("row", F.monotonically_increasing_id()).select("doc_id", "row", F.posexplode("found").alias("at", "x"))
    before = "(PARTITION BY row ORDER BY at ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    cover = " ".join(f"WHEN {p} THEN max(CASE WHEN x.priority <= {p} THEN -x.back END) OVER {before}" for p in range(1, PRIORITIES + 1))
    return rows.withColumn("cover", F.expr(f"CASE x.priority {cover} END")).select(
        "doc_id", "x.label", F.col("x.start").alias("first_word"), (-1 - F.col("x.back")).alias("last_word"), "x.priority", "x.score",
        F.coalesce(F.col("cover") >= -F.col("x.back"), F.lit(False)).alias("suppressed"),
    )
