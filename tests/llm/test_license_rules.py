"""License scans against a plain search of every rule, compared in pairs."""

from __future__ import annotations

import random
import re

from adlens.llm import license_rules as L

SCHEMA = "doc_id long, text string, Labels string, _s int"


COMPILED = [(r, re.compile(r.regex)) for r in L.rules()]  # more than the module's own cache holds


def words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(text):
    w = words(text)
    numbered = "".join(f" {i}:{x} " for i, x in enumerate(w))
    found = []
    for r, regex in COMPILED:
        for m in regex.finditer(numbered):
            found.append((int(m[0].split(":")[0]), int(m[0].rstrip().split(" ")[-1].split(":")[0]), r.tier, r.order, r.label))

    def beats(e, d):
        inside = e[0] <= d[0] and e[1] >= d[1]
        return inside and (e[2], e[0] - e[1], e[3]) < (d[2], d[0] - d[1], d[3])

    kept = [d for d in found if not any(beats(e, d) for e in found)]
    base = [(i, p) for p in L.BASE for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    own = {L.BASE[p] for _, p in base}
    starts = [i for i, _ in base]
    score = L.CONFIDENCE[min(d[2] for d in kept)] if kept else L.BASE_SCORE if base else 0.0
    return (len(w), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(own)),
            ",".join(sorted(own | {d[4] for d in kept})), score), sorted(found)


SOUP = ["licensed", "under", "the", "GNU", "General", "Public", "License", "version", "3", "2", "mit", "MIT License", "cc by", "CC BY-NC 4.0",
        "all rights reserved", "Apache License, Version 2.0", "BSD", "3-clause", "lesser", "und", "word", "terms of", "copyright 2020",
        "SPDX-License-Identifier:", "Apache-2.0", "public domain", "Licence", "creative commons", "attribution", "x" * 30, "ÄÖ", "😀"]


def test_scan_equals_plain_search(spark):
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choices(SOUP, k=rng.randint(1, 40)))) for k in range(120)]
    rows += [(200, None), (201, ""), (202, " \n\t..."), (203, "cc by cc by cc by"), (204, "CC-BY"), (205, "Kİ MIT LICENSE İ"),
             (7, rows[7][1]), (206, "Permission is hereby granted, free of charge, to any person obtaining a copy"),
             (207, "all rights reserved all rights reserved"), (None, "some mit license")]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).repartition(4)
    got = [tuple(r) for r in L.scan(df).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                                               "score", "_s").collect()]
    assert sorted(got, key=str) == sorted([(i, *plain(t)[0], 1) for i, t in rows], key=str)


def test_places_and_long_texts(spark):
    long = "lorem ipsum dolor " * 60_000 + "released under the MIT License. " * 2_000
    df = spark.createDataFrame([(1, "Released under the GNU General Public License, version 3."), (2, long)], "doc_id long, text string")
    got = {r["doc_id"]: r for r in L.scan(df).collect()}
    assert [tuple(d) for d in got[1]["detections"]] == sorted(plain("Released under the GNU General Public License, version 3.")[1],
                                                              key=lambda d: (d[0], -d[1], d[2:]))
    assert got[1]["labels"] == "gpl,gpl-3.0" and got[1]["score"] == 0.9
    assert got[2]["labels"] == "mit" and got[2]["n_words"] == 190_000 and len(got[2]["detections"]) == 4_000


def test_empty_table_and_native_plan(spark):
    df = L.scan(spark.createDataFrame([], "doc_id long, text string"))
    assert df.collect() == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan and "from_json" not in plan


def test_every_rule_finds_its_own_words():
    assert len(L.rules()) > 300
    for r in L.rules():
        assert r.keys and len(set(r.keys)) == len(r.keys)
        re.compile(r.regex)
