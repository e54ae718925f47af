"""License scans by ordered signature rules (operator 12).

A text's words (A-Z lower-cased; digits, letters and all non-ASCII characters
stay) are matched with several hundred signature rules. A rule has a tier (0 is
the strongest: sentences of license texts; then SPDX tags, statements such as
"licensed under ...", names, notices), a place in the order, a label, keywords
and a regular expression over whole words.

- Keyword prefilter: a rule runs only on texts that hold all its keywords; texts
  without any rule's rarest keyword (its anchor) are not searched at all.
- Places: words are numbered in the searched text, so a match carries its first and
  last word with it.
- Suppression: places are sorted by start, longer ones first, then by tier and order. A place that lies inside an
  earlier one of an equal or stronger tier is dropped ("general public license" inside "gnu general public license version 3"). The
  labels of the places that are left are the method's.

The base phrases' places are counted beside the rules and are never suppressed.

The score is the confidence of the strongest place left; base phrases alone
give ``BASE_SCORE``.

Scale: row-wise and native (SQL functions alone, no Python): no shuffle, nothing collected, no
broadcast but the rules in the plan. Work is linear in a text and in its places.

Defined results: NULL and empty texts have no words, no places, empty labels and
score 0; texts are searched whole; rows are scanned each on its own, repeated
ids too; result columns replace input columns of their names; an empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import quoted, without

# Fixed values of the base scan: phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
BASE_SCORE = 0.5
CONFIDENCE = (1.0, 0.95, 0.9, 0.7, 0.5)  # by tier
TEXT, TAG, STATEMENT, NAME, NOTICE = range(5)

# Patterns are words separated by spaces. ``w?`` is a word that may be absent, ``<n>`` up to
# n words of any kind, ``a|b`` either word; L stands for the word license.
_L = "licen[cs]es?"
_UNDER = "licen[cs]ed|released|distributed|redistributed|available|published|provided|covered|made|use|modify <3> under the? terms? of? the?"

# label: names. A name that ends in " +" is one only before the word license.
FAMILIES = {
    "mit": ["mit +", "expat +", "mit x11 +", "x11 mit +", "mit style +"],
    "mit-0": ["mit 0", "mit no attribution +"],
    "x11": ["x11 +"],
    "apache-2.0": ["apache L v|version? 2 0?", "apache software? L 2 0?", "apache 2 0?", "apache2 0?", "apachev2", "asl 2 0"],
    "apache-1.1": ["apache software? L v|version? 1 1", "apache 1 1"],
    "apache-1.0": ["apache software? L v|version? 1 0", "apache 1 0"],
    "apache": ["apache software? L", "apache +"],
    "bsd-0-clause": ["0bsd", "zero clause bsd", "bsd zero clause"],
    "bsd-2-clause": ["2 clause bsd", "bsd 2 clause", "two clause bsd", "simplified bsd", "freebsd +"],
    "bsd-3-clause": ["3 clause bsd", "bsd 3 clause", "three clause bsd", "new bsd", "revised bsd", "modified bsd"],
    "bsd-4-clause": ["4 clause bsd", "bsd 4 clause", "four clause bsd", "original bsd"],
    "bsd": ["bsd +", "bsd style +"],
    "isc": ["isc +"],
    "gpl-1.0": ["gnu? general public L <1> v|version 1 0?", "gplv1", "gpl v|version? 1 0?"],
    "gpl-2.0": ["gnu? general public L <1> v|version 2 0?", "gplv2", "gpl v|version? 2 0?", "gpl2", "gpl v2"],
    "gpl-3.0": ["gnu? general public L <1> v|version 3 0?", "gplv3", "gpl v|version? 3 0?", "gpl3", "gpl v3"],
    "gpl": ["gnu general public L", "general public L", "gnu gpl", "gpl +"],
    "lgpl-2.0": ["gnu? library general public L <1> v|version 2 0?", "lgplv2", "lgpl v|version? 2 0"],
    "lgpl-2.1": ["gnu? lesser general public L <1> v|version 2 1", "lgpl v|version? 2 1", "lgplv2 1"],
    "lgpl-3.0": ["gnu? lesser general public L <1> v|version 3 0?", "lgplv3", "lgpl v|version? 3 0?"],
    "lgpl": ["gnu? lesser general public L", "gnu? library general public L", "gnu lgpl", "lgpl"],
    "agpl-3.0": ["gnu? affero general public L <1> v|version 3 0?", "agplv3", "agpl v|version? 3 0?"],
    "agpl": ["gnu? affero general public L", "gnu agpl", "agpl"],
    "gfdl-1.2": ["gnu? free documentation L <1> v|version? 1 2", "gfdl v|version? 1 2"],
    "gfdl-1.3": ["gnu? free documentation L <1> v|version? 1 3", "gfdl v|version? 1 3"],
    "gfdl": ["gnu? free documentation L", "gfdl"],
    "mpl-1.1": ["mozilla public L <1> v|version? 1 1", "mpl v|version? 1 1"],
    "mpl-2.0": ["mozilla public L <1> v|version? 2 0", "mpl v|version? 2 0"],
    "mpl": ["mozilla public L", "mpl +"],
    "epl-1.0": ["eclipse public L <1> v|version? 1 0", "epl v|version? 1 0"],
    "epl-2.0": ["eclipse public L <1> v|version? 2 0", "epl v|version? 2 0"],
    "epl": ["eclipse public L"],
    "edl-1.0": ["eclipse distribution L v|version? 1? 0?"],
    "cddl-1.0": ["common development and distribution L <1> v|version? 1? 0?", "cddl v|version? 1? 0?"],
    "cddl-1.1": ["common development and distribution L <1> v|version? 1 1", "cddl v|version? 1 1"],
    "cpl-1.0": ["common public L v|version? 1? 0?"],
    "ipl-1.0": ["ibm public L v|version? 1? 0?"],
    "eupl-1.1": ["european union public L v|version? 1 1", "eupl v|version? 1 1"],
    "eupl-1.2": ["european union public L v|version? 1 2", "eupl v|version? 1 2"],
    "artistic-1.0": ["artistic L v|version? 1 0"],
    "artistic-2.0": ["artistic L v|version? 2 0"],
    "artistic": ["artistic L", "clarified artistic L"],
    "psf-2.0": ["python software foundation L", "psf +"],
    "php-3.01": ["php L v|version? 3 01", "php L"],
    "ruby": ["ruby L"],
    "zlib": ["zlib +", "zlib libpng +"],
    "libpng": ["libpng +"],
    "bsl-1.0": ["boost software L v|version? 1? 0?", "bsl 1 0"],
    "unlicense": ["the unlicense", "unlicense L"],
    "wtfpl": ["wtfpl", "do what the fuck you want to public L"],
    "cc0-1.0": ["cc0 v|version? 1? 0?", "creative commons zero v|version? 1? 0?", "cc zero"],
    "cc-pdm-1.0": ["creative commons public domain mark"],
    "pddl-1.0": ["open data commons public domain dedication", "pddl"],
    "odbl-1.0": ["open database L v|version? 1? 0?", "odbl"],
    "odc-by-1.0": ["open data commons attribution L", "odc by"],
    "ogl-3.0": ["open government L v|version? 3? 0?"],
    "ofl-1.1": ["sil open font L v|version? 1? 1?", "open font L v|version? 1 1", "ofl 1 1"],
    "ms-pl": ["microsoft public L", "ms pl"],
    "ms-rl": ["microsoft reciprocal L", "ms rl"],
    "ncsa": ["ncsa open source L", "ncsa +"],
    "postgresql": ["postgresql L"],
    "openssl": ["openssl L", "ssleay +"],
    "afl-3.0": ["academic free L v|version? 3? 0?"],
    "osl-3.0": ["open software L v|version? 3? 0?"],
    "qpl-1.0": ["q public L v|version? 1? 0?"],
    "sleepycat": ["sleepycat L"],
    "vim": ["vim L"],
    "w3c": ["w3c software <3> L", "w3c L"],
    "curl": ["curl L"],
    "icu": ["icu L"],
    "unicode-dfs-2016": ["unicode L <3> data files and software"],
    "tcl": ["tcl tk L", "tcl L"],
    "json": ["json L"],
    "beerware": ["beer ware L", "beerware L"],
    "lppl-1.3c": ["latex project public L v|version? 1? 3c?", "lppl"],
    "upl-1.0": ["universal permissive L v|version? 1? 0?"],
    "mulan-psl-2.0": ["mulan psl v2", "mulan permissive software L v|version? 2?"],
    "elastic-2.0": ["elastic L v|version? 2 0", "elastic L"],
    "sspl-1.0": ["server side public L", "sspl"],
    "busl-1.1": ["business source L v|version? 1? 1?"],
    "commons-clause": ["commons clause"],
    "polyform": ["polyform noncommercial L", "polyform small business L", "polyform shield L", "polyform strict L"],
    "openrail": ["creativeml open rail m", "bigscience openrail m", "openrail m? L?", "responsible ai L"],
    "llama": ["llama 2|3 community L"],
    "rpl-1.5": ["reciprocal public L v|version? 1? 5?"],
    "blueoak-1.0.0": ["blue oak model L"],
    "zpl-2.1": ["zope public L v|version? 2? 1?"],
    "nosl": ["netizen open source L"],
    "sissl": ["sun industry standards source L"],
    "cecill": ["cecill v|version? 2? 1?"],
}

# Sentences of license texts and notices, by label.
SENTENCES = {
    "mit": ["permission is hereby granted free of charge to any person obtaining a copy",
            "the above copyright notice and this permission notice shall be included in all copies"],
    "isc": ["permission to use copy modify and or? distribute this software for any purpose with or without fee is hereby granted"],
    "bsd": ["redistribution and use in source and binary forms with or without modification are permitted",
            "redistributions of source code must retain the above copyright notice",
            "redistributions in binary form must reproduce the above copyright notice"],
    "bsd-3-clause": ["neither the name of <12> nor the names of its contributors may be used to endorse or promote"],
    "bsd-4-clause": ["all advertising materials mentioning features or use of this software must display"],
    "apache-2.0": ["you may not use this file except in compliance with the L", "apache L version 2 0 january 2004"],
    "gpl": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general public L",
            "you should have received a copy of the gnu general public L"],
    "gpl-2.0": ["gnu general public L version 2 june 1991"],
    "gpl-3.0": ["gnu general public L version 3 29 june 2007"],
    "lgpl": ["you should have received a copy of the gnu lesser general public L",
             "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public L"],
    "agpl": ["you should have received a copy of the gnu affero general public L"],
    "mpl-2.0": ["this source code form is subject to the terms of the mozilla public L"],
    "epl": ["the accompanying program is provided under the terms of this eclipse public L"],
    "zlib": ["this software is provided as is without any express or implied warranty in no event will the authors be held liable",
             "altered source versions must be plainly marked as such"],
    "bsl-1.0": ["permission is hereby granted free of charge to any person or organization obtaining a copy"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "wtfpl": ["you just do what the fuck you want to"],
    "json": ["the software shall be used for good not evil"],
    "beerware": ["you can buy me a beer in return"],
    "perl": ["under the same terms as perl itself"],
    "ofl-1.1": ["this font software is licensed under the sil open font L"],
    "postgresql": ["permission to use copy modify and distribute this software and its documentation for any purpose without fee"],
    "unicode-dfs-2016": ["unicode inc L agreement data files and software"],
    "warranty-disclaimer": ["the software is provided as is without warranty of any kind", "without even the implied warranty of merchantability"],
}
NOTICES = {
    "public-domain": ["in the public domain", "released into the public domain", "dedicated to the public domain", "public domain dedication"],
    "all-rights-reserved": ["all rights reserved", "alle rechte vorbehalten", r"tous droits r\S+serv\S+", "todos los derechos reservados"],
    "some-rights-reserved": ["some rights reserved"],
    "no-derivatives": ["no derivative works"],
    "no-commercial-use": ["non commercial use only", "noncommercial use only", "not for commercial use"],
    "proprietary": ["proprietary and confidential", "confidential and proprietary", "trade secrets of"],
    "copyright-notice": ["copyright c? ©? [12][0-9]{3}", "© [12][0-9]{3}", "copyright holders"],
    "see-license": ["see the? L file? for <2> details", "L file", "L agreement", "end user L agreement", "terms of use"],
    "commercial-license": ["commercial L"],
    "open-source": ["open source L", "free software L", "osi approved L"],
    "creative-commons": ["creative commons L", "creative commons"],
    "unknown-license": ["licen[cs]ed under the? <4> L"],
}
_CC_TERMS = {"by": "", "by-sa": "sharealike|share <1>", "by-nd": "noderivs|noderivatives|no <1>", "by-nc": "noncommercial|non <1>",
             "by-nc-sa": "noncommercial|non <1> sharealike|share <1>", "by-nc-nd": "noncommercial|non <1> noderivs|noderivatives|no <1>"}


def _expanded() -> dict[str, list[str]]:
    """Families with the Creative Commons terms in all their versions."""
    out = {k: list(v) for k, v in FAMILIES.items()}
    for term, words in _CC_TERMS.items():
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0", ""):
            number = version.replace(".", " ")
            out[f"cc-{term}" + (f"-{version}" if version else "")] = [
                f"cc {term.replace('-', ' ')} {number}".strip(),
                re.sub(" +", " ", f"creative commons attribution {words} L? v|version? {number}").strip()]
    return out


@dataclass(frozen=True)
class Rule:
    tier: int
    order: int
    label: str
    keys: tuple[str, ...]     # words that every match holds, the rarest first
    regex: str                # over numbered words


# Words too common to tell texts apart; "license" stands for all its forms.
_COMMON = set("a all and any are as at be by can do for from if in is it its may must name names no nor not of on or or? released "
              "shall such terms that the this to under up use used v version with without you your new open same 0 1 2 3 4 5".split())


def compiled(pattern: str) -> tuple[tuple[str, ...], str]:
    """(keywords, regular expression over numbered words) of a pattern."""
    regex, keys = "", []
    for token in pattern.replace("L?", f"{_L}?").split():
        if re.fullmatch(r"<\d+>", token):
            regex += f"(?: [^ ]+ ){{0,{token[1:-1]}}}"
            continue
        if token == "L":
            token = _L
        may = token.endswith("?") and token != _L
        word = token[:-1] if may else token
        part = f" [0-9]+:(?:{word}) "
        regex += f"(?:{part})?" if may else part
        if may:
            continue
        if word.startswith("licen"):
            keys.append("license")
        elif re.fullmatch(r"[^\[\]|?{}()\\.*+]+", word):
            keys.append(word)
    telling = [k for k in dict.fromkeys(keys) if k not in _COMMON] or list(dict.fromkeys(keys))
    return tuple(sorted(telling, key=lambda k: (k == "license", -len(k)))), regex


def rules() -> list[Rule]:
    """All rules in their order."""
    found: list[tuple[int, str, str]] = [(TEXT, label, p) for label, ps in SENTENCES.items() for p in ps]
    for label, names in _expanded().items():
        found.append((TAG, label, f"spdx L identifier {label.replace('-', ' ').replace('.', ' ')}"))
        for name in names:
            full = name.replace("+", "L") if name.endswith("+") else f"{name} L?"
            found += [(STATEMENT, label, f"{_UNDER} {full}"), (NAME, label, full)]
    found += [(NOTICE, label, p) for label, ps in NOTICES.items() for p in ps]
    return [Rule(tier, k, label, *compiled(p)) for k, (tier, label, p) in enumerate(found)]


def _words(text: Column) -> Column:
    """The words of a text, joined by single spaces. ``lower`` is several times faster than
    ``translate``; other letters' case is in no rule, and the two characters that it turns
    into an ASCII letter take the other way."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(text.contains("\u212a") | text.contains("\u0130"),
                 F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).otherwise(F.lower(text))
    return F.trim(F.regexp_replace(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))


def _spaces(s: Column) -> Column:
    return F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))


def _literal(found: list[Rule]) -> Column:
    """The rules as one constant (folded when the plan is made)."""
    rows = [{"tier": r.tier, "order": r.order, "label": r.label, "keys": r.keys, "regex": r.regex} for r in found]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<tier:int,order:int,label:string,keys:array<string>,regex:string>>")


def _strings(values: list[str]) -> Column:
    return F.from_json(F.lit(json.dumps(values)), "array<string>")


def _numbered(words: Column) -> Column:
    return F.concat_ws("", F.transform(words, lambda w, i: F.concat(F.lit(" "), i.cast("string"), F.lit(":"), w, F.lit(" "))))


def _places(keys: Column, text: Column, found: list[Rule]) -> Column:
    """Sorted places of the rules whose keywords a numbered text has: struct(first, -last, tier, order, label)."""
    hits = F.filter(_literal(found), lambda r: F.forall(r["keys"], lambda k: F.array_contains(keys, k)))
    return F.sort_array(F.flatten(F.transform(hits, lambda r: F.transform(
        F.regexp_extract_all(text, r["regex"], F.lit(0)), lambda m: F.struct(
            F.regexp_extract(m, "^ ([0-9]+):", 1).cast("int").alias("first"),
            (-F.regexp_extract(m, "([0-9]+):[^ ]* $", 1).cast("int")).alias("back"),
            r["tier"].alias("tier"), r["order"].alias("order"), r["label"].alias("label"))))))


def _kept(places: Column) -> Column:
    """struct(labels, best) of the places that no earlier place of an equal or
    stronger tier holds. ``reach``: by tier, the furthest end of places of that
    tier or a stronger one so far."""
    start = F.struct(F.array(*[F.lit(-1)] * len(CONFIDENCE)).alias("reach"), F.array().cast("array<string>").alias("labels"),
                     F.lit(len(CONFIDENCE)).alias("best"))

    def step(acc, d):
        last = -d["back"]
        held = acc["reach"][d["tier"]] >= last
        return F.struct(
            F.transform(acc["reach"], lambda x, i: F.when(i >= d["tier"], F.greatest(x, last)).otherwise(x)).alias("reach"),
            F.when(held | F.array_contains(acc["labels"], d["label"]), acc["labels"])
            .otherwise(F.concat(acc["labels"], F.array(d["label"]))).alias("labels"),
            F.when(held, acc["best"]).otherwise(F.least(acc["best"], d["tier"])).alias("best"))

    return F.aggregate(places, start, step)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with n_words, n_base, first_word, last_word, base_labels,
    labels (distinct, sorted, comma-joined), score, and ``detections``: all
    places before suppression (first and last word, tier, rule, label)."""
    out = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
    found = rules()
    x = "_" + uuid.uuid4().hex[:8]
    keep = [F.col(quoted(c)) for c in without(docs, out)]
    col = lambda name: F.col(f"{x}{name}")
    step = docs.select(*keep, _words(F.col(quoted(text))).alias(f"{x}s"))
    step = step.select(*keep, col("s"), F.when(col("s") == "", F.array().cast("array<string>"))
                       .otherwise(F.split(col("s"), " ")).alias(f"{x}w"))
    # base phrases: what lies before, between and after their places
    padded = F.concat(F.lit(" "), col("s"), F.lit(" "))
    cuts = [F.when(padded.contains(f" {p} "), F.split(padded, f" {p}(?= )", -1)).alias(f"{x}b{k}") for k, p in enumerate(BASE)]
    anchors = sorted({r.keys[0] for r in found} - {"license"})
    every = sorted({k for r in found for k in r.keys} - {"license"})
    formed = padded.contains(" licens") | padded.contains(" licenc")
    near = F.arrays_overlap(col("w"), _strings(anchors)) | formed
    step = step.select(*keep, col("w"), F.size(col("w")).cast("long").alias(f"{x}n"), *cuts, formed.alias(f"{x}f"),
                       F.when(near, F.array_intersect(col("w"), _strings(every))).alias(f"{x}p"))
    cut = [col(f"b{k}") for k in range(len(BASE))]
    step = step.select(*keep, col("n"), *cut, F.when(col("f"), F.concat(col("p"), F.array(F.lit("license")))).otherwise(col("p")).alias(f"{x}p"),
                       F.when(col("p").isNotNull(), _numbered(col("w"))).alias(f"{x}t"))
    step = step.select(*keep, col("n"), *cut, F.when(col("p").isNotNull(), _places(col("p"), col("t"), found)).alias(f"{x}d"))
    step = step.select(*keep, col("n"), col("d"), *cut, _kept(col("d")).alias(f"{x}k"))
    first = [_spaces(c[0]).cast("long") for c in cut]
    last = [col("n") - (_spaces(F.element_at(c, -1)) - 1) - len(p.split()) for c, p in zip(cut, BASE, strict=True)]
    labels = F.array_sort(F.filter(F.array(*[F.when(c.isNotNull(), F.lit(v)) for c, v in zip(cut, BASE.values(), strict=True)]),
                                   lambda v: v.isNotNull()))
    own = F.coalesce(col("k")["labels"], F.array().cast("array<string>"))
    base_any = F.coalesce(*cut).isNotNull()
    score = F.coalesce(*[F.when(col("k")["best"] == t, F.lit(c)) for t, c in enumerate(CONFIDENCE)],
                       F.when(base_any, F.lit(BASE_SCORE)), F.lit(0.0))
    places = F.transform(F.coalesce(col("d"), F.array().cast(_PLACE)), lambda d: F.struct(
        d["first"].alias("first_word"), (-d["back"]).alias("last_word"), d["tier"].alias("tier"), d["order"].alias("rule"),
        d["label"].alias("label")))
    return step.select(
        *keep, col("n").alias("n_words"),
        sum((F.coalesce(F.size(c).cast("long") - 1, F.lit(0)) for c in cut[1:]),
            F.coalesce(F.size(cut[0]).cast("long") - 1, F.lit(0))).alias("n_base"),
        F.least(*first).alias("first_word"), F.greatest(*last).cast("long").alias("last_word"),
        F.array_join(labels, ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(labels, own))), ",").alias("labels"),
        score.alias("score"), places.alias("detections"))


_PLACE = "array<struct<first:int,back:int,tier:int,order:int,label:string>>"
