"""Vector codes against plain k-means over Python integers."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from adlens.llm import ball_codes

SCHEMA = "vec_id long, embedding array<double>, label int, CODE string, C0 int"


def plain(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [min(max(math.floor(4096 * x), -2**24), 2**24) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0], np.array(r[1], dtype="<i4").tobytes()))
    if not kept:
        return [], ""
    size = -(-max(len(v) for _, v, _ in kept) // parts)
    cut = [[(v + [0] * (size * parts - len(v)))[p * size:(p + 1) * size] for p in range(parts)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]

    def best(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), j) for j, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            own = [best(c[p], books[p])[1] for c in cut]
            for j in set(own):
                got = [c[p] for c, o in zip(cut, own, strict=True) if o == j]
                books[p][j] = [sum(col) // len(got) for col in zip(*got, strict=True)]
    out = []
    for (i, _, lab), c in zip(kept, cut, strict=True):
        found = [best(c[p], books[p]) for p in range(parts)]
        out.append((i, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found), lab))
    total = {}
    for _, _, e, lab in out:
        total[lab] = total.get(lab, 0) + e
    text = ",".join(str(x) for book in books for c in book for x in c)
    return [(i, c, e, total[lab]) for i, c, e, lab in out], hashlib.sha256(text.encode()).hexdigest()


def report(spark, rows):
    df = spark.createDataFrame([(i, v, lab, "x", 1) for i, v, lab in rows], SCHEMA).repartition(3)
    got = ball_codes.code_report(df).collect()
    return sorted((r["vec_id"], r["code"], r["error"], r["label_error"]) for r in got), {r["codebooks_sha256"] for r in got}


def some(n, dim, seed):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(dim)] for _ in range(9)]
    return [(i, [x + rng.gauss(0, 0.05) for x in rng.choice(centres)], rng.choice([None, 1, 1, 1, i])) for i in range(n)]


def test_codes_equal_plain_k_means(spark):
    rows = some(400, 24, 3)
    rows += [(1000 + k, list(rows[7][1]), 1) for k in range(150)]              # equal vectors
    rows += [(7, list(rows[9][1]), 2), (8, list(rows[8][1]), rows[8][2])]      # repeated ids and rows
    rows += [(2000, None, 1), (2001, [None] * 24, 1), (2002, [float("nan")] * 24, 1), (2003, [math.inf] + [0.0] * 23, None),
             (2004, [0.0] * 24, None), (2005, [1e30] + [-1e30] * 23, 5)]
    want, sha = plain(rows)
    assert report(spark, rows) == (sorted(want), {sha})


@pytest.mark.parametrize("rows", [
    [],
    [(1, None, 1)],
    [(1, [], 1), (2, [], None)],
    [(5, [0.1, -0.2, 0.3], None), (3, [0.1], 1), (4, [0.1, -0.2, 0.3], 1)],    # fewer vectors than entries, uneven lengths
    [(k % 3, [0.5] * 8, 1) for k in range(40)],                                # one vector, three ids
])
def test_codes_of_odd_tables(spark, rows):
    want, sha = plain(rows)
    assert report(spark, rows) == (sorted(want), {sha} if want else set())


def test_rings_equal_full_search():
    rng = np.random.default_rng(5)
    for _ in range(60):
        book = rng.integers(-20, 20, (16, 2))
        book[rng.integers(0, 16, 4)] = book[0]                                 # equal entries, many ties
        x = rng.integers(-25, 25, (300, 2))
        own = rng.integers(0, 16, 300)                                         # any assignment to start from
        for got, want in zip(ball_codes.reassign(x, book, own), ball_codes.nearest(x, book), strict=True):
            assert (got == want).all()
