"""Components against union-find; rounds of long chains; vectors that share ids."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from adlens.llm import graph, vector_join
from adlens.llm.graph import components


def plain(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


def found(spark, edges):
    return {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u long, v long").coalesce(2)).collect()}


def test_components_equal_union_find(spark):
    rng = random.Random(6)
    edges = [(rng.randint(-300, 300), rng.randint(-300, 300)) for _ in range(330)]       # loops and repeats among them
    edges += [(10**15 + k, 10**15) for k in range(1, 200)]                                # a star
    edges += [(2**62 + k, 2**62 + k + 1) for k in range(60)] + [(-2**63, 2**63 - 1)]      # a chain, the ends of the range
    assert found(spark, edges) == plain(edges)


@pytest.mark.parametrize("step", [1, -1])
def test_chain_of_1000_in_few_rounds(spark, monkeypatch, step):
    tables = []
    real = graph.stored
    monkeypatch.setattr(graph, "stored", lambda df, name: tables.append(name) or real(df, name))
    nodes = list(range(1000))[::step]
    assert set(found(spark, list(zip(nodes, nodes[1:], strict=False))).values()) == {0}
    assert tables.count("edges") - 1 <= 15


def test_scrambling_is_one_to_one(spark):
    df = spark.range(-5000, 5000).select((F.col("id") * 1_000_003).alias("x"))
    assert df.select(graph.scrambled(F.col("x"))).distinct().count() == 10_000


def test_no_edges(spark):
    assert found(spark, []) == {} and found(spark, [(3, 3)]) == {}


def brute(rows, cosine=0.9):
    ok = [k for k, (i, v) in enumerate(rows) if i is not None and v and any(v)]
    unit = {k: np.array(rows[k][1], float) / np.linalg.norm(rows[k][1]) for k in ok}
    links = [(a, b) for a in ok for b in ok if a < b and unit[a] @ unit[b] >= cosine - 1e-12]
    comp = plain(links)
    out = []
    for k, (i, _) in enumerate(rows):
        mates = [j for j in comp if comp[j] == comp.get(k)] if k in comp else [k]
        least = min((rows[j][0] for j in mates if rows[j][0] is not None), default=None)
        out.append((i, sum(k in x for x in links), least, i == least))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [
    [(1, [1.0, 0, 0]), (1, [0, 1.0, 0]), (1, [0, 1.0, 0]), (2, [0, 1.0, 0])],
    [(1, [1.0, 0, 0]), (1, [0, 0, 1.0]), (2, [1.0, 0.1, 0]), (3, [0.1, 0, 1.0])],
    [(5, [1.0, 0, 0])] * 3 + [(None, [1.0, 0, 0]), (4, [0.0, 0, 0]), (4, None), (3, [2.0, 0, 0])],
    [(k % 4, [1.0, 0.001 * k, 0]) for k in range(40)],                                    # near copies, few ids
])
def test_vectors_that_share_ids(spark, rows):
    got = vector_join.link_report(spark.createDataFrame([(i, v and list(map(float, v))) for i, v in rows], "vec_id long, embedding array<double>").repartition(3)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


def test_small_graphs_take_few_tasks(spark):
    conf = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    edges = [(k, k + 1) for k in range(0, 600, 2)] + [(k, k + 7) for k in range(0, 600, 5)]
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        out = components(spark.createDataFrame(edges, "u long, v long"))
        assert len(out.inputFiles()) == 1
        assert {r["node"]: r["component"] for r in out.collect()} == plain(edges)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
