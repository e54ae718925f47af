"""Embedding near-duplicates by collision-counting projections (operator 2).

Two vectors link when their cosine reaches a threshold. Random projections of
the unit vectors are sorted many times: list l sorts by (signs of ``k`` coarse
projections, value of one projection), and each vector, as a query, collides
with those whose value lies within ``WINDOW`` of its own under the same signs. Collisions
are counted per pair over all lists; pairs with at least ``COLLISIONS`` are verified by the
exact cosine in double precision.

Calibration: a pair at the threshold collides in one list with a known
probability p (angle for the signs, a normal law for the window); the number
of lists is the least L for which a Binomial(L, p) count reaches ``COLLISIONS``
with probability ``RECALL``. ``k`` grows with log2 of the row count, so a
window holds about as many strangers at every size and the work grows as
n * L(n), L about n^0.25.

Equal directions (bit for bit) are one class with a weight first. Vectors of different
lengths never meet.

Scale: one narrow shuffle of (list and signs, length, value, id) rows, streamed from
sorted partitions; counts are summed in each task before they are shuffled;
vectors travel only to pairs that pass. Near copies that all link each other
are counted pair by pair, as each vector's number of links asks for (the README
has the figures).

Defined results: NULL, zero, empty and non-finite vectors link with nothing (0
links, own component); every row is a vector of its own, with its own links, whatever other rows have its id;
a NULL id links nothing; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.llm.common import quoted, stored
from adlens.llm.graph import components

WINDOW = 1.0         # half width, in units of a projection's deviation
COLLISIONS = 2
RECALL = 0.999
STRANGERS = 16       # vectors under the same signs, about
SEED = 20_240_601
_BATCH = 1 << 18


def calibrate(n: int, cosine: float) -> tuple[int, int]:
    """(k sign projections, L lists) for ``n`` vectors."""
    k = max(2, round(math.log2(max(n, 2) / STRANGERS)))
    signs = (1 - math.acos(cosine) / math.pi) ** k
    window = math.erf(WINDOW / math.sqrt(2 * (1 - cosine)) / math.sqrt(2))
    p = signs * window
    lists = COLLISIONS
    while sum(math.comb(lists, j) * p**j * (1 - p) ** (lists - j) for j in range(COLLISIONS)) > 1 - RECALL:
        lists += 1
    return k, lists


def _unit(rows: pa.Array) -> list[np.ndarray | None]:
    """Unit vectors in double precision; None for what links with nothing."""
    out = []
    for v in rows.to_pylist():
        x = None if v is None or None in v or not v else np.asarray(v, dtype=np.float64)
        if x is not None and np.isfinite(x).all() and x.any():
            x = x / np.abs(x).max()
            x = x / math.sqrt(float(x @ x))
        else:
            x = None
        out.append(x)
    return out


@F.arrow_udf(T.BinaryType())
def _direction(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for rows in batches:
        yield pa.array([None if x is None else x.astype("<f8").tobytes() for x in _unit(rows)], type=pa.binary())


def _project(k: int, lists: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(k, dtype=np.int64)
        for batch in batches:
            ids, raw = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            sizes = np.array([len(r) // 8 for r in raw])
            for d in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == d)
                x = np.frombuffer(b"".join(raw[i] for i in own), dtype="<f8").reshape(-1, d)
                if d not in planes:
                    planes[d] = np.random.default_rng(SEED + d).standard_normal((lists, d, k + 1))
                for lst in range(lists):
                    y = x @ planes[d][lst]
                    # list in the high bits (8 million fit), signs in the low ones
                    place = (y[:, :k] > 0) @ weights + (lst << 40)
                    size = pa.array(np.full(len(own), d, np.int32))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(place), size, pa.array(y[:, k]), pa.array(ids[own])], names=["place", "size", "value", "id"])

    return run


def _window(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Collisions per pair in one partition, sorted by place, vector length and
    value. What is left of a window at a batch's end goes on in the next."""
    place, size, value, ids = np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0), np.empty(0, np.int64)
    found: list[np.ndarray] = []
    pairs = 0

    def counted() -> pa.RecordBatch:
        a = np.concatenate(found, axis=1)
        order = np.lexsort((a[1], a[0]))
        a = a[:, order]
        new = np.flatnonzero(np.concatenate(([True], (np.diff(a, axis=1) != 0).any(axis=0))))
        n = np.diff(np.append(new, a.shape[1]))
        return pa.RecordBatch.from_arrays([pa.array(a[0, new]), pa.array(a[1, new]), pa.array(n)], names=["a", "b", "n"])

    for batch in batches:
        old = len(place)
        place = np.concatenate([place, batch.column(0).to_numpy()])
        size = np.concatenate([size, batch.column(1).to_numpy()])
        value = np.concatenate([value, batch.column(2).to_numpy()])
        ids = np.concatenate([ids, batch.column(3).to_numpy()])
        left = np.arange(max(old, 1), len(place))   # the later row of each pair, new in this batch
        step = 1
        while len(left):
            left = left[left >= step]
            left = left[(place[left] == place[left - step]) & (size[left] == size[left - step])
                        & (value[left] - value[left - step] <= WINDOW)]
            if len(left):
                x, y = ids[left], ids[left - step]
                found.append(np.stack([np.minimum(x, y), np.maximum(x, y)]))
                pairs += len(left)
                if pairs >= 8 * _BATCH:
                    yield counted()
                    found, pairs = [], 0
            step += 1
        if len(place):
            keep = (place == place[-1]) & (size == size[-1]) & (value >= value[-1] - WINDOW)
            place, size, value, ids = place[keep], size[keep], value[keep], ids[keep]
    if found:
        yield counted()


@F.arrow_udf(T.DoubleType())
def _cosine(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for left, right in batches:
        yield pa.array([float(np.frombuffer(a, "<f8") @ np.frombuffer(b, "<f8"))
                        for a, b in zip(left.to_pylist(), right.to_pylist(), strict=True)], type=pa.float64())


def near_vectors(vectors: DataFrame, cosine: float = 0.9, vec_id: str = "vec_id", embedding: str = "embedding"):
    """(rows, links). ``rows``: (vec_id, dir, weight) of every input row; ``dir`` numbers the directions (NULL: links
    with nothing) and ``weight`` counts a direction's rows. ``links``: (a, b, cosine) between directions, a < b."""
    raw = stored(vectors.select(F.col(quoted(vec_id)).cast("long").alias("vec_id"), _direction(F.col(quoted(embedding))).alias("unit"))
                 .select("vec_id", F.when(F.col("vec_id").isNotNull(), F.col("unit")).alias("unit")), "units")
    # Numbers are given when the table is written, and stand as written.
    firsts = stored(raw.filter("unit IS NOT NULL").groupBy("unit").agg(F.count("*").alias("weight"))
                    .select(F.monotonically_increasing_id().alias("dir"), "unit", "weight"), "directions")
    k, lists = calibrate(firsts.count(), cosine)
    spread = firsts.select("dir", "unit").mapInArrow(_project(k, lists), "place long, size int, value double, id long")
    counts = (spread.repartition("place", "size").sortWithinPartitions("place", "size", "value", "id")
              .mapInArrow(_window, "a long, b long, n long")
              .groupBy("a", "b").agg(F.sum("n").alias("n")).filter(F.col("n") >= COLLISIONS).filter("a <> b"))
    left = firsts.select(F.col("dir").alias("a"), F.col("unit").alias("ua"))
    right = firsts.select(F.col("dir").alias("b"), F.col("unit").alias("ub"))
    links = counts.join(left, "a").join(right, "b").select("a", "b", _cosine("ua", "ub").alias("cosine")) \
        .filter(F.col("cosine") >= cosine)
    known = raw.filter("unit IS NOT NULL").join(firsts, "unit").select("vec_id", "dir", "weight")
    rows = known.unionByName(raw.filter("unit IS NULL").select("vec_id", F.lit(None).cast("long").alias("dir"), F.lit(None).cast("long").alias("weight")))
    return rows, stored(links, "links")


def link_report(vectors: DataFrame, cosine: float = 0.9, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows, links = near_vectors(vectors, cosine, vec_id, embedding)
    rows = stored(rows, "rows")
    linkable = rows.filter("dir IS NOT NULL")
    dirs = linkable.groupBy("dir").agg(F.max("weight").alias("weight"), F.min("vec_id").alias("least"))
    ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = ends.join(dirs.select(F.col("dir").alias("b"), "weight"), "b").groupBy("a").agg(F.sum("weight").alias("others"))
    group = components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    facts = (dirs.join(degree, F.col("dir") == F.col("a"), "left").join(group, F.col("dir") == F.col("node"), "left")
             .select("dir", "least", (F.col("weight") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "dir").alias("comp")))
    facts = stored(facts, "facts")
    smallest = facts.groupBy("comp").agg(F.min("least").alias("component_id"))
    known = facts.join(smallest, "comp").select("dir", "n_links", "component_id")
    got = linkable.join(known, "dir").select("vec_id", "n_links", "component_id").unionByName(
        rows.filter("dir IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return got.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
