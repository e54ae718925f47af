"""Vector code compression by ball k-means (operator 11).

Vectors become integers, floor(scale * x), and are cut into ``parts`` equal
consecutive parts; each part position has a codebook of at most ``entries``
entries, learned over ``rounds`` rounds, and a vector's code is the index of
the nearest entry of each part. All arithmetic is on 64-bit integers, so the
codes don't depend on the order or the partitioning of the rows.

An assignment starts from the one before. The parts that share an entry are a
ball: its radius is the largest distance of a member to the (moved) entry.

- Neighbours: entry j can take a member of ball i only if the squared distance
  of the two entries is at most four times the squared radius.
- Stable core: a member nearer to its entry than half the way to the nearest
  neighbour stays, and no other distance is computed for it. A ball without
  neighbours is skipped whole.
- Annular rings: neighbours sorted by distance divide the rest of the ball
  into rings; a member of the k-th ring is compared with the first k
  neighbours only.

These bounds are exact (equality is kept as a candidate, as ties go to the lower
index). A task measures its balls' radii over its own batch, which is a tighter
bound than the whole ball's.

Scale: no shuffle of vectors. A round reads the integers and last codes from
the shared folder, writes them with the new codes, and leaves one row of sums
a task, which Spark adds up; the driver receives the sums of ``entries``
entries (entries x vector length numbers), however many vectors there are. A
written round replaces the one before it, so that two of them exist at once at most.

Defined results: rows whose vector is NULL or holds a NULL or non-finite component
are dropped; shorter vectors and lengths that ``parts`` doesn't divide are filled with zeros
at their end; integers beyond +-2**24 are held there (components beyond +-4,096
at a scale of 4,096); the first entries are the vectors of the smallest ids
(equal ids by the bytes of their integers, NULL ids last), fewer if there are fewer vectors; equal entries
leave all their parts to the lowest index; repeated rows are coded each on its own;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.llm.common import dropped, quoted, stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LIMIT = 1 << 24         # 4 * LIMIT**2 * 8,192 components fit in 63 bits
ROWS = 4096             # vectors worked on at a time
HOT = 256               # a label with over 1 / HOT of all rows is joined by broadcast: fewer than HOT labels


def _whole(batches: Iterator[pa.RecordBatch], scale: int) -> Iterator[pa.RecordBatch]:
    """The last column (array<double>) as integers in little-endian 32 bits;
    rows that are NULL or hold a NULL or non-finite component go."""
    for batch in batches:
        for k in range(0, len(batch), ROWS):
            part = batch.slice(k, ROWS)
            raws: list[bytes | None] = []
            for v in part.column(part.num_columns - 1):
                values = v.values
                if values is None or values.null_count:
                    raws.append(None)
                    continue
                x = np.floor(values.to_numpy(zero_copy_only=False) * float(scale))
                raws.append(np.clip(x, -LIMIT, LIMIT).astype("<i4").tobytes() if np.isfinite(x).all() else None)
            cols = [*part.columns[:-1], pa.array(raws, type=pa.binary())]
            names = [*part.schema.names[:-1], "ints"]
            out = pa.RecordBatch.from_arrays(cols, names=names)
            yield out.filter(pa.array([r is not None for r in raws], type=pa.bool_()))


def _matrix(raws: Sequence[bytes], length: int) -> np.ndarray:
    """Rows of integers, filled with zeros up to ``length``."""
    if all(len(r) == 4 * length for r in raws):
        return np.frombuffer(b"".join(raws), dtype="<i4").reshape(len(raws), length).astype(np.int64)
    return np.frombuffer(b"".join([r.ljust(4 * length, b"\0") for r in raws]), dtype="<i4") \
        .reshape(len(raws), length).astype(np.int64)


def _squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = x - y
    return np.einsum("...k,...k->...", d, d)


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry by comparing with all."""
    d = _squared(x[:, None, :], book[None, :, :])
    best = d.argmin(axis=1)  # the first of equal ones
    return best, d[np.arange(len(x)), best]


def reassign(x: np.ndarray, book: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry, from the assignment ``own``."""
    best, d = own.copy(), _squared(x, book[own])
    between = _squared(book[:, None, :], book[None, :, :])
    for i in np.unique(own).tolist():
        ball = np.flatnonzero(own == i)
        reach = 4 * d[ball]
        order = np.argsort(between[i], kind="stable")
        order = order[(order != i) & (between[i][order] <= reach.max())]     # neighbour balls
        if not len(order):
            continue
        ring = np.searchsorted(between[i][order], reach, side="right")       # 0: the stable core
        for t, j in enumerate(order.tolist()):
            left = ball[ring > t]
            if not len(left):
                break
            far = _squared(x[left], book[j])
            nearer = (far < d[left]) | ((far == d[left]) & (j < best[left]))
            took = left[nearer]
            best[took], d[took] = j, far[nearer]
    return best, d


def _assign(book: np.ndarray, first: bool, sums: bool):
    """Task: new codes of all vectors and, in the task's last row, the sums and
    counts of each entry's parts."""
    n_parts, n_entries, width = book.shape
    length = n_parts * width

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_parts, n_entries, width + 1), dtype=np.int64)
        held = None
        for batch in batches:
            for k in range(0, len(batch), ROWS):
                part = batch.slice(k, ROWS)
                x = _matrix(part.column("ints").to_pylist(), length).reshape(len(part), n_parts, width)
                old = None if first else np.frombuffer(b"".join(part.column("code").to_pylist()), np.uint8).reshape(len(part), n_parts)
                codes, error = np.empty((len(x), n_parts), np.uint8), np.zeros(len(x), np.int64)
                for p in range(n_parts):
                    own = x[:, p, :]
                    got, d = nearest(own, book[p]) if first else reassign(own, book[p], old[:, p].astype(np.int64))
                    codes[:, p] = got
                    error += d
                    if sums:
                        order = np.argsort(got, kind="stable")
                        used, at = np.unique(got[order], return_index=True)
                        total[p, used, :width] += np.add.reduceat(own[order], at, axis=0)
                        total[p, used, width] += np.bincount(got, minlength=n_entries)[used]
                if held is not None:
                    yield held
                cols = {name: part.column(name) for name in part.schema.names if name not in ("code", "error", "sums")}
                cols["code"] = pa.array([c.tobytes() for c in codes], type=pa.binary())
                cols["error"] = pa.array(error)
                cols["sums"] = pa.nulls(len(x), pa.list_(pa.int64()))
                held = pa.RecordBatch.from_pydict(cols)
        if held is not None:
            if sums:
                last = [None] * (len(held) - 1) + [total.ravel().tolist()]
                held = held.set_column(held.schema.get_field_index("sums"), "sums", pa.array(last, type=pa.list_(pa.int64())))
            yield held

    return run


@dataclass
class Codes:
    """``rows``: the carried columns, ``code`` (a byte for each part) and ``error``;
    ``books``: (part, entry, position) integers."""
    rows: DataFrame
    books: np.ndarray

    def sha256(self) -> str:
        """Of all entries' decimal components, comma-joined, in order."""
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", carry: Sequence[str] = (),
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codes:
    """Codebooks of ``vectors`` and every vector's code. ``carry`` names columns
    of ``vectors`` that the result keeps beside the id."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has one byte a part: 1 to 256 entries")
    kept = vectors.select(F.col(quoted(vec_id)).alias("vec_id"),
                          *[F.col(quoted(c)).alias(f"c{k}") for k, c in enumerate(carry)],
                          F.col(quoted(embedding)).cast("array<double>").alias("ints"))
    own = kept.schema.fields[:-1]
    schema = T.StructType([*own, T.StructField("ints", T.BinaryType())])
    state = stored(kept.mapInArrow(lambda b: _whole(b, scale), schema), "whole")
    longest = (state.agg(F.max(F.length("ints"))).first()[0] or 0) // 4
    width = -(-longest // parts)
    seeds = state.select("vec_id", "ints").orderBy(F.asc_nulls_last("vec_id"), "ints").limit(entries).collect()
    books = _matrix([bytes(r["ints"]) for r in seeds], width * parts).reshape(len(seeds), parts, width).transpose(1, 0, 2).copy()
    coded = T.StructType([*schema.fields, T.StructField("code", T.BinaryType()), T.StructField("error", T.LongType()),
                          T.StructField("sums", T.ArrayType(T.LongType()))])
    for k in range(rounds + 1):
        old, state = state, stored(state.mapInArrow(_assign(books, k == 0, k < rounds), coded), "codes")
        dropped(old)
        if k == rounds or not seeds:
            break
        sums = (state.filter("sums IS NOT NULL").select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s")))
        total = np.zeros(parts * books.shape[1] * (width + 1), np.int64)
        for row in sums.collect():  # entries x (length + parts) numbers
            total[row["pos"]] = row["s"]
        total = total.reshape(parts, books.shape[1], width + 1)
        count = total[:, :, width:]
        books = np.where(count > 0, total[:, :, :width] // np.maximum(count, 1), books)
    names = {f"c{k}": c for k, c in enumerate(carry)}
    return Codes(state.select("vec_id", *[F.col(k).alias(c) for k, c in names.items()], "code", "error"), books)


def code_report(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every coded vector.

    Errors are summed by label before anything is joined. Labels with more than
    1 / ``HOT`` of the rows (fewer than ``HOT`` of them) come back by broadcast; rows of
    the others meet their sum by a join in which no key is hot."""
    got = compress(vectors, vec_id, embedding, carry=[label])
    rows = got.rows.select("vec_id", F.hex("code").alias("code"), "error",
                           F.coalesce(F.concat(F.lit("="), F.col(quoted(label)).cast("string")), F.lit("null")).alias("_label"))
    sums = stored(rows.groupBy("_label").agg(F.sum("error").alias("sum"), F.count("*").alias("n")), "labels")
    share = (sums.agg(F.sum("n")).first()[0] or 0) // HOT
    hot = sums.filter(F.col("n") > share).select("_label", F.col("sum").alias("_hot"))
    rest = sums.filter(F.col("n") <= share).select(F.col("_label").alias("_key"), F.col("sum").alias("_rest"))
    met = rows.join(F.broadcast(hot), "_label", "left")
    # rows that have their sum get keys of their own, which no label equals
    key = F.when(F.col("_hot").isNull(), F.col("_label")).otherwise(F.concat(F.lit("#"), F.xxhash64("vec_id", "code").cast("string")))
    met = met.withColumn("_key", key).join(rest, "_key", "left")
    return met.select("vec_id", F.lower("code").alias("code"), "error", F.coalesce("_hot", "_rest").alias("label_error"),
                      F.lit(got.sha256()).alias("codebooks_sha256"))
