"""Benchmark decontamination with a generalised suffix automaton (operator 1).

The words of the test items form one automaton per shard of at most
``SHARD_BYTES`` of item text. Each document streams its words through it; the
automaton gives at every word the longest match ending there. Where that match
is at least a window long (13 words, or a shorter item's whole length), the
window's words are hit and the state names the items that contain it.

Only runs of known item words can hold a window, so the walk covers those runs
alone: a word that no item has ends every match.

Scale: a benchmark of one shard is one pass over the documents, row by row,
with no shuffle. A larger one is passed over shard by shard: the documents are
stored once with a row number, each shard's pass is written before the next
one's items are sent, and what the passes found is joined to the rows by number.
So a worker holds one automaton: 80 MB for each MB of item text, measured on
pieces of documents of sf0.1. Items longer than ``PIECE_WORDS`` words are cut into
pieces that share a window less a word, so that a shard can be as small.

Defined results: NULL or word-less texts have 0 words, 0 hits and are clean;
NULL or word-less items have no window; an item with a NULL id marks hits but
is not listed; repeated items count once by id; repeated documents are judged
each on its own; empty tables give no rows or no hits.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.llm.automaton import SuffixAutomaton
from adlens.llm.common import quoted, scratch, slices, stored, with_struct, without, word_list

WINDOW = 13
COVERAGE = 0.05          # contaminated: 20 * n_hit >= n_words
SHARD_BYTES = 2 << 20    # item text in one automaton
PIECE_WORDS = 8_192      # of an item, where there are several shards

_WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")
_RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.IntegerType())),
    T.StructField("items", T.ArrayType(T.StringType())),
])
_ARROW = pa.struct([("n_words", pa.int64()), ("hits", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])


class ItemIndex:
    """Automaton of one shard of items, and the items of every window."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int) -> None:
        self.vocab: dict[bytes, int] = {}
        self.auto = SuffixAutomaton()
        texts = []
        for item_id, text in items:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in word_list(text)]
            if ids:
                texts.append((item_id, ids))
                self.auto.add(ids)
        # window length -> state -> item ids
        self.windows: dict[int, dict[int, set[str | None]]] = {}
        for item_id, ids in texts:
            n = min(window, len(ids))
            at = self.windows.setdefault(n, {})
            state = 0
            for i, c in enumerate(ids):
                state = self.auto.next[state][c]
                if i + 1 >= n:
                    at.setdefault(self.auto.suffix_state(state, n), set()).add(item_id)
        self.lengths = sorted(self.windows)

    def scan(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Hit word positions (ascending) and ids of the items found."""
        if not self.lengths or len(words) < self.lengths[0]:
            return np.empty(0, np.int32), set()
        ids = np.fromiter(map(self.vocab.get, words, _MINUS_ONES), dtype=np.int64, count=len(words))
        known = np.flatnonzero(np.diff(np.concatenate(([0], ids >= 0, [0])).astype(np.int8)))
        starts, ends = known[::2], known[1::2]
        long = (ends - starts) >= self.lengths[0]
        if not long.any():
            return np.empty(0, np.int32), set()
        auto, found, hit = self.auto, set(), np.zeros(len(words), dtype=bool)
        shortest = self.lengths[0]
        for a, b in zip(starts[long].tolist(), ends[long].tolist(), strict=True):
            state = matched = 0
            for i, c in enumerate(ids[a:b].tolist(), a):
                state, matched = auto.step(state, matched, c)
                if matched < shortest:
                    continue
                for n in self.lengths:
                    if n > matched:
                        break
                    items = self.windows[n].get(auto.suffix_state(state, n))
                    if items:
                        hit[i - n + 1:i + 1] = True
                        found |= items
        found.discard(None)
        return np.flatnonzero(hit).astype(np.int32), found


class _Forever:
    def __iter__(self):
        return self

    def __next__(self):
        return -1


_MINUS_ONES = _Forever()


def _scan_udf(shared: Broadcast, window: int, left: str | None = None):
    """``left``: a further field, the text without its hit words where there are any."""
    kind, arrow = _RESULT, _ARROW
    if left:
        kind, arrow = T.StructType([*_RESULT, T.StructField(left, T.StringType())]), pa.struct([*_ARROW, (left, pa.string())])

    @F.arrow_udf(kind)
    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        index = ItemIndex(shared.value, window)
        for texts in slices(batches):
            out = []
            for text in texts.to_pylist():
                words = word_list(text)
                hits, found = index.scan(words)
                out.append({"n_words": len(words), "hits": hits, "items": sorted(found)})
                if left and len(hits):
                    out[-1][left] = cut_words(text, hits.tolist())
            yield pa.array(out, type=arrow)

    return scan


def _pieces(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1):
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for item_id, text in zip(ids, texts, strict=True):
                words = word_list(text)
                step = max(PIECE_WORDS, 2 * window)
                # the last piece is never shorter than a window, unless the item is
                parts = [b" ".join(words[k:k + step + window - 1]).decode("utf-8")
                         for k in range(0, max(len(words) - window + 1, 1), step)]
                yield pa.RecordBatch.from_arrays([pa.array([item_id] * len(parts), type=pa.string()), pa.array(parts, type=pa.string())],
                                                 names=["i", "t"])

    return run


def item_shards(items: DataFrame, item_id: str, text: str, window: int = WINDOW) -> Iterator[list[tuple]]:
    """The items, in shards whose text is about ``SHARD_BYTES`` at most."""
    rows = items.select(F.col(quoted(item_id)).cast("string").alias("i"), F.col(quoted(text)).alias("t"))
    weight = F.sum(F.octet_length("t") + F.lit(64)).alias("b")
    if (rows.agg(weight).first()["b"] or 0) <= SHARD_BYTES:
        yield [(r["i"], r["t"]) for r in rows.collect()]
        return
    rows = stored(rows.filter("t IS NOT NULL").mapInArrow(_pieces(window), "i string, t string").distinct(), "items")
    shards = max(1, -(-int((rows.agg(weight).first()["b"] or 0) * 3 // 2) // SHARD_BYTES))
    for k in range(shards):
        part = rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(shards)) == k)
        yield [(r["i"], r["t"]) for r in part.collect()]


def find_overlaps(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, left: str | None = None) -> DataFrame:
    """``docs`` with ``n_words`` (long), ``hits`` (positions of hit words) and
    ``items`` (ids of the items with occurring windows). ``left``: a column for
    the text without its hit words, where there are any."""
    spark, fields = docs.sparkSession, [f.name for f in _RESULT]
    shards = item_shards(items, item_id, item_text, window)
    shard, more = next(shards), next(shards, None)
    if more is None:
        scan = _scan_udf(spark.sparkContext.broadcast(shard), window, left)
        # not deterministic, so that a filter on what it found does not scan a second time, in workers of its own
        scan = scan.asNondeterministic() if left else scan
        return with_struct(docs, scan(F.col(quoted(text))), [*fields, left] if left else fields)
    row, found = "_row_" + uuid.uuid4().hex, "_found_" + uuid.uuid4().hex
    kept = stored(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    paths = []
    for part in chain([shard, more], shards):
        shared = spark.sparkContext.broadcast(part)
        # not deterministic, so that the filter does not scan a second time
        scan = _scan_udf(shared, window).asNondeterministic()
        got = kept.select(row, scan(F.col(quoted(text))).alias("r")).select(row, "r.*")
        if paths:  # the first pass has all rows
            got = got.filter(F.size("hits") > 0)
        paths.append(scratch(spark, "overlaps"))
        got.write.parquet(paths[-1])
        shared.destroy()
    merged = spark.read.parquet(*paths).groupBy(row).agg(F.struct(
        F.max("n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")).alias(found))
    got = with_struct(kept.join(merged, row), F.col(found), fields).drop(row, found)
    return got.withColumn(left, _cut(F.col(quoted(text)), F.col("hits"))) if left else got


def contaminated(coverage: float = COVERAGE):
    """True where hit words reach ``coverage`` of a document's words."""
    per = round(1 / coverage)
    return (F.size("hits") > 0) & (F.lit(per) * F.size("hits").cast("long") >= F.col("n_words"))


def cut_words(text: str, hits: list[int]) -> str:
    """``text`` without the hit words and what lies between adjacent ones."""
    spans = [m.span() for m in _WORD.finditer(text)]
    out, at, k = [], 0, 0
    while k < len(hits):
        j = k
        while j + 1 < len(hits) and hits[j + 1] == hits[j] + 1:
            j += 1
        out.append(text[at:spans[hits[k]][0]])
        at = spans[hits[j]][1]
        k = j + 1
    return "".join([*out, text[at:]])


@F.arrow_udf(T.StringType())
def _cut(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for texts, hits in slices(batches):
        yield pa.array([t if t is None or not h else cut_words(t, h)
                        for t, h in zip(texts.to_pylist(), hits.to_pylist(), strict=True)], type=pa.string())


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
                  item_text: str = "text", window: int = WINDOW, coverage: float = COVERAGE) -> DataFrame:
    """Documents whose hit words stay below ``coverage``, their benchmark spans
    (window words or longer) cut out; columns as in ``docs``."""
    left = "_left_" + uuid.uuid4().hex
    found = find_overlaps(docs, items, text, item_id, item_text, window, left).filter(~contaminated(coverage))
    cut = F.when(F.size("hits") > 0, F.col(left)).otherwise(F.col(quoted(text)))
    return found.select(*[cut.alias(c) if c == text else F.col(quoted(c))
                          for c in without(docs, ["n_words", "hits", "items"])])
