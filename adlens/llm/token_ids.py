"""Token ids as Parquet list columns (operator 4).

``write_token_ids`` encodes whole texts with the ``tokenizers`` library, closes
each with an end id, and writes them in ascending id order: ``ids`` is a
dictionary-encoded list column, ``doc_id`` and ``offset`` are delta-encoded,
row groups and pages have set sizes, and Parquet's page index lets a reader
with a filter on ``doc_id`` touch only the pages it needs; a reader of
``doc_id``/``n_tokens`` alone never opens the ids.

A byte-level pre-tokenizer never joins the text before a single space with
what follows it (given non-space characters on both sides), nor a letter with a
punctuation mark, nor a line's end with its neighbours, so texts are cut there, each different piece of a batch is coded once, and the library's ids are
remembered in a bounded cache. Any other kind of tokenizer, and any text that
holds a special token, goes to the library whole. The ids equal a plain
``encode`` call's in every case.

Scale: one range shuffle of the texts by id; the encode and the write stream
through it. Ids are never grouped or collected; positions come from one total
per written partition.

Defined results: NULL and empty texts have the end id alone; rows with equal
ids keep one entry each, in text order; NULL ids come first; an empty table
gives no rows.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.llm.common import held, quoted, scratch, slices

CACHE_PIECES = 500_000   # pieces remembered per worker
END_ID = 0

# Parquet layout of the token files.
LAYOUT = {
    "parquet.writer.version": "PARQUET_2_0",      # delta encodings
    "parquet.block.size": str(32 << 20),          # row group bytes
    "parquet.page.size": str(1 << 20),
    "parquet.page.row.count.limit": "2000",       # rows between page-index entries
    "parquet.dictionary.page.size": str(2 << 20),  # holds a whole vocabulary
    "parquet.enable.dictionary": "true",
    "parquet.enable.dictionary#doc_id": "false",  # delta instead
    "parquet.enable.dictionary#offset": "false",
    "compression": "zstd",
}

_FILE = T.StructType([
    T.StructField("doc_id", T.LongType()),
    T.StructField("part", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("ids", T.ArrayType(T.IntegerType())),
])
_ENCODED = T.StructType([_FILE["offset"], _FILE["n_tokens"], _FILE["ids"]])

_CUT = re.compile(r"(?<=\S)(?= \S)")
# A space beside other white space or at an end, or white space at the end: not every space is a cut.
_WHITE = r"[\s\x0B\x1C-\x1F\x{85}\p{Z}]"
_ODD = rf"(?:^|{_WHITE}) | (?:{_WHITE}|$)|{_WHITE}$"
# Further cuts, of letters known to every Unicode version: before marks that are neither letter, digit nor
# space, and around a line's end. A piece that begins with _BARE has no space before it.
_BARE = "\0"
_LETTER = r"[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{1BA}\x{410}-\x{44F}]"
_MORE = [(rf"({_LETTER})([.,;:!?*&%$#|\-()\"])", rf"\1 {_BARE}\2"),
         (rf"([A-Za-z.,;:!?*&%$#])\n({_LETTER})", f"\\1 {_BARE}\n {_BARE}\\2")]


class PieceCache:
    """The library's ids of texts, piece by piece.

    The cache holds pieces between single spaces as little-endian uint32 bytes.
    A full cache keeps what it has (the frequent head comes early) and codes
    the rest anew.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.cuts = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
                     and pre.get("use_regex", True) and not pre.get("add_prefix_space"))
        self.special = [t["content"] for t in spec.get("added_tokens", [])]
        vocab = self.tok.get_vocab()
        self.opens = np.zeros(max(vocab.values(), default=0) + 1, dtype=bool)  # tokens that begin with a space
        self.opens[[i for t, i in vocab.items() if t.startswith("\u0120")]] = True
        self.known: dict[str, bytes] = {}  # pieces after a space, without it

    def library(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, dtype="<u4").tobytes()
                for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def code(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of new pieces, each with the space before it, if it has one. Pieces without other
        spaces go side by side, many to a call: they stay apart, and only the
        first token of each begins with a space."""
        plain = [p for p in pieces if " " not in p and p[:1] != _BARE and not p[-1:].isspace()]
        out: dict[str, bytes] = {}
        for k in range(0, len(plain), 2000):
            part = plain[k:k + 2000]
            raw = self.library([" " + " ".join(part)])[0]
            starts = np.flatnonzero(self.opens[np.frombuffer(raw, dtype="<u4")])
            if len(starts) == len(part) and starts[0] == 0:
                at = [*(4 * starts).tolist(), len(raw)]
                out.update(zip(part, [raw[a:b] for a, b in zip(at, at[1:], strict=False)], strict=True))
        left = [p for p in pieces if p not in out]
        out.update(zip(left, self.library([p[1:] if p[:1] == _BARE else " " + p for p in left]), strict=True))
        return out

    def cut(self, texts: pa.Array) -> pa.ListArray:
        """The pieces of each text, the spaces at the cuts taken out; one piece at least."""
        odd = pc.match_substring_regex(texts, _ODD)
        whole = pa.array(np.full(len(texts), not self.cuts))
        for mark in [_BARE, *self.special]:
            whole = pc.or_(whole, pc.match_substring(texts, mark))
        even = pc.invert(pc.or_(odd, whole))
        plain = texts.filter(even)
        for pattern, cut in _MORE:
            plain = pc.replace_substring_regex(plain, pattern, cut)
        parts = [pc.split_pattern(plain, " ")]
        rest = pc.invert(even)
        if pc.any(rest).as_py():
            lists = []
            for text, one in zip(texts.filter(rest).to_pylist(), whole.filter(rest).to_pylist(), strict=True):
                first, *more = [text] if one else _CUT.split(text)
                lists.append([first, *(p[1:] for p in more)])
            parts.append(pa.array(lists, type=parts[0].type))
        order = np.argsort(np.concatenate([np.flatnonzero(even.to_numpy(zero_copy_only=False)),
                                           np.flatnonzero(rest.to_numpy(zero_copy_only=False))]))
        return pa.concat_arrays(parts).take(pa.array(order))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a batch of texts (large strings, no nulls), and how many each text has."""
        if not len(texts):
            return np.empty(0, dtype="<i4"), np.empty(0, dtype=np.int64)
        cut = self.cut(texts)
        ends, flat = cut.offsets.to_numpy(), cut.values
        heads = ends[:-1]
        later = np.ones(len(flat), dtype=bool)
        later[heads] = False
        coded = flat.filter(pa.array(later)).dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        got = list(map(self.known.get, pieces))
        new = self.code([p for p, g in zip(pieces, got, strict=True) if g is None])
        if new:
            got = [new[p] if g is None else g for p, g in zip(pieces, got, strict=True)]
            if len(self.known) + len(new) <= CACHE_PIECES:
                self.known.update(new)
        pool = id_lists(self.library(flat.take(pa.array(heads)).to_pylist()) + got)
        at = np.empty(len(flat), dtype=np.int64)
        at[heads] = np.arange(len(heads))
        at[later] = len(heads) + coded.indices.to_numpy()
        n = np.add.reduceat(np.diff(pool.offsets.to_numpy())[at], heads, dtype=np.int64)
        return pool.take(pa.array(at)).flatten().to_numpy(), n


def _loaded(path: str) -> PieceCache:
    return held("token ids", path, lambda: PieceCache(path))


def _chunks(texts: pa.Array, size: int = 8 << 20) -> Iterator[pa.Array]:
    """Runs of texts of about ``size`` bytes, one text at least."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy())
    at = 0
    while at < len(texts):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + size, side="right")))
        yield texts.slice(at, stop - at)
        at = stop


def id_lists(rows: list[bytes]) -> pa.ListArray:
    """Arrow int32 lists from rows of little-endian 32-bit ids."""
    ends = np.cumsum([0, *(len(r) // 4 for r in rows)])
    values = pa.array(np.frombuffer(b"".join(rows), dtype="<i4"), type=pa.int32())
    return pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), values)


def _closed(ids: np.ndarray, n: np.ndarray, end_id: int) -> pa.ListArray:
    """A list for each text: its ids and the end id."""
    ends = np.cumsum(n)
    values = np.insert(ids, ends, np.uint32(end_id).astype("<i4"))
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], ends + np.arange(1, len(n) + 1))), type=pa.int32()),
                                    pa.array(values, type=pa.int32()))


def _encode_udf(path: str, end_id: int):
    @F.arrow_udf(_ENCODED)
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model, at = _loaded(path), 0
        for batch in slices(batches, 2000, "token ids"):
            lists = [_closed(*model.encode(part), end_id)
                     for part in _chunks(batch.cast(pa.large_string()).fill_null(""))]
            ids = pa.concat_arrays(lists) if lists else id_lists([])
            n = np.diff(ids.offsets.to_numpy()).astype(np.int64)
            offset = at + np.concatenate(([0], np.cumsum(n)))
            at = int(offset[-1])
            yield pa.StructArray.from_arrays([pa.array(offset[:-1]), pa.array(n), ids], names=_ENCODED.names)

    return encode


def write_token_ids(docs: DataFrame, tokenizer: str, out: str, doc_id: str = "doc_id", text: str = "text",
                    end_id: int = END_ID) -> None:
    """Encode ``docs`` and write the token files to the folder ``out``."""
    rows = docs.select(F.col(quoted(doc_id)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))
    # The text's hash orders rows of one id; it also splits an id with many rows.
    tie = F.xxhash64("text")
    ordered = (rows.withColumn("_tie", tie).repartitionByRange("doc_id", "_tie")
               .sortWithinPartitions("doc_id", "_tie"))
    coded = ordered.select("doc_id", F.spark_partition_id().alias("part"),
                           _encode_udf(tokenizer, end_id)(F.col("text")).alias("e"))
    coded.select("doc_id", "part", "e.offset", "e.n_tokens", "e.ids").write.options(**LAYOUT).parquet(out)


def read_token_ids(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids): ``start`` counts all ids of earlier rows."""
    files = spark.read.schema(_FILE).parquet(path)
    # One row per written partition, in id order.
    totals = files.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = totals.select(F.col("part").alias("_part"), (F.sum("n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")).alias("_base"))
    return (files.join(F.broadcast(before), F.col("part") == F.col("_part"))
            .select("doc_id", (F.col("_base") + F.col("offset")).alias("start"), "n_tokens", "ids"))


@F.arrow_udf(T.LongType())
def ids_crc32(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""
    for lists in slices(batches):
        if lists.null_count:
            lists = lists.fill_null([])
        ends = lists.offsets.to_numpy()
        # ``values`` ignores the array's own offset, as ``offsets`` does
        raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), dtype="<i4")).cast("B")
        yield pa.array([zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)],
                       type=pa.int64())


def token_digests(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                  out: str | None = None) -> DataFrame:
    """Write the token files, read them back, and digest every row's ids."""
    out = out or scratch(docs.sparkSession, "token_ids")
    write_token_ids(docs, tokenizer, out, doc_id, text)
    back = read_token_ids(docs.sparkSession, out)
    return back.select("doc_id", "start", "n_tokens", ids_crc32(F.col("ids")).alias("ids_crc32"))
