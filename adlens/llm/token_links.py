"""Cross-tokenizer alignment by external spill counting (operator 13).

Every text is coded by two tokenizers, A (byte-level BPE of the ``tokenizers`` library, over a
space and the text) and B (a SentencePiece model, which adds that space itself). Byte offsets where
tokens of both end cut a text into groups; each A and each B token that share a
byte are a link. The links of an id pair are counted over the whole corpus, and
each document gets the sums of its links' counts.

Both tokenizers break where a single space follows another character: texts are cut into such units, a unit's tokens, links and
group string are worked out once and remembered in a bounded cache, and a
document's are its units' put together.

Counting, out of core:

1. *Runs.* A task gathers (side, other, document) links, side being the B id, up to
   ``RUN_LINKS``, sorts them and partitions them by ``side`` mod ``RADICES``. Each
   partition is written to the shared folder as two zstd blocks: the run's distinct pairs with their
   counts, and the pair-document records.
2. *Merge.* The pair blocks of a radix are merged by a heap over the runs' next
   sides, at most ``FAN_IN`` runs at a time, in as many levels as the number of
   runs asks for. The order is side-major: when the heap goes on to the next
   side, all its pairs are complete and the side's highest count is known.
3. *Answers.* Counts go back: each pair block meets the counts of its radix and becomes
   a block of (count, whether it is the side's highest) in the run's own order.
4. *Contributions.* The records of a run stream past its answers, radix by radix, and
   add up by document.

Scale: documents never meet each other; what is shuffled are blocks. A pair that is in every
document is one entry a run, so no id is hot. Memory a task: one run (a single document may be
larger), or the distinct pairs of one radix, which the two vocabularies bound. Everything between the steps is
a written table, so a lost executor costs its tasks only.

Defined results: NULL and empty texts, and texts whose joined A or B bytes are not the space
and the text (a literal U+2581, say), have no tokens: zeros and an empty
digest. Special tokens' strings are plain text. Rows are aligned each on its own, repeated ids too, and all count; NULL ids are kept;
ties of the highest count are all best; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import heapq
import io
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlens.llm.common import held, quoted, released, stored
from adlens.llm.token_ids import PieceCache

RADICES = 64
FAN_IN = 256               # runs merged at a time
RUN_LINKS = 3_000_000      # links a run holds, about
RUN_DOCS = 1 << 17
UNITS = 300_000            # units remembered a worker
BATCH_BYTES = 2 << 20      # text worked on at a time

_CUT = re.compile(r"(?<=\S)(?= \S)")


def _vocabulary_a(tok) -> list[bytes]:
    """Bytes of each id of a byte-level tokenizer."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    chars = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(plain)))}
    vocab = tok.get_vocab()
    out = [b""] * (max(vocab.values(), default=-1) + 1)
    for piece, i in vocab.items():
        out[i] = bytes([chars[c] for c in piece]) if all(c in chars for c in piece) else piece.encode("utf-8")
    return out


def _vocabulary_b(sp) -> list[bytes]:
    """Bytes of each id of a SentencePiece model."""
    return [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else
            sp.id_to_piece(i).replace("▁", " ").encode("utf-8") for i in range(sp.get_piece_size())]


def align(len_a: np.ndarray, len_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(A index, B index) of each link in byte order, and whether a group ends with it,
    of two token sequences over the same bytes, given the tokens' lengths.

    The ends of both cut the bytes into segments; a segment lies in one token of each
    side, and tokens that overlap share exactly one segment."""
    ends_a, ends_b = np.cumsum(len_a), np.cumsum(len_b)
    ends = np.union1d(ends_a, ends_b)
    a, b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
    return a, b, (ends_a[a] == ends) & (ends_b[b] == ends)


def _digits(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 ... n - 1, a row each with room for a mark behind, and their numbers."""
    text = [str(i).encode() for i in range(n)]
    size = np.array([len(t) for t in text], np.int64)
    width = int(size.max(initial=1)) + 1
    return np.frombuffer(b"".join([t.ljust(width, b"\0") for t in text]), np.uint8).reshape(n, width), size


class _Flat:
    """Id lists laid end to end."""

    def __init__(self, lists, sizes: np.ndarray) -> None:
        self.n = np.array([len(x) for x in lists], np.int64)
        self.ids = np.concatenate([np.zeros(0, np.int64), *(np.asarray(x, np.int64) for x in lists)])
        self.size = sizes[self.ids]

    def sums(self) -> np.ndarray:
        """Bytes of each list."""
        at = np.concatenate([[0], np.cumsum(self.size)])
        ends = np.cumsum(self.n)
        return at[ends] - at[ends - self.n]


class Units:
    """Tokens, links and group strings of units, worked out once each, many at a time."""

    def __init__(self, tokenizer: str, model: str) -> None:
        import sentencepiece

        self.coder = PieceCache(tokenizer)
        self.coder.tok.encode_special_tokens = True
        self.sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.bytes_a, self.bytes_b = _vocabulary_a(self.coder.tok), _vocabulary_b(self.sp)
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.digits, self.n_digits = _digits(max(len(self.bytes_a), len(self.bytes_b)))
        self.shift = max(1, len(self.bytes_a) - 1).bit_length()
        self.known: dict[str, int] = {}      # unit without its leading space -> number
        self.strings: list[bytes] = []       # group strings
        self.whole: list[bool] = []          # cut as far as it can be
        self.facts = [np.zeros((0, 4), np.int64)]   # n_a (-1: not lossless), n_b, n_groups, n_links
        self.links = [np.zeros(0, np.int64)]        # side << shift | other

    def trim(self) -> None:
        """Keep the first ``UNITS`` units, the frequent ones: they come early."""
        if len(self.strings) <= UNITS:
            return
        facts, starts, links = self.tables()
        end = int(starts[UNITS])
        self.facts, self.links = [facts[:UNITS].copy()], [links[:end].copy()]
        del self.strings[UNITS:], self.whole[UNITS:]
        while len(self.known) > UNITS:
            self.known.popitem()             # the latest first

    def _coded(self, units: list[str]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """A and B ids of each unit. Units without white space at their ends go to A side by side
        (a NUL in front would mean something else to that coder)."""
        coded = self.coder.code([u for u in units if u and not u[0].isspace() and u[0] != "\0"])
        rest = [u for u in units if u not in coded]
        coded.update(zip(rest, self.coder.library([" " + u for u in rest]), strict=True))
        return [np.frombuffer(coded[u], "<u4") for u in units], self.sp.encode(units, num_threads=1)

    def add(self, units: list[str]) -> None:
        first = len(self.strings)
        self.known.update(zip(units, range(first, first + len(units)), strict=True))
        self.whole += [bool(u) and not u[0].isspace() and not u[-1].isspace() and " " not in u for u in units]
        ids_a, ids_b = self._coded(units)
        raw = [(" " + u).encode("utf-8") for u in units]
        size = np.array([len(r) for r in raw], np.int64)
        a, b = _Flat(ids_a, self.size_a), _Flat(ids_b, self.size_b)
        facts, strings = np.zeros((len(units), 4), np.int64), [b""] * len(units)
        facts[:, 0] = -1
        good = list(range(len(units)))
        joined = b"".join(raw)
        if (a.sums() != size).any() or (b.sums() != size).any() or b"".join(map(self.bytes_a.__getitem__, a.ids.tolist())) != joined \
                or b"".join(map(self.bytes_b.__getitem__, b.ids.tolist())) != joined:
            good = [k for k in good if b"".join([self.bytes_a[i] for i in ids_a[k].tolist()]) == raw[k]
                    and b"".join([self.bytes_b[i] for i in ids_b[k]]) == raw[k]]
            a, b = _Flat([ids_a[k] for k in good], self.size_a), _Flat([ids_b[k] for k in good], self.size_b)
        if good:
            self._aligned(good, a, b, facts, strings)
        self.facts.append(facts)
        self.strings += strings

    def _aligned(self, good: list[int], side_a: _Flat, side_b: _Flat, facts: np.ndarray, strings: list[bytes]) -> None:
        """Links and group strings of units laid end to end: both sides' bytes are the same, so
        no link or group crosses from one unit to the next."""
        flat_a, flat_b, n_a, n_b = side_a.ids, side_b.ids, side_a.n, side_b.n
        ends_a, ends_b = np.cumsum(side_a.size), np.cumsum(side_b.size)
        a, b, closes = align(side_a.size, side_b.size)
        last = np.cumsum(n_b) - 1                                  # each unit's last B token
        unit = np.searchsorted(ends_b[last], ends_b[b])            # of each link
        n = len(good)
        facts[good] = np.stack([n_a, n_b, np.bincount(unit[closes], minlength=n), np.bincount(unit, minlength=n)], axis=1)
        self.links.append((flat_b[b] << self.shift) | flat_a[a])
        # the strings: tokens in order of group, side and place, each with its mark behind
        group_ends = ends_b[b[closes]]
        group_a, group_b = np.searchsorted(group_ends, ends_a), np.searchsorted(group_ends, ends_b)
        mark_a = np.where(group_ends[group_a] == ends_a, ord("|"), ord(","))
        mark_b = np.where(group_ends[group_b] == ends_b, ord(";"), ord(","))
        ids = np.concatenate([flat_a, flat_b])
        size = self.n_digits[ids] + 1
        size[len(flat_a) + last] -= 1                              # nothing behind a unit's last token
        chars = self.digits[ids]
        chars[np.arange(len(ids)), self.n_digits[ids]] = np.concatenate([mark_a, mark_b])
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        text = chars[order][np.arange(chars.shape[1])[None, :] < size[order][:, None]].tobytes()
        of_unit = np.concatenate([np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)])
        ends = np.cumsum(np.bincount(of_unit, weights=size, minlength=n).astype(np.int64)).tolist()
        for k, lo, hi in zip(good, [0, *ends], ends, strict=False):
            strings[k] = text[lo:hi]

    def numbers(self, texts: list[str]) -> list[list[int]]:
        """The units of each text."""
        self.trim()
        cut = [t.split(" ") for t in texts]
        new = dict.fromkeys(u for units in cut for u in units if u not in self.known)
        if new:
            self.add(list(new))
        out, odd = [], []
        for k, units in enumerate(cut):
            numbers = list(map(self.known.__getitem__, units))
            if not all(map(self.whole.__getitem__, numbers)):   # white space beside a space: not every space is a cut
                odd.append(k)
            out.append(numbers)
        if odd:
            cut = [[u[1:] for u in _CUT.split(" " + texts[k])] for k in odd]
            new = dict.fromkeys(u for units in cut for u in units if u not in self.known)
            if new:
                self.add(list(new))
            for k, units in zip(odd, cut, strict=True):
                out[k] = list(map(self.known.__getitem__, units))
        return out

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(facts, first link of each unit, links) of all units known."""
        self.facts, self.links = [np.concatenate(self.facts)], [np.concatenate(self.links)]
        ends = np.cumsum(self.facts[0][:, 3])
        return self.facts[0], ends - self.facts[0][:, 3], self.links[0]


def _loaded(tokenizer: str, model: str) -> Units:
    return held("token links", (tokenizer, model), lambda: Units(tokenizer, model))


# --- zstd blocks -------------------------------------------------------------

def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of non-negative integers in one zstd block; each as its smallest unsigned type."""
    raw = io.BytesIO()
    for x in arrays:
        kind = np.min_scalar_type(int(x.max())) if len(x) else np.dtype(np.uint8)
        raw.write(np.array([len(x), kind.itemsize], "<u8").tobytes())
        raw.write(np.ascontiguousarray(x.astype(f"<u{kind.itemsize}")).tobytes())
    return zstandard.ZstdCompressor(level=3).compress(raw.getvalue())


def _unpacked(block: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.ZstdDecompressor().decompress(block), 0, []
    while at < len(raw):
        n, size = np.frombuffer(raw, "<u8", 2, at).tolist()
        out.append(np.frombuffer(raw, f"<u{size}", n, at + 16).astype(np.int64))
        at += 16 + n * size
    return out


def _gaps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=0)


# --- 1: runs -----------------------------------------------------------------

_RUN = "run long, radix int, kind int, block binary"
DOCS, PAIRS, RECORDS = range(3)


class _Run:
    """Documents and links gathered by a task."""

    def __init__(self, number: int, shift: int) -> None:
        self.number, self.shift, self.n_links = number, shift, 0
        self.ids: list = []
        self.facts: list[tuple] = []
        self.links: list[np.ndarray] = []
        self.docs: list[np.ndarray] = []

    def rows(self) -> Iterator[pa.RecordBatch]:
        """One row for the documents, two for each radix."""
        out: list[tuple[int, int, bytes]] = []
        n_a, n_b, n_groups, n_links, digest = (list(c) for c in zip(*self.facts, strict=True))
        docs = pa.RecordBatch.from_pydict({"doc_id": pa.array(self.ids, pa.int64()), "n_a": n_a, "n_b": n_b, "n_groups": n_groups,
                                           "n_links": n_links, "groups_sha256": pa.array(digest, pa.string())})
        sink = io.BytesIO()
        with pa.ipc.new_stream(sink, docs.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
            writer.write_batch(docs)
        out.append((-1, DOCS, sink.getvalue()))
        links = np.concatenate(self.links) if self.links else np.zeros(0, np.int64)
        doc = np.concatenate(self.docs) if self.docs else np.zeros(0, np.int64)
        order = np.lexsort((doc, links))
        links, doc = links[order], doc[order]
        new = np.flatnonzero(np.concatenate(([True], (np.diff(links) != 0) | (np.diff(doc) != 0)))) if len(links) else np.zeros(0, int)
        times = np.diff(np.append(new, len(links)))
        links, doc = links[new], doc[new]
        radix = (links >> self.shift) % RADICES
        order = np.argsort(radix, kind="stable")
        links, doc, times, radix = links[order], doc[order], times[order], radix[order]
        bounds = np.searchsorted(radix, np.arange(RADICES + 1))
        for r, (lo, hi) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)):
            if lo == hi:
                continue
            own = links[lo:hi]
            first = np.flatnonzero(np.concatenate(([True], np.diff(own) != 0)))
            ends = np.append(first, len(own))
            out.append((r, PAIRS, _packed(_gaps(own[first]), np.add.reduceat(times[lo:hi], first))))
            out.append((r, RECORDS, _packed(np.diff(ends), doc[lo:hi], times[lo:hi])))
        yield pa.RecordBatch.from_arrays(
            [pa.array([self.number] * len(out), pa.int64()), *(pa.array(list(c), t) for c, t in zip(
                zip(*out, strict=True), (pa.int32(), pa.int32(), pa.binary()), strict=True))], names=["run", "radix", "kind", "block"])


def _write_runs(tokenizer: str, model: str, run_links: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _loaded(tokenizer, model)
        number = TaskContext.get().partitionId() << 32
        gathered = _Run(number, units.shift)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            at = 0
            while at < len(ids):
                some, size = [], 0
                while at + len(some) < len(ids) and (not some or size < BATCH_BYTES) and len(some) < 2000:
                    some.append(texts[at + len(some)].as_py() or "")
                    size += len(some[-1])
                numbers = units.numbers(some)
                facts, starts, links = units.tables()
                for i, text, own in zip(ids[at:at + len(some)], some, numbers, strict=True):
                    f = facts[own]
                    if not text or (f[:, 0] < 0).any():
                        gathered.facts.append((0, 0, 0, 0, ""))
                    else:
                        n = f[:, 3]
                        total = f.sum(axis=0).tolist()
                        digest = hashlib.sha256(b";".join(map(units.strings.__getitem__, own))).hexdigest()
                        gathered.facts.append((*total, digest))
                        place = np.repeat(starts[own] - (np.cumsum(n) - n), n) + np.arange(total[3])
                        gathered.links.append(links[place])
                        gathered.docs.append(np.full(total[3], len(gathered.ids), np.int64))
                        gathered.n_links += total[3]
                    gathered.ids.append(i)
                    if gathered.n_links >= run_links or len(gathered.ids) >= RUN_DOCS:
                        yield from gathered.rows()
                        number += 1
                        gathered = _Run(number, units.shift)
                at += len(some)
        if gathered.ids:
            yield from gathered.rows()
        released()

    return run


# --- 2: merge ----------------------------------------------------------------

def merged(blocks: list[bytes], shift: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(pairs, counts) of one side after the other, from sorted runs of pairs:
    a heap holds each run's next side."""
    runs, heap = [], []
    for k, block in enumerate(blocks):
        gaps, count = _unpacked(block)
        pairs = np.cumsum(gaps)
        sides = pairs >> shift
        first = np.flatnonzero(np.concatenate(([True], np.diff(sides) != 0)))
        runs.append((pairs, count, [*first.tolist(), len(pairs)], sides[first].tolist()))
        heap.append((runs[-1][3][0], k, 0))
    heapq.heapify(heap)
    while heap:
        side, parts = heap[0][0], []
        while heap and heap[0][0] == side:
            _, k, at = heap[0]
            pairs, count, ends, sides = runs[k]
            parts.append((pairs[ends[at]:ends[at + 1]], count[ends[at]:ends[at + 1]]))
            if at + 1 < len(sides):
                heapq.heapreplace(heap, (sides[at + 1], k, at + 1))
            else:
                heapq.heappop(heap)
        if len(parts) == 1:
            yield parts[0]
            continue
        pairs, count = np.concatenate([p for p, _ in parts]), np.concatenate([c for _, c in parts])
        order = np.argsort(pairs, kind="stable")
        pairs, count = pairs[order], count[order]
        first = np.flatnonzero(np.concatenate(([True], np.diff(pairs) != 0)))
        yield pairs[first], np.add.reduceat(count, first)


def _merge(shift: int, last: bool):
    """Runs of one (radix, heap) into one; the last level adds whether a pair is its side's best."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, blocks = None, []

        def closed() -> pa.RecordBatch:
            sides = list(merged(blocks, shift))
            pairs, count = np.concatenate([p for p, _ in sides]), np.concatenate([c for _, c in sides])
            cols = [_gaps(pairs), count]
            if last:
                cols.append(np.concatenate([(c == c.max()).astype(np.int64) for _, c in sides]))
            return pa.RecordBatch.from_arrays([pa.array([key[1]], pa.int64()), pa.array([key[0]], pa.int32()),
                                               pa.array([_packed(*cols)], pa.binary())], names=["run", "radix", "block"])

        for batch in batches:
            for radix, heap, block in zip(*(batch.column(c).to_pylist() for c in ("radix", "heap", "block")), strict=True):
                if (radix, heap) != key:
                    if blocks:
                        yield closed()
                    key, blocks = (radix, heap), []
                blocks.append(block)
        if blocks:
            yield closed()

    return run


# --- 3, 4: answers and contributions -----------------------------------------

def _answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of a radix (first in its group), then the runs' pair blocks."""
    known = None
    for batch in batches:
        out = []
        for run, block in zip(batch.column("run").to_pylist(), batch.column("block").to_pylist(), strict=True):
            if run < 0:
                gaps, count, best = _unpacked(block)
                known = np.cumsum(gaps), count, best
                out.append(None)
                continue
            at = np.searchsorted(known[0], np.cumsum(_unpacked(block)[0]))
            out.append(_packed(known[1][at], known[2][at]))
        got = pa.RecordBatch.from_arrays([batch.column("run"), batch.column("radix"), pa.array(out, pa.binary())],
                                         names=["run", "radix", "block"])
        yield got.filter(pa.array([b is not None for b in out], pa.bool_()))


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _contribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a run in order: its documents, then each radix's records and answers."""
    docs = n_best = count_sum = records = None

    def closed() -> pa.RecordBatch:
        cols = [docs.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")]
        return pa.RecordBatch.from_arrays([*cols, pa.array(n_best), pa.array(count_sum), docs.column("groups_sha256")],
                                          names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    for batch in batches:
        for kind, block in zip(batch.column("kind").to_pylist(), batch.column("block").to_pylist(), strict=True):
            if kind == DOCS:
                if docs is not None:
                    yield closed()
                docs = pa.ipc.open_stream(block).read_next_batch()
                n_best, count_sum = np.zeros(len(docs), np.int64), np.zeros(len(docs), np.int64)
            elif kind == RECORDS:
                records = _unpacked(block)
            else:
                (size, doc, times), (count, best) = records, _unpacked(block)
                np.add.at(count_sum, doc, np.repeat(count, size) * times)
                np.add.at(n_best, doc, np.repeat(best, size) * times)
    if docs is not None:
        yield closed()


def align_corpus(docs: DataFrame, tokenizer: str, model: str, doc_id: str = "doc_id", text: str = "text",
                 run_links: int = RUN_LINKS, fan_in: int = FAN_IN) -> tuple[DataFrame, DataFrame]:
    """(documents, pairs): a row per document, and the corpus-wide counts as
    (radix, block) rows, which :func:`pair_table` opens."""
    units = Units(tokenizer, model)
    shift = units.shift
    rows = docs.select(F.col(quoted(doc_id)).cast("long").alias("doc_id"), F.col(quoted(text)).alias("text"))
    runs = stored(rows.mapInArrow(_write_runs(tokenizer, model, run_links), _RUN), "runs")
    pairs = runs.filter(F.col("kind") == PAIRS).select("run", "radix", "block")
    n_runs = runs.filter(F.col("kind") == DOCS).count()
    merged_runs, left = pairs, n_runs
    while True:
        heaps = -(-left // fan_in)
        keyed = merged_runs.select("run", "radix", "block", F.pmod(F.xxhash64("run"), F.lit(max(1, heaps))).alias("heap"))
        level = (keyed.repartition("radix", "heap").sortWithinPartitions("radix", "heap", "run")
                 .mapInArrow(_merge(shift, heaps <= 1), "run long, radix int, block binary"))
        merged_runs = stored(level, "merged")
        if heaps <= 1:
            break
        left = heaps
    counts = merged_runs.select("radix", "block")
    # each group of runs of a radix gets the radix's counts once
    groups = -(-n_runs // fan_in) or 1
    known = counts.select(F.lit(-1).cast("long").alias("run"), "radix", "block",
                          F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))).alias("heap"))
    asked = pairs.select("run", "radix", "block", F.pmod(F.xxhash64("run"), F.lit(groups)).alias("heap"))
    answers = stored(known.unionByName(asked).repartition("radix", "heap").sortWithinPartitions("radix", "heap", "run")
                     .select("run", "radix", "block").mapInArrow(_answer, "run long, radix int, block binary"), "answers")
    parts = runs.filter(F.col("kind") != PAIRS).select("run", "radix", "kind", "block") \
        .unionByName(answers.select("run", "radix", F.lit(RECORDS + 1).alias("kind"), "block"))
    result = (parts.repartition("run").sortWithinPartitions("run", "radix", "kind").select("kind", "block")
              .mapInArrow(_contribute, _RESULT))
    return result, counts


def pair_table(counts: DataFrame, tokenizer: str, model: str) -> DataFrame:
    """(b_id, a_id, links, best) of every linked id pair."""
    shift = Units(tokenizer, model).shift

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column("block").to_pylist():
                gaps, count, best = _unpacked(block)
                pairs = np.cumsum(gaps)
                yield pa.RecordBatch.from_arrays([pa.array(pairs >> shift), pa.array(pairs & ((1 << shift) - 1)), pa.array(count),
                                                  pa.array(best == 1)], names=["b_id", "a_id", "links", "best"])

    return counts.select("block").mapInArrow(opened, "b_id long, a_id long, links long, best boolean")
