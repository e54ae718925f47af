"""SentencePiece encoding and decoding by streaming Viterbi (operator 9).

``PieceModel`` reads a SentencePiece model's pieces and scores and runs a
Viterbi pass over the boundaries between characters. Every boundary keeps one
back-pointer: the start of the last piece of the surviving path into it.

- Unigram models: the path with the largest sum of piece scores survives.
- BPE models: scores are merge ranks, and their sum is not what the model
  means. A path survives into a boundary if each two neighbouring pieces are
  what the merges leave of their joined text. Merges never cross a boundary
  between final pieces, so exactly one path into each boundary has that
  property and the ids equal the library's merge result.

The pass keeps a window of back-pointers. Paths go on only from boundaries
at most the longest piece's length back; whenever the paths into these meet in
one boundary, the ids before it are committed and the window drops them. The
result equals a pass over the whole text.

Two characters that are neighbours in no piece are a boundary of every path: a
convergence known beforehand. Many texts at a time are cut there; the pass runs
over each distinct segment once, and a bounded cache remembers the ids of those
met lately.

The text is coded without loss: a space becomes the mark, one mark is put in
front, a character without a piece (and a literal mark) becomes byte pieces.
But for literal marks the ids are the library's.

Scale: row-wise, no shuffle, nothing collected. Memory per worker: the model,
bounded caches, and one Arrow batch.

Defined results: NULL and empty texts have no ids and decode to the empty
text; equal totals prefer the longer last piece; rows are coded each on its
own; empty tables give no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.llm.common import held, quoted, slices, with_struct
from adlens.llm.token_ids import id_lists

MARK = "\u2581"
CACHE_SEGMENTS = 200_000  # and so many again from before (see ``Recent``): a worker on 0.5 GB meets hundreds of thousands
CACHE_FITS = 400_000
SEGMENT_CHARS = 64       # longer segments are not remembered
_UNKNOWN_PENALTY = 10.0


def _fields(raw: bytes):
    """(number, value) of a protocol-buffer message's fields."""
    def varint(k: int) -> tuple[int, int]:
        x = shift = 0
        while True:
            x |= (raw[k] & 127) << shift
            k, shift = k + 1, shift + 7
            if raw[k - 1] < 128:
                return x, k

    k = 0
    while k < len(raw):
        key, k = varint(k)
        if key & 7 == 0:
            value, k = varint(k)
        else:
            n, k = varint(k) if key & 7 == 2 else ({1: 8, 5: 4}[key & 7], k)
            value, k = raw[k:k + n], k + n
        yield key >> 3, value


def is_bpe(serialized: bytes) -> bool:
    """Model type of a SentencePiece file: trainer_spec (2), model_type (3), BPE (2)."""
    return any(v == 2 for n, spec in _fields(serialized) if n == 2 for m, v in _fields(spec) if m == 3)


class Recent(dict):
    """What was asked for lately: ``size`` entries become ``before`` and make room; those asked for
    again come back. So what a later part of a corpus repeats is remembered too."""

    def __init__(self, size: int) -> None:
        super().__init__()
        self.size, self.before = size, {}

    def __missing__(self, key: str) -> bytes | None:
        got = self.before.get(key)
        if got is not None:
            self.keep(key, got)
        return got

    def keep(self, key: str, value: bytes) -> None:
        if len(self) >= self.size:
            self.before = dict(self)
            self.clear()
        self[key] = value


class PieceModel:
    def __init__(self, path: str | None = None, pieces: dict[str, tuple[int, float]] | None = None,
                 byte_ids: list[int] | None = None, bpe: bool = False) -> None:
        if path is not None:
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            pieces = {sp.id_to_piece(i): (i, sp.get_score(i)) for i in range(sp.get_piece_size())
                      if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
            byte_ids = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
            bpe = is_bpe(sp.serialized_model_proto())
        self.pieces, self.byte_ids, self.bpe = pieces, byte_ids, bpe
        self.longest = max(map(len, pieces), default=1)
        self.fallback = min((s for _, s in pieces.values()), default=0.0) - _UNKNOWN_PENALTY
        #: every prefix of a piece -> its score, or None where it is no piece
        self.trie: dict[str, float | None] = {p[:k]: None for p in pieces for k in range(1, len(p))}
        self.trie.update((p, s) for p, (_, s) in pieces.items() if not bpe or self._merged(p) == [p])
        #: pieces by their characters; a piece ends where "" leads to it
        self.tree: dict = {}
        for p in (p for p, score in self.trie.items() if score is not None):
            node = self.tree
            for c in p:
                node = node.setdefault(c, {})
            node[""] = p
        self.joined = {p[k:k + 2] for p in pieces for k in range(len(p) - 1)}
        #: the characters of these pairs by number (0: the others), and whether two of them are a pair
        chars = sorted({c for pair in self.joined for c in pair})
        self.number = np.zeros(sys.maxunicode + 1, dtype=np.uint16 if len(chars) < 1 << 16 else np.int32)
        self.number[[ord(c) for c in chars]] = range(1, len(chars) + 1)
        self.pairs = np.zeros((len(chars) + 1, len(chars) + 1), dtype=bool)
        for a, b in self.joined:
            self.pairs[self.number[ord(a)], self.number[ord(b)]] = True
        self.cache = Recent(CACHE_SEGMENTS)   # ids of segments
        self.fits: dict[str, dict[str, bool]] = {}
        self.n_fits = 0
        self.code = {p: i.to_bytes(4, "little") for p, (i, _) in pieces.items()}
        self.raw = [b""] * (1 + max([i for i, _ in pieces.values()] + list(byte_ids)))
        for p, (i, _) in pieces.items():
            self.raw[i] = p.replace(MARK, " ").encode("utf-8")
        for b, i in enumerate(byte_ids):
            self.raw[i] = bytes([b])

    def _merged(self, s: str) -> list[str]:
        """What merging the best-scored neighbours leaves of a short text."""
        parts, pieces = list(s), self.pieces
        while len(parts) > 1:
            best = at = None
            for k in range(len(parts) - 1):
                hit = pieces.get(parts[k] + parts[k + 1])
                if hit is not None and (best is None or hit[1] > best):
                    best, at = hit[1], k
            if at is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fit(self, a: str, b: str) -> bool:
        """Whether the merges leave ``a`` and ``b`` of their joined text."""
        known = self.fits.get(a)
        if known is None:
            known = self.fits[a] = {}
        got = known.get(b)
        if got is None:
            if self.n_fits >= CACHE_FITS:
                self.fits.clear()
                self.n_fits = 0
            self.n_fits += 1
            got = known[b] = a[-1] + b[0] not in self.joined or self._merged(a + b) == [a, b]
        return got

    def _coded(self, pieces: list[str]) -> bytes:
        code = self.code
        return b"".join([code[p] if p in code else self.byte_code(p) for p in pieces])

    def byte_code(self, s: str) -> bytes:
        return b"".join([self.byte_ids[b].to_bytes(4, "little") for b in s.encode("utf-8")])

    def viterbi(self, s: str) -> Iterator[list[str]]:
        """Pieces of ``s``, committed in batches as the surviving paths converge."""
        trie, longest, n, bpe, absent = self.trie, self.longest, len(s), self.bpe, ""
        size = min(n, 8 * longest)
        score: list[float | None] = [None] * (size + longest + 1)  # of boundaries base, base + 1, ...
        back = [-1] * (size + longest + 1)
        score[0], base = 0.0, 0
        for i in range(n):
            here = score[i - base]
            if here is not None:
                before = s[back[i - base]:i] if i else ""
                for j in range(i + 1, min(n, i + longest) + 1):
                    gain = trie.get(s[i:j], absent)
                    if gain is absent:
                        if j > i + 1:
                            break
                        gain = self.fallback  # a single character without a piece
                    elif gain is None:
                        if j > i + 1 or s[i] in self.pieces:
                            continue
                        gain = self.fallback
                    old = score[j - base]
                    if bpe:
                        if old is None and (not before or self._fit(before, s[i:j])):
                            score[j - base], back[j - base] = 0.0, i
                    elif old is None or here + gain > old:
                        score[j - base], back[j - base] = here + gain, i
            if i + 1 - base >= size and i + 1 < n:
                # boundaries from which paths go on
                alive = {j for j in range(i + 1, min(n, i + longest) + 1) if back[j - base] >= 0}
                while len(alive) > 1:
                    last = max(alive)
                    alive.remove(last)
                    alive.add(back[last - base])
                meet = alive.pop()
                if meet > base:
                    yield self._walk(s, back, base, meet)
                    del score[:meet - base], back[:meet - base]
                    base = meet
                room = size + longest + 1 + (i + 1 - base)
                score += [None] * (room - len(score))
                back += [-1] * (room - len(back))
        if n > base:
            yield self._walk(s, back, base, n)

    @staticmethod
    def _walk(s: str, back: list[int], base: int, end: int) -> list[str]:
        out = []
        while end > base:
            start = back[end - base]
            out.append(s[start:end])
            end = start
        return out[::-1]

    def _within(self, s: str) -> list[str]:
        """The pass of a BPE model over a text that its window holds whole: the
        last piece of each boundary's path is kept instead of its start."""
        tree, n, fits, alone = self.tree, len(s), self.fits, {}
        last: list[str | None] = [None] * (n + 1)
        last[0] = ""
        for i in range(n):
            before = last[i]
            if before is None:
                continue
            known = fits.get(before) or alone
            j, node = i, tree
            for c in s[i:]:
                node = node.get(c)
                j += 1
                if node is None or (j == i + 1 and "" not in node):
                    # a character without a piece stands alone
                    if j == i + 1 and last[j] is None and (not before or self._fit(before, c)):
                        last[j] = c
                    if node is None:
                        break
                elif last[j] is None and "" in node:
                    piece = node[""]
                    if before:
                        fit = known.get(piece)
                        if not (self._fit(before, piece) if fit is None else fit):
                            continue
                    last[j] = piece
        out = []
        while n:
            out.append(last[n])
            n -= len(last[n])
        return out[::-1]

    def _segment(self, s: str) -> bytes:
        if not self.bpe or len(s) > 8 * self.longest:
            return b"".join([self._coded(part) for part in self.viterbi(s)])
        # a piece that the merges build is the only path into its end
        return self.code[s] if self.trie.get(s) is not None else self._coded(self._within(s))

    def _remembered(self, s: str) -> bytes:
        got = self.cache[s]
        if got is None:
            got = self._segment(s)
            if len(s) <= SEGMENT_CHARS:
                self.cache.keep(s, got)
        return got

    def _stretches(self, stretches: pa.Array) -> list[bytes]:
        """Ids of stretches (strings with marks for spaces), cut where no piece joins two characters."""
        size = pc.binary_length(stretches).to_numpy(zero_copy_only=False)
        raw = b"".join([s.as_buffer() for s in stretches])
        ends = np.concatenate(([0], np.cumsum(size, dtype=np.int64)))
        first = np.flatnonzero((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)      # bytes that begin a character
        chars = self.number[np.frombuffer(raw.decode("utf-8").encode("utf-32-le"), dtype="<u4")]
        cut = np.ones(len(first), dtype=bool)
        cut[1:] = ~self.pairs[chars[:-1], chars[1:]]
        cut[np.searchsorted(first, ends[:-1][size > 0])] = True
        starts = first[cut]
        offsets = pa.py_buffer(np.append(starts, len(raw)).astype(np.int64))
        segments = pa.LargeStringArray.from_buffers(len(starts), offsets, pa.py_buffer(raw)).dictionary_encode()
        known = [self._remembered(s) for s in segments.dictionary.to_pylist()]
        ids = np.frombuffer(b"".join(known), dtype="<i4")
        n = np.array([len(k) // 4 for k in known], dtype=np.int64)
        at = segments.indices.to_numpy(zero_copy_only=False)
        total = np.concatenate(([0], np.cumsum(n[at])))                 # ids before each segment
        shift = (np.cumsum(n) - n)[at] - total[:-1]
        out = ids[np.repeat(shift, n[at]) + np.arange(total[-1])].tobytes()
        bounds = (4 * total[np.searchsorted(starts, ends)]).tolist()
        return [out[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers; literal marks become bytes."""
        text = pa.large_string()
        literal, mark, none = self.byte_code(MARK), pa.scalar(MARK, text), pa.scalar("", text)
        texts = pc.fill_null(texts.cast(text), none)
        marked = pc.match_substring(texts, MARK)
        whole = pc.binary_join_element_wise(mark, pc.replace_substring(texts, " ", MARK), none)
        out = self._stretches(pc.if_else(pc.or_(marked, pc.equal(texts, none)), none, whole))
        for k in np.flatnonzero(marked.to_numpy(zero_copy_only=False)).tolist():
            parts = [p.replace(" ", MARK) for p in texts[k].as_py().split(MARK)]
            out[k] = literal.join(self._stretches(pa.array([MARK + parts[0], *parts[1:]], type=text)))
        return out

    def encode(self, text: str | None) -> bytes:
        return self.encode_all(pa.array([text], type=pa.string()))[0]

    def decode(self, ids) -> str:
        raw = b"".join(map(self.raw.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", errors="replace")


def loaded(path: str) -> PieceModel:
    return held("pieces", path, lambda: PieceModel(path))


_CODED = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())]


def _coder(model: str, fields: list[T.StructField]):
    kind = T.StructType(fields)

    @F.arrow_udf(kind)
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = loaded(model)
        for texts in slices(batches, 250, "pieces"):
            rows = m.encode_all(texts)
            out = [id_lists(rows), pa.array([len(r) // 4 for r in rows], type=pa.int64())]
            if "lossless" in kind.names:
                out.append(pa.array([m.decode(np.frombuffer(r, "<i4").tolist()) == (t or "")
                                     for r, t in zip(rows, texts.to_pylist(), strict=True)], type=pa.bool_()))
            yield pa.StructArray.from_arrays(out, names=kind.names)

    return code


def encode(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array<int>) and ``n_tokens`` (long)."""
    return with_struct(docs, _coder(model, _CODED)(F.col(quoted(text))), ["ids", "n_tokens"])


def decode(ids, model: str):
    """Column: the text of an ids column (NULL ids: NULL)."""
    @F.arrow_udf(T.StringType())
    def text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = loaded(model)
        for lists in slices(batches, 100, "pieces"):
            flat, at, out = lists.flatten().to_numpy(zero_copy_only=False).tolist(), 0, []
            for n in lists.value_lengths().to_pylist():
                out.append(None if n is None else m.decode(flat[at:at + n]))
                at += n or 0
            yield pa.array(out, type=pa.string())

    return text(ids)


def round_trip(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """``encode`` plus ``lossless``: the decoded ids are the text again. One worker of a task
    does both: each worker beside it would hold the model and remembered segments too."""
    fields = [*_CODED, T.StructField("lossless", T.BooleanType())]
    return with_struct(docs, _coder(model, fields)(F.col(quoted(text))), [f.name for f in fields])
