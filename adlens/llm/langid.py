"""Language identification by cross-parsing entropy (operator 10).

Labelled text of each language becomes a suffix automaton. A document is
parsed against every language from left to right: take the longest match that
occurs in the language's text, count one phrase, go on behind it. Text in the
language needs few, long phrases. The count is normalised as
``phrases * log2(training length) / characters``, the cross-parsing estimate of
bits per character. Languages are compared under one training length, the
longest: the fewest phrases win (ties: the smaller name), so a language with
less training text can only cost more.

Only letters count: a run of other characters is one space, upper case is
lower case, and a letter that no training text has is a phrase of its own in
every language. A text is parsed in segments of ``SEGMENT`` characters (a
phrase ends at a segment's end), all of them, for all languages.

All segments of a batch advance side by side: one gather per character and
language in the automaton's jump table. Every letter of the training texts is a
symbol; the ``ALPHABET`` most frequent have columns in the table, the others
are found by binary search among the automaton's edges.

Scale: training text is a bounded sample (``TRAIN_CHARS`` characters of each
language, from at most ``TRAIN_DOCS`` documents in expectation, of each
``TRAIN_SLICE`` characters from a place that a hash of its id chooses); the scoring pass reads every document once, row by row, without a shuffle.
Automata are rebuilt in each worker from the broadcast sample.

Defined results: a NULL text and a text without a letter are ``und`` with score
0; with no labelled rows every text is ``und``; rows with a NULL label or NULL id are not
learned from.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.llm.automaton import SuffixAutomaton
from adlens.llm.common import fold, held, quoted, share, slices, with_struct

UNKNOWN = "und"
TRAIN_DOCS = 60
TRAIN_SLICE = 2_000
TRAIN_CHARS = 30_000
ALPHABET = 120           # letters with a column in the jump tables; the rarer ones are looked up
SEGMENT = 512
FAR = 3.0                # unrecognisable: this many times the bits per character of labelled text,
SINGLE = 0.9             # or this share of the characters phrases of their own
SPARE = 4                # phrases that a text of any length may have
BATCH_CHARS = 4 << 20

_RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
_CODES = 0x110000
_NONE = np.empty(0, np.int64)


class LanguageModel:
    """Jump tables of all languages over one alphabet.

    Symbols: 0 a letter that training lacks, 1 other characters, 2... letters.
    """

    def __init__(self, texts: dict[str, list[str]], alphabet: int = ALPHABET, chars: int = TRAIN_CHARS) -> None:
        self.langs = sorted(texts)
        counts: dict[str, int] = {}
        for lang in self.langs:
            for t in texts[lang]:
                for ch in t.lower():
                    if ch.isalpha():
                        counts[ch] = counts.get(ch, 0) + 1
        letters = sorted(counts, key=lambda c: (-counts[c], c))
        self.symbols, self.columns = len(letters) + 2, min(len(letters), alphabet) + 2
        self.lut = np.ones(_CODES, dtype=np.min_scalar_type(self.symbols))
        self.lut[[i for i in range(_CODES) if chr(i).isalpha()]] = 0
        for k, ch in enumerate(letters):
            for form in {ch, ch.upper()}:
                if len(form) == 1:
                    self.lut[ord(form)] = k + 2
        self.tables, self.bits = [], []
        for lang in self.langs:
            auto, used = SuffixAutomaton(), 0
            for t in texts[lang]:
                # an unseen letter's symbol never enters an automaton: texts are cut there
                for run in np.split(codes := self.encode(t), np.flatnonzero(codes == 0)):
                    run = run[run != 0][:chars - used].tolist()
                    auto.add(run)
                    used += len(run)
                if used >= chars:
                    break
            self.tables.append(auto.jump_table(self.symbols, self.columns))
            self.bits.append(np.log2(max(used, 2)))

    def encode(self, text: str) -> np.ndarray:
        """Symbols of a text, each run of non-letters as one."""
        codes = self.lut[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
        keep = codes != 1
        keep[1:] |= codes[:-1] != 1
        keep[:1] = True
        return codes[keep]

    def phrases(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Phrases [text, language], and each text's numbers of symbols and letters."""
        codes = [self.encode(t) for t in texts]
        n = np.array([len(c) for c in codes], dtype=np.int64)
        letters = np.array([int((c != 1).sum()) for c in codes], dtype=np.int64)
        flat = np.concatenate([*codes, np.empty(0, self.lut.dtype)])
        first = np.concatenate(([0], np.cumsum(n)))
        parts = -(-n // SEGMENT)
        doc = np.repeat(np.arange(len(texts)), parts)
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(parts) - parts, parts)
        start = first[doc] + nth * SEGMENT
        length = np.minimum(SEGMENT, first[doc + 1] - start)
        order = np.argsort(-length, kind="stable")
        start, length, doc = start[order], length[order], doc[order]
        live = np.searchsorted(-length, -np.arange(SEGMENT), side="left")  # segments longer than t
        out = np.zeros((len(texts), len(self.langs)))
        state = np.zeros((len(self.langs), len(start)), dtype=np.int32)
        phrases = np.zeros((len(self.langs), len(start)), dtype=np.int32)
        for t in range(SEGMENT):
            k = int(live[t])
            if not k:
                break
            symbol = flat[start[:k] + t]
            at = np.flatnonzero(symbol >= self.columns) if self.symbols > self.columns else _NONE
            rare = symbol[at].astype(np.int64) - self.columns
            if len(at):
                symbol[at] = 0
            symbol = symbol.astype(np.int32)
            for a, table in enumerate(self.tables):
                to = table.step(state[a, :k], symbol, at, rare)
                phrases[a, :k] += to & 1
                state[a, :k] = to >> 1
        for a in range(len(self.langs)):
            # a segment's last phrase is open: the count of ended phrases plus one
            out[:, a] = np.bincount(doc, weights=phrases[a] + 1, minlength=len(texts))
        return out, n, letters

    def rates(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per character [text, language], each under its own training
        length, and the number of letters."""
        count, n, letters = self.phrases(texts)
        return count * np.array(self.bits) / np.maximum(n, 1)[:, None], letters

    def _counted(self, texts: list[str | None]) -> Iterator[tuple]:
        """Places of texts that are not empty, with what ``phrases`` has of them, by batches."""
        at, size = [], 0
        for i, t in enumerate(texts):
            if t:
                at.append(i)
                size += len(t)
            if at and (size >= BATCH_CHARS or i == len(texts) - 1):
                yield at, *self.phrases([texts[j] for j in at])
                at, size = [], 0

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        for at, count, _, letters in self._counted(texts) if self.langs else ():
            best = count.argmin(axis=1)
            second = np.partition(count, 1, axis=1)[:, 1] if len(self.langs) > 1 else np.full(len(at), np.inf)
            for k, j in enumerate(at):
                if letters[k]:
                    langs[j] = self.langs[best[k]]
                    scores[j] = 1 - count[k, best[k]] / second[k]
        return langs, scores

    def recognised(self, texts: list[str | None], limits: dict[str, float]) -> np.ndarray:
        """True for texts with a letter whose best language (or one of several)
        needs at most its limit of bits per character, besides ``SPARE`` phrases."""
        out = np.zeros(len(texts), dtype=bool)
        limit = np.array([limits[name] for name in self.langs])
        for at, count, n, letters in self._counted(texts) if self.langs else ():
            near = (count - SPARE) * max(self.bits) <= limit * n[:, None]
            out[at] = (letters > 0) & (near & (count == count.min(axis=1)[:, None])).any(axis=1)
        return out


def training_texts(labelled: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id",
                   docs: int = TRAIN_DOCS, chars: int = TRAIN_SLICE) -> dict[str, list[str]]:
    """A bounded hash sample of each language's texts."""
    rows = labelled.select(F.col(quoted(doc_id)).alias("i"), F.col(quoted(lang)).alias("l"),
                           F.col(quoted(text)).alias("t")).filter("i IS NOT NULL AND l IS NOT NULL AND length(t) > 0")
    sizes = {r["l"]: r["n"] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}  # a row per language
    if not sizes:
        return {}
    pick = F.lit(False)
    for name, n in sizes.items():
        pick = pick | ((F.col("l") == name) & share(min(1.0, docs / n), "i"))
    out: dict[str, list[tuple]] = {}
    spare = F.greatest(F.length("t") - F.lit(chars), F.lit(0)).cast("long")
    start = F.pmod(F.xxhash64(F.lit(3), F.col("i")), spare + 1).cast("int") + 1
    for r in rows.filter(pick).select("l", F.xxhash64("i").alias("h"), F.col("t").substr(start, F.lit(chars)).alias("t")).collect():
        out.setdefault(r["l"], []).append((r["h"], r["t"]))
    return {name: [t for _, t in sorted(ts)] for name, ts in out.items()}


def limits(texts: dict[str, list[str]]) -> dict[str, float]:
    """The most bits per character of recognisable text, by language: ``FAR``
    times those of one half of its labelled texts parsed against the other.
    What a language's little training cannot know raises its limit."""
    halves = {name: (ts[::2], ts[1::2]) if len(ts) > 1 else ([ts[0][:len(ts[0]) // 2]], [ts[0][len(ts[0]) // 2:]])
              for name, ts in texts.items()}
    model = LanguageModel({name: learnt for name, (learnt, _) in halves.items()})
    out = {}
    for a, name in enumerate(model.langs):
        count, n, _ = model.phrases(halves[name][1])
        out[name] = float(max(model.bits) * min(FAR * count[:, a].sum() / max(n.sum(), 1), SINGLE))
    return out


def _model(key: str, texts: dict[str, list[str]]) -> LanguageModel:
    return held("language " + key, key, lambda: LanguageModel(texts))   # one model at a time per worker


def identify(docs: DataFrame, texts: dict[str, list[str]], text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` (string) and ``score`` (double: how far the
    best language's phrases lie below the second's, 0 to 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(texts)
    key = uuid.uuid4().hex

    @F.arrow_udf(_RESULT)
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = _model(key, shared.value)
        for part in slices(batches, 2_000, "language " + key):
            langs, scores = model.predict(part.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(langs, type=pa.string()), pa.array(scores)], names=_RESULT.names)

    return with_struct(docs, predict(F.col(quoted(text))), ["lang_pred", "score"])


def keep_recognised(docs: DataFrame, texts: dict[str, list[str]], text: str = "text") -> DataFrame:
    """The documents in a recognisable language: a letter, and bits per
    character within the ``limits`` of the best language. Texts that fit several
    languages alike stay."""
    shared, most = docs.sparkSession.sparkContext.broadcast(texts), limits(texts)
    key = uuid.uuid4().hex

    @F.arrow_udf(T.BooleanType())
    def recognised(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = _model(key, shared.value)
        for part in slices(batches, 2_000, "language " + key):
            yield pa.array(model.recognised(part.to_pylist(), most))

    return docs.filter(recognised(F.col(quoted(text))))


def train_fold(docs: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    return docs.filter(fold(doc_id) != 0)
