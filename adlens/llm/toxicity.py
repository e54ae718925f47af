"""Toxicity by gradient-boosted trees over dense features (operator 3).

The lexicon is learned from labelled training documents: words whose smoothed
log-odds between toxic and other documents are high, in two grades. A document's
features are lexicon densities and counts, the nearness of lexicon words to
second-person words, capitals, punctuation, and obfuscation (digits or marks inside
words, spaced-out letters, lexicon words that appear only after these are undone).
Boosted trees score them, and isotonic regression on training documents that the trees did
not see turns the score into a probability.

Language, source and id are no features. Whole texts are read.

Scale: the training sample is bounded (``TRAIN_ROWS`` labelled documents in
expectation, chosen by hash); word counts are aggregated in Spark; the scoring
pass reads each document once, row by row, without a shuffle. The broadcast
lexicon has at most ``LEXICON_WORDS`` words.

Defined results: NULL and empty texts are scored from their (zero) features;
with no labels every score is 0 and nothing is predicted toxic;
contradicting repeated labels all count; labels without a document are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.llm.boosting import Isotonic, Trees, fit_isotonic, fit_trees
from adlens.llm.common import quoted, share, slices, with_struct, word_list

TRAIN_ROWS = 20_000
LEXICON_WORDS = 1_000
LEXICON_MIN_DOCS = 5
STRONG, WEAK = 3.0, 1.2    # log-odds of the two grades
NEAR = 6                   # words between a lexicon word and a second-person word

# Second-person words of the languages served.
SECOND_PERSON = frozenset(w.encode() for w in (
    "you your yours yourself u ur tu te toi ton ta tes vous votre vos du dich dir dein deine euch ihr "
    "usted ustedes tú vosotros vuestro").split())
# Look-alikes of letters.
_LOOKALIKE = str.maketrans("013457@$!|", "oleastasil")
_MASKED = re.compile(r"[A-Za-z]+[@$!|*0-9][A-Za-z@$!|*0-9]*|[@$0-9][A-Za-z]+[A-Za-z@$!|*0-9]*")
_SPACED = re.compile(r"\b(?:[A-Za-z][ .\-_*]){3,}[A-Za-z]\b")
_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
_CAPITALS = bytes(range(65, 91))
_DIGITS = b"0123456789"
_PUNCTUATION = bytes(b for b in range(33, 127) if not chr(b).isalnum())

FEATURES = ["strong_density", "weak_density", "strong_count", "distinct_hits", "odds_sum", "max_odds",
            "near_you", "you_density", "capital_rate", "shout_rate", "punctuation_rate", "bang_rate",
            "symbol_rate", "digit_rate", "masked_rate", "masked_hits", "spaced_rate", "spaced_hits",
            "log_words", "word_length"]


def features(text: str | None, lexicon: dict[bytes, float]) -> list[float]:
    if not text:
        return [0.0] * len(FEATURES)
    raw = text.encode("utf-8", "surrogatepass")
    words = word_list(text)
    n, size = max(len(words), 1), len(raw)
    hits = [(i, o) for i, o in enumerate(map(lexicon.get, words)) if o is not None] \
        if not lexicon.keys().isdisjoint(words) else []
    odds = [o for _, o in hits]
    strong = sum(o >= STRONG for o in odds)
    near = you = 0
    if not SECOND_PERSON.isdisjoint(words):
        at = np.array([i for i, w in enumerate(words) if w in SECOND_PERSON])
        you = len(at)
        near = sum(int(np.abs(at - i).min()) <= NEAR for i, _ in hits)
    letters = size - len(raw.translate(None, _LETTERS))
    capitals = size - len(raw.translate(None, _CAPITALS))
    punctuation = size - len(raw.translate(None, _PUNCTUATION))
    digits = size - len(raw.translate(None, _DIGITS))
    bangs = raw.count(b"!") + raw.count(b"?")
    symbols = sum(raw.count(c) for c in (b"*", b"&", b"%", b"$", b"#", b"@"))
    shouted = sum(w.isupper() and len(w) > 1 for w in text.split()) if capitals > 0.1 * letters else 0
    masked = _MASKED.findall(text) if symbols or digits or bangs or b"|" in raw else []
    undone = sum(m.translate(_LOOKALIKE).replace("*", "").lower().encode() in lexicon
                 and m.lower().encode() not in lexicon for m in masked)
    spaced = _SPACED.findall(text) if not text.isalnum() else []
    joined = sum(re.sub(r"[ .\-_*]", "", s).lower().encode() in lexicon for s in spaced)
    return [strong / n, (len(odds) - strong) / n, float(strong), float(len({words[i] for i, _ in hits})), sum(odds),
            max(odds, default=0.0), float(near), you / n, capitals / max(letters, 1), shouted / n,
            punctuation / size, bangs / size, symbols / size, digits / size, len(masked) / n, float(undone),
            len(spaced) / n, float(joined), float(np.log1p(len(words))), size / n]


def matrix(texts: list[str | None], lexicon: dict[bytes, float]) -> np.ndarray:
    return np.array([features(t, lexicon) for t in texts], dtype=np.float64).reshape(len(texts), len(FEATURES))


class ToxicityModel:
    def __init__(self, lexicon: dict[bytes, float], trees: Trees | None, scale: Isotonic | None) -> None:
        self.lexicon, self.trees, self.scale = lexicon, trees, scale

    def score(self, texts: list[str | None]) -> np.ndarray:
        if self.trees is None:
            return np.zeros(len(texts))
        return np.clip(self.scale(self.trees.raw(matrix(texts, self.lexicon))), 0.0, 1.0)


def _word_counts(train: DataFrame, only: frozenset[bytes] | None = None) -> DataFrame:
    """(word, documents with it), of all words or of some; summed in each task first."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Counter()
        for part in batches:
            for text in part["t"]:
                words = set(word_list(text))
                seen.update(words if only is None else words & only)
        yield pd.DataFrame({"w": list(seen), "n": list(seen.values())})

    return train.select("t").mapInPandas(count, "w binary, n long").groupBy("w").agg(F.sum("n").alias("n"))


def learn_lexicon(train: DataFrame, rows: int, toxic: int) -> dict[bytes, float]:
    """Words of enough toxic documents (a few thousand at most, as the sample is
    bounded), then their counts in all; the best by log-odds and support."""
    hits = {bytes(r["w"]): r["n"] for r in
            _word_counts(train.filter("y = 1")).filter(F.col("n") >= LEXICON_MIN_DOCS).collect()}
    everywhere = {bytes(r["w"]): r["n"] for r in _word_counts(train, frozenset(hits)).collect()}
    odds = {w: float(np.log((k + 0.5) / (toxic + 1.0)) - np.log((everywhere[w] - k + 0.5) / (rows - toxic + 1.0)))
            for w, k in hits.items()}
    best = sorted((w for w in odds if odds[w] >= WEAK), key=lambda w: (-odds[w] * hits[w] ** 0.5, w))
    return {w: odds[w] for w in best[:LEXICON_WORDS]}


def train_model(docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id",
                label: str = "toxic", label_id: str = "doc_id", rows: int = TRAIN_ROWS) -> ToxicityModel:
    """Fit on the labelled documents; ``docs`` must hold the training rows only."""
    marked = labels.select(F.col(quoted(label_id)).alias("i"), F.col(quoted(label)).cast("int").alias("y")) \
        .filter("i IS NOT NULL AND y IS NOT NULL")
    known = marked.count()
    # the sample of labels is bounded, so it may be broadcast
    picked = F.broadcast(marked.filter(share(min(1.0, rows / max(known, 1)), "i")))
    train = docs.select(F.col(quoted(doc_id)).alias("i"), F.col(quoted(text)).alias("t")).join(picked, "i")
    sizes = train.agg(F.count("*").alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("k")).first()
    if not sizes["n"]:
        return ToxicityModel({}, None, None)
    lexicon = learn_lexicon(train, sizes["n"], sizes["k"])
    names = [f"f{k}" for k in range(len(FEATURES))]

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            out = pd.DataFrame(matrix(part["t"].tolist(), lexicon), columns=names)
            out["y"], out["g"] = part["y"].to_numpy(), part["g"].to_numpy()
            yield out

    schema = ", ".join(f"{n} double" for n in names) + ", y int, g long"
    # numbers only: at most ``rows`` labelled rows (in expectation) reach the driver
    got = train.select("t", "y", F.xxhash64("i").alias("g")).mapInPandas(measure, schema) \
        .orderBy("g", *names).toPandas()
    x, y = got[names].to_numpy(), got["y"].to_numpy(dtype=float)
    fitted = (got["g"].to_numpy() >> 7) % 4 != 0  # the rest calibrates
    if not fitted.any() or fitted.all():
        fitted[:] = True
    trees = fit_trees(x[fitted], y[fitted])
    rest = ~fitted if not fitted.all() else fitted
    return ToxicityModel(lexicon, trees, fit_isotonic(trees.raw(x[rest]), y[rest]))


_RESULT = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 from 0.5)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(_RESULT)
    def rate(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        m = shared.value
        for texts in slices(batches):
            s = m.score(texts.to_pylist())
            yield pa.StructArray.from_arrays([pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=_RESULT.names)

    return with_struct(docs, rate(F.col(quoted(text))), ["score", "predicted"])
