"""Quality classifier by co-training (operator 8).

Two views of a document: its text content (shape of words, marks, repetition)
and its page metadata (source, language, length). Each view has boosted trees.
Over ``ROUNDS`` rounds, each view scores the whole unlabelled fold and hands
documents that it is confident about (calibrated probability beyond ``CONFIDENT``)
to the other view's training set: of either class and round at most ``EXCHANGE``, dealt evenly over
``STRATA`` groups of (source, language) and drawn by hash within each, so that rare kinds are
asked as well as common ones. The views' calibrated scores are combined by a logistic
regression on labelled documents that neither view was trained on, and every document is scored.

Scale: the features of the unlabelled fold are written once (about 100 bytes a document); a round
reads them, keeps at most ``EXCHANGE`` rows a view, class and task, and ends in a top-k by hash. The driver
trains on at most ``TRAIN_ROWS`` labelled rows in expectation and 2 * ``EXCHANGE`` exchanged ones a view and round. The
scoring pass reads each document once, row by row, no shuffle.

Defined results: NULL and empty texts have zero features and NULL metadata its
own value; all are scored; with no labels every score is 0.5 and nothing is
rejected; repeated rows are scored each on its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.llm.boosting import Isotonic, Trees, fit_isotonic, fit_trees, sigmoid
from adlens.llm.common import dropped, fold, quoted, share, slices, stored, with_struct

TRAIN_ROWS = 12_000
ROUNDS = 3
EXCHANGE = 400
STRATA = 16
CONFIDENT = 0.97
BUCKETS = 32             # hash features for each metadata value

TEXT_FEATURES = ["log_words", "word_length", "long_words", "distinct_words", "letter_rate", "capital_rate", "space_rate",
                 "digit_rate", "mark_rate", "symbol_rate", "bar_rate", "bang_rate", "sentence_rate",
                 "compression", "distinct_lines", "line_words", "marked_words", "top_word"]
_ASCII_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123))
_CAPITALS = bytes(range(65, 91))
_DIGITS = b"0123456789"
_MARKS = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_HIGH = bytes(range(128, 256))


def text_features(text: str | None) -> list[float]:
    if not text:
        return [0.0] * len(TEXT_FEATURES)
    raw = text.encode("utf-8", "surrogatepass")
    words, lines = raw.split(), text.split("\n")
    n, size = max(len(words), 1), len(raw)

    def rate(chars: bytes) -> float:
        return (size - len(raw.translate(None, chars))) / size

    distinct = set(words)
    marked = sum(raw.count(c) for c in (b"* ", b"& ", b"% ", b"$ ", b"# ", b"! ", b"| "))
    top = max(map(words.count, list(distinct)[:3])) if len(distinct) < 4 and words else 0
    return [float(np.log1p(len(words))), size / n, sum(len(w) > 20 for w in distinct) / n, len(distinct) / n,
            rate(_ASCII_LETTERS + _HIGH), rate(_CAPITALS), raw.count(b" ") / size, rate(_DIGITS), rate(_MARKS),
            sum(raw.count(c) for c in (b"*", b"&", b"%", b"$", b"#")) / size, raw.count(b"|") / size,
            raw.count(b"!") / size, raw.count(b".") / n, len(zlib.compress(raw, 1)) / size,
            len(set(lines)) / len(lines), n / len(lines), marked / n, top / n]


def meta_features(source: str | None, lang: str | None, n_chars: float | None) -> list[float]:
    out = [0.0] * (2 * BUCKETS + 2)
    for k, v in enumerate((source, lang)):
        out[k * BUCKETS + (zlib.crc32(v.encode()) % BUCKETS if v is not None else 0)] = 1.0
    out[-2] = float(np.log1p(max(float(n_chars), 0.0))) if n_chars is not None and n_chars == n_chars else -1.0
    out[-1] = float(v is None)
    return out


@dataclass
class View:
    trees: Trees
    scale: Isotonic

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.scale(self.trees.raw(x))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


def _logistic(x: np.ndarray, y: np.ndarray, steps: int = 25, l2: float = 1.0) -> np.ndarray:
    """Weights and bias by Newton steps, drawn towards equal trust in all views."""
    x = np.column_stack([x, np.ones(len(x))])
    home = np.array([1.0] * (x.shape[1] - 1) + [0.0])
    w = home.copy()
    for _ in range(steps):
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + l2 * np.eye(len(w))
        w = w + np.linalg.solve(h, x.T @ (y - p) - l2 * (w - home))
    return w


@dataclass
class QualityModel:
    views: list[View]
    weights: np.ndarray | None
    exchanged: int = 0

    def score(self, xs: list[np.ndarray]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(xs[0]), 0.5)
        z = np.column_stack([_logit(v.probability(x)) for v, x in zip(self.views, xs, strict=True)] + [np.ones(len(xs[0]))])
        return sigmoid(z @ self.weights)


Drawn = tuple[np.ndarray, np.ndarray]  # rows for a view and their pseudo-labels


def co_train(xs: list[np.ndarray], y: np.ndarray, draw: Callable[[list[View]], list[Drawn]] | None, rounds: int = ROUNDS) -> QualityModel:
    """``xs``: labelled rows in each view. ``draw``: called with the views of a round, gives each view the rows
    that the other one is confident about, new ones every time. Rows 0, 4, 8, ... calibrate and combine, the others train."""
    if len(y) == 0:
        return QualityModel([], None)
    held = np.arange(len(y)) % 4 == 0
    if held.all() or not (~held).any():
        held[:] = False
    rest = ~held
    check = held if held.any() else rest
    gained: list[list[Drawn]] = [[(x[rest], y[rest])] for x in xs]
    total = 0
    for turn in range(rounds + 1):
        views = []
        for x, parts in zip(xs, gained, strict=True):
            trees = fit_trees(np.vstack([p for p, _ in parts]), np.concatenate([m for _, m in parts]), rounds=40, depth=4)
            views.append(View(trees, fit_isotonic(trees.raw(x[check]), y[check])))
        if turn == rounds or draw is None:
            break
        for parts, (rows, marks) in zip(gained, draw(views), strict=True):
            if len(marks):
                parts.append((rows, marks))
                total += len(marks)
    z = np.column_stack([_logit(v.probability(x[check])) for v, x in zip(views, xs, strict=True)])
    return QualityModel(views, _logistic(z, y[check]), total)


def confident_rows(views: list[View], x: list[np.ndarray], h: np.ndarray, taken: list[np.ndarray], confident: float) -> Iterator[tuple]:
    """(view that gets them, pseudo-label, row numbers) of rows that the other view is confident about."""
    for k, view in enumerate(views):
        prob = view.probability(x[k])
        free = ~np.isin(h, taken[1 - k])
        for mark, sure in ((1, prob), (0, 1 - prob)):
            yield 1 - k, mark, np.flatnonzero((sure >= confident) & free)


class _Pool:
    """The written features of the unlabelled fold, and what was drawn from them."""

    def __init__(self, rows: DataFrame, split: int, exchange: int, confident: float) -> None:
        self.rows, self.split, self.exchange, self.confident = rows, split, exchange, confident
        self.taken = [np.empty(0, np.int64), np.empty(0, np.int64)]

    def draw(self, views: list[View]) -> list[Drawn]:
        split, confident, taken, quota = self.split, self.confident, self.taken, max(1, self.exchange // STRATA)

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """Of each view, class and stratum, the task's ``quota`` rows of the smallest hash."""
            best: dict[tuple, list[tuple]] = {}
            for batch in slices(batches, 2000):
                raw = batch.column("x").to_pylist()
                x = np.frombuffer(b"".join(raw), dtype="<f4").reshape(len(raw), -1).astype(float)
                h, stratum = batch.column("h").to_numpy(), batch.column("stratum").to_numpy()
                for view, mark, rows in confident_rows(views, [x[:, :split], x[:, split:]], h, taken, confident):
                    for s in np.unique(stratum[rows]).tolist():
                        own = rows[stratum[rows] == s]
                        own = own[np.argsort(h[own], kind="stable")[:quota]]
                        key = (view, mark, s)
                        best[key] = sorted(best.get(key, []) + [(int(h[j]), raw[j]) for j in own])[:quota]
            out = [(*key, *row) for key, rows in best.items() for row in rows]
            if out:
                cols = [pa.array(list(c), kind) for c, kind in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True)]
                yield pa.RecordBatch.from_arrays(cols, names=["view", "mark", "stratum", "h", "x"])

        place = F.row_number().over(Window.partitionBy("view", "mark", "stratum").orderBy("h", "x"))
        got = (self.rows.mapInArrow(pick, "view int, mark int, stratum int, h long, x binary")
               .withColumn("place", place).filter(F.col("place") <= quota).collect())   # 4 * exchange rows at most
        out = []
        for view in range(2):
            rows = sorted((r["h"], bytes(r["x"]), float(r["mark"])) for r in got if r["view"] == view)
            x = np.array([np.frombuffer(b, "<f4") for _, b, _ in rows] or np.zeros((0, split)), dtype=float)
            out.append((x[:, :split] if view == 0 else x[:, split:], np.array([m for *_, m in rows])))
            self.taken[view] = np.concatenate([self.taken[view], np.array([h for h, *_ in rows], np.int64)])
        return out


def _features(texts: pa.Array, sources: pa.Array, langs: pa.Array, sizes: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    xt = np.array([text_features(t) for t in texts.to_pylist()]).reshape(len(texts), len(TEXT_FEATURES))
    xm = np.array([meta_features(*v) for v in zip(sources.to_pylist(), langs.to_pylist(), sizes.to_pylist(),
                                                  strict=True)]).reshape(len(texts), 2 * BUCKETS + 2)
    return xt, xm


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, stratum, y, x) of documents: x holds the features of both views in 32 bits."""
    for part in slices(batches):
        x = np.hstack(_features(*(part.column(c) for c in "tslc"))).astype("<f4")
        yield pa.RecordBatch.from_arrays([part.column("h"), part.column("stratum"), part.column("y"),
                                          pa.array([r.tobytes() for r in x], pa.binary())], names=["h", "stratum", "y", "x"])


def train_model(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
                lang: str = "lang", n_chars: str = "n_chars", label: str = "quality", label_id: str = "doc_id",
                rows: int = TRAIN_ROWS, exchange: int = EXCHANGE, confident: float = CONFIDENT) -> QualityModel:
    """Fit on documents of the folds 1 to 4 (fold 0 is held out)."""
    marked = labels.select(F.col(quoted(label_id)).alias("i"), F.col(quoted(label)).cast("int").alias("y")) \
        .filter("i IS NOT NULL AND y IS NOT NULL")
    known = marked.count()
    if not known:
        return QualityModel([], None)
    picked = F.broadcast(marked.filter(share(min(1.0, rows / known), "i")))          # bounded by ``rows``
    base = docs.filter(fold(doc_id) != 0).select(
        F.col(quoted(doc_id)).alias("i"), F.col(quoted(text)).alias("t"), F.col(quoted(source)).cast("string").alias("s"),
        F.col(quoted(lang)).cast("string").alias("l"), F.col(quoted(n_chars)).cast("double").alias("c"))
    facts = [F.xxhash64("i").alias("h"), F.pmod(F.xxhash64("s", "l"), F.lit(STRATA)).cast("int").alias("stratum"), "y", "t", "s", "l", "c"]
    schema = "h long, stratum int, y int, x binary"
    got = base.join(picked, "i").select(*facts).mapInArrow(_measure, schema).orderBy("h", "x", "y").collect()
    if not got:
        return QualityModel([], None)
    x = np.array([np.frombuffer(r["x"], "<f4") for r in got], dtype=float)
    y, split = np.array([r["y"] for r in got], dtype=float), len(TEXT_FEATURES)
    # rows of the fold that have a label are among the unlabelled ones too: their label is not used there
    fold_rows = stored(base.withColumn("y", F.lit(-1)).select(*facts).mapInArrow(_measure, schema), "features")
    pool = _Pool(fold_rows, split, exchange, confident)
    model = co_train([x[:, :split], x[:, split:]], y, pool.draw)
    dropped(fold_rows)
    return model


_RESULT = T.StructType([T.StructField("quality_score", T.DoubleType()), T.StructField("quality_pred", T.IntegerType())])


def score(docs: DataFrame, model: QualityModel, text: str = "text", source: str = "source", lang: str = "lang",
          n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with ``quality_score`` (0 to 1) and ``quality_pred`` (1 from 0.5)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(_RESULT)
    def rate(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        m = shared.value
        for part in slices(batches):
            xt, xm = _features(*part)
            s = m.score([xt, xm])
            yield pa.StructArray.from_arrays([pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=_RESULT.names)

    args = [F.col(quoted(text)), F.col(quoted(source)).cast("string"), F.col(quoted(lang)).cast("string"),
            F.col(quoted(n_chars)).cast("double")]
    return with_struct(docs, rate(*args), ["quality_score", "quality_pred"])


def keep_good(docs: DataFrame, model: QualityModel, **columns: str) -> DataFrame:
    """The documents that the classifier accepts, columns as in ``docs``."""
    kept = score(docs, model, **columns).filter("quality_pred = 1")
    gone = {"quality_score", "quality_pred"}
    return kept.select(*[F.col(quoted(c)) for c in docs.columns if c.lower() not in gone])
