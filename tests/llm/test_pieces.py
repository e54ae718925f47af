"""What a worker remembers of the pieces that it worked out."""

from __future__ import annotations

import pyarrow as pa

from adlens.llm import pieces
from adlens.llm.pieces import MARK, PieceModel


def test_words_of_a_large_vocabulary_are_worked_out_once(monkeypatch):
    digits = "0123456789"
    pairs = [MARK + "w", *("w" + a for a in digits), *(a + b for a in digits for b in digits)]     # no place to cut a word at
    vocab = {c: (k, -1.0) for k, c in enumerate([MARK, "w", *digits, *pairs])}
    model = PieceModel(pieces=vocab, byte_ids=list(range(200, 456)))
    text = " ".join(f"w{k}" for k in range(150_000))
    first = model.encode(text)
    monkeypatch.setattr(model, "_segment", lambda s: (_ for _ in ()).throw(AssertionError(s)))
    assert model.encode(text) == first


def test_what_a_later_part_repeats_is_worked_out_once(monkeypatch):
    for bound in ("CACHE_WORDS", "CACHE_SEGMENTS"):
        monkeypatch.setattr(pieces, bound, 50, raising=False)
    digits = "0123456789"
    pairs = [MARK + "w", *("w" + a for a in digits), *(a + b for a in digits for b in digits)]
    model = PieceModel(pieces={c: (k, -1.0) for k, c in enumerate([MARK, "w", *digits, *pairs])}, byte_ids=list(range(200, 456)))
    model.encode(" ".join(f"w{k}" for k in range(200)))                # fills what a worker may remember
    first = model.encode("w901 w902 w903")
    monkeypatch.setattr(model, "_segment", lambda s: (_ for _ in ()).throw(AssertionError(s)))
    assert model.encode("w903 w901 w902 w901")[:4] == first[:4]


def test_many_texts_are_cut_and_coded_as_each_alone():
    import numpy as np
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model, sp = PieceModel(path), sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["", None, "the end", " a  b ", "\u20ac\U00010348 \u65e5\u672c", "\u2581 a\u2581b", "x" * 3000, "", "the end", "\u2581", "\n", None]
    for kind in (pa.string(), pa.large_string()):
        rows = model.encode_all(pa.array(["cut off", *texts], type=kind).slice(1))
        assert rows == [model.encode(t) for t in texts]
        for t, row in zip(texts, rows, strict=True):
            ids = np.frombuffer(row, "<i4").tolist()
            assert model.decode(ids) == (t or "")
            assert MARK in (t or "") or ids == sp.encode(t or "")
    assert model.encode_all(pa.array([], type=pa.string())) == []
