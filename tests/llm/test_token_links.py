"""Cross-tokenizer links against the libraries' ids of whole texts."""

from __future__ import annotations

import collections
import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from adlens.llm import token_links

BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


def plain(rows):
    tok, sp = Tokenizer.from_file(BPE), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    tok.encode_special_tokens = True
    a_bytes, b_bytes = token_links._vocabulary_a(tok), token_links._vocabulary_b(sp)
    docs, count = [], collections.Counter()
    for i, text in rows:
        a = tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = sp.encode(text) if text else []
        raw = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes[x] for x in a) != raw or b"".join(b_bytes[x] for x in b) != raw:
            docs.append((i, [], [], [], ""))
            continue
        spans = []
        for ids, sizes in ((a, a_bytes), (b, b_bytes)):
            at, own = 0, []
            for x in ids:
                own.append((at, at + len(sizes[x])))
                at += len(sizes[x])
            spans.append(own)
        cuts = {e for _, e in spans[0]} & {e for _, e in spans[1]}
        sides: list[list[str]] = []
        for ids, own in ((a, spans[0]), (b, spans[1])):
            parts, now = [], []
            for x, (_, e) in zip(ids, own, strict=True):
                now.append(str(x))
                if e in cuts:
                    parts.append(",".join(now))
                    now = []
            sides.append(parts)
        groups = [f"{x}|{y}" for x, y in zip(*sides, strict=True)]
        links, k = [], 0
        for x, (s, e) in zip(a, spans[0], strict=True):
            while k and spans[1][k - 1][1] > s:
                k -= 1
            while k < len(b) and spans[1][k][0] < e:
                if spans[1][k][1] > s:
                    links.append((b[k], x))
                k += 1
        count.update(links)
        docs.append((i, a, b, links, hashlib.sha256(";".join(groups).encode()).hexdigest()) + (len(groups),))
    best = collections.Counter()
    for (b, _), n in count.items():
        best[b] = max(best[b], n)
    return [(d[0], len(d[1]), len(d[2]), d[5] if len(d) > 5 else 0, len(d[3]), sum(count[x] == best[x[0]] for x in d[3]),
             sum(count[x] for x in d[3]), d[4]) for d in docs], count, best


def odd_texts():
    rng = random.Random(8)
    parts = ["a", " ", "  ", "\n", "\t", "é", "日本", "😀", ".", "'s", "word", " the", "12", "<|endoftext|>", "</s>", " ", "\x1c", "\r\n", "x" * 9]
    rows = [(k, "".join(rng.choices(parts, k=rng.randint(1, 30)))) for k in range(300)]
    return rows + [(1000, None), (1001, ""), (1002, " "), (1003, "   "), (1004, "a ▁ b"), (1005, "\x00"), (None, "some text"), (3, rows[3][1]),
                   (1006, "ab" * 10_000), (1007, "the word " * 5_000)]


@pytest.mark.parametrize("run_links, fan_in", [(token_links.RUN_LINKS, token_links.FAN_IN), (3_000, 2)])
def test_links_equal_plain_alignment(spark, run_links, fan_in):
    rows = odd_texts() + [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(60).collect()]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, run int, BLOCK string").repartition(5)
    docs, counts = token_links.align_corpus(df, BPE, PIECES, run_links=run_links, fan_in=fan_in)
    want, count, best = plain(rows)
    assert sorted(map(tuple, docs.collect()), key=str) == sorted(want, key=str)
    pairs = {(r["b_id"], r["a_id"]): (r["links"], r["best"]) for r in token_links.pair_table(counts, BPE, PIECES).collect()}
    assert pairs == {x: (n, n == best[x[0]]) for x, n in count.items()}


def test_empty_table_and_texts_without_tokens(spark):
    schema = "doc_id long, text string"
    assert token_links.align_corpus(spark.createDataFrame([], schema), BPE, PIECES)[0].collect() == []
    got = token_links.align_corpus(spark.createDataFrame([(1, None), (2, "▁")], schema), BPE, PIECES)[0].collect()
    assert sorted(map(tuple, got)) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
