"""The training-data operators against brute force, and on edge rows."""

from __future__ import annotations

import gzip
import hashlib
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from adlens.llm import decontaminate, html_text, langid, pieces, quality, shingle_join, token_ids, toxicity, vector_join, warc
from adlens.llm.automaton import SuffixAutomaton
from adlens.llm.common import fold

SF = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t) if t else 0) for i, t in rows], DOCS)


EDGE = [(1, None), (2, ""), (3, " \n\t"), (None, "a b c"), (4, "one two three"), (4, "one two three"), (5, "x" * 200_000),
        (6, "word " * 20_000), (7, "ÄÖ ß日本語 😀 ▁ \x00 end")]


@pytest.fixture(scope="module")
def edge(spark):
    return docs_frame(spark, EDGE).withColumn("Score", F.lit(1)).withColumn("N_WORDS", F.lit("x")).withColumn("ids", F.lit(2))


# --- automaton -------------------------------------------------------------

def test_automaton_finds_longest_matches():
    auto, texts = SuffixAutomaton(), ["abcab", "bcd", "abcd"]
    for t in texts:
        auto.add(t)
    state = matched = 0
    query = "zabcdabca"
    for i, c in enumerate(query):
        state, matched = auto.step(state, matched, c)
        want = max(k for k in range(i + 2) if any(query[i + 1 - k:i + 1] in t for t in texts))
        assert matched == want


# --- 1 ---------------------------------------------------------------------

def words(t):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute_overlap(docs, items, window=13):
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for item, it in items:
            iw = words(it)
            n = min(window, len(iw))
            grams = {tuple(iw[k:k + n]) for k in range(len(iw) - n + 1)} if n else set()
            for k in range(len(w) - n + 1) if n else ():
                if tuple(w[k:k + n]) in grams:
                    hit |= set(range(k, k + n))
                    found.add(str(item))
        out.append((i, len(w), tuple(sorted(hit)), tuple(sorted(found))))
    return sorted(out, key=str)


def test_decontamination_equals_brute_force(spark):
    rng = np.random.default_rng(1)
    vocab = [f"w{k}" for k in range(12)]

    def text(n):
        return " ".join(rng.choice(vocab, n))

    items = [(k, text(int(rng.integers(5, 40)))) for k in range(8)] + [(98, None), (99, ""), (100, "W1, w2"), (101, "w1 w2")]
    docs = []
    for k in range(60):
        t = text(int(rng.integers(0, 60)))
        if k % 3 == 0:
            part = items[k % 8][1].split()
            a = int(rng.integers(0, max(1, len(part) - 13)))
            t += " " + " ".join(part[a:a + 15]).upper() + " " + text(4)
        docs.append((k, t))
    docs += EDGE[:4]
    found = decontaminate.find_overlaps(docs_frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    got = sorted(((r["doc_id"], r["n_words"], tuple(r["hits"]), tuple(sorted(r["items"]))) for r in found.collect()), key=str)
    assert got == brute_overlap(docs, items)


def test_decontamination_in_shards_and_cuts(spark, monkeypatch, edge):
    items = [(k, " ".join(f"i{k}x{j}" for j in range(20))) for k in range(6)]
    frame = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_frame(spark, [(1, "start " * 600 + items[2][1] + " end"), (2, items[0][1] + " " + items[5][1]), (3, "clean")])
    whole = {r["doc_id"]: (r["hits"], sorted(r["items"])) for r in decontaminate.find_overlaps(docs, frame).collect()}
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 300)
    parts = {r["doc_id"]: (sorted(r["hits"]), sorted(r["items"])) for r in decontaminate.find_overlaps(docs, frame).collect()}
    assert parts == whole and whole[2][1] == ["0", "5"]
    kept = {r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, frame).collect()}
    assert set(kept) == {1, 3} and "i2x" not in kept[1] and kept[1].endswith("  end")
    assert decontaminate.find_overlaps(edge, frame.limit(0)).filter(F.size("hits") > 0).count() == 0
    assert decontaminate.decontaminate(edge, frame).count() == len(EDGE)
    assert decontaminate.decontaminate(edge.limit(0), frame).count() == 0


def test_each_shard_is_a_pass_of_its_own(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 2_000)
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 30)
    rng = np.random.default_rng(8)
    vocab = [f"w{k}" for k in range(40)]
    long = " ".join(f"z{k}" for k in range(800))                                    # several shards long by itself
    items = [(k, " ".join(rng.choice(vocab, 60))) for k in range(12)] + [(50, long), (51, "one two"), (None, "lone item"), (52, None)]
    frame = spark.createDataFrame(items, "item_id long, text string")
    sizes = [sum(len(t) for _, t in s) for s in decontaminate.item_shards(frame, "item_id", "text")]
    assert len(sizes) > 3 and max(sizes) <= 2_000 and sum(sizes) >= len(long)
    docs = [(1, items[3][1] + " x " + items[7][1][:100]), (2, " ".join(long.split()[20:60])), (3, None), (3, "a lone item"),
            (4, "three one two"), (5, ""), (None, "clean words"), (6, long), (6, long)]
    live = []
    built = decontaminate._scan_udf
    monkeypatch.setattr(decontaminate, "_scan_udf", lambda shared, window: live.append(shared) or built(shared, window))
    out = decontaminate.find_overlaps(docs_frame(spark, docs), frame)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_words", "hits", "items"] and len(live) == len(sizes)
    got = sorted(((r["doc_id"], r["n_words"], tuple(r["hits"]), tuple(r["items"])) for r in out.collect()), key=str)
    want = [(i, n, h, tuple(x for x in f if x != "None")) for i, n, h, f in brute_overlap(docs, items)]
    assert got == want
    assert "PythonUDF" not in out._jdf.queryExecution().optimizedPlan().toString()  # no automaton is left to the plan


# --- 2 ---------------------------------------------------------------------

def test_vector_links_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((60, 16))
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    rows += [(100 + k, (base[k % 20] + 0.15 * rng.standard_normal(16)).tolist()) for k in range(60)]
    rows += [(200, base[0].tolist()), (201, (2 * base[0]).tolist()), (202, None), (203, [0.0] * 16), (204, [float("nan")] + [1.0] * 15),
             (205, [None] + [1.0] * 15), (206, [1.0, 2.0]), (207, []), (208, [float("inf")] * 16)]
    got = {r["vec_id"]: tuple(r)[1:] for r in vector_join.link_report(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    good = {i: np.array(v) / np.linalg.norm(v) for i, v in rows
            if v and None not in v and np.isfinite(v).all() and any(v)}
    links = {(a, b) for a in good for b in good if a != b and len(good[a]) == len(good[b]) and good[a] @ good[b] >= 0.9}
    comp = {i: i for i, _ in rows}
    for _ in range(len(rows)):
        for a, b in links:
            comp[a] = comp[b] = min(comp[a], comp[b])
    want = {i: (sum(a == i for a, _ in links), comp[i], comp[i] == i) for i, _ in rows}
    assert got == want
    assert vector_join.link_report(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_collision_threshold_reaches_its_recall():
    k, lists = vector_join.calibrate(50_000, 0.9)
    rng = np.random.default_rng(0)
    hits = 0
    for _ in range(300):
        x = rng.standard_normal(32)
        x /= np.linalg.norm(x)
        y = rng.standard_normal(32)
        y -= (x @ y) * x
        y = 0.9 * x + np.sqrt(1 - 0.81) * y / np.linalg.norm(y)
        planes = rng.standard_normal((lists, 32, k + 1))
        a, b = x @ planes, y @ planes
        same = ((a[:, :k] > 0) == (b[:, :k] > 0)).all(axis=1) & (np.abs(a[:, k] - b[:, k]) <= vector_join.WINDOW)
        hits += same.sum() >= vector_join.COLLISIONS
    assert hits >= 0.98 * 300


def test_vector_lists_beyond_128_and_lengths_keep_apart():
    def projected(lists, rows):
        units = pa.RecordBatch.from_arrays(
            [pa.array(range(len(rows))), pa.array([np.array(x, "<f8").tobytes() for x in rows])], names=["dir", "unit"])
        got = pa.Table.from_batches(list(vector_join._project(2, lists)(iter([units]))))
        return got.sort_by([(c, "ascending") for c in got.column_names])

    _, lists = vector_join.calibrate(10_000_000, 0.9)
    assert lists > 128
    got = projected(lists, [[0, 1, 0], [0, 1, 0], [0, 1]])   # a pair, and another length
    places = {r["place"] for r in got.to_pylist() if r["id"] == 0}
    assert len(places) == lists and max(places) >> 40 == lists - 1
    counts = pa.Table.from_batches(list(vector_join._window(iter(got.combine_chunks().to_batches())))).to_pylist()
    assert counts == [{"a": 0, "b": 1, "n": lists}]
    # lengths 65,536 apart are different lengths
    assert set(projected(2, [[1] * 3, [1] * 65_539])["size"].to_pylist()) == {3, 65_539}


# --- 3 and 8 ---------------------------------------------------------------

def test_toxicity_and_quality_on_held_out_rows(spark, edge):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train_model(docs.filter(fold("doc_id") != 0), labels.filter(fold("doc_id") != 0))
    judged = toxicity.score(docs, model).join(labels, "doc_id").filter(fold("doc_id") == 0)
    right, n = judged.agg(F.sum((F.col("predicted") == F.col("toxic")).cast("int")), F.count("*")).first()
    assert right / n > 0.97
    out = toxicity.score(edge, model).collect()
    assert len(out) == len(EDGE) and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.score(edge, toxicity.train_model(docs, labels.limit(0))).filter("predicted = 1").count() == 0

    model = quality.train_model(docs, labels)
    judged = quality.score(docs, model).join(labels, "doc_id").filter(fold("doc_id") == 0)
    right, n = judged.agg(F.sum((F.col("quality_pred") == F.col("quality")).cast("int")), F.count("*")).first()
    assert right / n > 0.97
    assert quality.score(edge, model).count() == len(EDGE)
    assert quality.keep_good(edge, quality.train_model(docs, labels.limit(0))).count() == len(EDGE)


def test_co_training_exchanges_labels():
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 400).astype(float)
    a, b = y[:, None] + 0.3 * rng.standard_normal((400, 3)), y[:, None] + 0.4 * rng.standard_normal((400, 2))
    taken = [np.empty(0, int), np.empty(0, int)]

    def draw(views):
        out = [([], []), ([], [])]
        for view, mark, rows in quality.confident_rows(views, [a[80:], b[80:]], np.arange(320), taken, 0.9):
            out[view][0].append((a, b)[view][80:][rows])
            out[view][1].append(np.full(len(rows), float(mark)))
            taken[view] = np.concatenate([taken[view], rows])
        return [(np.vstack(x), np.concatenate(m)) for x, m in out]

    model = quality.co_train([a[:80], b[:80]], y[:80], draw)
    assert model.exchanged > 0 and all(len(set(t)) == len(t) for t in taken)
    assert ((model.score([a, b]) >= 0.5) == (y == 1)).mean() > 0.95


def test_exchange_draws_from_the_whole_fold(spark):
    """The drawn rows equal a plain choice over all rows: the smallest hashes of each view, class and stratum."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((3000, 4)).astype("<f4")
    h, stratum = rng.integers(-2**62, 2**62, 3000), rng.integers(0, 5, 3000)
    y = (x[:, 0] + x[:, 2] > 0).astype(float)
    views = []
    for part in (x[:200, :2].astype(float), x[:200, 2:].astype(float)):
        trees = quality.fit_trees(part, y[:200], rounds=10)
        views.append(quality.View(trees, quality.fit_isotonic(trees.raw(part), y[:200])))
    df = spark.createDataFrame([(int(a), int(b), c.tobytes()) for a, b, c in zip(h, stratum, x, strict=True)], "h long, stratum int, x binary")
    pool = quality._Pool(df.repartition(7), 2, 16 * 3, 0.8)
    gone = [set(), set()]
    for _ in range(2):
        got = pool.draw(views)
        for view in range(2):
            want = []
            prob = views[1 - view].probability([x[:, :2], x[:, 2:]][1 - view].astype(float))
            for mark, sure in ((1.0, prob), (0.0, 1 - prob)):
                for s in range(5):
                    rows = [j for j in range(3000) if stratum[j] == s and sure[j] >= 0.8 and h[j] not in gone[view]]
                    want += [(h[j], mark) for j in sorted(rows, key=lambda j: h[j])[:3]]
            gone[view] |= {i for i, _ in want}
            assert got[view][1].tolist() == [m for _, m in sorted(want)]


def test_quality_of_tied_and_contradicting_labels(spark):
    docs = docs_frame(spark, [(k, "the same text") for k in range(40)])
    labels = spark.createDataFrame([(k % 40, k % 2) for k in range(80)], "doc_id long, quality int")
    got = [r["quality_score"] for r in quality.score(docs, quality.train_model(docs, labels)).collect()]
    assert len(got) == 40 and all(0 <= v <= 1 for v in got) and len(set(got)) == 1


# --- 4 ---------------------------------------------------------------------

def test_token_ids_equal_the_library(spark, edge):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(BPE)
    extra = [(20, "  two  spaces \n and\ttabs "), (21, "a<|endoftext|>b it's DON'T 12,345.6%%%"), (22, "　wide   x\x1c y"),
             (23, "tail** tail &&& |x| a-b"), (24, " ")]
    texts = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(120).collect()
    rows = [(i, t) for i, t in EDGE if i is not None and i != 4] + extra + [(1000 + r["doc_id"], r["text"]) for r in texts]
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"])
           for r in token_ids.token_digests(docs_frame(spark, rows), BPE).collect()}
    start = 0
    for i, t in sorted(rows):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        assert got[i] == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))), t
        start += len(ids)
    assert token_ids.token_digests(edge, BPE).count() == len(EDGE)
    assert token_ids.token_digests(edge.limit(0), BPE).count() == 0


# --- 5 ---------------------------------------------------------------------

PAGE = """<html><head><title>t</title></head><body><div id="masthead"><a href="/">Site</a></div><nav><ul><li><a>One</a><li><a>Two</a></ul></nav>
<div class="cookie-consent"><p>We use cookies to improve things on this site.</p></div><script>var t="</p>";</script>
<article><h1>Title of it</h1><p>First <b>paragraph of the story, with words &amp; more words.<br><p>Second <a href=x>linked</a> here
line two &copy 2020.</p></article><div class="sidebar"><h3>Popular</h3></div><div class="comments"><p>I liked this article, it was long.</p></div>
<form><p>Subscribe now</p><input></form><footer>All rights reserved"""


def test_html_blocks_and_extraction(spark):
    texts = [b.text for b in html_text.blocks(PAGE)]
    assert "Second linked here line two © 2020." in texts and "First paragraph of the story, with words & more words." in texts
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    model = html_text.train_model(pages)
    assert html_text.main_text(PAGE, model).startswith("Title of it\n\nFirst paragraph")
    assert "cookies" not in html_text.main_text(PAGE, model) and "liked" not in html_text.main_text(PAGE, model)
    got = html_text.extract(pages, model).collect()
    want = ["\n\n".join(b.text for b, y in zip(p, html_text.semantic_labels(p), strict=True) if y)
            for p in (html_text.blocks(r["html"]) for r in got)]
    assert sum(r["text"] == w for r, w in zip(got, want, strict=True)) >= 0.995 * len(got)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "<p"), (4, "<<<>>> & </x>"), (5, "<p>" * 5000), (6, "plain")], "page_id long, html string") \
        .withColumn("TEXT", F.lit(1))
    assert {r["page_id"]: r["n_chars"] for r in html_text.extract(odd, model).collect()}[1] == 0
    assert html_text.extract(odd, html_text.train_model(odd.limit(0))).count() == 6


def test_training_pages_are_drawn_from_labelled_ones(spark):
    bare = '<div class="menu"><a href=x>One</a></div><div class="content"><p>Words of a story, and more of them.</p></div>'
    false = "<script>'<main>'</script><p>No markup here.</p>"
    rows = [(k, bare if k % 2 else false) for k in range(4_000)]
    rows += [(5_000 + k, PAGE.replace("Title", f"Title {k}") + "<p>" + "x" * 50_000 * (k % 2)) for k in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, html string")
    model = html_text.train_model(pages)
    assert model is not None
    assert "cookies" not in html_text.main_text(PAGE.replace("article>", "section>"), model)
    # a table of its labelled pages alone gives the same field
    alone = html_text.train_model(pages.filter("page_id >= 5000"))
    assert model.index == alone.index and np.array_equal(model.weight, alone.weight)
    assert html_text.train_model(pages.filter("page_id < 5000")) is None


def test_viterbi_finds_the_best_chain():
    rng = np.random.default_rng(5)
    page = html_text.blocks(PAGE)[:8]
    model = html_text.Field({f: k for k, f in enumerate(sorted({x for fs in html_text.features(page) for x in fs}))})
    model.weight, model.step = rng.standard_normal((len(model.index), 2)), rng.standard_normal((2, 2))
    e = np.array(model.scores(page))

    def total(labels):
        return sum(e[k, y] for k, y in enumerate(labels)) + sum(model.step[a, b] for a, b in zip(labels, labels[1:], strict=False))

    best = max((tuple(int(c) for c in f"{k:0{len(page)}b}") for k in range(2 ** len(page))), key=total)
    assert tuple(model.viterbi(page)) == best


# --- 6 ---------------------------------------------------------------------

def shingle_set(t, size=4):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    n = min(size, len(w))
    return frozenset(tuple(w[k:k + n]) for k in range(len(w) - n + 1)) if w else frozenset()


def brute_components(rows, percent=85):
    sets = {i: shingle_set(t) for i, t in rows}
    comp = {i: i for i in sets}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    for _ in range(len(sets)):
        moved = False
        for a, b in links:
            low = min(comp[a], comp[b])
            moved = moved or comp[a] != low or comp[b] != low
            comp[a] = comp[b] = low
        if not moved:
            break
    return {i: (len(sets[i]), comp[i]) for i in sets}


def near_texts(seed, groups=12, copies=8):
    rng = np.random.default_rng(seed)
    rows, k = [], 0
    shared = " ".join(f"p{j}" for j in range(30))
    for g in range(groups):
        n = int(rng.choice([2, 5, 9, 14, 40, 120, 300]))
        base = [f"g{g}w{j}" for j in range(n)]
        for _ in range(copies):
            own = list(base)
            for _ in range(int(rng.integers(0, 4))):
                own[int(rng.integers(0, n))] = f"e{k}x{rng.integers(99)}"
            if rng.random() < 0.3 and n > 20:
                own += shared.split()
            rows.append((k, " ".join(own).upper() if k % 2 else " ".join(own)))
            k += 1
    return rows


@pytest.mark.parametrize("block", [4096, 3])
def test_jaccard_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(shingle_join, "BLOCK", block)
    rows = near_texts(block) + [(900, None), (901, ""), (902, " \n"), (903, "a b"), (904, "A\tb"), (905, "one two three")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in shingle_join.jaccard_components(docs_frame(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_partners_always_share_a_signature():
    rng = np.random.default_rng(2)
    for _ in range(400):
        n = int(rng.integers(1, 400))
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        y = x.copy()
        while True:
            z = np.unique(np.concatenate([np.delete(y, rng.integers(len(y))), rng.integers(0, 2**63, int(rng.integers(0, 2))).astype(np.uint64)])) \
                if len(y) > 1 else y
            both = len(np.intersect1d(x, z))
            if 100 * both < 85 * (len(x) + len(z) - both) or len(z) == len(y) == 1:
                break
            y = z
        assert len(np.intersect1d(shingle_join.signatures(x, 85), shingle_join.signatures(y, 85)))


def test_near_duplicate_edges(spark, edge):
    out = shingle_join.jaccard_components(edge)
    assert out.count() == len(EDGE)
    kept = [r["doc_id"] for r in shingle_join.keep_one(edge).collect()]
    assert sorted(kept, key=str) == sorted([1, 2, 3, None, 4, 5, 6, 7], key=str)
    assert shingle_join.jaccard_components(edge.limit(0)).count() == 0


# --- 7 ---------------------------------------------------------------------

def test_warc_round_trip_and_revisits(spark):
    same = "<p>" + "same " * 40 + "\r\n\r\nWARC/1.1\r\n</p>"
    rows = [(5, "u", same), (3, "u 2\r\n", same), (9, None, same), (1, "u", "short"), (2, "u", "short"), (4, "u", None),
            (None, "u", same), (7, "u", "é" * 60), (8, "u", "")]
    got = {r["page_id"]: tuple(r)[1:] for r in warc.archive_report(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for i, _, h in rows:
        raw = (h or "").encode()
        revisit = h == same and i != 3
        assert got[i] == (len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None)
    assert warc.archive_report(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc_salvage_recovers_later_records(spark, tmp_path):
    out = str(tmp_path / "plain")
    rows = [(k, "u", f"<p>page {k} " + "text " * 30) for k in range(6)]
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), out)
    data = next(p for p in (tmp_path / "plain").iterdir() if p.name.startswith("part-")).read_bytes()
    records = [x for x in warc.salvage(data)]
    assert len(records) == 6 and sum(r.length for r in records) == len(data)
    broken = bytearray(data)
    broken[records[1].offset + records[1].length - 20] ^= 1                # payload digest fails
    cut = records[3].offset + records[3].length - 80
    broken = bytes(broken[:cut]) + bytes(broken[cut + 25:])               # bytes lost in a payload
    parts = list(warc.salvage(b"junk" + broken + b"WARC/1.1\r\ntail"))
    gaps = [x for x in parts if isinstance(x, warc.Gap)]
    assert len(parts) - len(gaps) == 4 and len(gaps) == 4
    assert sum(x.length for x in parts) == len(broken) + 4 + 14
    members = [gzip.compress(data[r.offset:r.offset + r.length]) for r in records]
    bad = bytearray(members[2])
    bad[len(bad) // 2] ^= 255
    parts = list(warc.salvage(b"".join([*members[:2], bytes(bad), *members[3:]])))
    assert [type(x) for x in parts] == [warc.Record, warc.Record, warc.Gap, warc.Record, warc.Record, warc.Record]
    assert parts[2].length == len(bad)
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "a.warc").write_bytes(broken)
    read = warc.read_warc(spark, str(tmp_path / "bad")).collect()
    assert sum(r["gap"] is None for r in read) == 4 and all(r["payload"] for r in read if r["gap"] is None)
    with pytest.raises(Exception, match="hold no record"):      # what the report of its own archives does with a gap
        warc.read_warc(spark, str(tmp_path / "bad"), strict=True).collect()


def test_warc_members_written_are_read_and_salvaged(spark, tmp_path):
    rows = [(k, "u", None if k == 5 else f"<p>é page {k % 4} " + "text " * 30) for k in range(7)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    files = {}
    for members in (False, True):
        out = tmp_path / str(members)
        warc.write_warc(pages, str(out), members=members)
        files[members] = next(p for p in out.iterdir() if p.name.startswith("part-")).read_bytes()
    # inflated, the members are the plain archive
    assert gzip.decompress(files[True]) == files[False]
    data = files[True]
    records = list(warc.salvage(data))
    assert [r.payload for r in records] == [r.payload for r in warc.salvage(files[False])] and len(records) == 7
    bad = bytearray(data)
    bad[records[2].offset + records[2].length // 2] ^= 255
    parts = list(warc.salvage(bytes(bad) + b"tail"))
    assert [r.payload for r in parts if isinstance(r, warc.Record)] == [r.payload for k, r in enumerate(records) if k != 2]
    assert sum(isinstance(x, warc.Gap) for x in parts) == 2


# --- 9 ---------------------------------------------------------------------

def test_piece_ids_equal_the_library_and_round_trip(spark, edge):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    model = pieces.loaded(PIECES)
    assert model.bpe
    rows = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    for t in [*rows[:150], "  a  b\n c ", "", " ", "€\U00010348 日本", "        x", "a" * 5000, "the" * 900]:
        assert np.frombuffer(model.encode(t), "<i4").tolist() == sp.encode(t), t[:60]
    for t in ("▁ a▁b", "▁", "a▁▁"):
        assert model.decode(np.frombuffer(model.encode(t), "<i4").tolist()) == t
    out = pieces.round_trip(edge, PIECES).collect()
    assert len(out) == len(EDGE) and all(r["lossless"] for r in out)


def test_streaming_viterbi_equals_whole_viterbi():
    rng = np.random.default_rng(4)
    vocab = {p: (k, -float(rng.integers(1, 9))) for k, p in enumerate(["a", "b", "c", "ab", "bc", "abc", "ca", "aab", "▁", "▁a"])}
    model = pieces.PieceModel(pieces=vocab, byte_ids=list(range(100, 356)))
    s = "".join(rng.choice(list("abc▁"), 700))
    commits = list(model.viterbi(s))
    assert len(commits) > 3 and "".join(p for part in commits for p in part) == s
    best = [0.0] + [-1e9] * len(s)
    for j in range(1, len(s) + 1):
        best[j] = max(best[i] + vocab[s[i:j]][1] for i in range(max(0, j - 3), j) if s[i:j] in vocab)
    assert sum(vocab[p][1] for part in commits for p in part) == best[-1]


# --- 10 --------------------------------------------------------------------

def test_language_phrases_and_held_out_accuracy(spark, edge):
    model = langid.LanguageModel({"x": ["abcabc"], "y": ["bca"]})
    text = "abcabcbzca"
    rates, _ = model.rates([text])
    for k, train in enumerate(["abcabc", "bca"]):
        phrases = at = 0
        while at < len(text):
            n = next((n for n in range(len(text) - at, 0, -1) if text[at:at + n] in train), 1)
            phrases, at = phrases + 1, at + n
        assert rates[0, k] == pytest.approx(phrases * np.log2(len(train)) / len(text))
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    texts = langid.training_texts(langid.train_fold(docs))
    right, n = langid.identify(docs, texts).filter(fold("doc_id") == 0) \
        .agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right / n > 0.98
    got = {r["doc_id"]: r["lang_pred"] for r in langid.identify(edge, texts).collect()}
    assert got[1] == got[2] == got[3] == "und" and got[4] in texts
    assert langid.identify(edge, langid.training_texts(docs.limit(0))).filter("lang_pred <> 'und'").count() == 0
    assert langid.identify(edge.limit(0), texts).count() == 0


def test_a_tiny_training_text_does_not_win(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = langid.training_texts(langid.train_fold(docs))
    sample = [r["text"] for r in docs.filter("length(text) > 200").limit(60).collect()]
    before = langid.LanguageModel(texts).predict(sample)[0]
    for tiny in ("Ciao.", "a", "12."):
        assert langid.LanguageModel({**texts, "xx": [tiny]}).predict(sample)[0] == before, tiny


def test_every_training_letter_counts():
    rng = np.random.default_rng(4)
    common = "".join(chr(c) for c in range(0x4E00, 0x4E00 + 200))
    texts = {"a": ["".join(rng.choice(list(common), 3_000))],                          # crowds out a small alphabet
             "b": ["αβγδ εζηθ " * 3], "c": ["дежз ийкл " * 3]}
    model = langid.LanguageModel(texts)
    langs, scores = model.predict(["εζηθ αβγδ", "ийкл дежз", texts["a"][0][50:90]])
    assert langs == ["b", "c", "a"] and min(scores) > 0.5
    # the phrases do not depend on how many letters have columns
    mixed = ["".join(rng.choice(list(common + "αβγдеxyz .1"), 700)) + t[0] for t in texts.values()]
    whole = langid.LanguageModel(texts, alphabet=10_000).phrases(mixed)
    for columns in (0, 5, 120):
        for a, b in zip(whole, langid.LanguageModel(texts, alphabet=columns).phrases(mixed), strict=True):
            assert (a == b).all()


def test_languages_are_learned_from_anywhere_in_a_document(spark):
    rows = [(k, "header " * 300 + f"body{k} " * 2_000, "x", "s", 0) for k in range(20)] + [(90, "short", "x", "s", 0)]
    got = langid.training_texts(spark.createDataFrame(rows, DOCS))["x"]
    assert len(got) == 21 and "short" in got and max(map(len, got)) == langid.TRAIN_SLICE
    assert sum("body" in t for t in got) > 15


# --- pipeline --------------------------------------------------------------

def test_pipeline_runs_and_keeps_schemas(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs.limit(0), SF)
        assert out.columns == docs.columns, name
    out = P.run(spark, SF)
    assert out.columns == ["doc_id", "lang", "source", "ids", "n_tokens"] and 0 < out.count() <= docs.count()


def test_every_pipeline_stage_bounds_the_batches_of_its_workers(spark):
    import corpus_pipeline as P

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    for name, stage in P.STAGES:
        spark.conf.unset(key)
        before = spark.conf.get(key)
        stage(spark, docs, SF)
        assert spark.conf.get(key) != before and int(spark.conf.get(key)) <= 4 << 20, name


def test_written_stages_and_pieces_take_one_worker_a_task(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    frames = {name: stage(spark, docs, SF) for name, stage in P.STAGES if name in ("quality", "language", "decontamination", "tokens")}
    frames["round trip"] = pieces.round_trip(docs, PIECES)
    for name, frame in frames.items():
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1, name


def test_whole_and_sharded_decontamination_leave_the_same_texts(spark, monkeypatch):
    passage = " ".join(f"w{k}" for k in range(20))
    lead = " ".join(f"x{k}" for k in range(500))
    docs = docs_frame(spark, enumerate([f"{lead} {passage} end.", lead, passage, "", None, f"{lead}, {passage}! {lead} ({passage})"]))
    items = spark.createDataFrame([(k, f"{passage} {k}" if k else passage) for k in range(30)], "item_id long, text string")
    kept = [{r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, items).collect()}]
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", 2_000)
    kept.append({r["doc_id"]: r["text"] for r in decontaminate.decontaminate(docs, items).collect()})
    assert kept[0] == kept[1] and sorted(kept[0].values(), key=str) == sorted(
        [f"{lead}  end.", lead, "", None, f"{lead}, ! {lead} ()"], key=str)


def test_language_stage_keeps_short_and_tied_texts(spark):
    import corpus_pipeline as P

    learnt = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("length(text) > 500")
    odd = [(-1, "This."), (-2, "De."), (-3, "Die tz."), (-4, "A.\nAll rights reserved."), (-5, "a"),
           (-6, "日本語の文章です。これは日本語で書かれています。"), (-7, "xq zjw kqx vzpt qqjx wkzr " * 4), (-8, "12345"), (-9, None)]
    rows = spark.createDataFrame([(i, t, None, "s", 0) for i, t in odd], DOCS)
    both = learnt.select("doc_id", "text", "lang", "source", "n_chars").unionByName(rows)
    kept = P.language_stage(spark, both, "").filter("doc_id < 0").collect()
    assert {r["doc_id"] for r in kept} == {-1, -2, -3, -4, -5}


def test_little_training_rejects_nothing_of_its_language():
    learnt = {"en": ["the quick brown fox jumps over the lazy dog and runs away " * 40] * 4, "it": ["Ciao."]}
    model = langid.LanguageModel(learnt)
    assert model.recognised(["Ciao, ciao ciao a tutti", "the dog jumps"], langid.limits(learnt)).all()
