"""Main text of HTML pages by a linear-chain CRF over leaf blocks (operator 5).

A page becomes a sequence of leaf blocks: runs of inline text between block
tags, each with its ancestors' tags and class/id words, its share of linked
characters and the look of its text. A linear-chain conditional random field
labels each block main or not; Viterbi finds the best label sequence of a page.

Training pages: a bounded hash sample of the pages with semantic markup, of any
length (``TRAIN_PAGES`` in expectation, all where there are fewer), labelled by it (inside
``article`` or ``main``, outside navigation, footers, asides, forms ...), and the same pages
*redressed*: their blocks in other containers (classes of content, menu,
sidebar, comment, notice ... instead of semantic tags), so that the field learns class
words and text features as well. Training is stochastic gradient ascent on the likelihood
(forward-backward), in numpy, on the driver.

Scripts, styles, templates, forms' controls, comments and the head are no text. Character references are
decoded, white space inside a block (line breaks included) becomes one space.

Scale: pages are read twice for the sample (to count those with markup, and to
draw; again where the markup seldom held text) and once for extraction, row by row, no shuffle; the field's weights (a few thousand numbers) are broadcast.

Defined results: NULL, empty and text-less pages give an empty text; broken
markup is read to its end; pages with one id are extracted each on their own;
where no page can be learned from, semantic markup decides alone (a page
without any is all main text); empty tables give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from math import exp, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adlens.llm.common import quoted, share, slices, with_struct

TRAIN_PAGES = 120
EPOCHS = 8

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe xmp noembed noframes".split())
# Elements whose text is no text of the page; a block's start tag closes those of the second list where their end tag is missing.
DROPPED = frozenset("button option optgroup select datalist svg annotation annotation-xml canvas audio video object".split())
SHORT = frozenset("button option optgroup select datalist svg annotation annotation-xml".split())
HEAD_TAGS = frozenset("html head base link meta title style script noscript template".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr br img nobr "
                   "math mi mn mo ms mtext mrow mfrac msup msub msubsup msqrt mroot mover munder munderover mtable mtr mtd mspace "
                   "mstyle mpadded mphantom menclose semantics".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
                     "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
            "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"])}
LIST_SCOPE = frozenset(["ul", "ol", "menu", "dl", "table", "body", "article", "section", "div"])
MAIN_TAGS = frozenset(["article", "main"])
_SEMANTIC = r"(?i)<(article|main)[\s/>]"
OTHER_TAGS = frozenset("nav footer aside form dialog menu".split())
# Class and id words by which redressed pages are built.
MAIN_WORDS = ("content article post entry story main body text prose article-body post-content entry-content "
              "main-content page-content story-body").split()
OTHER_WORDS = {
    "nav": "menu nav navbar navigation breadcrumb breadcrumbs topnav site-nav toolbar tabs pagination pager",
    "header": "header masthead top banner site-header topbar logo branding",
    "footer": "footer bottom copyright site-footer legal colophon credits",
    "aside": "sidebar aside related widget recommended more-stories popular trending side tags share social",
    "ad": "ad ads advert advertisement sponsor sponsored promo banner-ad promotion",
    "notice": "cookie notice consent gdpr alert popup modal banner-notice cookie-banner warning",
    "comments": "comments comment reader-comments discussion replies responses disqus comment-list reply",
    "form": "newsletter subscribe signup search login form search-form contact",
}

# A quote opens a value after "=" only; one that nothing closes is a character of the tag.
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\s>]*+|[\"']))*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s]*)))?")
_WORD = re.compile(r"[A-Za-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Block:
    text: str
    tag: str
    tags: tuple[str, ...]
    words: tuple[str, ...]
    linked: int


@dataclass
class _Element:
    tag: str
    words: tuple[str, ...] = ()
    hidden: bool = False
    dropped: bool = False


def _element(tag: str, attributes: str) -> _Element:
    words: list[str] = []
    hidden = False
    if "=" in attributes or "hidden" in attributes.lower():
        seen = set()
        for m in _ATTRIBUTE.finditer(attributes):
            name = m[1].lower()
            if name in seen:                     # the first of its name counts
                continue
            seen.add(name)
            value = m[2] or m[3] or m[4] or ""
            if name == "hidden":
                hidden = True
            elif name == "style":
                hidden = hidden or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I) is not None
            elif name in ("class", "id", "role", "itemprop"):
                words += [w.lower() for part in value.split() for w in _WORD.findall(_CAMEL.sub(" ", part))]
    return _Element(tag, tuple(dict.fromkeys(words)), hidden)


def blocks(html: str | None) -> list[Block]:
    """The page's leaf blocks with text, in page order."""
    out: list[Block] = []
    if not html:
        return out
    stack: list[_Element] = [_Element("")]
    text: list[str] = []
    linked = 0
    in_link = hidden = dropped = 0
    unclosed: set[str] = set()       # raw elements without a further end tag
    is_open: Counter[str] = Counter()  # tags of the stack

    def flush() -> None:
        nonlocal linked
        if text:
            raw = "".join(text)
            line = " ".join((unescape(raw) if "&" in raw else raw).split())
            if line and not hidden:
                own = [e for e in stack[1:] if e.tag not in INLINE and e.tag not in ("html", "body")]
                out.append(Block(line, own[-1].tag if own else "", tuple(dict.fromkeys(e.tag for e in own)),
                                 tuple(dict.fromkeys(w for e in own for w in e.words)), min(linked, len(line))))
            text.clear()
        linked = 0

    def pop(k: int) -> None:
        """Close the elements from position ``k`` of the stack on."""
        nonlocal in_link, hidden, dropped
        while len(stack) > k:
            e = stack.pop()
            in_link -= e.tag == "a"
            hidden -= e.hidden
            dropped -= e.dropped
            is_open[e.tag] -= 1

    def place_of(tag: str) -> int:
        """Of the innermost open element of a tag; 0: none."""
        return next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0) if is_open[tag] else 0

    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        end = m.start() if m else n
        if end > at and not dropped:
            piece = html[at:end]
            if stack[-1].tag == "head" and not piece.isspace():
                pop(len(stack) - 1)
            text.append(piece)
            if in_link:
                linked += len(piece.strip())
        if not m:
            break
        at = m.end()
        if m[2] is None:
            if m[0].startswith("<![CDATA[") and not dropped:
                text.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = m[2].lower()
        if m[1]:
            place = place_of(tag)
            if tag in DROPPED:
                if place and all(e.tag in INLINE or e.dropped for e in stack[place + 1:]):
                    pop(place)
            elif tag not in INLINE:
                flush()
                if place:
                    pop(place)
            elif place and all(e.tag in INLINE for e in stack[place:]):
                pop(place)
            continue
        if tag not in HEAD_TAGS:
            place = place_of("head")
            if place:                # its end tag may be left out
                flush()
                pop(place)
        if tag in RAW:
            closing = None if tag in unclosed else re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(html, at)
            if closing is None:
                unclosed.add(tag)
            if not m[3].endswith("/"):
                at = closing.end() if closing else n if tag in ("script", "style") else at
            continue
        if tag in DROPPED:
            if tag in ("option", "optgroup") and stack[-1].tag == "option" or tag == "button" and stack[-1].tag == "button":
                pop(len(stack) - 1)
            if not m[3].endswith("/"):
                stack.append(_Element(tag, dropped=True))
                dropped += 1
                is_open[tag] += 1
            continue
        if tag == "br":
            text.append("\n")
            continue
        if tag in VOID:
            if tag == "hr":
                flush()
            continue
        if tag not in INLINE:
            if tag in CLOSES_P and any(is_open[t] for t in SHORT):
                place = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag not in INLINE and stack[k].tag not in SHORT), 0)
                short = next((k for k in range(place + 1, len(stack)) if stack[k].tag in SHORT), 0)
                if short:
                    pop(short)
            flush()
            if tag in CLOSES_P:
                place = place_of("p")
                if place and not any(e.tag in ("table", "button") for e in stack[place:]):
                    pop(place)
            if tag in SIBLINGS:
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].tag in SIBLINGS[tag]:
                        pop(k)
                        break
                    if stack[k].tag in LIST_SCOPE:
                        break
        if m[3].endswith("/") and tag not in INLINE:
            continue
        e = _element(tag, m[3])
        stack.append(e)
        is_open[tag] += 1
        in_link += tag == "a"
        hidden += e.hidden
    flush()
    return [b for b in out if "head" not in b.tags]


_SECTIONS = MAIN_TAGS | OTHER_TAGS | {"header"}


def container(b: Block) -> list[str]:
    """Features of where a block stands."""
    home = next((t for t in reversed(b.tags) if t in _SECTIONS), "")
    return [f"tag={b.tag}", f"home={home}", *(f"in={t}" for t in b.tags), *(f"class={w}" for w in b.words)]


def look(b: Block, k: int, n: int, longest: int) -> list[str]:
    """Features of block ``k`` of ``n`` by its text."""
    size, count = len(b.text), b.text.count(" ") + 1
    f = ["bias", _SIZE[min(size.bit_length(), 12)], _WORDS[min(count.bit_length(), 9)],
         _LINKS[0 if not b.linked else 1 + min(3, 4 * b.linked // size)], _PLACE[4 * k // n],
         _RANK[min(4 * size // longest, 3)], "stop" if b.text[-1] in '.!?\u2026"\u201d\u00bb' else "open",
         _MARKS[min(3, b.text.count(",") + b.text.count(". "))]]
    if "\u00a9" in b.text:
        f.append("copyright")
    if size < 200:
        f += [f"word={w}" for w in {w.strip(".,:;!?").lower() for w in b.text.split()[:12]} & _TELLING]
    return f


_SIZE, _WORDS, _LINKS = ([f"{name}={i}" for i in range(13)] for name in ("size", "words", "links"))
_PLACE, _RANK, _MARKS = ([f"{name}={i}" for i in range(5)] for name in ("place", "rank", "marks"))


def features(page: list[Block]) -> list[list[str]]:
    """Names of the active features of every block."""
    longest = max((len(b.text) for b in page), default=1)
    return [container(b) + look(b, k, len(page), longest) for k, b in enumerate(page)]


# Words by which short blocks of boilerplate are known.
_TELLING = frozenset("cookie cookies privacy subscribe newsletter login sign share comments comment reply advertisement "
                     "sponsored copyright reserved rights menu home search related more read follow accept terms".split())


@dataclass
class Field:
    """Weights of a two-label chain: label 1 is main text."""

    index: dict[str, int] = field(default_factory=dict)
    weight: np.ndarray = field(default_factory=lambda: np.zeros((0, 2)))
    step: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))

    places: dict[tuple, tuple[float, float]] = field(default_factory=dict)
    pairs: dict[str, tuple[float, float]] = field(default_factory=dict)

    def scores(self, page: list[Block]) -> list[tuple[float, float]]:
        if not self.pairs:
            rows = self.weight.tolist()
            self.pairs = {f: (rows[i][0], rows[i][1]) for f, i in self.index.items()}
        longest, pairs, none = max(len(b.text) for b in page), self.pairs, (0.0, 0.0)
        out = []
        for k, b in enumerate(page):
            place = (b.tag, b.tags, b.words)
            got = self.places.get(place)
            if got is None:
                if len(self.places) > 50_000:
                    self.places.clear()
                got = self.places[place] = tuple(map(sum, zip(none, *(pairs.get(f, none) for f in container(b)))))
            x, y = got
            for f in look(b, k, len(page), longest):
                u, v = pairs.get(f, none)
                x += u
                y += v
            out.append((x, y))
        return out

    def viterbi(self, page: list[Block]) -> list[int]:
        if not page:
            return []
        (s00, s01), (s10, s11) = self.step.tolist()
        scores = self.scores(page)
        a, b = scores[0]
        back = []
        for e0, e1 in scores[1:]:
            from0, from1 = int(b + s10 > a + s00), int(b + s11 > a + s01)
            back.append((from0, from1))
            a, b = max(a + s00, b + s10) + e0, max(a + s01, b + s11) + e1
        labels = [int(b > a)]
        for step in reversed(back):
            labels.append(step[labels[-1]])
        return labels[::-1]


def semantic_labels(page: list[Block]) -> list[int] | None:
    """Labels by semantic markup; None where a page has no main element."""
    if not any(MAIN_TAGS & set(b.tags) for b in page):
        return None
    other = {w for ws in OTHER_WORDS.values() for w in ws.split()}
    return [int(bool(MAIN_TAGS & set(b.tags)) and not OTHER_TAGS & set(b.tags) and not other & set(b.words))
            for b in page]


# Elements that hold main text inside its container.
_INNER = (("ul", "li"), ("ol", "li"), ("h2",), ("h3",), ("blockquote",), ("blockquote", "p"), ("table", "tr", "td"), ("div",),
          ("pre",), ("section", "p"), ("figure", "figcaption"), ("p",))


def redressed(page: list[Block], labels: list[int], rng: np.random.Generator, pool: list[str]) -> tuple[list[Block], list[int]]:
    """The page's blocks in other containers, with other pages' text as comments,
    sidebars and notices around and inside the main text."""
    def words(kind: str) -> tuple[str, ...]:
        w = rng.choice(OTHER_WORDS[kind].split())
        return tuple(_WORD.findall(str(w)))

    def other(kind: str, text: str, linked: bool = False) -> Block:
        semantic = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "comments": "section",
                    "form": "form"}.get(kind, "div")
        tag = str(rng.choice(["p", "div", "li", "span", "h3"]))
        outer = semantic if rng.random() < 0.5 else str(rng.choice(["div", "section", "ul"]))
        named = words(kind) if outer != semantic or rng.random() < 0.7 or outer in ("section", "div") else ()
        inside = (*(("article",) if rng.random() < 0.15 else ("main",) if rng.random() < 0.15 else ()), outer)
        return Block(text, tag, tuple(dict.fromkeys((*inside, tag))), named, len(text) if linked else 0)

    main = [b for b, y in zip(page, labels, strict=True) if y]
    rest = [b for b, y in zip(page, labels, strict=True) if not y]
    dress = rng.random()
    named = tuple(_WORD.findall(str(rng.choice(MAIN_WORDS)))) if dress < 0.8 else ()
    around = (*(("article",) if dress > 0.7 else ()), *(("main",) if rng.random() < 0.2 else ()),
              str(rng.choice(["div", "section"])))
    out: list[tuple[Block, int]] = []
    for kind in ("header", "nav", "notice", "ad"):
        if rng.random() < 0.5:
            source = rest[int(rng.integers(len(rest)))].text if rest and rng.random() < 0.6 else str(rng.choice(pool))
            out.append((other(kind, source[:int(rng.integers(20, 300))].strip() or "Menu", kind == "nav"), 0))
    for b in main:
        inner = (b.tag if b.tag and b.tag not in MAIN_TAGS else "p",) if rng.random() > 0.15 else \
            _INNER[int(rng.integers(len(_INNER)))]
        if rng.random() < 0.08:
            out.append((other(str(rng.choice(["ad", "aside", "form", "notice"])), str(rng.choice(pool))[:200]), 0))
        out.append((Block(b.text, inner[-1], tuple(dict.fromkeys((*around, *inner))), named, b.linked), 1))
    for kind in ("comments", "comments", "aside", "form", "ad", "footer"):
        if rng.random() < 0.5:
            out.append((other(kind, str(rng.choice(pool))[:int(rng.integers(30, 1500))].strip() or "Reply",
                              kind == "aside" and rng.random() < 0.5), 0))
    return [b for b, _ in out], [y for _, y in out]


def _add(a: float, b: float) -> float:
    """log(exp(a) + exp(b))"""
    return a + log1p(exp(b - a)) if a > b else b + log1p(exp(a - b))


def _sums(e: list[list[float]], s: list[list[float]]) -> tuple[np.ndarray, np.ndarray, float]:
    """Forward and backward log sums of a chain, and the log partition."""
    (s00, s01), (s10, s11) = s
    forward, back = [tuple(e[0])], [(0.0, 0.0)]
    for x, y in e[1:]:
        a, b = forward[-1]
        forward.append((_add(a + s00, b + s10) + x, _add(a + s01, b + s11) + y))
    for x, y in reversed(e[1:]):
        a, b = back[-1]
        back.append((_add(s00 + x + a, s01 + y + b), _add(s10 + x + a, s11 + y + b)))
    return np.array(forward), np.array(back[::-1]), _add(*forward[-1])


def fit(pages: list[tuple[list[Block], list[int]]], epochs: int = EPOCHS, rate: float = 0.3, l2: float = 1e-5,
        seed: int = 7) -> Field:
    """Maximum likelihood by Adagrad, one page a step."""
    model = Field()
    rows = []
    for page, labels in pages:
        if page:
            f = [[model.index.setdefault(x, len(model.index)) for x in fs] for fs in features(page)]
            at = np.repeat(np.arange(len(f)), [len(x) for x in f])
            rows.append((np.array([i for x in f for i in x]), at, np.array(labels)))
    w, s = np.zeros((len(model.index), 2)), np.zeros((2, 2))
    gw, gs = np.full_like(w, 1e-6), np.full_like(s, 1e-6)
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in rng.permutation(len(rows)):
            ids, at, y = rows[k]
            n = len(y)
            e = np.zeros((n, 2))
            np.add.at(e, at, w[ids])
            forward, back, total = _sums(e.tolist(), s.tolist())
            grad = -np.exp(forward + back - total)
            grad[np.arange(n), y] += 1
            step = np.zeros((2, 2))
            if n > 1:
                pair = np.exp(forward[:-1, :, None] + s + (e + back)[1:, None, :] - total)
                step = -pair.sum(axis=0)
                np.add.at(step, (y[:-1], y[1:]), 1)
            full = np.zeros_like(w)
            np.add.at(full, ids, grad[at])
            touched = np.unique(ids)
            g = full[touched] - l2 * w[touched]
            gw[touched] += g * g
            w[touched] += rate * g / np.sqrt(gw[touched])
            gs += step * step
            s = s + rate * step / np.sqrt(gs)
    model.weight, model.step = w, s
    return model


@F.arrow_udf(T.BooleanType())
def _learnable(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for part in slices(batches):
        yield pa.array([any(semantic_labels(blocks(h)) or ()) for h in part.to_pylist()], type=pa.bool_())


def train_model(pages: DataFrame, html: str = "html", page_id: str = "page_id", rows: int = TRAIN_PAGES) -> Field | None:
    own = pages.select(F.col(quoted(page_id)).alias("i"), F.col(quoted(html)).alias("h")).filter("i IS NOT NULL")
    semantic = F.col("h").rlike(_SEMANTIC)
    known = own.filter(semantic).count()
    part = min(1.0, rows / max(known, 1))
    while True:
        # the markup may be in a script or hold no text: more is drawn until enough pages have labels
        sample = own.filter(share(part, "i")).filter(semantic).filter(_learnable("h")) \
            .select(F.xxhash64("i").alias("k"), "h").collect() if known else []
        if part == 1.0 or 2 * len(sample) >= rows:
            break
        part = min(1.0, part * min(16.0, rows / max(len(sample), 1)))
    labelled = []
    for r in sorted(sample, key=lambda r: (r["k"], r["h"])):
        page = blocks(r["h"])
        labelled.append((page, semantic_labels(page)))
    if not labelled:
        return None
    rng = np.random.default_rng(11)
    pool = [b.text for page, _ in labelled for b in page]
    return fit(3 * labelled + [redressed(p, y, rng, pool) for _ in range(2) for p, y in labelled])


def main_text(html: str | None, model: Field | None) -> str:
    page = blocks(html)
    if model is None:
        labels = semantic_labels(page) or [1] * len(page)
    else:
        labels = model.viterbi(page)
    return "\n\n".join(b.text for b, y in zip(page, labels, strict=True) if y)


_RESULT = T.StructType([T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def extract(pages: DataFrame, model: Field | None, html: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points)."""
    shared = pages.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(_RESULT)
    def read(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in slices(batches):
            texts = [main_text(h, shared.value) for h in part.to_pylist()]
            yield pa.StructArray.from_arrays([pa.array(texts, type=pa.string()),
                                              pa.array([len(t) for t in texts], type=pa.int64())], names=_RESULT.names)

    return with_struct(pages, read(F.col(quoted(html))), ["text", "n_chars"])
