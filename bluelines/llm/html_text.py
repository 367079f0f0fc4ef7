"""Operator 3: main text of HTML pages by a recurrent block labeller.

A page is read into leaf blocks. Each block becomes a vector: its tag path (tag names, class, id and
role words, the innermost pair) and its words, both hashed to random sign vectors, with length, link
share and punctuation. A bidirectional LSTM in numpy reads the whole sequence of a page's blocks in
both directions and labels every block; the blocks labelled main, in page order, make the text.

Fit, on a bounded sample of ``SAMPLE_PAGES`` pages by hash of the whole page: blocks within article
or main elements and not within elements or classes of page furniture are main, the others not. For
each page ``VARIANTS`` more are made from the same blocks under other containers and other furniture
(lists ``MAIN`` and ``FURNITURE``), so that the labeller does not depend on one set of tags.

Edge cases: null or empty html and pages without a main block give an empty text; broken markup is
read as far as it goes; repeated pages give repeated rows; an empty table or a sample without any
text labels nothing; extra columns are not read.
"""

from __future__ import annotations

import math
import random
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bluelines.llm.bilstm import BiLSTM
from bluelines.llm.blocks import Block, blocks
from bluelines.llm.common import text_batches

SAMPLE_PAGES, VARIANTS, LONGEST = 250, 5, 120  # sampled pages; made ones for each; blocks of a training sequence
PATH, WORDS = 64, 32
MAIN = (("article",), ("main",), ("main", "article"), ("div", ".content"), ("div", ".post", "article"), ("div", ".entry", ".content"), ("div", ".article", ".body"),
        ("section", ".story"), ("div", ".main", ".text"), ("div", ".page", "div", ".body"), ("td", ".text"), ("div",))
FURNITURE = {
    "top": (("header",), ("div", ".header"), ("div", ".masthead"), ("nav",), ("nav", "ul", "li"), ("div", ".menu", "ul", "li"), ("ul", ".navigation", "li"),
            ("div", ".breadcrumb"), ("div", ".topbar"), ("div", ".cookie", ".notice"), ("div", ".consent"), ("div", ".alert"), ("div", ".ad"),
            ("div", ".advert"), ("div", ".banner"), ("form",), ("form", ".search"), ("div", ".notice"), ("div", ".popup"), ("div", ".navbar", "li"), ("head", "title")),
    "inside": (("div", ".ad"), ("div", ".advertisement"), ("aside",), ("div", ".sponsored"), ("div", ".share"), ("div", ".social", "ul", "li"), ("div", ".related"),
               ("form", ".newsletter"), ("div", ".promo"), ("aside", ".sidebar"), ("div", ".tags", "li"), ("div", ".notice"), ("nav",)),
    "after": (("footer",), ("div", ".footer"), ("footer", "ul", "li"), ("aside",), ("div", ".sidebar"), ("div", ".widget"), ("section", ".comments"), ("div", ".comments", "p"),
              ("div", ".comment", ".body"), ("ol", ".comment", ".list", "li"), ("section", ".comments", "article", ".comment", "p"), ("div", ".disqus"), ("div", ".reader", ".comments"),
              ("div", ".replies"), ("form", ".comment"), ("form", ".login"), ("form",), ("div", ".copyright"), ("div", ".ad"), ("div", ".recommended"), ("div", ".subscribe"), ("div", ".legal")),
}
_LABELLED_OUT = frozenset("nav header footer aside form head button dialog menu".split()) | {
    n for kinds in FURNITURE.values() for path in kinds for n in path if n.startswith(".")} - {".body", ".list", ".reader"}


@lru_cache(1 << 16)
def _sign_vector(word: str, size: int) -> np.ndarray:
    rng = np.random.default_rng(zlib.crc32(word.encode("utf-8", "replace")))
    return (rng.integers(0, 2, size) * 2 - 1).astype(np.float32)


@lru_cache(1 << 14)
def path_vector(path: tuple[str, ...]) -> np.ndarray:
    v = np.zeros(PATH, np.float32)
    for n in set(path):
        v += _sign_vector(n, PATH)
    tags = [n for n in path if n[0] != "."]
    return (v + 0.5 * _sign_vector(">".join(tags[-2:]), PATH)) / 3


def vector(block: Block) -> np.ndarray:
    text = block.text
    bins = np.bincount([zlib.crc32(w.encode("utf-8", "replace")) % (2 * WORDS) for w in text.lower().split()], minlength=2 * WORDS)
    words = bins[:WORDS] - bins[WORDS:]
    n = len(text)
    marks = text.count(".") + text.count(",")
    numbers = [math.log(n + 1) / 5, block.linked / n, min(1.0, 10 * marks / n), 1.0]
    return np.concatenate([path_vector(block.path), np.sign(words) * np.log1p(np.abs(words)) / 4, numbers]).astype(np.float32)


def weak_label(path: tuple[str, ...]) -> bool:
    return ("article" in path or "main" in path) and not _LABELLED_OUT.intersection(path)


def _variant(main: list[Block], other: list[Block], r: random.Random) -> list[tuple[Block, bool]]:
    """A made page: the main blocks in another container, with furniture whose texts come from ``other``."""
    outer = ("html", "body", *r.choice(((), ("div",), ("div", ".wrapper"), ("div", ".page"))))
    container = r.choice(MAIN)
    if r.random() < 0.4:
        outer, container = ("html", "body"), ("article",)

    def piece(path, prose):
        b = r.choice((main if prose else other) or main or other or [Block((), "text", 0)])
        text = b.text
        if not prose:
            w = text.split()
            text = " ".join(w[:r.randrange(1, 12)])
        link = len(text) if r.random() < 0.5 and not prose else 0
        return Block(path, text, link), False

    def furniture(kind, least):
        out = []
        for _ in range(r.randrange(least, 4)):
            path = r.choice(FURNITURE[kind])
            prose = any(n in (".comment", ".comments", ".ad", ".replies", ".disqus", "aside", ".notice", ".related") for n in path) and r.random() < 0.6
            repeat = r.randrange(1, 7) if path[-1] in ("li", "p") else 1
            inner = ("p",) if path[-1] not in ("p", "li") and r.random() < (0.5 if prose else 0.25) else ()
            out += [piece((*outer, *path, *inner) if kind != "inside" else (*outer, *container, *path, *inner), prose) for _ in range(repeat)]
        return out

    body = []
    for k, b in enumerate(main):
        leaf = b.path[-1:] if b.path and b.path[-1] in ("p", "h1", "h2", "li", "pre", "blockquote") else ("p",)
        if r.random() < 0.1:
            leaf = r.choice((("h2",), ("ul", "li"), ("blockquote", "p"), ("p",), ("pre",), ()))
        body.append((Block((*outer, *container, *leaf), b.text, b.linked), True))
        if r.random() < 0.05:
            body += furniture("inside", 0)
    return furniture("top", 0) + body + furniture("after", 0)


def train(pages: DataFrame, html_col: str = "html") -> BiLSTM | None:
    html = F.col(html_col).cast("string")
    sample = pages.select(html.alias("html")).where("length(html) > 0").select("html", F.xxhash64("html").alias("h"))
    chosen = sample.select("h").distinct().orderBy("h").limit(SAMPLE_PAGES).agg(F.max("h")).first()[0]
    if chosen is None:
        return None
    rows = sample.where(F.col("h") <= chosen).dropDuplicates(["h"]).orderBy("h").collect()
    r = random.Random(11)
    sequences = []
    for page in rows:
        found = [(b, weak_label(b.path)) for b in blocks(page.html)]
        main = [b for b, y in found if y] or [b for b, _ in found if len(b.text) > 80]
        other = [b for b, y in found if not y]
        if any(y for _, y in found):
            sequences.append(found)
        for _ in range(VARIANTS):
            k = r.randrange(len(main)) if main else 0
            sequences.append(_variant(main[k:k + r.randrange(1, 12)] if r.random() < 0.5 else main, other, r))
    sequences = [s[:LONGEST] for s in sequences if s]
    if not any(y for s in sequences for _, y in s):
        return None
    inputs = [np.stack([vector(b) for b, _ in s]) for s in sequences]
    return BiLSTM(inputs[0].shape[1]).fit(inputs, [np.array([float(y) for _, y in s], np.float32) for s in sequences])


def texts(model: BiLSTM | None, pages: list[str | None]) -> list[str]:
    """Main text of each page."""
    found = [blocks(p) for p in pages]
    if model is None:
        return ["" for _ in pages]
    labels = model.predict([np.stack([vector(b) for b in bs]) if bs else np.zeros((0, 1)) for bs in found])
    return [" ".join(b.text for b, p in zip(bs, ps) if p >= 0.5) for bs, ps in zip(found, labels)]


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (page_id, url, text, n_chars), one per input row."""
    text_batches(pages.sparkSession)
    model = pages.sparkSession.sparkContext.broadcast(train(pages, html_col))

    @F.arrow_udf("string")
    def main_text(html: pa.Array) -> pa.Array:
        out = []
        for k in range(0, len(html), 64):
            out += texts(model.value, html[k:k + 64].to_pylist())
        return pa.array(out, pa.string())

    out = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), main_text(F.col(html_col).cast("string")).alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
