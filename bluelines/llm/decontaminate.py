"""Operator 8: benchmark decontamination by pigeonhole edit matching.

Texts are lower-cased, white space runs become one space. A test item of m characters may occur with
up to e = floor(``ERROR_RATE`` * m) edits. Cut into e + 1 pieces, one piece of any such occurrence must
be free of edits: all pieces of a block of items form one Aho-Corasick automaton, which scans each
whole text once. Every piece hit gives the window where its item would lie; overlapping windows of an
item are merged and verified with Myers' bit-parallel distance.

Items are read in blocks of at most ``BLOCK_CHARS`` characters (an item longer than that is a block of
its own). One block after the other is handed to the tasks, the documents are scanned, the hits are written, and
the block is taken back before the next is read, so neither the driver nor an executor holds more than a block of a
large benchmark. Nothing is shuffled for it.

Edge cases: very long texts are scanned whole; of equally near occurrences of an item in a text the first is given; an empty
table of either kind gives no row; null or empty texts and items match nothing; short items (e = 0) match exactly; an item id
that repeats counts each of its texts; extra columns are not read.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bluelines.llm.bitparallel import best_occurrence, positions
from bluelines.llm.common import text_batches
from bluelines.session import materialize

ERROR_RATE = 0.05
BLOCK_CHARS = 4_000_000
HASH_BROADCAST_ROWS = 500_000  # 16 bytes each
HIT = "array<struct<item_id:long,distance:int,end:long>>"


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def pieces(item: str) -> list[tuple[int, str]]:
    """(offset, piece): floor(ERROR_RATE * length) + 1 pieces that cover the item."""
    n = int(ERROR_RATE * len(item)) + 1
    cuts = [len(item) * k // n for k in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


class Matcher:
    def __init__(self, items: list[tuple[int, str]]):
        import ahocorasick

        self.items = [(i, t, int(ERROR_RATE * len(t)), positions(t)) for i, t in items if t]
        where: dict[str, list] = {}
        for k, (_, text, _, _) in enumerate(self.items):
            for offset, piece in pieces(text):
                where.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, at in where.items():
            self.automaton.add_word(piece, (len(piece), at))
        if where:
            self.automaton.make_automaton()

    def hits(self, text: str | None) -> list[dict]:
        """One entry per item that occurs: its smallest distance and where that occurrence ends."""
        text = normal(text)
        starts: dict[int, list[int]] = {}
        if self.items and text:
            for last, (n, at) in self.automaton.iter(text):
                for k, offset in at:
                    starts.setdefault(k, []).append(last - n + 1 - offset)
        out = []
        for k, at in starts.items():
            item_id, item, errors, masks = self.items[k]
            found = min((self._verify(text, item, errors, masks, a, b) for a, b in self._windows(sorted(set(at)), len(item), errors)), default=None)
            if found and found[0] <= errors:
                out.append({"item_id": item_id, "distance": found[0], "end": found[1]})
        return sorted(out, key=lambda x: (x["item_id"] is not None, x["item_id"] or 0, x["distance"]))

    @staticmethod
    def _windows(starts: list[int], m: int, errors: int):
        a = b = None
        for s in starts:
            if a is not None and s - errors <= b:
                b = s + m + errors
                continue
            if a is not None:
                yield a, b
            a, b = s - errors, s + m + errors
        yield a, b

    @staticmethod
    def _verify(text, item, errors, masks, a, b):
        a, b = max(a, 0), max(b, 0)
        if not errors:
            at = text.find(item, a, b)
            return (0, at + len(item)) if at >= 0 else (1, 0)
        distance, end = best_occurrence(masks, len(item), text[a:b])
        return distance, a + end


def _scan(items):
    @F.arrow_udf(HIT)
    def scan(texts: pa.Array) -> pa.Array:
        if "matcher" not in made:
            made["matcher"] = Matcher(items.value)
        found = made["matcher"].hits
        return pa.array([found(t.as_py()) for t in texts], pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("end", pa.int64())])))

    made: dict = {}
    return scan.asNondeterministic()  # so that no filter on its result makes Spark run it twice


def blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text"):
    """The items as lists of (id, normalised text) with at most BLOCK_CHARS characters each."""
    block, size = [], 0
    for r in benchmark.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).toLocalIterator():
        text = normal(r[1])
        if block and size + len(text) > BLOCK_CHARS:
            yield block
            block, size = [], 0
        if text:
            block.append((r[0], text))
            size += len(text)
    if block:
        yield block


def _scanned(docs: DataFrame, benchmark: DataFrame, text: str, pick, written: list[str] | None) -> list[DataFrame]:
    """``pick(docs with a column of hits)`` for every block of the benchmark, written before the next block is read."""
    text_batches(docs.sparkSession)
    out = []
    for block in blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(block)
        out.append(materialize(pick(docs.withColumn("item hits", _scan(sent)(F.col(text).cast("string")))), "item-hits", written))
        sent.unpersist()
    return out


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            written: list[str] | None = None) -> DataFrame:
    """Rows (doc_id, item_id, distance, end_char), one per document row and item that occurs in it; clean
    documents give no row. end_char: where the best occurrence ends in the normalised text."""
    def pick(scanned):
        found = scanned.select("doc_id", F.explode("item hits").alias("h"))
        return found.select("doc_id", F.col("h.item_id").alias("item_id"), F.col("h.distance").alias("distance"), F.col("h.end").alias("end_char"))

    found = _scanned(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), benchmark, "text", pick, written)
    if not found:
        return docs.select(F.col(id_col).alias("doc_id"), *(F.lit(None).cast(t).alias(c) for c, t in
                           (("item_id", "long"), ("distance", "int"), ("end_char", "long")))).limit(0)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, written: list[str] | None = None) -> DataFrame:
    """``docs`` without the rows in which a test item occurs. The texts with hits are named by two hashes, which are sent to
    all executors while they are few and joined by shuffle beyond that."""
    def name(text):
        return [F.xxhash64(text).alias("hash a"), F.xxhash64(F.lit(1), text).alias("hash b")]

    found = _scanned(docs.select(F.col("text").cast("string").alias("text")), benchmark, "text",
                     lambda scanned: scanned.where(F.size("item hits") > 0).select(*name(F.col("text"))), written)
    if not found:
        return docs
    dirty = found[0]
    for f in found[1:]:
        dirty = dirty.unionByName(f)
    dirty = materialize(dirty.distinct(), "dirty-texts", written)
    if dirty.count() <= HASH_BROADCAST_ROWS:
        dirty = F.broadcast(dirty)
    a, b = name(docs["text"].cast("string"))
    return docs.join(dirty, (a == dirty["hash a"]) & (b == dirty["hash b"]), "left_anti").select(*[docs[c] for c in docs.columns])
