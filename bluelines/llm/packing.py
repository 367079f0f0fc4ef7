"""Operator 11: best-fit packing of token pieces into sequences, online and in bounded space.

Every task reads its documents once, cuts those over ``CAPACITY`` ids and places each piece, in the order of
arrival, into the open bin that it fills best. At most ``OPEN`` bins are open; they are found through a bitset
in which bit f is set while a bin with f free places is open: the best fit for n ids is the lowest bit from n
up. When one more bin is needed than may be open, the fullest closes first. Nothing is shuffled for that.

What a task still has open at its end goes to the next level: the pieces of ``FAN`` neighbouring tasks meet and
are placed again, longest first, among as many bins as came in; then the fullest close until ``OPEN`` are left,
which go to the level above. The last group closes its bins, so only there bins stay half empty. A group takes
at most FAN * OPEN bins of at most CAPACITY pieces each, however large the input.

Edge cases: null and empty texts are the end id alone; rows that repeat an id are packed each for itself; a
null id stays null; extra columns are not read; a very long text is cut into as many pieces as it takes, of
which only the last can be shorter; an empty table gives no piece. Ties: of bins with equal room the one that
came to this room last is taken. Reruns over the same files agree; another split of the input may pack otherwise.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bluelines.llm.common import in_chunks, text_batches
from bluelines.llm.word_ids import with_end, word_ids
from bluelines.session import materialize

CAPACITY = 4096
END_ID = 1
OPEN = 512
CHUNK, KNOWN_WORDS = 4 << 20, 400_000  # bytes of text encoded together, words kept by a worker
FAN = 8
NODE_BITS = 34  # a sequence id is (level, node, number of the bin there)
LEVEL_BITS = 58
PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
PLACED = PIECE.append(pa.field("sequence_id", pa.int64())).append(pa.field("offset", pa.int64())).append(
    pa.field("node", pa.int64())).append(pa.field("settled", pa.bool_()))
PLACED_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long, node long, settled boolean"


class Bins:
    """Open bins by free space; ``done`` collects (number of the bin, [(row, offset)]) of those that closed."""

    def __init__(self, capacity: int, most: int):
        self.capacity, self.most = capacity, most
        self.bits, self.room = 0, {}  # bit f: some open bin has f free; room[f]: those bins, youngest last
        self.open = self.made = 0
        self.done: list[tuple[int, list]] = []

    def _take(self, free: int) -> tuple[int, list]:
        bins = self.room[free]
        taken = bins.pop()
        if not bins:
            self.bits ^= 1 << free
        self.open -= 1
        return taken

    def place(self, row, length: int) -> None:
        fits = self.bits >> length
        if fits:
            free = length + (fits & -fits).bit_length() - 1
            number, rows = self._take(free)
        else:
            if self.open >= self.most and length < self.capacity:
                self.done.append(self._take((self.bits & -self.bits).bit_length() - 1))
            free, number, rows = self.capacity, self.made, []
            self.made += 1
        rows.append((row, self.capacity - free))
        left = free - length
        if left:
            bins = self.room.setdefault(left, [])
            bins.append((number, rows))
            self.bits |= 1 << left
            self.open += 1
        else:
            self.done.append((number, rows))

    def rest(self) -> list[tuple[int, list]]:
        """The open bins, fullest first."""
        return [b for free in sorted(self.room) for b in self.room[free]]


def _placed(bins: list[tuple[int, list]], level: int, node: int, settled: bool) -> pa.RecordBatch:
    base = (level << LEVEL_BITS) | (node << NODE_BITS)
    rows = [(*row, base | number, offset, node, settled) for number, held in bins for row, offset in held]
    columns = zip(*rows) if rows else [()] * len(PLACED)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PLACED)], schema=PLACED)


def pieces(keys: list, ids: np.ndarray, sizes: np.ndarray, capacity: int):
    """Rows of PIECE for documents whose ids lie one after the other."""
    raw, at = memoryview(ids.astype("<u4").tobytes()), 0
    for key, n in zip(keys, sizes.tolist()):
        for k, start in enumerate(range(0, n, capacity)):
            length = min(capacity, n - start)
            yield key, k, start, length, zlib.crc32(raw[4 * (at + start):4 * (at + start + length)])
        at += n


def _stream(tokenizer: str, end_id: int, capacity: int, most: int):
    def run(batches):
        enc, node, bins = word_ids(tokenizer, KNOWN_WORDS), TaskContext.get().partitionId(), Bins(capacity, most)
        for batch in batches:
            for a, b in in_chunks(batch.column(1), CHUNK):
                ids, sizes = with_end(*enc.encode(batch.column(1)[a:b]), end_id)
                for row in pieces(batch.column(0)[a:b].to_pylist(), ids, sizes, capacity):
                    bins.place(row, row[3])
                yield _placed(bins.done, 0, node, True)
                bins.done = []
        yield _placed(bins.rest(), 0, node, False)

    return run


def _again(level: int, last: bool, capacity: int, most: int):
    def run(key, part):
        rows = sorted(zip(*(part[c].to_pylist() for c in PIECE.names)), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, *r[1:]))
        node, bins = key[0].as_py(), Bins(capacity, FAN * most)
        for row in rows:
            bins.place(row, row[3])
        rest = bins.rest()
        closed, rest = (rest, []) if last else (rest[:-most], rest[-most:])
        return pa.Table.from_batches([_placed(bins.done + closed, level, node, True), _placed(rest, level, node, False)])

    return run


def pack(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
         capacity: int = CAPACITY, most: int = OPEN, written: list[str] | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    text_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    placed = materialize(src.mapInArrow(_stream(tokenizer, end_id, capacity, most), PLACED_DDL), "packed", written)
    nodes = (placed.agg(F.max("node")).first()[0] or 0) + 1
    done, level = [placed.where("settled")], 0
    while True:
        level, nodes = level + 1, -(-nodes // FAN)
        left = placed.where("not settled").withColumn("node", F.floor(F.col("node") / FAN))
        again = left.groupBy("node").applyInArrow(_again(level, nodes == 1, capacity, most), PLACED_DDL)
        placed = materialize(again, "packed", written)
        done.append(placed.where("settled"))
        if nodes == 1:
            break
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.drop("node", "settled")
