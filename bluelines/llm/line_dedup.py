"""Operator 7: line dedup by a segment-partition edit join.

Lines are cut at newlines and stripped of ASCII white space. Two different lines of at least ``SHORT``
characters are linked if few edits (characters inserted, deleted, replaced) turn one into the other:
at most one per ``RATE`` characters of the longer line, but ``EDITS`` in any case; shorter lines match
only if equal. Linked and equal lines form classes.

1. Lines under ``LONG`` (``EDITS`` edits): each line of length l is cut into EDITS + 1 segments. A line
   within EDITS edits of it, of the same or greater length, holds one of the segments unchanged near its
   place, so every line also looks up the substrings that may be a segment of a line of its length, one
   less, and so on; which places need looking up follows from how many edits can lie left and right of
   the segment. Segments and substrings become 64-bit keys of (length, segment number, content).
   Longer lines: the keys are windows of ``WINDOW`` characters that start with a space, the first of a line in the
   order of their hashes, so many that one more of them do not overlap than a partner can have edits. Close lines
   share one: of the line that stops earlier in that order one window is unchanged in the other line, which goes on
   at least as far. A line with too few such windows gives them all, and the first of the windows at all places.
2. Keys travel as arrays, one row per part of the keys and task. A key is open if different lines have it, one of them
   as a segment or window. Of a key of up to 2 * ``BLOCK`` lines those stay that have a partner whose length and place
   of the key differ by no more than the limit of edits; larger ones are cut into blocks of ``BLOCK`` by length, and
   pairs of blocks of near lengths stay. Of keys with the same lines one stays. Of the lines that stay the first
   occurrence is read again, from the documents that hold it.
3. Each pair of blocks is one task's work, where pairs that lengths and counts of neighbouring characters do not rule
   out are verified by their edit distance, many at once, in the first key that they share; lines of large keys that
   are left no partner go before their texts are sent. A task returns how many links each line has, and only as
   many links as join its components.

No pairs are shuffled and nothing is capped; the texts of a large key's lines do not meet in one task, their hashes, lengths
and places do (20 bytes a line). Keys of equal lines of a chunk are combined before the shuffle.

Edge cases: blank lines belong to no class (null) and are kept; null and empty texts and null ids
have lines of their own like any other (a null text has none); rows that repeat an id count as
further lines; extra columns are not read.
"""

from __future__ import annotations

from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bluelines.llm.bitparallel import Texts
from bluelines.llm.common import components, in_chunks, text_batches
from bluelines.llm.shingles import mix
from bluelines.session import materialize

EDITS = 2
RATE = 40
SHORT = 20
WINDOW = 16
LONG = (EDITS + 1) * RATE  # from this length on a line may differ in more than EDITS
BLOCK = 1024
BINS = 32  # of hashed pairs of neighbouring characters
MORE_BINS = 256  # the same for lines that are verified
KEY_BROADCAST_ROWS = 500_000  # open keys or lines (8 bytes each) sent to all executors; more are joined by shuffle
CHUNK = 1 << 20
STRETCH = 1 << 14  # characters summed in one go, so that they stay in the processor's cache
KEY_PARTS = 4  # parts that keys are dealt to, per shuffle partition
KEYS_HELD = 250_000  # keys that a task holds before it deals them
EARLY = 4  # keys of a line that are compared for all pairs at once
PAIRS_HELD = 20_000  # pairs of lines verified at once, about
NULL_ID = -(2**63)  # stands for a null document id
_U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_FEW = _U(2**64 // 3)  # the first third of the windows by hash
_BLANK = " \t\r\x0b\x0c"


def _code(points: np.ndarray, which: int) -> np.ndarray:
    return mix(points + _U(_BASES[which]))


@lru_cache(2)
def _codes(which: int) -> np.ndarray:
    """Codes of the points of the basic plane."""
    return _code(np.arange(1 << 16, dtype=np.uint64), which)


@lru_cache(4)
def _powers(which: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_BASES[which], pow(_BASES[which], -1, 2**64)):
        p = np.full(size + 1, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


class Lines:
    """The lines of some texts as one array of code points, with hashes of any stretch of it."""

    def __init__(self, texts: list[str | None]):
        self.text: list[str] = []
        owner, number = [], []
        for k, t in enumerate(texts):
            if t is not None:
                own = [x.strip(_BLANK) for x in t.split("\n")]
                owner += [k] * len(own)
                number += range(len(own))
                self.text += own
        self.owner, self.number = np.array(owner, np.int64), np.array(number, np.int64)
        self.length = np.array([len(x) for x in self.text], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.points = np.frombuffer("".join(self.text).encode("utf-32-le", "surrogatepass"), np.uint32)
        self.sums: dict[int, np.ndarray] = {}

    def _sums(self, which: int) -> np.ndarray:
        """Prefix sums of the points' codes times powers, made when first asked for."""
        if which not in self.sums:
            n, total = len(self.points), np.zeros(len(self.points) + 1, np.uint64)
            codes, powers = _codes(which), _powers(which, 1 << max(20, n.bit_length()))[0]
            basic = not n or self.points.max() < len(codes)
            for a in range(0, n, STRETCH):
                b = min(a + STRETCH, n)
                spread = codes.take(self.points[a:b]) if basic else _code(self.points[a:b].astype(np.uint64), which)
                spread *= powers[a:b]
                spread[:1] += total[a:a + 1]
                np.cumsum(spread, out=total[a + 1:b + 1])
            self.sums[which] = total
        return self.sums[which]

    def hash(self, start: np.ndarray, length: np.ndarray, which: int = 0) -> np.ndarray:
        total, n = self._sums(which), len(self.points)
        inverse = _powers(which, 1 << max(20, n.bit_length()))[1]
        return mix((total[start + length] - total[start]) * inverse[start] + length.astype(np.uint64))

    def ids(self) -> np.ndarray:
        """Hashes of the lines, even, so that ``_occurrences`` can put a flag into the last bit."""
        return (self.hash(self.start, self.length) & ~_U(1)).view(np.int64)

    def checks(self) -> np.ndarray:
        """Other hashes, as two lines may have the same id."""
        return np.array([crc32(x.encode("utf-8", "surrogatepass")) for x in self.text], np.int64)

    def keys(self):
        """(line, key, whether the line is to be found by it) of all lines that take part."""
        for line, key, own, _ in self.places():
            yield line, key, own

    def places(self):
        """The same with the places in the lines."""
        n = EDITS + 1
        for less in range(n):
            size = self.length - less  # of the lines looked up
            for i in range(n):
                base, longer = size // n, size % n
                begin = i * base + np.maximum(0, i - (n - longer))
                width = base + (i >= n - longer)
                for shift in range(max(-i, less - (EDITS - i)), min(i, less + EDITS - i) + 1):
                    at = begin + shift
                    line = np.flatnonzero((size >= max(SHORT, n)) & (self.length < LONG) & (at >= 0) & (at + width <= self.length))
                    found = self.hash(self.start[line] + at[line], width[line])
                    key = mix(found + (size[line] * n + i).astype(np.uint64) * _U(0xD6E8FEB86659FD93))
                    yield line, key.view(np.int64), less == 0 and shift == 0, at[line]
        yield from self._window_places()

    def _window_places(self):
        """The same for lines of ``LONG`` characters and those that may be close to one."""
        most = self.length // (RATE - 1)  # edits to the longest line that can be close
        left = most > EDITS
        for kind, ordinary in enumerate((True, False)):
            if not left.any():
                return
            at = np.flatnonzero(self.points == 32) if ordinary else np.flatnonzero(np.repeat(left, self.length))
            line = np.searchsorted(self.start, at, "right") - 1  # the last of the lines that begin there; those before it are empty
            fits = left[line] & (at - self.start[line] + WINDOW <= self.length[line])
            line, at = line[fits], at[fits]
            found = self.hash(at, np.full(len(at), WINDOW))
            chosen, enough = np.zeros(len(at), bool), np.zeros(len(left), bool)
            for share in (_FEW, _U(2**64 - 1)):  # for most lines the first windows by hash are enough
                few = np.flatnonzero((found <= share) & ~enough[line])
                picked, fine = _first_windows(line[few], at[few], found[few], most + 1)
                chosen[few[picked]] = True
                enough |= fine
            pick = np.flatnonzero(chosen | ~enough[line])
            key = mix(found[pick] + _U((kind + 1) * 0x9E3779B97F4A7C15 % 2**64)).view(np.int64)
            yield line[pick], key, True, at[pick] - self.start[line[pick]]
            left = left & ~enough


def _apart(line, at, most):
    """How many windows that do not overlap each line has, of windows in order of place; not all if more than ``most[line]``."""
    nth = np.arange(1, len(at) + 1)  # the next window that does not overlap
    todo = np.arange(len(at) - 1)
    while len(todo := todo[at[np.minimum(nth[todo], len(at) - 1)] - at[todo] < WINDOW]):
        nth[todo] += 1
        todo = todo[nth[todo] < len(at)]
    count = np.zeros(len(most), np.int64)
    now = np.flatnonzero(np.insert(line[1:] != line[:-1], 0, True)) if len(at) else todo
    while len(now) > 8:
        here = line[now]
        count[here] += 1
        now = nth[now]
        stays = (now < len(at)) & (count[here] < most[here])
        now, here = now[stays], here[stays]
        now = now[line[now] == here]
    for k in now.tolist():  # few lines, mostly long ones
        free = 0
        for place in at[k:np.searchsorted(line, line[k], "right")].tolist():
            if place >= free:
                count[line[k]] += 1
                free = place + WINDOW
    return count


def _first_windows(line, at, rank, need):
    """Of windows in order of place: which are in the smallest group of a line's first by rank (about) that holds
    ``need[line]`` windows that do not overlap; and which lines have so many."""
    size = np.bincount(line, minlength=len(need))
    begin, bits = np.cumsum(size) - size, len(need).bit_length()
    order = np.argsort(line.astype(np.uint64) << _U(64 - bits) | rank >> _U(bits))
    take, chosen, enough = np.minimum(size, need + need // 3 + 1), np.zeros(len(at), bool), np.zeros(len(need), bool)
    todo = (size >= need) & (size > 0)
    while todo.any():
        top = np.zeros(len(need), np.uint64)
        top[todo] = rank[order[begin[todo] + take[todo] - 1]]
        pick = np.flatnonzero(todo[line] & (rank <= top[line]))  # with all of the same rank
        got = todo & (_apart(line[pick], at[pick], need) >= need)
        chosen[pick[got[line[pick]]]] = True
        enough |= got
        todo &= ~got & (take < size)
        take = np.minimum(size, take + take // 6 + 1)
    return chosen, enough


KEY_TYPES = [("key", np.uint32), ("id", np.uint64), ("size", np.uint32), ("place", np.uint32)]
KEY_BYTES = sum(np.dtype(t).itemsize for _, t in KEY_TYPES)
OCCURRENCES = pa.schema([*((c, pa.int64()) for c in ("doc_id", "line_no", "id", "check", "size")), ("part", pa.int32()), ("keys", pa.binary())])


def _dealt(held: list[tuple], parts: int) -> pa.RecordBatch:
    """One row per part of the keys: its keys as the bytes of one array per column."""
    key, *columns = (np.concatenate(c) for c in zip(*held))
    part = (key >> _U(32)) % _U(parts)
    order = np.argsort(part.astype(np.uint16 if parts <= 1 << 16 else np.uint32), kind="stable")
    columns = [c[order].astype(t) for c, (_, t) in zip([key & _U(2**32 - 1), *columns], KEY_TYPES)]
    cuts = np.flatnonzero(np.bincount(part.astype(np.int64), minlength=parts))
    ends = np.cumsum(np.bincount(part.astype(np.int64), minlength=parts))[cuts].tolist()
    blobs = [b"".join(c[a:b].tobytes() for c in columns) for a, b in zip([0, *ends], ends)]
    own = {"part": pa.array(cuts, pa.int32()), "keys": pa.array(blobs, pa.binary())}
    return pa.RecordBatch.from_arrays([own.get(f.name, pa.nulls(len(blobs), f.type)) for f in OCCURRENCES], schema=OCCURRENCES)


def _occurrences(parts: int):
    """All lines, and the keys of those that a chunk holds, dealt to ``parts`` by key."""
    def run(batches):
        held, n = [], 0
        for batch in batches:
            for a, b in in_chunks(batch.column(1), CHUNK):
                lines = Lines(batch.column(1)[a:b].to_pylist())
                ids = lines.ids()
                own = {"doc_id": batch.column(0)[a:b].take(pa.array(lines.owner)), "line_no": lines.number, "id": ids,
                       "check": lines.checks(), "size": lines.length}
                yield pa.RecordBatch.from_arrays([pa.array(own[f.name]) if f.name in own else pa.nulls(len(ids), f.type) for f in OCCURRENCES], schema=OCCURRENCES)
                first = np.zeros(len(ids), bool)
                first[np.unique(ids, return_index=True)[1]] = True  # equal lines of a chunk give their keys once
                for line, key, mine, at in lines.places():
                    pick = first[line]
                    line, at = line[pick], at[pick]
                    held.append((key[pick].view(np.uint64), ids[line].view(np.uint64) | _U(mine), lines.length[line], at))
                    n += len(at)
                if n >= KEYS_HELD:
                    yield _dealt(held, parts)
                    held, n = [], 0
        if n:
            yield _dealt(held, parts)
    return run


def _open_lines(part: int, blobs: list[bytes], block: int):
    """Of the keys of a part those that different lines have, one to be found by it: the lines that have a partner of
    near length and place, or all in pairs of blocks of near lengths if there are many."""
    columns, before = [], 0
    for _, t in KEY_TYPES:
        wide = np.dtype(t).itemsize
        columns.append(np.concatenate([np.frombuffer(b, t, len(b) // KEY_BYTES, len(b) // KEY_BYTES * before) for b in blobs]))
        before += wide
    spread = np.sort(columns[0].astype(np.uint64) << _U(32) | np.arange(len(columns[0]), dtype=np.uint64))
    same = spread[1:] >> _U(32) == spread[:-1] >> _U(32)
    pick = (spread[np.append(same, False) | np.insert(same, 0, False)] & _U(2**32 - 1)).astype(np.int64)
    key, ids, size, low = (c[pick] for c in columns)
    key, size, low = key.astype(np.int64), size.astype(np.int64), low.astype(np.int64)
    own, ids = (ids & _U(1)).astype(np.int64), (ids & ~_U(1)).view(np.int64)
    order = np.lexsort((ids, size, key))
    key, ids, size, low, own = (c[order] for c in (key, ids, size, low, own))
    first = np.flatnonzero(np.insert((key[1:] != key[:-1]) | (ids[1:] != ids[:-1]), 0, True)) if len(key) else order
    if len(first) < 2:
        return
    key, ids, size = key[first], ids[first], size[first]  # a line once per key
    low, high, own = np.minimum.reduceat(low, first), np.maximum.reduceat(low, first), np.maximum.reduceat(own, first)  # it may have it at several places
    new = np.insert(key[1:] != key[:-1], 0, True)
    run = np.cumsum(new) - 1
    count, last = np.bincount(run), np.searchsorted(run, run, "right")
    stays, rest, step = np.zeros(len(key), bool), size - high, 1
    i = np.flatnonzero(count[run] <= 2 * block)
    while len(i):
        i = i[i + step < last[i]]
        j = i + step
        limit = np.maximum(EDITS, size[j] // RATE)
        near = size[j] - size[i] <= limit  # lengths rise in a key
        i, j, limit = i[near], j[near], limit[near]
        left = np.maximum(0, np.maximum(low[i] - high[j], low[j] - high[i]))  # edits before the place at least, and after it
        right = np.maximum(0, np.maximum(rest[i] - size[j] + low[j], rest[j] - size[i] + low[i]))
        fits = (left + right <= limit) & (own[i] | own[j] > 0)
        stays[i[fits]] = stays[j[fits]] = True
        step += 1
    if stays.any():
        begins = np.flatnonzero(np.insert(np.diff(run[stays]) > 0, 0, True))
        yield _cells(part, key[stays][begins], 0, 0, 0, ids[stays], begins, ids[stays], begins)
    for r in np.flatnonzero((count > 2 * block) & (np.bincount(run, own) > 0)):
        begin = int(np.searchsorted(run, r))
        starts, of_key = range(begin, begin + int(count[r]), block), ids[begin:begin + int(count[r])]
        ends = [min(a + block, starts.stop) for a in starts]
        for i, (a, b) in enumerate(zip(starts, ends)):
            for j in range(i, len(ends)):
                c, d = starts[j], ends[j]
                if size[c] - max(EDITS, size[c] // RATE) > size[b - 1]:
                    break
                for side, block_ids in enumerate((ids[a:b], ids[c:d])[:1 + (i < j)]):
                    yield _cells(part, key[a:a + 1], i, j, side, block_ids, [0], of_key, [0])


def _cells(part, key, i, j, side, ids, begins, of_key, key_begins) -> pa.RecordBatch:
    """Rows of lines of open keys, with the number and two sums of all lines of the key."""
    code = of_key.view(np.uint64)
    ends = np.append(begins, len(ids)).astype(np.int32)
    alike = {"n": np.diff(np.append(key_begins, len(of_key))), "x": np.bitwise_xor.reduceat(mix(code), key_begins).view(np.int64),
             "y": np.add.reduceat(mix(code + _U(_BASES[1])), key_begins).view(np.int64)}
    where = {c: np.full(len(key), v, np.int32) for c, v in (("i", i), ("j", j), ("side", side))}
    return pa.RecordBatch.from_pydict({"key": (part << 32) + key, **where, **alike, "ids": pa.ListArray.from_arrays(ends, ids)})


def _open(block: int):
    """``_open_lines`` of each part; rows come in order of parts."""
    def run(batches):
        now, blobs = None, []
        for batch in batches:
            for part, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if part != now and blobs:
                    yield from _open_lines(now, blobs, block)
                    blobs = []
                now = part
                blobs.append(blob.as_buffer())
        if blobs:
            yield from _open_lines(now, blobs, block)
    return run


def _pair_counts(texts: list[str], bins: int = BINS) -> np.ndarray:
    """How often pairs of neighbouring characters occur in each text, by hash into ``bins`` bins of up to 255. An edit
    changes the bins by four at most, so lines whose bins differ in more than four per edit are not close."""
    size = np.array([len(t) for t in texts], np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(points) < 2:
        return np.zeros((len(texts), bins), np.uint8)
    owner = np.repeat(np.arange(len(size)), size)
    inside = owner[1:] == owner[:-1]
    spot = (points[1:] * np.uint32(40503) + points[:-1] * np.uint32(2654435761 % 2**32)) >> np.uint32(16)
    cell = owner[1:][inside] * bins + (spot[inside] % bins).astype(np.int64)
    counts = np.bincount(cell, minlength=len(texts) * bins).reshape(-1, bins)
    return np.minimum(counts, 255).astype(np.uint8)


def _texts(batches):
    """Batches of text and the numbers of the lines asked for: those lines with their hashes."""
    for batch in batches:
        for a, b in in_chunks(batch.column(0), CHUNK):
            asked = []
            for text, numbers in zip(batch.column(0)[a:b].to_pylist(), batch.column(1)[a:b].to_pylist()):
                own = [] if text is None else text.split("\n")
                asked += [own[n] for n in numbers if n < len(own)]
            lines = Lines(asked)
            yield pa.RecordBatch.from_pydict({"id": lines.ids(), "check": lines.checks(),
                                              "size": lines.length, "bins": pa.array([b.tobytes() for b in _pair_counts(lines.text)], pa.binary()),
                                              "line": pa.array(lines.text, pa.string())})


CELL_COLS = ["key", "i", "j", "side", "id", "check"]
LINKS = "a_id long, a_check long, b_id long, b_check long, links long"


def _begins(rows: pa.Table) -> np.ndarray:
    """Where a pair of blocks begins."""
    new = np.zeros(rows.num_rows, bool)
    new[:1] = True
    for c in ("key", "i", "j"):
        col = rows[c].to_numpy()
        new[1:] |= col[1:] != col[:-1]
    return new


def _per_cell(work):
    """``work`` on tables of whole pairs of blocks from sorted rows; the last pair of a batch may go on in the next."""
    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            rows = pa.Table.from_batches([*held, batch]).combine_chunks()
            begins = np.flatnonzero(_begins(rows))
            cut = int(begins[-1]) if len(begins) else 0
            if cut:
                yield work(rows.slice(0, cut))
            held = rows.slice(cut).to_batches()
        if held:
            yield work(pa.Table.from_batches(held))
    return run


def _pairs(rows: pa.Table):
    """(places of one line, places of the other) in steps: all pairs that a pair of blocks brings together, but equal lines."""
    ids, check, side = (rows[c].to_numpy() for c in ("id", "check", "side"))
    cell = np.cumsum(_begins(rows)) - 1
    place, last = np.arange(len(cell)), np.searchsorted(cell, cell, "right")
    two = np.bincount(cell, side)[cell] > 0
    more = last - place - 1  # partners that follow a line
    ends = np.cumsum(more)
    a = done = 0
    while a < len(place):
        b = max(a + 1, int(np.searchsorted(ends, done + PAIRS_HELD, "right")))
        i = np.repeat(place[a:b], more[a:b])
        j = np.arange(1, len(i) + 1) + i - np.repeat(ends[a:b] - more[a:b] - done, more[a:b])
        asked = (~two[i] | (side[i] != side[j])) & ((ids[i] != ids[j]) | (check[i] != check[j]))
        yield i[asked], j[asked]
        a, done = b, int(ends[b - 1])


def _near(rows: pa.Table):
    """Those of ``_pairs`` that lengths and counts of neighbouring characters do not rule out, with their limits of edits."""
    size = rows["size"].to_numpy()
    bins = np.frombuffer(b"".join(rows["bins"].to_pylist()), np.uint8).reshape(-1, BINS).astype(np.int16)
    for i, j in _pairs(rows):
        limit = np.maximum(EDITS, np.maximum(size[i], size[j]) // RATE)
        near = np.flatnonzero(np.abs(size[i] - size[j]) <= limit)
        near = near[np.abs(bins[i[near]] - bins[j[near]]).sum(1, dtype=np.int64) <= 4 * limit[near]]
        if len(near):
            yield i[near], j[near], limit[near]


def _candidates(rows: pa.Table) -> pa.RecordBatch:
    """The lines of pairs of blocks that lengths and counts of neighbouring characters leave a partner."""
    stays = np.zeros(rows.num_rows, bool)
    for i, j, _ in _near(rows):
        stays[i] = stays[j] = True
    return pa.RecordBatch.from_arrays([pa.array(rows[c].to_numpy()[stays]) for c in CELL_COLS], CELL_COLS)


def _early(here: np.ndarray, keys: pa.ListArray):
    """The keys of each row's line before the row's own, sorted, where they begin and end, the first ones as a matrix, and
    bits that tell rows apart that share none. A pair is verified in the first key that it shares."""
    nth = np.arange(len(here))
    flat, owner = keys.flatten().to_numpy(), np.repeat(nth, keys.value_lengths().to_numpy())
    flat, owner = flat[flat < here[owner]], owner[flat < here[owner]]
    order = np.lexsort((flat, owner))
    flat, owner = flat[order], owner[order]
    begin, end = np.searchsorted(owner, nth), np.searchsorted(owner, nth, "right")
    rank = np.arange(len(flat)) - begin[owner]
    some = np.repeat(-1 - nth[:, None], EARLY, 1)
    some[owner[rank < EARLY], rank[rank < EARLY]] = flat[rank < EARLY]
    marks = np.zeros(len(here), np.uint64)
    np.bitwise_or.at(marks, owner, _U(1) << (mix(flat.view(np.uint64)) >> _U(58)))
    return flat, begin, end, some, marks


def _verify(rows: pa.Table) -> pa.RecordBatch:
    """Pairs of blocks of lines with one open key: a row per line with links (how many; b is null), and a row per link
    that joins two components."""
    here, ids, check = (rows[c].to_numpy() for c in ("key", "id", "check"))
    line = rows["line"]
    early, begin, end, some, marks = _early(here, rows["keys"].combine_chunks())
    comp, count, out = list(range(len(ids))), np.zeros(len(ids), np.int64), []

    def root(k):
        while comp[k] != k:
            comp[k] = comp[comp[k]]
            k = comp[k]
        return k

    def link(i, j, limit):
        used, of = np.unique(np.concatenate([i, j]), return_inverse=True)
        own = line.take(pa.array(used)).to_pylist()
        text, bins, x, y = Texts(own), _pair_counts(own, MORE_BINS).astype(np.int16), of[:len(i)], of[len(i):]
        most = 4 * limit - np.abs(text.size[x] - text.size[y])  # a character inserted or deleted changes three bins
        few = np.concatenate([np.abs(bins[x[a:a + 2048]] - bins[y[a:a + 2048]]).sum(1, dtype=np.int64) for a in range(0, len(x), 2048)]) <= most
        near = np.flatnonzero(few)[text.within(x[few], y[few], limit[few])]
        i, j = i[near], j[near]
        count[:] += np.bincount(i, minlength=len(count)) + np.bincount(j, minlength=len(count))
        for a, b in zip(i.tolist(), j.tolist()):
            if (a := root(a)) != (b := root(b)):
                comp[b] = a
                out.append((ids[a], check[a], ids[b], check[b], 0))

    held, n = [], 0
    for i, j, limit in _near(rows):
        apart = marks[i] & marks[j] == 0
        doubt = np.flatnonzero(~apart)
        doubt = doubt[(some[i[doubt], :, None] != some[j[doubt], None, :]).all((1, 2))]
        for k in doubt.tolist():
            apart[k] = not np.isin(early[begin[i[k]]:end[i[k]]], early[begin[j[k]]:end[j[k]]]).any()
        held.append((i[apart], j[apart], limit[apart]))
        n += len(held[-1][0])
        if n >= PAIRS_HELD:
            link(*(np.concatenate(c) for c in zip(*held)))
            held, n = [], 0
    if n:
        link(*(np.concatenate(c) for c in zip(*held)))
    out += [(ids[k], check[k], None, None, count[k]) for k in np.flatnonzero(count)]
    names = [c.split()[0] for c in LINKS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([None if r[k] is None else int(r[k]) for r in out], pa.int64()) for k in range(len(names))], names)


def _only(df, keys, col):
    few = keys.count() <= KEY_BROADCAST_ROWS
    return df.join(F.broadcast(keys) if few else keys, col, "left_semi")


def line_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", written: list[str] | None = None) -> DataFrame:
    """Rows (doc_id, line_no, class_doc_id, class_line_no, links, kept), one per line of each text. The
    class is named by its first line (smallest document id, then line number); links counts the other
    lines (each text once) close to it; kept marks the first line of each class."""
    text_batches(docs.sparkSession)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    parts = KEY_PARTS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lines = materialize(src.mapInArrow(_occurrences(parts), "doc_id long, line_no long, id long, check long, size long, part int, keys binary"), "lines", written)
    spread = lines.where("part is not null").select("part", "keys").repartition("part").sortWithinPartitions("part")
    rows = spread.mapInArrow(_open(BLOCK), "key long, i int, j int, side int, n long, x long, y long, ids array<long>")
    # of keys with the same lines one is enough
    rows = rows.groupBy("i", "j", "side", "n", "x", "y").agg(F.min("key").alias("key"), F.first("ids").alias("ids"))
    many = (F.col("n") > 2 * BLOCK).alias("many")
    rows = materialize(rows.select("key", "i", "j", "side", many, F.explode("ids").alias("id")), "open-lines", written)
    lines = lines.where("part is null").drop("part", "keys")
    firsts = lines.where("size > 0").groupBy("id", "check").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(NULL_ID)).alias("d"), "line_no")).alias("first"))
    firsts = materialize(firsts, "first-lines", written)
    asked = materialize(_only(firsts, materialize(rows.select("id").distinct(), "line-ids", written), "id"), "asked-lines", written)
    wanted = asked.groupBy(F.col("first.d").alias("d")).agg(F.collect_set("first.line_no").alias("numbers"))  # of one document
    wanted = materialize(wanted, "wanted-lines", written)
    few = wanted.count() <= KEY_BROADCAST_ROWS
    read = src.join(F.broadcast(wanted) if few else wanted, F.coalesce("doc_id", F.lit(NULL_ID)) == F.col("d")).select("text", "numbers")
    texts = read.mapInArrow(_texts, "id long, check long, size long, bins binary, line string").dropDuplicates(["id", "check"])
    texts = materialize(texts, "line-texts", written)
    dealt = lambda df: df.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    keys = rows.groupBy("id").agg(F.collect_set("key").alias("keys"))  # of a line
    full = texts.join(keys, "id")
    cells = rows.where("not many").drop("many").join(full, "id")
    if not rows.where("many").isEmpty():  # of keys of many lines only those go on that have a partner
        large = dealt(rows.where("many").join(texts.select("id", "check", "size", "bins"), "id"))
        large = large.mapInArrow(_per_cell(_candidates), "key long, i int, j int, side int, id long, check long")
        cells = cells.unionByName(materialize(large, "line-cells", written).join(full, ["id", "check"]))
    cells = dealt(cells.select(*CELL_COLS, "size", "bins", "line", "keys"))
    found = cells.mapInArrow(_per_cell(_verify), LINKS)
    found = materialize(found, "line-links", written)

    name = lambda side: asked.select(F.col("id").alias(f"{side}_id"), F.col("check").alias(f"{side}_check"), F.col("first").alias(side))
    linked = found.where("b_id is not null").join(name("a"), ["a_id", "a_check"]).join(name("b"), ["b_id", "b_check"]).select("a", "b")
    comp = materialize(components(linked, "lines", written), "line-components", written)
    counts = found.where("b_id is null").groupBy(F.col("a_id").alias("id"), F.col("a_check").alias("check")).agg(F.sum("links").alias("links"))
    counts = counts.join(asked, ["id", "check"])
    linked = counts.join(comp, counts["first"] == comp["id"]).select(counts["id"], "check", "links", "component")
    out = lines.join(firsts, ["id", "check"], "left").join(linked, ["id", "check"], "left")
    out = out.withColumn("class", F.coalesce("component", "first"))
    class_doc = F.when(F.col("class.d") > NULL_ID, F.col("class.d"))
    first = F.col("class").isNull() | ((F.coalesce("doc_id", F.lit(NULL_ID)) == F.col("class.d")) & (F.col("line_no") == F.col("class.line_no")))
    return out.select("doc_id", "line_no", class_doc.alias("class_doc_id"), F.col("class.line_no").alias("class_line_no"),
                      F.when(F.col("class").isNotNull(), F.coalesce("links", F.lit(0))).alias("links"), first.alias("kept"))
