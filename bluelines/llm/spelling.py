"""Operator 13: spelling variants by a frequency-vector trie.

Words are the maximal letter runs of all texts (a run of a document loses one letter where the contract says
so) with at least ``LEAST_LENGTH`` code points and ``LEAST_COUNT`` occurrences. Letters fall into ``GROUPS``
groups; a word's path in the trie is its count of letters of each group, one level after the other. One
edit changes the counts by at most one surplus and one deficit, so a depth-first search that may spend one of
each meets every near word; at the leaves words are compared letter by letter.

The trie is cut into parts that share a path of ``depth`` levels. A part holds the words on its path and those
with one letter more in one of these levels; a pair belongs to the part of the lower counts of both, so it is
met in exactly one. A part of more than ``PART_WORDS`` words is cut again two levels deeper, whatever it takes
down to the last level. What is still too large there (words of one letter stock) is matched by spelling:
words that are equal when one letter is left out.

Every part gives per word its number of near words and the best of them, never the pairs; these are added up.
Forms are followed to the last by pointer doubling; counts grow tenfold each step, so a few rounds do.

Edge cases: null and empty texts have no words; for a null id the hashed text starts with
the colon; rows that repeat an id count each; very long texts are read whole; ties go to the word that is smaller
in code points; extra columns are not read; an empty table gives no word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bluelines.llm.common import ascii_lower
from bluelines.session import materialize

LETTERS = r"[A-Za-zÀ-ÿ]"
LEAST_LENGTH = 7
LEAST_COUNT = 2
CUT_EVERY = 31
TIMES = 10  # a form has at least so many times the word's occurrences
GROUPS = 16
STEP = 2  # levels by which a large part is cut again
PART_WORDS = 10_000
FOUND = "word string, n_near long, best struct<n: long, word: string>"
MEMBER = "part binary, word string, n long, counts binary"


# ---- words ------------------------------------------------------------------------------------

def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words, after the deletions, of at least LEAST_LENGTH code points."""
    runs = F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(f"{LETTERS}{{{LEAST_LENGTH},}}"), F.lit(0))
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    run = docs.select(key.alias("key"), F.explode(runs).alias("run")).select("key", ascii_lower(F.col("run")).alias("run"))
    h = F.crc32(F.concat("key", F.lit(":"), "run").cast("binary"))
    at = (h % F.char_length("run")).cast("int")
    cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    word = F.when(h % CUT_EVERY == 0, cut).otherwise(F.col("run"))
    out = run.select(word.alias("word")).where(F.char_length("word") >= LEAST_LENGTH)
    return out.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


# ---- paths ------------------------------------------------------------------------------------

def counts_of(words: list[str]) -> np.ndarray:
    """Letter-group counts, one row a word: letters go round the groups by code point."""
    sizes = np.array([len(w) for w in words], np.int64)
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    cells = np.repeat(np.arange(len(words)) * GROUPS, sizes) + points % GROUPS
    return np.minimum(np.bincount(cells, minlength=len(words) * GROUPS), 255).reshape(-1, GROUPS).astype(np.uint8)


def _vectors(batches):
    for batch in batches:
        counts = counts_of(batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes() for c in counts], pa.binary())],
                                         ["word", "n", "counts"])


def _members(depth: int):
    """Each word once for the part on its path and once for each part that has one letter less in a level."""
    def run(batches):
        for batch in batches:
            rows, parts = [], []
            for k, counts in enumerate(batch.column(2).to_pylist()):
                head = counts[:depth]
                rows.append(k)
                parts.append(head)
                for j, c in enumerate(head):
                    if c:
                        rows.append(k)
                        parts.append(head[:j] + bytes((c - 1,)) + head[j + 1:])
            taken = batch.take(pa.array(rows, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(parts, pa.binary()), *taken.columns], ["part", "word", "n", "counts"])

    return run


# ---- search of a part -------------------------------------------------------------------------

def one_edit(a: str, b: str) -> bool:
    """Do two different words differ by one inserted, deleted or replaced code point?"""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = 0
    while k < len(a) and a[k] == b[k]:
        k += 1
    return a[k:] == b[k + 1:] if len(a) < len(b) else a[k + 1:] == b[k + 1:]


def trie(vectors: list[bytes]) -> dict:
    root: dict = {}
    for v in vectors:
        node = root
        for c in v:
            node = node.setdefault(c, {})
    return root


def near_vectors(root: dict, vector: bytes):
    """Vectors of the trie with at most one letter more in one group and one less in another, depth first."""
    last = len(vector)
    stack = [(root, 0, 1, 1, b"")]  # node, level, surplus and deficit left, path
    while stack:
        node, level, more, less, path = stack.pop()
        if level == last:
            yield path
            continue
        c = vector[level]
        if c in node:
            stack.append((node[c], level + 1, more, less, path + bytes((c,))))
        if more and c + 1 in node:
            stack.append((node[c + 1], level + 1, 0, less, path + bytes((c + 1,))))
        if less and c and c - 1 in node:
            stack.append((node[c - 1], level + 1, more, 0, path + bytes((c - 1,))))


class Best:
    """Near words counted and the best kept: most occurrences, then smallest."""

    def __init__(self):
        self.found: dict[str, list] = {}

    def link(self, a: str, n: int, b: str, m: int) -> None:
        for word, other, k in ((a, b, m), (b, a, n)):
            mine = self.found.setdefault(word, [0, 0, ""])
            mine[0] += 1
            if k > mine[1] or (k == mine[1] and other < mine[2]):
                mine[1:] = k, other

    def table(self) -> pa.Table:
        best = pa.StructArray.from_arrays([pa.array([f[1] for f in self.found.values()], pa.int64()),
                                           pa.array([f[2] for f in self.found.values()], pa.string())], ["n", "word"])
        return pa.table({"word": pa.array(list(self.found), pa.string()),
                         "n_near": pa.array([f[0] for f in self.found.values()], pa.int64()), "best": best})


def search_part(part: bytes, words: list[str], n: list[int], counts: list[bytes]) -> pa.Table:
    """Near words of a part, each pair whose lower counts are ``part`` once."""
    depth, by = len(part), {}
    for row in zip(words, n, counts):
        by.setdefault(row[2], []).append(row)
    root, best = trie(list(by)), Best()
    for vector, mine in by.items():
        head = vector[:depth]
        for other in near_vectors(root, vector):
            if other < vector or (head != part and head == other[:depth]):
                continue  # met from the other side, or in the part of their common path
            for k, (a, m, _) in enumerate(mine):
                for b, p, _ in (mine[k + 1:] if other == vector else by[other]):
                    if one_edit(a, b):
                        best.link(a, m, b, p)
    return best.table()


def _search(key, table):
    return search_part(key[0].as_py(), *(table[c].to_pylist() for c in ("word", "n", "counts")))


def _rests(batches):
    """(part, place, rest, member): a word without the letter at a place. For inserted letters the place is -1, the
    word itself is a rest too, and of a run of equal letters only the first is left out."""
    schema = pa.schema([("part", pa.binary()), ("place", pa.int32()), ("rest", pa.string()), ("word", pa.string()), ("n", pa.int64()), ("counts", pa.binary())])
    for batch in batches:
        out = []
        for part, word, n, counts in zip(*(c.to_pylist() for c in batch.columns)):
            out.append((part, -1, word, word, n, counts))
            for k in range(len(word)):
                rest = word[:k] + word[k + 1:]
                out.append((part, k, rest, word, n, counts))
                if not k or word[k] != word[k - 1]:
                    out.append((part, -1, rest, word, n, counts))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)] if out else
                                         [pa.array([], f.type) for f in schema], schema=schema)


def _match(batches):
    for batch in batches:
        best = Best()
        for part, place, rest, members in zip(*(c.to_pylist() for c in batch.columns)):
            members = [(m["word"], m["n"], m["counts"]) for m in members]
            first = members if place >= 0 else [m for m in members if m[0] == rest]
            for k, (a, m, u) in enumerate(first):
                for b, p, v in members[k + 1:] if place >= 0 else members:
                    if a != b and (u == part or u != v):
                        best.link(a, m, b, p)
        yield from best.table().to_batches()


def _by_spelling(members: DataFrame) -> DataFrame:
    """Near words among the members of parts of full depth, from equal rests: at most one word per letter replaces a
    place, and at most (letters * places) words are one longer than a rest, which only the rest itself is compared with."""
    rests = members.mapInArrow(_rests, "part binary, place int, rest string, word string, n long, counts binary")
    groups = rests.groupBy("part", "place", "rest").agg(F.collect_list(F.struct("word", "n", "counts")).alias("members"))
    return groups.where(F.size("members") > 1).mapInArrow(_match, FOUND)


def near_words(words: DataFrame, part_words: int = PART_WORDS, written: list[str] | None = None) -> DataFrame:
    """(word, n_near, best) for the words of ``words`` (word, n) that have near words."""
    vectors = materialize(words.mapInArrow(_vectors, "word string, n long, counts binary"), "spelling-vectors", written)
    large, depth, found = None, 0, []
    while True:
        members = vectors.mapInArrow(_members(depth), MEMBER)
        if large is not None:  # below the parts that were too large
            above = large.withColumnRenamed("part", "above")
            members = members.join(above, F.substring("part", 1, depth - STEP) == F.col("above"), "left_semi")
        members = materialize(members, "spelling-members", written)
        sizes = members.groupBy("part").agg(F.count(F.lit(1)).alias("members"))
        large = materialize(sizes.where(F.col("members") > part_words).select("part"), "spelling-large", written)
        some = not large.isEmpty()
        small = members.join(large, "part", "left_anti") if some else members
        found.append(materialize(small.groupBy("part").applyInArrow(_search, FOUND), "spelling-found", written))
        if not some:
            break
        if depth == GROUPS:
            found.append(materialize(_by_spelling(members.join(large, "part", "left_semi")), "spelling-found", written))
            break
        depth += STEP
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    better = F.struct((-F.col("best.n")).alias("n"), F.col("best.word").alias("word"))
    out = out.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(better).alias("best"))
    return out.select("word", "n_near", F.struct((-F.col("best.n")).alias("n"), F.col("best.word").alias("word")).alias("best"))


# ---- forms ------------------------------------------------------------------------------------

def follow(forms: DataFrame, written: list[str] | None = None) -> DataFrame:
    """(word, root) for rows (word, form): the last form reached. Pointers double each round."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots", written)
    while True:
        step = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        ahead = now.join(step, F.col("root") == F.col("at"), "left")
        ahead = ahead.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        ahead = materialize(ahead, "spelling-roots", written)
        now = ahead.drop("moved")
        if ahead.where("moved").isEmpty():
            return now


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_words: int = PART_WORDS,
             written: list[str] | None = None) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n."""
    words = materialize(occurrences(docs, id_col, text_col).where(F.col("n") >= LEAST_COUNT), "spelling-words", written)
    near = near_words(words, part_words, written)
    good = F.col("best.n") >= TIMES * F.col("n")
    rows = words.join(near.withColumnRenamed("word", "near"), F.col("word") == F.col("near"), "left")
    rows = rows.select("word", F.when(good, F.col("best.word")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                       F.when(good, F.col("best.n")).alias("form_n"))
    rows = materialize(rows, "spelling-rows", written)
    roots = follow(rows.where("form is not null"), written).withColumnRenamed("word", "of")
    out = rows.join(roots, F.col("word") == F.col("of"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
