"""Operator 2: MinHash near duplicates with sequential Bayesian verification.

Texts become sets of distinct 5-word shingles (A-Z lower-cased; fewer words: the whole sequence as
one shingle; no words or null: empty, linked with nothing). Two documents are linked if the Jaccard
similarity of their full sets is at least ``THRESHOLD``.

1. One pass writes a table of 128 minhashes (16 bits each), 32 band keys and a set digest per row.
2. Rows with equal sets form classes (grouping by digest); the smallest id stands for its class.
3. Representatives that share a band key are candidates. First round: every representative is paired
   with the hub (smallest id) it shares most bands with; signatures are compared in batches and a
   pair is dropped when the posterior chance of reaching the threshold falls below ``MISS``;
   survivors are verified on full sets, and verified links give components.
4. Of a band group that still holds more than one component, the members outside of its largest component are
   compared with all others. Both sides are cut into blocks of ``BLOCK`` members, or of ``BLOCK_ITEMS`` shingles if their
   sets are large; each pair of blocks with outsiders is one task's work, so the members of a large component are
   repeated once per block of outsiders, not once per block of the group. A first pass over signatures names the members that have pairs
   across components whose posterior survives; a second pass gets the full sets of just those,
   verifies, and returns only links that join components. A pair that shares several bands is taken
   up in the first. So every banded candidate pair is either pruned by its posterior, verified, or
   already connected: nothing is capped, no pairs are shuffled, and no group meets in one task.

A pair at the threshold shares no band with chance (1 - 0.75**4)**32 = 5e-6.

Edge cases: a very long text is one set of all its shingles; an empty table gives no row; a null id is returned with a null component and is kept; rows that repeat an id count as
one document holding each of their sets, so all that is linked with one of them is linked with the
id; extra columns are not read.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bluelines.llm import shingles
from bluelines.llm.common import components, in_chunks, text_batches
from bluelines.session import materialize

THRESHOLD = 0.75
ROWS, BANDS = 4, 32
BATCH = 16  # minhashes compared before each look at the posterior
MISS = 1e-7  # posterior chance of a link at which a pair is given up
BLOCK = 1024
BLOCK_ITEMS = 2_000_000  # shingles of a block, 8 bytes each; a larger set is in a block with others of its key by chance only
ID_BROADCAST_ROWS = 500_000  # ids (8 bytes each) sent to all executors at most; more are joined by shuffle
SIGNATURES = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sig binary"


@lru_cache(1)
def least_matches() -> np.ndarray:
    """For 16, 32, ... compared minhashes, the fewest matches at which P(similarity >= threshold) >= MISS,
    under a flat prior: the posterior is Beta(matches + 1, misses + 1), its tail a binomial sum."""
    out = []
    for n in range(BATCH, shingles.PERMUTATIONS + 1, BATCH):
        for m in range(n + 1):
            below = sum(comb(n + 1, j) * THRESHOLD**j * (1 - THRESHOLD) ** (n + 1 - j) for j in range(m + 1))
            if below >= MISS:  # P(J >= t | m of n) = P(Binomial(n + 1, t) <= m)
                out.append(m)
                break
    return np.array(out)


def survives(equal: np.ndarray) -> np.ndarray:
    """equal: one row of matches and misses per pair. Looks at the posterior after each batch; pairs
    that fall below the bound leave, so later batches are summed for the rest only."""
    alive = np.arange(len(equal))
    matches = np.zeros(len(equal), np.int64)
    for k, least in enumerate(least_matches()):
        matches[alive] += equal[alive, k * BATCH:(k + 1) * BATCH].sum(1)
        alive = alive[matches[alive] >= least]
    out = np.zeros(len(equal), bool)
    out[alive] = True
    return out


def _sign(batches):
    for batch in batches:
        for a, b in in_chunks(batch.column(1), shingles.CHUNK):
            ids, text = batch.column(0)[a:b], batch.column(1)[a:b]
            low, sizes, digests = shingles.minima(text)
            sig = (shingles.mix(low) & np.uint64(0xFFFF)).astype("<u2")
            keys = np.zeros((len(low), BANDS), np.uint64)
            for r in range(ROWS):
                keys = shingles.mix(keys + low[:, r::ROWS] + np.arange(BANDS, dtype=np.uint64)[None, :])
            at = np.cumsum(sizes > 0) - 1
            yield pa.RecordBatch.from_pydict({
                "doc_id": ids, "n_shingles": sizes,
                "set_a": digests[:, 0].view(np.int64), "set_b": digests[:, 1].view(np.int64),
                "bands": pa.array([keys[at[i]].view(np.int64) if sizes[i] else None for i in range(b - a)], pa.list_(pa.int64())),
                "sig": pa.array([sig[at[i]].tobytes() if sizes[i] else None for i in range(b - a)], pa.binary()),
            })


def _prune(batches):
    for batch in batches:
        if batch.num_rows:
            a, b = (np.frombuffer(b"".join(batch.column(k).to_pylist()), "<u2").reshape(batch.num_rows, -1) for k in (2, 3))
            yield batch.select([0, 1]).filter(pa.array(survives(a == b)))


def _sets(batches):
    for batch in batches:
        for a, b in in_chunks(batch.column(1), shingles.CHUNK):
            sets = shingles.distinct_sets(batch.column(1)[a:b])
            yield pa.RecordBatch.from_pydict({"id": batch.column(0)[a:b], "items": pa.array([s.tobytes() for s in sets], pa.binary())})


def _verify(batches):
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3)):
            x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
            common = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * common >= 100 * THRESHOLD * (len(x) + len(y) - common) and common > 0)
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _cross_pairs(part):
    """For each member of one pair of blocks, the members of other components that it must be compared
    with here: those whose first common band is this one and whose signatures survive. Yields
    (member, others); ``comp`` may be changed by the caller meanwhile, to join components."""
    side, ids, comp = (part[c].to_numpy() for c in ("side", "id", "comp"))
    comp = comp.copy()
    sigs = np.frombuffer(b"".join(part["sig"].to_pylist()), "<u2").reshape(len(ids), -1)
    keys = np.array(part["bands"].to_pylist(), np.int64)
    band = part["band"][0].as_py()
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    same = part["i"][0].as_py() == part["j"][0].as_py()
    for i in left:
        other = left[ids[left] > ids[i]] if same else right[ids[right] != ids[i]]
        other = other[comp[other] != comp[i]]
        other = other[(keys[other] == keys[i]).argmax(1) == band]
        if len(other):
            other = other[survives(sigs[other] == sigs[i])]
            if len(other):
                yield ids, comp, i, other


def _open_members(key, part):
    """The members of one pair of blocks that have something left to verify there."""
    found: set[int] = set()
    for ids, _, i, other in _cross_pairs(part):
        found.update((int(i), *other.tolist()))
    return part.take(pa.array(sorted(found), pa.int64())).select(["key", "i", "j", "side", "id"])


def _block_links(key, part):
    """Verified links across the components of one pair of blocks, as many as join them: members that
    a link has connected are not compared again."""
    items = [np.frombuffer(x, np.uint64) for x in part["items"].to_pylist()]
    out_a, out_b = [], []
    for ids, comp, i, other in _cross_pairs(part):
        sizes = np.array([len(items[o]) for o in other])
        pool = np.concatenate([items[o] for o in other])
        at = np.minimum(np.searchsorted(items[i], pool), len(items[i]) - 1)
        common = np.add.reduceat((items[i][at] == pool).astype(np.int64), np.cumsum(sizes) - sizes)
        for o in other[100 * common >= 100 * THRESHOLD * (len(items[i]) + sizes - common)]:
            if comp[o] != comp[i]:
                comp[comp == comp[o]] = comp[i]
                out_a.append(ids[i])
                out_b.append(ids[o])
    return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64())})


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(_sign, SIGNATURES)


def _only(df, ids, col="id"):
    """The rows of ``df`` whose ``col`` is in the written table ``ids``: sent to the scan while it is small, so
    that the wide rows of ``df`` stay where they are, and joined by shuffle beyond that."""
    few = ids.count() <= ID_BROADCAST_ROWS
    return df.join(F.broadcast(ids) if few else ids, df[col] == ids["id"], "left_semi")


def _item_sets(docs, ids, name, written):
    """Full sets (id, items) of the documents in ``ids``, whose texts are read again."""
    texts = _only(docs, materialize(ids, f"{name}-ids", written), "doc_id")
    return materialize(texts.select("doc_id", "text").mapInArrow(_sets, "id long, items binary"), f"{name}-sets", written)


def _linked(docs, pairs, name, written):
    """The pairs whose full sets reach the threshold."""
    sets = _item_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), name, written)
    x = sets.select(F.col("id").alias("a"), F.col("items").alias("items_a"))
    y = sets.select(F.col("id").alias("b"), F.col("items").alias("items_b"))
    joined = pairs.hint("merge").join(x.hint("merge"), "a").hint("merge").join(y.hint("merge"), "b")
    return materialize(joined.select("a", "b", "items_a", "items_b").mapInArrow(_verify, "a long, b long"), f"{name}-links", written)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    written: list[str] | None = None) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept), one per input row."""
    text_batches(docs.sparkSession)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    table = materialize(signatures(docs), "minhash", written)
    full = table.where("n_shingles > 0 and doc_id is not null")
    classes = full.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = materialize(classes, "classes", written)
    member = full.join(classes.where("copies > 1"), ["set_a", "set_b", "n_shingles"]).where("doc_id != rep")
    member = materialize(member.select("doc_id", "set_a", "set_b", "rep"), "copies", written)
    gone = member.select("doc_id", "set_a", "set_b").distinct()
    gone = F.broadcast(gone) if gone.count() <= ID_BROADCAST_ROWS else gone
    stands = full.join(gone, ["doc_id", "set_a", "set_b"], "left_anti").select(F.col("doc_id").alias("id"), "n_shingles", "bands", "sig")
    bands = stands.select("id", "n_shingles", F.posexplode("bands").alias("band", "key"))
    groups = bands.groupBy("key").agg(F.min("id").alias("hub"), F.max("id").alias("top")).where("top > hub").select("key", "hub")
    banded = materialize(bands.join(groups, "key"), "banded", written)

    first = banded.where("id != hub").groupBy("id", "hub").agg(F.count(F.lit(1)).alias("n"))
    first = first.groupBy("id").agg(F.max(F.struct("n", (-F.col("hub")).alias("h"))).alias("best"))
    first = first.select(F.col("id").alias("a"), (-F.col("best.h")).alias("b"))
    ids = materialize(first.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "first-signed", written)
    sigs = _only(stands, ids).select("id", "sig")
    first = first.join(sigs.select(F.col("id").alias("a"), F.col("sig").alias("sig_a")), "a")
    first = first.join(sigs.select(F.col("id").alias("b"), F.col("sig").alias("sig_b")), "b")
    first = materialize(first.select("a", "b", "sig_a", "sig_b").mapInArrow(_prune, "a long, b long").distinct(), "first-pairs", written)
    links = _linked(docs, first, "first", written)

    comp = materialize(components(links, "first", written), "first-components", written)
    open_rows = banded.join(comp, "id", "left").select("key", "band", "id", "n_shingles", F.coalesce("component", "id").alias("comp"))
    parts = open_rows.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("size"), F.sum("n_shingles").alias("items"))
    main = F.max(F.struct("size", "items", "comp"))
    groups = parts.groupBy("key").agg(main.alias("main"), F.sum("size").alias("size"), F.sum("items").alias("items")).where("size > main.size")

    def blocks(size, items):
        return F.ceil(F.greatest(size / BLOCK, items / BLOCK_ITEMS)).cast("int")

    groups = groups.select("key", F.col("main.comp").alias("main"), blocks(F.col("main.size"), F.col("main.items")).alias("inner"),
                           blocks(F.col("size") - F.col("main.size"), F.col("items") - F.col("main.items")).alias("outer"))
    inside, spread = F.col("comp") == F.col("main"), F.xxhash64("id")
    # blocks of the largest component come first; its members meet the blocks of outsiders, those meet every block
    cells = open_rows.join(groups, "key").withColumn(
        "own", F.when(inside, F.pmod(spread, "inner")).otherwise(F.col("inner") + F.pmod(spread, "outer")).cast("int"))
    cells = cells.withColumn("other", F.explode(F.sequence(F.when(inside, F.col("inner")).otherwise(0), F.col("inner") + F.col("outer") - 1)))
    cells = materialize(cells.select("key", "band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                                     (F.col("own") > F.col("other")).cast("int").alias("side"), "id", "comp"), "cells", written)
    payload = _only(stands, materialize(cells.select("id").distinct(), "cell-ids", written))
    left = cells.join(payload, "id").groupBy("key", "i", "j").applyInArrow(_open_members, "key long, i int, j int, side int, id long")
    left = materialize(left.distinct(), "open", written)
    if not left.isEmpty():
        sets = _item_sets(docs, left.select("id").distinct(), "open", written)
        second = cells.join(left, ["key", "i", "j", "side", "id"], "left_semi").join(_only(payload, sets.select("id")), "id").join(sets, "id")
        second = second.groupBy("key", "i", "j").applyInArrow(_block_links, "a long, b long")
        links = links.unionByName(materialize(second, "open-links", written))

    links = links.unionByName(member.select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    comp = materialize(components(links, "all", written), "all-components", written)
    out = table.select("doc_id", "n_shingles").join(comp.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_first(docs: DataFrame, written: list[str] | None = None) -> DataFrame:
    """``docs`` with one document of each group; documents with a null id stay. Of rows that repeat a
    kept id all stay (they are one document)."""
    gone = near_duplicates(docs, written=written).where("not kept").select(F.col("doc_id").alias("gone id")).distinct()
    gone = materialize(gone, "gone", written)
    few = gone.count() <= ID_BROADCAST_ROWS
    return docs.join(F.broadcast(gone) if few else gone, docs["doc_id"] == gone["gone id"], "left_anti").select(*[docs[c] for c in docs.columns])
