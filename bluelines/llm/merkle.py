"""Operator 12: Merkle manifest of a dataset as postorder append logs.

A leaf is the hash of a row's fields, each with its length in front. The leaves of a group (language), in the
order of their ids, are dealt to aligned builders of ``2 ** LEVELS`` leaves. A builder appends every node to
its log in the order in which nodes are completed, which is postorder: a node follows both subtrees. Nothing else is
stored, because places follow from sizes: before the subtree that starts at leaf s lie all nodes that s leaves
complete, ``2 * s - popcount(s)``; a subtree over m leaves of height h has ``sum(ceil(m / 2 ** j), j = 0..h)``
nodes, its own node last. So a sibling's digest is read at 32 times its place.

The roots of a group's builders are the leaves of its next tier, built alike, until one node is left (subroot);
the subroots, in the order of their groups, make one more tree of the same kind, whose last node is the root. A
node without a sibling is hashed alone into its parent; a group of one leaf is its own subroot.

  <folder>/log/<group>-<tier>-<builder>.log    digests (32 bytes each) in postorder; group -1: tree of subroots
  <folder>/groups/                             Parquet: group (language), number, leaves

Edge cases: null fields enter as ``-``; null ids come first and are never altered; rows that repeat an id are
leaves of their own, ordered by digest; extra columns are not read; very long texts are hashed whole by Spark;
an empty table gives no row and no log. Equal rows get the places of each other, which changes nothing.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bluelines.llm import files
from bluelines.operators.numbering import number_within
from bluelines.session import materialize

LEVELS = 14  # a builder takes 2 ** 14 leaves: a log of 1 MB
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TOP = -1  # number of the tree of subroots
SIZE = 32
NODE = "tree long, nth long, n long, digest binary"
PROOF = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean, "
         "log_position long, n_siblings int")


# ---- hashes -----------------------------------------------------------------------------------

def leaf_hash(fields: list[Column]) -> Column:
    """Lower-case hexadecimal sha256 of the fields: ``-`` for null, else ``<bytes>:<value>``."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in fields]
    return F.sha2(F.concat(*parts), 256)


def parent(*digests: bytes) -> bytes:
    return hashlib.sha256(b"".join(d.hex().encode() for d in digests)).digest()


# ---- places -----------------------------------------------------------------------------------

def subtree_size(leaves: int, height: int) -> int:
    return sum(-(-leaves >> j) for j in range(height + 1)) if leaves < 1 << height else (2 << height) - 1


def place(level: int, index: int, leaves: int) -> int:
    """Number of nodes before node ``index`` of ``level`` in the postorder of a tree of ``leaves`` leaves."""
    start = index << level
    return 2 * start - start.bit_count() + subtree_size(min(1 << level, leaves - start), level) - 1


def postorder(digests: list[bytes], height: int) -> list[bytes]:
    """Nodes in the order of their completion: equal neighbours on the stack are joined at once; at the end
    the open right edge is closed level by level up to ``height``."""
    log, stack = [], []  # stack: (level, digest) of completed subtrees that wait for their sibling

    def push(level: int, digest: bytes) -> None:
        log.append(digest)
        while stack and stack[-1][0] == level:
            digest, level = parent(stack.pop()[1], digest), level + 1
            log.append(digest)
        stack.append((level, digest))

    for d in digests:
        push(0, d)
    while stack and stack[-1][0] < height:
        level, digest = stack.pop()
        push(level + 1, parent(digest))
    return log


def height(leaves: int) -> int:
    return max(leaves - 1, 0).bit_length()


def builders(nth: int, n: int, levels: int) -> list[tuple[int, int, int, int, int]]:
    """The builders above leaf ``nth`` of ``n``, one a tier: (tier, builder, place within, its leaves, its height)."""
    out, tier = [], 0
    while True:
        blocks = -(-n >> levels)
        here = min(1 << levels, n - (nth >> levels << levels))
        out.append((tier, nth >> levels, nth & ((1 << levels) - 1), here, levels if blocks > 1 else height(n)))
        if blocks <= 1:
            return out
        nth, n, tier = nth >> levels, blocks, tier + 1


def _uri(folder: str, tree: int, tier: int, block: int) -> str:
    return f"{folder}/log/{tree}-{tier:02d}-{block:08d}.log"


class Log:
    """An opened builder's log; whole in memory for a builder's own proofs, else read node by node."""

    def __init__(self, folder: str, tree: int, tier: int, block: int, whole: bool = False):
        self.file = files.open_input(_uri(folder, tree, tier, block))
        self.data = self.file.read() if whole else None

    def node(self, at: int) -> bytes:
        return self.data[SIZE * at:SIZE * at + SIZE] if self.data is not None else self.file.read_at(SIZE, SIZE * at)

    def siblings(self, nth: int, leaves: int, top: int) -> list[tuple[bytes | None, bool]]:
        """Level by level: (sibling or None, is it on the left) of the path up from leaf ``nth``."""
        out = []
        for level in range(top):
            index, other = nth >> level, (nth >> level) ^ 1
            there = other << level < leaves
            out.append((self.node(place(level, other, leaves)) if there else None, other < index))
        return out

    def root(self, leaves: int, top: int) -> bytes:
        return self.node(subtree_size(leaves, top) - 1)


def path(folder: str, tree: int, nth: int, n: int, levels: int, skip: int = 0) -> tuple[list, bytes]:
    """Siblings of a tree's leaf from tier ``skip`` up, and the tree's root."""
    out, root = [], b""
    for tier, block, within, leaves, top in builders(nth, n, levels)[skip:]:
        log = Log(folder, tree, tier, block)
        out += log.siblings(within, leaves, top)
        root = log.root(leaves, top)
    return out, root


def fold(digest: bytes, siblings: list[tuple[bytes | None, bool]]) -> bytes:
    for other, left in siblings:
        digest = parent(digest) if other is None else parent(other, digest) if left else parent(digest, other)
    return digest


# ---- building ---------------------------------------------------------------------------------

def _builder(folder: str, tier: int, levels: int):
    def run(key, part):
        tree, block = (k.as_py() for k in key)
        rows = sorted(zip(part["nth"].to_pylist(), part["digest"].to_pylist()))
        n = part["n"][0].as_py()
        top = builders(rows[0][0], n, levels)[0][4]
        log = postorder([d for _, d in rows], top)
        files.publish(_uri(folder, tree, tier, block), [b"".join(log)])
        return pa.table({"tree": [tree], "nth": [block], "n": [-(-n >> levels)], "digest": [log[-1]]})

    return run


def build_trees(leaves: DataFrame, folder: str, levels: int = LEVELS, written: list[str] | None = None) -> DataFrame:
    """Logs of all trees of ``leaves`` (tree, nth, n, digest); returns (tree, digest of its root)."""
    done, tier, nodes = None, 0, leaves
    while True:
        blocks = nodes.withColumn("block", F.shiftright("nth", levels)).groupBy("tree", "block")
        nodes = materialize(blocks.applyInArrow(_builder(folder, tier, levels), NODE), "merkle-tier", written)
        roots = nodes.where("n = 1").select("tree", "digest")
        done = roots if done is None else done.unionByName(roots)
        nodes, tier = nodes.where("n > 1"), tier + 1
        if nodes.isEmpty():
            return done


def leaves(docs: DataFrame, group: str = "lang", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """(doc_id, group, leaf, altered): the leaf of each row, and for every seventh id by crc32 the leaf that the
    row would have with one more character counted."""
    key = F.col(fields[0]).cast("long")
    cols = {c: F.col(c) for c in fields}
    altered = leaf_hash([c + 1 if n == "n_chars" else c for n, c in cols.items()])
    hit = F.crc32(key.cast("string").cast("binary")) % 7 == 0
    return docs.select(key.alias("doc_id"), F.col(group).cast("string").alias("group"), F.unhex(leaf_hash(list(cols.values()))).alias("leaf"),
                       F.when(hit, F.unhex(altered)).alias("altered"))


def manifest(docs: DataFrame, folder: str, group: str = "lang", fields: tuple[str, ...] = FIELDS, levels: int = LEVELS,
             written: list[str] | None = None) -> tuple[DataFrame, int]:
    """Writes logs and groups below ``folder``. Returns the rows (doc_id, leaf, altered, tree, nth, n) and the
    number of groups."""
    rows = materialize(leaves(docs, group, fields), "merkle-leaves", written)
    numbered = number_within(rows, ["group"], [F.col("doc_id").asc_nulls_first(), F.col("leaf").asc()], "merkle-rows", written)
    groups = materialize(numbered.where("nth = 0").select("group", F.col("n").alias("leaves")), "merkle-groups", written)
    groups = number_within(groups, [], [F.col("group").asc_nulls_first()], "merkle-order", written, nth="tree", total="groups")
    groups.write.parquet(f"{folder}/groups")
    groups = docs.sparkSession.read.parquet(f"{folder}/groups")
    trees = groups.select(F.col("group").alias("of"), "tree")
    numbered = numbered.join(trees, F.col("group").eqNullSafe(F.col("of"))).drop("group", "of")
    numbered = materialize(numbered, "merkle-numbered", written)
    roots = build_trees(numbered.select("tree", "nth", "n", F.col("leaf").alias("digest")), folder, levels, written)
    count = groups.count()
    top = roots.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("nth"), F.lit(count).cast("long").alias("n"), "digest")
    build_trees(top, folder, levels, written)
    return numbered, count


# ---- proofs -----------------------------------------------------------------------------------

def _prover(folder: str, groups: int, levels: int):
    def run(key, part):
        tree, block = (k.as_py() for k in key)
        rows = part.select(["nth", "n", "doc_id", "leaf", "altered"]).to_pylist()
        nth, n = rows[0]["nth"], rows[0]["n"]
        _, _, _, here, top = builders(nth, n, levels)[0]
        own = Log(folder, tree, 0, block, whole=True)
        shared, subroot = path(folder, tree, nth, n, levels, skip=1)
        subroot = subroot or own.root(here, top)
        above, root = path(folder, TOP, tree, groups, levels)
        shared += above
        tail = "".join(d.hex() for d, _ in shared if d is not None).encode()
        count = sum(d is not None for d, _ in shared)
        folded = {}
        out = []
        for r in rows:
            within = r["nth"] & ((1 << levels) - 1)
            siblings = own.siblings(within, here, top)
            given = [d.hex() for d, _ in siblings if d is not None]
            low = fold(r["altered"] or r["leaf"], siblings)
            if low not in folded:
                folded[low] = fold(low, shared)
            got = folded[low]
            if len(folded) > 1024:
                folded = {}
            out.append((r["doc_id"], r["leaf"].hex(), subroot.hex(), root.hex(), hashlib.sha256("".join(given).encode() + tail).hexdigest(),
                        got.hex(), got == root, place(0, r["nth"], n), len(given) + count))
        types = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
        names = [x.split() for x in PROOF.split(", ")]
        return pa.table({c: pa.array(v, types[t]) for (c, t), v in zip(names, zip(*out))})

    return run


def proofs(rows: DataFrame, folder: str, groups: int, levels: int = LEVELS) -> DataFrame:
    """One row per leaf: its proof read from the logs, and the root folded from the altered leaf where there is
    one, else from the leaf. ``log_position``: the leaf's place in the postorder of its group's whole tree."""
    blocks = rows.withColumn("block", F.shiftright("nth", levels)).groupBy("tree", "block")
    return blocks.applyInArrow(_prover(folder, groups, levels), PROOF)


def proof_of(spark: SparkSession, folder: str, group: str | None, nth: int, levels: int = LEVELS) -> tuple[list, bytes]:
    """Siblings and root for one leaf (its place in its group), read from the logs without a Spark job over rows."""
    g = spark.read.parquet(f"{folder}/groups").where(F.col("group").eqNullSafe(F.lit(group))).first()
    siblings, _ = path(folder, g.tree, nth, g.leaves, levels)
    above, root = path(folder, TOP, g.tree, g.groups, levels)
    return siblings + above, root
