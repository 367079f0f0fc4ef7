"""Operator 9: mixing sources to target weights by pivotal dependent rounding.

A document's size is its number of words. Sources in code point order (null last) weigh 1, 2, 3 and so
on again; they share 100 % of all words by weight, but no source gets more than ``MOST`` times its own
words, and the excess is reshared among the rest. A document of a source is due
target / source size copies: the whole part is certain, the rest is a probability p.

Pivotal rounding in words: two fractional documents i, j swap mass so that size_i * p_i + size_j * p_j
stays the same and one of them becomes 0 or 1; the direction is drawn so that every p keeps its
expectation. Each source is cut into groups of about ``GROUP_ROWS`` documents by hash; a group settles
all but at most one of its documents. The residuals of ``FAN`` neighbouring groups meet in the next
level of a reduction tree until one residual per source is left, which goes to the nearer side, so a
source misses its target by at most half of one document (and by what the cap of a whole mix leaves).
Random numbers come from seeds per source, level and group; group sizes follow from the data: reruns agree.

Edge cases: null and empty texts have size 0 and are repeated by an independent draw with the same p;
rows that repeat an id within a source are one document, taken or left together; a null id is
identified by its text; extra columns are not read; an empty table gives an empty mix.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bluelines.llm.common import WORD
from bluelines.session import materialize

MOST = 3
WEIGHTS = 3
GROUP_ROWS = 2_000
FAN = 64
COPIES_BROADCAST_ROWS = 500_000  # decisions (at most 24 bytes each) sent to all executors; more are joined by shuffle
UNIT = "key long, source string, size long, whole int, p double, node long, seed long"


def targets(sized: DataFrame) -> DataFrame:
    """One row per source: source, source_size, documents, target. Only this table of sources, not the
    documents, is ordered as a whole."""
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    s = s.withColumn("weight", (F.row_number().over(order) - 1) % WEIGHTS + 1)
    # filled by ascending cap per weight: a source stops at its cap if its share of what the sources before it leave is larger
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, on = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    s = s.withColumn("total", F.sum("source_size").over(everything).cast("double"))
    s = s.withColumn("left", F.col("total") - MOST * F.coalesce(F.sum("source_size").over(before), F.lit(0)))
    s = s.withColumn("level", F.col("left") / F.sum("weight").over(on))
    s = s.withColumn("capped", F.col("level") * F.col("weight") >= MOST * F.col("source_size"))
    first = F.min(F.when(~F.col("capped"), F.struct(F.col("source_size") / F.col("weight"), "source", "level"))).over(everything)["level"]
    target = F.when(F.col("capped"), (MOST * F.col("source_size")).cast("double")).otherwise(first * F.col("weight"))
    return s.select("source", "source_size", "documents", target.alias("target"))


def settle(sizes: np.ndarray, p: np.ndarray, draw) -> int:
    """Pivotal rounding in place, in the order given; returns the one left fractional, or -1."""
    at = -1
    for j in range(len(p)):
        if not 0.0 < p[j] < 1.0:
            continue
        if at < 0:
            at = j
            continue
        wi, wj, pi, pj = sizes[at], sizes[j], p[at], p[j]
        up = min((1 - pi) * wi, pj * wj)  # words that j can give to i
        down = min(pi * wi, (1 - pj) * wj)
        if draw() * (up + down) < down:
            p[at] = 1.0 if up == (1 - pi) * wi else pi + up / wi
            p[j] = 0.0 if up == pj * wj else pj - up / wj
        else:
            p[at] = 0.0 if down == pi * wi else pi - down / wi
            p[j] = 1.0 if down == (1 - pj) * wj else pj + down / wj
        fractional = [k for k in (at, j) if 0.0 < p[k] < 1.0]
        at = fractional[0] if fractional else -1
    return at


def _settle_group(key, part):
    sizes, p, keys = (part[c].to_numpy() for c in ("size", "p", "key"))
    order = np.lexsort((sizes, keys, part["seed"].to_numpy()))
    rng = np.random.default_rng([int(part["seed"].to_numpy()[order[0]]) % 2**64, len(order)])
    own = p[order].copy()
    settle(sizes[order].astype(float), own, rng.random)
    out = p.copy()
    out[order] = own
    return part.set_column(part.column_names.index("p"), "p", pa.array(out))


def copies(sized: DataFrame, written: list[str] | None = None) -> DataFrame:
    """Rows (key, source, copies, target, source_size) for ``sized`` (key, source, size)."""
    units = sized.groupBy("key", "source").agg(F.sum("size").alias("size"))
    goal = materialize(targets(units), "mix-targets", written)
    share = F.least(F.col("target") / F.col("source_size"), F.lit(float(MOST)))
    units = units.join(goal.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    seed = F.xxhash64("key", "source")
    due = F.coalesce(F.when(F.col("source_size") > 0, share), F.lit(0.0))
    units = units.withColumn("seed", seed).withColumn("whole", F.floor(due).cast("int")).withColumn("p", due - F.floor(due))
    groups = F.ceil(F.col("documents") / GROUP_ROWS)
    units = units.withColumn("node", F.pmod("seed", groups).cast("long"))
    chance = F.pmod(F.xxhash64("seed"), F.lit(1 << 30)) / float(1 << 30)
    settled = units.withColumn("p", F.when(F.col("size") > 0, F.col("p")).otherwise((chance < F.col("p")).cast("double")))
    columns = [c.split()[0] for c in UNIT.split(", ")]
    level = settled.select(columns)
    nodes = goal.agg(F.max("documents")).first()[0] or 0
    nodes, done = -(-nodes // GROUP_ROWS), []
    while True:
        level = materialize(level.groupBy("source", "node").applyInArrow(_settle_group, UNIT), "mix-level", written)
        done.append(level.where("p <= 0 or p >= 1"))
        left = level.where("p > 0 and p < 1")
        if nodes <= 1:
            done.append(left.withColumn("p", F.round("p")))
            break
        level, nodes = left.withColumn("node", F.floor(F.col("node") / FAN)), -(-nodes // FAN)
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    out = out.select("key", "source", (F.col("whole") + F.col("p")).cast("int").alias("copies"))
    goal = goal.select(F.col("source").alias("s"), "source_size", "target")
    return materialize(out.join(goal, F.col("source").eqNullSafe(F.col("s"))).drop("s"), "mix", written)


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    text = F.col(text_col).cast("string")
    size = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(id_col).alias("doc_id"), identity(F.col(id_col), text).alias("key"),
                       F.col(source_col).cast("string").alias("source"), size.alias("size"))


def identity(id_col, text):
    return F.coalesce(id_col.cast("long"), F.xxhash64(text))


def mix(docs: DataFrame, written: list[str] | None = None) -> DataFrame:
    """Rows (doc_id, size, source_size, target, taken, copies), one per input row."""
    sized = materialize(sizes(docs), "mix-sizes", written)
    plan = copies(sized, written).withColumnRenamed("key", "k").withColumnRenamed("source", "s")
    out = sized.join(plan, (F.col("key") == F.col("k")) & F.col("source").eqNullSafe(F.col("s")))
    return out.select("doc_id", "size", F.col("source_size"), "target", (F.col("copies") * F.col("size")).alias("taken"), "copies")


def mixed(docs: DataFrame, written: list[str] | None = None) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; all columns stay as they are. The decisions are
    sent to all executors while they are few, and joined by shuffle beyond that."""
    sized = materialize(sizes(docs), "mix-sizes", written)
    plan = copies(sized, written).where("copies > 0").select(F.col("key").alias("mix key"), F.col("source").alias("mix source"), F.col("copies").alias("mix copies"))
    few = plan.count() <= COPIES_BROADCAST_ROWS
    key = identity(docs["doc_id"], docs["text"].cast("string"))
    out = docs.join(F.broadcast(plan) if few else plan, (key == plan["mix key"]) & docs["source"].eqNullSafe(plan["mix source"]))
    out = out.select(*[docs[c] for c in docs.columns], F.explode(F.sequence(F.lit(1), plan["mix copies"])))
    return out.select(*[docs[c] for c in docs.columns])
