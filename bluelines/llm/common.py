"""Shared helpers of the training-data operators: table access, folds, bounded samples, components."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bluelines.session import materialize

FOLDS = 5  # rows whose crc32(id as text) mod 5 is 0 are held out of every fit
BATCH_ROWS = 1_000
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_batches(spark: SparkSession) -> None:
    """From now on whole documents go to the Python workers in batches of at most BATCH_ROWS rows, so that a
    worker holds a few MB of text at a time; a smaller setting of the session stays."""
    rows = int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    if not 0 < rows <= BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def held_out(col: Column) -> Column:
    """True for the rows that no model may learn from (a null id counts as held out)."""
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def in_chunks(column: pa.Array, limit: int):
    """Slices (from, to) of a string column whose UTF-8 bytes stay near ``limit``; one long text makes
    a slice of its own. Keeps the working memory of vectorised scans apart from Arrow's batch size."""
    sizes = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += int(n)
    if start < len(sizes):
        yield start, len(sizes)


def components(edges: DataFrame, name: str = "cc", written: list[str] | None = None) -> DataFrame:
    """Connected components of ``edges`` (columns a, b): rows (id, component) with the smallest id
    reachable, for every id that has an edge.

    Alternating large-star and small-star steps: each replaces the edges of a node by edges to the
    smallest neighbour. Only minima are aggregated (combined before the shuffle), so a hub with many
    neighbours is never gathered; the join that hands a minimum back has one row per node on its
    other side, so Spark can split a hub's rows. Every round is written to the shared folder; the
    rounds end when a checksum of the edges stands still (about log of the diameter).
    """
    def written_edges(df, step):
        return materialize(df.where("a != b").distinct(), f"{name}-{step}", written)

    def signature(df):
        r = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    cur = written_edges(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    seen = signature(cur)
    while seen[0]:
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written_edges(large, "large")
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        cur = written_edges(small.unionByName(low.select("a", F.col("m").alias("b"))), "small")
        now = signature(cur)
        if now == seen:
            break
        seen = now
    stars = cur.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return stars.unionByName(cur.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
