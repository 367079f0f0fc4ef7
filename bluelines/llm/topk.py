"""Operator 4: exact top-k search by inner product with multi-resolution segment statistics.

Vectors become integers, floor(64 * x). Cut into segments of L components with means m and deviations s,
two vectors have q.x <= sum of L * (m_q * m_x + s_q * s_x), which is the lower bound of their squared
distance |q|^2 + |x|^2 - 2 q.x read the other way. Finer segments tighten it. A query keeps the
candidates whose bound reaches the k-th best score known so far, from one segment to ``LEVELS[-1]``,
and computes exact scores for the survivors only.

Queries and candidates are dealt into blocks by hash; every pair of blocks is one task's work with
bounded memory, and returns its k best per query, which are ranked once more (Spark limits each
query's rows before the shuffle). Equal vectors only meet as rows of different blocks.

Edge cases: null vectors, vectors with null, NaN or infinite components and null ids take no part; only
vectors of equal length are compared; rows that repeat an id are rows of their own, each a candidate of the
others and, if its id is a query's, a query with its own result rows; no row is its own neighbour; ties go to the
smaller id; extra columns are not read; an empty table gives no row. Scores are exact while they fit a long.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bluelines.session import materialize

K = 20
SCALE = 64
LEVELS = (1, 2, 4, 8, 16)
QUERY_BLOCK, CANDIDATE_BLOCK = 2048, 8192


def statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Per segment sqrt(L) * mean and sqrt(L) * deviation, so that bounds are inner products."""
    parts = []
    for columns in np.array_split(np.arange(vectors.shape[1]), segments):
        if len(columns):
            x = vectors[:, columns]
            parts += [x.mean(1) * len(columns) ** 0.5, x.std(1) * len(columns) ** 0.5]
    return np.stack(parts, 1) if parts else np.zeros((len(vectors), 1))


def _exact(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products as integers: in doubles where every partial sum is exact, else in longs."""
    top = float(np.abs(vectors).max(initial=0)) * float(np.abs(query).max(initial=0)) * max(1, len(query))
    if top < 2**53:
        return (vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    return vectors @ query


def best(queries: np.ndarray, query_rows: np.ndarray, vectors: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int = K):
    """For each query the (place among the queries, ids, scores) of its k best among ``vectors`` of other rows, all ties
    in order."""
    as_float = vectors.astype(np.float64)
    small = float(np.abs(as_float).max(initial=0)) * float(np.abs(queries).max(initial=0)) * max(1, vectors.shape[1]) < 2**53
    stats = [(statistics(as_float, m), statistics(queries.astype(np.float64), m)) for m in LEVELS]
    for n, (q, own) in enumerate(zip(queries, query_rows)):
        left = np.flatnonzero(rows != own)
        if not len(left):
            continue
        x, y = stats[0]
        bound = x @ y[n]
        seed = left if len(left) <= 2 * k else left[np.argpartition(-bound[left], 2 * k)[:2 * k]]
        floor = -np.inf
        if len(left) > k:
            known = np.sort(_exact(vectors[seed], q))
            floor = float(known[-k])
            slack = 1e-9 * (1 + abs(floor) + np.abs(bound).max())
            left = left[bound[left] >= floor - slack]
            for x, y in stats[1:]:
                left = left[x[left] @ y[n] >= floor - slack]
        score = (as_float[left] @ q.astype(np.float64)).astype(np.int64) if small else _exact(vectors[left], q)
        if len(left) > k:
            kth = np.partition(score, len(score) - k)[len(score) - k]
            left, score = left[score >= kth], score[score >= kth]
        order = np.lexsort((ids[left], -score))[:k]
        yield n, ids[left[order]], score[order]


def _search(k: int):
    def run(key, part):
        side, ids, rows = (part[c].to_numpy() for c in ("side", "id", "row"))
        vectors = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in part["v"].chunks]).reshape(len(ids), key[2].as_py())
        out = {"query_row": [], "query_id": [], "vec_id": [], "score": []}
        ask, of = side == 0, side == 1
        for n, found, score in best(vectors[ask], rows[ask], vectors[of], rows[of], ids[of], k):
            out["query_row"].append(np.full(len(found), rows[ask][n]))
            out["query_id"].append(np.full(len(found), ids[ask][n]))
            out["vec_id"].append(found)
            out["score"].append(score)
        return pa.table({c: pa.array(np.concatenate(v) if v else [], pa.int64()) for c, v in out.items()})

    return run


def integers(vector: Column) -> Column:
    """floor(64 * x) of each component; null if the vector takes no part."""
    wide = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(wide, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)) & ~F.isnan(x))
    return F.when(F.coalesce(fine, F.lit(False)), F.transform(wide, lambda x: F.floor(SCALE * x)))


def top_k(embeddings: DataFrame, is_query, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
          written: list[str] | None = None) -> DataFrame:
    """Rows (query_id, rank, vec_id, score). ``is_query``: function of the id column."""
    rows = embeddings.select(F.col(id_col).cast("long").alias("id"), integers(F.col(vector_col)).alias("v"))
    rows = rows.where("id is not null and v is not null").withColumn("dim", F.size("v")).withColumn("row", F.monotonically_increasing_id())
    rows = materialize(rows, "topk-rows", written)  # both sides read the same row numbers
    n, n_queries = rows.agg(F.count(F.lit(1)), F.count_if(is_query(F.col("id")))).first()
    q_blocks, c_blocks = -(-max(n_queries, 1) // QUERY_BLOCK), -(-max(n, 1) // CANDIDATE_BLOCK)
    own = F.xxhash64("row")
    queries = rows.where(is_query(F.col("id"))).select(
        F.lit(0).alias("side"), "id", "row", "v", "dim", F.pmod(own, F.lit(q_blocks)).cast("int").alias("q"),
        F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))).alias("c"))
    others = rows.select(
        F.lit(1).alias("side"), "id", "row", "v", "dim", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("q"),
        F.pmod(own, F.lit(c_blocks)).cast("int").alias("c"))
    found = queries.unionByName(others).groupBy("q", "c", "dim").applyInArrow(_search(k), "query_row long, query_id long, vec_id long, score long")
    order = Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
