"""Small building blocks shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def first_per_key(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """First row per key under an explicit order (``distinct on (key) ... order by key, order``).

    A ``min_by`` aggregate: partial aggregation on the map side, no sort, no window, and a hot
    key is reduced per task before the shuffle.
    """
    others = [c for c in df.columns if c not in key]
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    best = F.min_by(F.struct(*[F.col(c) for c in others]), F.struct(*order_cols)).alias("_best")
    return df.groupBy(*key).agg(best).select(*key, *[F.col("_best")[c].alias(c) for c in others])


def insert_ignore(target: DataFrame, incoming: DataFrame, key: list[str], order: list) -> DataFrame:
    """``insert ... on conflict (key) do nothing``: the rows of ``target`` plus the first incoming
    row of every key that ``target`` does not hold yet."""
    fresh = first_per_key(incoming, key, order).join(target.select(*key), key, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def round6(c) -> F.Column:
    """Doubles in results are given to 6 decimals so that two engines compare equal."""
    return F.round(F.col(c) if isinstance(c, str) else c, 6)
