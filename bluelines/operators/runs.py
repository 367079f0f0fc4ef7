"""Run collapse over long ordered sequences: keep a row only where its value differs from the row
before it in the same sequence.

The per-piece type lists are short and use the array form (``functions.lists.collapse_runs``).
A sequence that may be huge (all events of one user) must not become one task, so the rows are range-partitioned
and sorted by key and order (``numbering.in_ranges``): ranges hold about equally many rows however the rows crowd
in time. The ``lag`` runs inside ``(key, range)``, and the value before a range's first row of a key is the last value
of that key's previous range, taken from a summary (``max_by`` with partial aggregation; one row per key and
range, far smaller than the rows). A row's range comes from the shuffle, so the plan does not grow with their number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bluelines.operators.numbering import in_ranges


def run_starts(df: DataFrame, key: str, order: list[str], value: str, bucket: F.Column | None = None,
               written: list[str] | None = None) -> DataFrame:
    """Rows of ``df`` that start a run of equal ``value`` within ``key`` ordered by ``order``.

    ``bucket`` is a column that grows with ``order`` (e.g. the hour of a timestamp) where the rows have one; without it
    they are dealt into ranges."""
    if bucket is None:
        d = in_ranges(df, [F.col(c).asc_nulls_first() for c in (key, *order)], "runs", written, "_b", "_at").drop("_at")
    else:
        d = df.withColumn("_b", bucket)
    inner = Window.partitionBy(key, "_b").orderBy(*order)
    last = (d.groupBy(key, "_b")
            .agg(F.max_by(F.col(value), F.struct(*[F.col(c) for c in order])).alias("_last")))
    # previous non-empty bucket of the key: a window over bucket summaries (one row per bucket)
    by_bucket = Window.partitionBy(key).orderBy("_b")
    carry = last.select(F.col(key).alias("_key"), F.col("_b").alias("_of"), F.lag("_last").over(by_bucket).alias("_carry"))
    d = d.withColumn("_prev", F.lag(value).over(inner)).withColumn("_rn", F.row_number().over(inner))
    d = d.join(carry, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_b") == F.col("_of")), "left")
    prev = F.when(F.col("_rn") == 1, F.col("_carry")).otherwise(F.col("_prev"))
    d = d.withColumn("_p", prev)
    keep = F.col("_p").isNull() | (F.col("_p") != F.col(value))
    return d.where(keep).drop("_b", "_prev", "_rn", "_carry", "_p", "_key", "_of")
