"""Numbering within groups by range-partitioned prefix sums: no group, however large, is ordered in one task.

A window ``row_number() over (partition by group order by ...)`` brings a group into one task. Here the rows
are range-partitioned and sorted by (group, order), so a large group spans as many tasks as it needs. Each
range counts its rows per group; these counts (at most ranges + groups rows) are summed up before each range,
and a row's number is its place in its range plus the rows of its group in the ranges before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bluelines.session import materialize

_RANGE_BITS = 33  # monotonically_increasing_id: number of the partition above, of the row in it below


def in_ranges(df: DataFrame, keys: list[Column], name: str = "ranges", written: list[str] | None = None,
              part: str = "range", at: str = "row") -> DataFrame:
    """``df`` range-partitioned and sorted by ``keys``, with the number of the range (int, ascending along the keys) and of
    the row (long, ascending along the whole order). Rows equal in ``keys`` may lie in different ranges.

    The result is written and read back, because bounds are sampled anew whenever the shuffle is planned. Which range a
    row falls in costs no expression and no join, however many ranges there are. ``df`` is read twice (bounds, rows)."""
    tie = "tie of ranges"
    keys = [*keys, F.col(tie)]
    dealt = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys).drop(tie)
    dealt = materialize(dealt.withColumn(at, F.monotonically_increasing_id()), name, written)
    return dealt.withColumn(part, F.shiftrightunsigned(F.col(at), _RANGE_BITS).cast("int"))


def number_within(df: DataFrame, group: list[str], order: list[Column], name: str = "numbered",
                  written: list[str] | None = None, nth: str = "nth", total: str = "n") -> DataFrame:
    """``df`` with ``nth`` (long, from 0, by ``order`` within ``group``) and ``total`` (rows of the group).

    NULLs in ``group`` make a group of their own and come first. Rows equal in ``order`` get distinct numbers
    in any order; they may lie in different ranges, because the row's place in the input breaks ties. An empty
    ``group`` numbers the whole table. ``df`` is read twice (bounds, rows): give a stored table.
    """
    at, part, shift, same_part = (f"{x} of numbering" for x in ("row", "range", "shift", "same range"))
    dealt = in_ranges(df, [*(F.col(c).asc_nulls_first() for c in group), *order], name, written, part, at)
    counts = dealt.groupBy(*group, part).agg(F.min(at).alias("first row"), F.count(F.lit(1)).alias("rows here"))
    over = Window.partitionBy(*group)  # one row per range
    before = over.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(*(F.col(c).alias(f"{c} of range") for c in group), F.col(part).alias(same_part),
                           (F.coalesce(F.sum("rows here").over(before), F.lit(0)) - F.col("first row")).alias(shift),
                           F.sum("rows here").over(over).alias(total))
    same = F.col(part) == F.col(same_part)
    for c in group:
        same &= F.col(c).eqNullSafe(F.col(f"{c} of range"))
    out = dealt.join(counts, same)
    return out.select(*df.columns, (F.col(at) + F.col(shift)).alias(nth), F.col(total))


def running_sum(df: DataFrame, order: list[Column], value: str, total: str = "running", name: str = "running",
                written: list[str] | None = None) -> DataFrame:
    """``df`` with ``total``: the sum of ``value`` over the rows up to this one in ``order``. Sums run inside the ranges; each
    range adds the sum of the ranges before it (one row per range). ``df`` is read twice: give a stored table."""
    at, part, here, of, before = (f"{x} of running" for x in ("row", "range", "sum", "same range", "before"))
    dealt = in_ranges(df, order, name, written, part, at)
    sums = dealt.groupBy(part).agg(F.sum(value).alias(here))
    earlier = Window.partitionBy().orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    sums = materialize(sums.select(F.col(part).alias(of), F.coalesce(F.sum(here).over(earlier), F.lit(0)).alias(before)), f"{name}-sums", written)
    inner = Window.partitionBy(part).orderBy(at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = dealt.withColumn(here, F.sum(value).over(inner)).join(sums, F.col(part) == F.col(of))
    return out.select(*df.columns, (F.col(here) + F.col(before)).alias(total))
