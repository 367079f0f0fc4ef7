"""Ordered-list helpers for the per-piece point lists (all array higher-order functions)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Notation types in priority order (earlier = higher priority).
TYPE_PRIORITY = ["FR", "FR-EXC", "OR", "PWS", "AR"]

# Fixed values of the output layout: secondary types are cut at 30 characters,
# keeping 28 and adding '..'.
SECONDARY_WIDTH = 30
SECONDARY_KEEP = 28
SECONDARY_SUFFIX = ".."

LIST_SEPARATOR = ";"


def type_priority(notation_type: Column) -> Column:
    """Position of the type in ``TYPE_PRIORITY`` (1-based); NULL for unknown types so they sort last."""
    arr = F.array(*[F.lit(t) for t in TYPE_PRIORITY])
    return F.nullif(F.array_position(arr, notation_type), F.lit(0)).cast("int")


def collapse_runs(arr: Column) -> Column:
    """Keep an element only where it differs from the element before it."""
    return F.filter(arr, lambda x, i: (i == 0) | (x != F.get(arr, i - 1)))


def cut_label(s: Column, width: int = SECONDARY_WIDTH, keep: int = SECONDARY_KEEP,
              suffix: str = SECONDARY_SUFFIX) -> Column:
    """``s`` when shorter than ``width``, else its first ``keep`` characters and ``suffix``."""
    return F.when(F.length(s) < width, s).otherwise(F.concat(F.substring(s, 1, keep), F.lit(suffix)))


def secondary_types(types: Column) -> Column:
    """Types after the first, adjacent repeats removed, joined and cut; NULL when there are none.

    A single-expression form for ad-hoc use: the sliced array is an expression inside the run
    filter's lambda, so long arrays cost more than linear time. The pipeline computes the same
    result in separate projections (``operators.lists.with_list_columns``)."""
    rest = collapse_runs(F.slice(types, 2, F.greatest(F.size(types) - 1, F.lit(0))))
    joined = F.array_join(rest, LIST_SEPARATOR)
    return F.when(F.size(rest) > 0, cut_label(joined))
