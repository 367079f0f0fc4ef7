"""Hierarchical dotted codes (``100.000300.0000000042``) as plain strings.

Codes compare as strings: labels of one level have a fixed width in the data and '.'
sorts before every digit, so string order equals level-by-level order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def depth(code) -> Column:
    """Number of levels of a code (dots + 1), without splitting it."""
    c = _c(code)
    return F.length(c) - F.length(F.replace(c, F.lit("."), F.lit(""))) + 1


def levels(code) -> Column:
    """The labels of a code as ``array<string>``."""
    return F.split(_c(code), r"\.")


def prefix(code, n) -> Column:
    """The first ``n`` levels of a code (the whole code when it has fewer); ``n`` int or column."""
    n_c = n if isinstance(n, Column) else F.lit(n)
    return F.call_function("substring_index", _c(code), F.lit("."), n_c)


def prefixes(code) -> Column:
    """All prefixes of a code, shortest first, the code itself last (one per level)."""
    c = _c(code)
    return F.transform(F.sequence(F.lit(1), depth(c)), lambda n: prefix(c, n))


def level_range(lo, hi) -> Column:
    """``[lo .. hi]`` as an array, empty when ``hi < lo`` (``sequence`` alone would count down).

    Exploding level numbers and taking ``prefix(code, n)`` per row keeps the work in generated
    code; building the prefixes inside an array with a lambda is several times slower."""
    lo_c = lo if isinstance(lo, Column) else F.lit(lo)
    hi_c = hi if isinstance(hi, Column) else F.lit(hi)
    return F.when(hi_c >= lo_c, F.sequence(lo_c, hi_c)).otherwise(F.array().cast("array<int>"))


def is_within(code, root) -> Column:
    """``code`` equals ``root`` or lies below it (the ``<@`` test). NULL if either is NULL."""
    return F.startswith(F.concat(_c(code), F.lit(".")), F.concat(_c(root), F.lit(".")))


def is_strictly_within(code, root) -> Column:
    """``code`` lies below ``root`` and is not equal to it."""
    return is_within(code, root) & (_c(code) != _c(root))
