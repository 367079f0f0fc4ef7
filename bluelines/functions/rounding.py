"""The two rounding rules the pipeline needs, written as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even_long(x: Column) -> Column:
    """Round a double to the nearest integer, ties to even, as ``bigint``.

    This is the rule for doubles in the key of a piece; ``F.round`` would round ties up.
    The cast to ``bigint`` keeps the text form free of a trailing ``.0``.
    """
    return F.rint(x).cast("bigint")


def round_half_away_int(x: Column) -> Column:
    """Round to the nearest integer, ties away from zero, as ``int`` (the rule for exact numbers)."""
    return F.round(x, 0).cast("int")


def piece_key(blue_line_key: Column, downstream_route_measure: Column) -> Column:
    """Key of a piece of line: ``<line>.<start measure in millimetres>``."""
    return F.concat_ws(".", blue_line_key.cast("string"),
                       round_half_even_long(downstream_route_measure * 1000).cast("string"))
