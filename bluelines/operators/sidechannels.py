"""Side channels without local codes: where they go and which points they list.

Such a channel cannot be placed on its code, so the rules are coarse:

* a work group takes part only if one of its points lies at the start of its line: within
  250 m of the line's start, or on one of its first three pieces -- counted over
  points x pieces, so with ``k`` points on a line the piece at position ``p`` (0-based) has the
  numbers ``p*k+1 .. p*k+k``, and "first three" means ``p*k + 1 <= 3``;
* codes holding two points more than 50 m apart are left out (except codes at or below '999');
* the list of a channel piece holds the points downstream of it on its own line, plus every
  point with the same code.

A position is the place of the point's own segment among the pieces of its line, numbered only on lines
that hold points, by range-partitioned prefix sums, so that a long line spans many tasks; no point meets any piece
but that of its own segment.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bluelines.functions.codes import is_within
from bluelines.operators.numbering import number_within
from bluelines.session import materialize

# Fixed values of the side-channel rules.
START_MEASURE = 250.0
START_PIECES = 3
SEPARATION = 50.0
EXEMPT_ROOT = "999"


def line_positions(points: DataFrame, pieces: DataFrame, written: list[str] | None = None) -> DataFrame:
    """Per point: its segment's group, and ``pos`` = number of pieces of its line (same group)
    that start below its segment (no two pieces of a line share a start); ``k`` = number of points on its line."""
    k = points.groupBy("blue_line_key").agg(F.count(F.lit(1)).alias("k"))
    wanted = pieces.select("linear_feature_id", "blue_line_key", "watershed_group_code", "downstream_route_measure", "piece_index")
    wanted = materialize(wanted.join(k.select("blue_line_key"), "blue_line_key", "left_semi"), "pieces-of-points", written)
    numbered = number_within(wanted, ["blue_line_key", "watershed_group_code"], [F.col("downstream_route_measure").asc()],
                             "piece-numbers", written, nth="pos", total="_of")
    numbered = numbered.where("piece_index = 0").select("linear_feature_id", "watershed_group_code", "pos")
    own = points.select("notation_id", "linear_feature_id", "blue_line_key", "downstream_route_measure")
    return own.join(numbered, "linear_feature_id").join(k, "blue_line_key").select(
        "notation_id", "linear_feature_id", "blue_line_key", "watershed_group_code", "downstream_route_measure", "pos", "k")


def start_of_route(positions: DataFrame, count_points: bool = True) -> DataFrame:
    """``(notation_id, watershed_group_code, near_start)``.

    ``count_points=True`` numbers pieces over points x pieces, as the reference does (with ``k``
    points on a line the "first three" shrink); ``False`` counts distinct pieces."""
    k = F.col("k") if count_points else F.lit(1)
    flag = (F.col("pos") * k + 1 <= START_PIECES) | (F.col("downstream_route_measure") < START_MEASURE)
    return positions.select("notation_id", "watershed_group_code", flag.alias("near_start"))


def multi_point_codes(points: DataFrame) -> DataFrame:
    """Codes with two different points more than 50 m apart (``max - min`` per code; ids are unique)."""
    exempt = F.coalesce(is_within(F.col("wscode"), F.lit(EXEMPT_ROOT)), F.lit(True))
    return (points.where(~exempt).groupBy("wscode")
            .agg((F.max("downstream_route_measure") - F.min("downstream_route_measure")).alias("spread"))
            .where(F.col("spread") > SEPARATION).select("wscode"))


def side_pieces(pieces: DataFrame, starts: DataFrame, multi: DataFrame, points: DataFrame | None = None,
                correlated: bool = False) -> DataFrame:
    """Channel pieces (no local code, not the main flow line) of the groups with a start point,
    minus codes with several points.

    As written in the reference one start point admits every channel of its group
    (``correlated=False``); ``correlated=True`` also requires the channel's code to be the start
    point's code (``points`` gives the codes)."""
    ok = starts.where(F.col("near_start"))
    channels = pieces.where(F.col("localcode").isNull() & (F.col("blue_line_key") != F.col("watershed_key")))
    if correlated:
        keys = ok.join(points.select("notation_id", "wscode"), "notation_id").select(
            "watershed_group_code", "wscode").distinct()
        channels = channels.join(keys, ["watershed_group_code", "wscode"], "left_semi")
    else:
        groups = ok.select("watershed_group_code").distinct()
        channels = channels.join(groups, "watershed_group_code", "left_semi")
    return channels.join(multi, "wscode", "left_anti")
