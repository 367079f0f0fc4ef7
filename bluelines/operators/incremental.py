"""Which work groups an edit of the points or the network can change, and the part of the network that
rebuilding just those groups needs.

The output of a group can change only through its own pieces, so an edit is carried along the same ties by
which points reach pieces:

* an edited segment, before and after, touches its group;
* an edited segment or point touches every group that has a segment on its line (cuts, piece keys, positions
  along the line, the number of points on it);
* an edited point, before and after, touches the groups of all segments it reaches: upstream of it, holding it,
  or channels with its code (the tagged equi join of ``operators.upstream``, as a semi join);
* an edited point touches its own group.

Each tie is a semi join against the edits, which are few; the network is read and never copied. The rebuilt
part holds whole lines, so that keys and positions come out as in a full run, and all points.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bluelines.operators import upstream
from bluelines.operators.changes import row_hash
from bluelines.session import materialize

GROUP = "watershed_group_code"
TIES = ["linear_feature_id", "blue_line_key", "watershed_key", "downstream_route_measure", "upstream_route_measure",
        "wscode", "localcode", GROUP]


def both_versions(before: DataFrame, after: DataFrame, key: str, cols: list[str], compare: list[str] | None = None,
                  written: list[str] | None = None) -> DataFrame:
    """The rows, as they were and as they are (``cols``), whose key is new, gone or has another row in ``compare``.

    The keys come from one aggregation of key and digest, and are written, so that Spark knows how few they are when it
    joins the rows with them."""
    compared = [c for c in (compare or before.columns) if c != key]
    half = lambda n: F.conv(F.substring("_h", 1 + 16 * n, 16), 16, -10).cast("long").alias(f"_h{n}")  # noqa: E731 (all 64 bits)
    version = lambda df, now: df.where(F.col(key).isNotNull()).select(
        key, row_hash(df, compared).alias("_h"), F.lit(now).alias("_now")).select(key, half(0), half(1), "_now")
    ends = version(before, 0).unionByName(version(after, 1)).groupBy(key).agg(
        *[f(c).alias(n + c) for c in ("_h0", "_h1", "_now") for n, f in (("_low", F.min), ("_high", F.max))])
    keys = ends.where("_low_h0 <> _high_h0 or _low_h1 <> _high_h1 or _low_now = _high_now").select(key)
    keys = materialize(keys, "edited-keys", written)
    return before.select(cols).unionByName(after.select(cols)).join(keys, key, "left_semi")


def touched_groups(segments_before: DataFrame, segments_after: DataFrame, points_before: DataFrame, points_after: DataFrame,
                   tolerance: float = upstream.TOLERANCE, segment_compare: list[str] | None = None,
                   written: list[str] | None = None) -> DataFrame:
    """One row per work group whose output the edits can change (column ``watershed_group_code``).

    Segments by ``linear_feature_id``, compared in ``segment_compare`` (all columns of ``segments_before``); placed points by
    ``notation_id`` (``schemas.PLACED_POINTS``)."""
    point_cols = [c for c in points_before.columns if c in points_after.columns]
    points = materialize(both_versions(points_before, points_after, "notation_id", point_cols, written=written), "edited-points", written)
    edited = materialize(both_versions(segments_before, segments_after, "linear_feature_id", TIES, segment_compare, written),
                         "edited-segments", written)
    every = segments_after.select(TIES).unionByName(edited)
    lines = points.select("blue_line_key").unionByName(edited.select("blue_line_key")).unionByName(
        every.join(points.select("linear_feature_id"), "linear_feature_id", "left_semi").select("blue_line_key")).distinct()
    reached = upstream.reached_lines(every, upstream.keyed_points(points), tolerance, written=written)
    groups = (edited.select(GROUP).unionByName(points.select(GROUP))
              .unionByName(every.join(lines, "blue_line_key", "left_semi").select(GROUP))
              .unionByName(reached.select(GROUP)))
    return groups.distinct()


def needed_segments(segments: DataFrame, groups: DataFrame) -> DataFrame:
    """The segments of all lines that run through the groups."""
    lines = segments.join(groups.select(GROUP), GROUP, "left_semi").select("blue_line_key").distinct()
    return segments.join(lines, "blue_line_key", "left_semi")
