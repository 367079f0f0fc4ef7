"""Linear referencing on tables: snap points to the nearest segment of their line, the point on a
route at a measure, and the cut of a line to a measure range.

The caller prunes the segments to the lines of the points before their geometry is built. Per-row
geometry is column expressions over vertex arrays (``functions.geometry``). Lines have a column ``geom`` (one part) or
``parts`` (any number of parts, with gaps in the measures between them).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bluelines.functions.geometry import (between_points, closest_point, closest_point_parts, covered_parts, covered_range,
                                          first_pair_holding, force2d, point_at_measure, point_at_measure_parts, point_on_pair)


def _closest(lines: DataFrame, x: F.Column, y: F.Column) -> F.Column:
    return closest_point_parts(F.col("parts"), x, y) if "parts" in lines.columns else closest_point(F.col("geom"), x, y)


def _at_measure(lines: DataFrame, m: F.Column) -> F.Column:
    return point_at_measure_parts(F.col("parts"), m) if "parts" in lines.columns else point_at_measure(F.col("geom"), m)


def nearest_segment(points_src: DataFrame, lines: DataFrame) -> DataFrame:
    """For every point, the closest segment with the same ``blue_line_key`` and where on it.

    ``points_src``: ``schemas.POINTS_SRC``. ``lines``: linear_feature_id, blue_line_key,
    downstream_route_measure, length_metre, wscode, localcode, watershed_group_code, geom.
    Ties on distance go to the smaller ``linear_feature_id``. Points whose line key has no
    segment drop out (inner join). A notation id that occurs more than once yields one row, its
    nearest candidate (``distinct on (notation_id) ... order by distance``).
    """
    cand = lines.join(points_src.withColumnRenamed("blue_line_key", "_pblk"),
                      F.col("blue_line_key") == F.col("_pblk"))
    cand = cand.withColumn("_cp", _closest(lines, F.col("x"), F.col("y")))
    frac = F.when(F.col("_cp.total") > 0, F.col("_cp.along") / F.col("_cp.total")).otherwise(F.lit(0.0))
    snapped = F.struct(
        F.col("notation_type"), F.col("notation_description"), F.col("wls_wn_sysid"),
        F.col("linear_feature_id"), F.col("blue_line_key"),
        (frac * F.col("length_metre") + F.col("downstream_route_measure")).alias("downstream_route_measure"),
        F.col("wscode"), F.col("localcode"), F.col("watershed_group_code"),
        F.col("_cp.dist").alias("distance_to_stream"))
    # one row per notation id (a repeated id keeps its nearest candidate), ties by segment id,
    # then by the point's own fields so that the choice is deterministic
    order = F.struct(F.col("_cp.dist"), F.col("linear_feature_id"), F.col("notation_type"),
                     F.col("notation_description"))
    best = F.min_by(snapped, order).alias("_nn")
    return (cand.groupBy("notation_id").agg(best)
            .select("notation_id", "_nn.notation_type", "_nn.notation_description",
                    "_nn.linear_feature_id", "_nn.blue_line_key", "_nn.downstream_route_measure",
                    "_nn.wscode", "_nn.localcode", "_nn.watershed_group_code", "_nn.wls_wn_sysid", "_nn.distance_to_stream"))


def locate_along(points: DataFrame, lines: DataFrame) -> DataFrame:
    """The 2-D point on each point's route at its measure (route = all segments of the line key).

    ``points``: notation_id, blue_line_key, downstream_route_measure.
    The segment whose measure range holds the measure is used; at a shared end the lower one. A measure in a
    gap of its line has no point and gives no row.
    """
    pm = F.col("_pm")
    cand = (lines.join(points.select("notation_id", F.col("blue_line_key").alias("_pblk"),
                                     F.col("downstream_route_measure").alias("_pm")),
                       (F.col("blue_line_key") == F.col("_pblk"))
                       & (F.col("downstream_route_measure") <= pm) & (pm <= F.col("upstream_route_measure"))))
    pt = force2d(_at_measure(lines, pm))  # null fields where there is none
    best = F.min_by("_at", F.struct(F.col("downstream_route_measure"), F.col("linear_feature_id"))).alias("_pt")
    return cand.withColumn("_at", pt).where(F.col("_at.x").isNotNull()).groupBy("notation_id").agg(best).select("notation_id", F.col("_pt.x").alias("x"),
                                                         F.col("_pt.y").alias("y"))


def with_location(snapped: DataFrame, lines: DataFrame) -> DataFrame:
    """The snapped points with ``geom``, the point of their route at their measure."""
    at = locate_along(snapped, lines).select("notation_id", F.struct("x", "y").alias("geom"))
    return snapped.join(at, "notation_id", "left")


def with_geometry(pieces: DataFrame, lines: DataFrame) -> DataFrame:
    """``pieces`` with ``geom`` and ``part``: its segment's line cut to the piece's measure range, in two dimensions, one
    row per part. A piece whose range misses the line, lies in a gap or has no line gives no row."""
    line = lines.select("linear_feature_id", F.col("parts" if "parts" in lines.columns else "geom").alias("_parts"))
    m0, m1 = F.col("downstream_route_measure"), F.col("upstream_route_measure")
    parts = F.col("_parts") if "parts" in lines.columns else F.when(F.col("_parts").isNotNull(), F.array("_parts"))
    covered = pieces.join(line, "linear_feature_id").select(*pieces.columns, F.posexplode(covered_parts(parts, m0, m1)).alias("part", "_line"))
    # inside a lambda an expression is computed wherever it occurs, so a part is cut as a row, step by step
    low, high = covered_range(F.col("_line"), m0, m1)
    step = covered.withColumns({"_low": low, "_high": high})
    step = step.withColumns({"_from": first_pair_holding(F.col("_line"), F.col("_low")), "_to": first_pair_holding(F.col("_line"), F.col("_high"))})
    ends = {"_start": point_on_pair(F.col("_line"), F.col("_from"), F.col("_low")), "_end": point_on_pair(F.col("_line"), F.col("_to"), F.col("_high"))}
    cut = F.transform(between_points(F.col("_line"), F.col("_start"), F.col("_end"), F.col("_low"), F.col("_high")), force2d)
    return step.withColumns(ends).select(*pieces.columns, "part", cut.alias("geom"))


def clip_pieces(pieces: DataFrame, lines: DataFrame) -> DataFrame:
    """The same geometry as rows, one per vertex (``segmented_stream_id, part, vertex_index, x, y``)."""
    # the outer form with a test of its own: the inner one is given a test of its input, for which every line would be cut twice
    rows = with_geometry(pieces, lines).select("segmented_stream_id", "part", F.posexplode_outer("geom").alias("vertex_index", "v"))
    return rows.where("vertex_index is not null").select("segmented_stream_id", "part", "vertex_index", F.col("v.x").alias("x"), F.col("v.y").alias("y"))
