"""Cut the working segments at the points (breakpoints more than 1 m from both ends).

Breakpoints are rows (line, measure), one per rounded measure. Segments and breakpoints meet in an equi
join on line and measure bucket, with the range as residual, so a long line with many points does not
pair every segment with every point. Only the cuts inside a segment are put in order; the pieces come
from ``explode(arrays_zip(starts, ends))``: the first keeps the segment's key and start, the others start
at a cut. A piece whose key exists already is skipped, segments before cuts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bluelines.functions.rounding import piece_key, round_half_away_int
from bluelines.operators.common import first_per_key

MIN_END_DISTANCE = 1.0  # metres; no cut within this distance of an end
BUCKET = 1000.0  # metres of line that share a join key


def _bucket(measure: F.Column) -> F.Column:
    return F.floor(measure / BUCKET)


def breakpoints(points: DataFrame) -> DataFrame:
    """Distinct rounded point measures: rows (blue_line_key, m)."""
    return points.select("blue_line_key", round_half_away_int(F.col("downstream_route_measure")).alias("m")).distinct()


def cuts(work: DataFrame, bps: DataFrame, gap: float = MIN_END_DISTANCE) -> DataFrame:
    """Rows (linear_feature_id, cuts): the ordered cuts of each segment that has some."""
    dm, um, m = F.col("downstream_route_measure"), F.col("upstream_route_measure"), F.col("m")
    seg = work.select("linear_feature_id", "blue_line_key", "downstream_route_measure", "upstream_route_measure",
                      F.explode(F.sequence(_bucket(dm), _bucket(um))).alias("_b"))
    at = bps.select("blue_line_key", "m", _bucket(m).alias("_b"))
    return (seg.join(at, ["blue_line_key", "_b"]).where((m - dm > F.lit(gap)) & (um - m > F.lit(gap)))
            .groupBy("linear_feature_id").agg(F.array_sort(F.collect_set(m.cast("double"))).alias("cuts")))


def break_lines(work: DataFrame, bps: DataFrame, gap: float = MIN_END_DISTANCE) -> DataFrame:
    """Pieces of the working segments: one row per key with ``segmented_stream_id``, ``piece_index`` (0 =
    the shortened original), ``parent_stream_id`` (key of the segment it was cut from), start and end
    measure; all other columns of ``work`` are carried."""
    dm, um = F.col("downstream_route_measure"), F.col("upstream_route_measure")
    inner = F.coalesce("cuts", F.array().cast("array<double>"))
    keep = [c for c in work.columns if c not in ("downstream_route_measure", "upstream_route_measure")]
    ends = F.arrays_zip(F.concat(F.array(dm), inner).alias("s"), F.concat(inner, F.array(um)).alias("e"))
    parts = work.join(cuts(work, bps, gap), "linear_feature_id", "left").select(
        *keep, piece_key(F.col("blue_line_key"), dm).alias("parent_stream_id"), F.posexplode(ends).alias("piece_index", "se"))
    parts = parts.select(piece_key(F.col("blue_line_key"), F.col("se")["s"]).alias("segmented_stream_id"),
                         *keep, "piece_index", "parent_stream_id",
                         F.col("se")["s"].alias("downstream_route_measure"), F.col("se")["e"].alias("upstream_route_measure"))
    return first_per_key(parts, ["segmented_stream_id"], [F.col("piece_index") > 0, "linear_feature_id", "piece_index"])


def whole_pieces(work: DataFrame) -> DataFrame:
    """The pieces of segments without cuts, one per key already: each is its segment."""
    key = piece_key(F.col("blue_line_key"), F.col("downstream_route_measure"))
    keep = [c for c in work.columns if c not in ("downstream_route_measure", "upstream_route_measure")]
    return work.select(key.alias("segmented_stream_id"), *keep, F.lit(0).alias("piece_index"), key.alias("parent_stream_id"),
                       "downstream_route_measure", "upstream_route_measure")
