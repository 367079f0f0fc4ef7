"""The end-to-end job: points -> work segments -> pieces -> per-piece point lists -> outputs.

One Spark application replaces the reference's per-group loop of database sessions: all work
groups are processed in one job, and groups only lay out the output files. Reused intermediate
tables (network, points, pieces, lists) are written as Parquet below the shared checkpoint
folder and read back, which cuts lineage and survives the loss of executors; ``release()``
deletes them when the job is done.

Shuffles in the main path: building the network (fixture only); one row per key of the work segments and
of the pieces; the piece table by line id; the distinct codes of the pieces; and the join of per-piece
direct lists with per-code inherited lists on the code. No join is forced to broadcast: the point tables
are written first, so Spark knows their bytes and decides.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bluelines.operators import breaking, lists, sidechannels, snapping, upstream
from bluelines.session import apply_defaults, materialize, remove_paths
from bluelines.sources import fixtures
from bluelines.sources.tables import Tables

PIECE_ATTRS = ["linear_feature_id", "segmented_stream_id", "blue_line_key", "fwa_watershed_code",
               "downstream_route_measure", "upstream_route_measure", "watershed_group_code"]

OUTPUT_COLS = ["linear_feature_id", "notation_id_list", "primary_notation_type", "secondary_notation_types",
               "fwa_watershed_code", "blue_line_key", "downstream_route_measure", "upstream_route_measure"]


class Network:
    """All stages of the job over one data folder; every stage is built once, lazily."""

    def __init__(self, spark: SparkSession, sf_dir: str | None = None, tolerance: float = upstream.TOLERANCE,
                 segments: DataFrame | None = None, points: DataFrame | None = None,
                 points_src: DataFrame | None = None, vertices: DataFrame | None = None,
                 side_correlated: bool = False, side_count_points: bool = True):
        """Over the fixture network of ``sf_dir``, or over given tables: ``segments``
        (``schemas.SEGMENTS``), snapped ``points`` (``schemas.NOTATIONS``), raw ``points_src`` and
        line ``vertices`` (linear_feature_id, seq, x, y, m). The two side-channel options keep the
        reference's behaviour by default (see ``operators/sidechannels.py``)."""
        self.side_correlated = side_correlated
        self.side_count_points = side_count_points
        apply_defaults(spark)
        self.spark = spark
        self.sf_dir = sf_dir
        self.tables = Tables(spark, sf_dir) if sf_dir else None
        self.tolerance = tolerance
        self._given = {"segments": segments, "points": points, "points_src": points_src, "vertices": vertices}
        self.written: list[str] = []

    def release(self) -> int:
        """Delete the intermediate tables this job wrote below the checkpoint folder. Call it once
        the outputs are written or consumed: DataFrames of this object read those tables."""
        n = remove_paths(self.spark, self.written)
        self.written.clear()
        # forget the stages that read them; using the object again recomputes them
        for name, attr in type(self).__dict__.items():
            if isinstance(attr, cached_property):
                self.__dict__.pop(name, None)
        return n

    # ---- inputs -------------------------------------------------------------------------
    @cached_property
    def segments(self) -> DataFrame:
        """The network. A given table is used as it is (its lineage is a scan, and copying the
        largest input would cost a full write); the fixture network, derived from several tables
        by joins and a window, is materialised once because every stage reads it, the rows of a line together."""
        seg = self._given["segments"]
        if seg is not None:
            return seg
        return materialize(fixtures.network(self.tables), "network", self.written, bucket="blue_line_key")

    @cached_property
    def points(self) -> DataFrame:
        """Snapped points with their list rank (materialised: small, read many times)."""
        pts = self._given["points"]
        pts = fixtures.points(self.tables, self.segments) if pts is None else pts
        return materialize(lists.rank_points(pts), "points", self.written)

    @cached_property
    def kpoints(self) -> DataFrame:
        """Points exploded to their join tags."""
        kp = upstream.keyed_points(self.points, extra=["prank"])
        return materialize(kp, "keyed-points", self.written)

    @cached_property
    def vertices(self) -> DataFrame:
        v = self._given["vertices"]
        return fixtures.vertices(self.segments) if v is None else v

    LINE_COLS = ["linear_feature_id", "blue_line_key", "downstream_route_measure", "upstream_route_measure",
                 "length_metre", "wscode", "localcode", "watershed_group_code"]

    def _lines(self, wanted: DataFrame, key: str, name: str, cols: list[str]) -> DataFrame:
        """Segments whose ``key`` is in ``wanted``, one row each (``cols``) with its vertices in order. The segments,
        and then the vertices, are cut down to what is asked for before any vertex is grouped."""
        seg = self.segments.select(*self.LINE_COLS).join(wanted.select(key).distinct(), key, "left_semi")
        if self._given["vertices"] is None:  # the fixture's vertices derive from the segment row
            lines = fixtures.segment_geometry(seg).select(*cols, "geom")
        else:
            vertices = self.vertices.join(seg.select("linear_feature_id"), "linear_feature_id", "left_semi")
            lines = seg.select(*cols).join(fixtures.line_geometry(vertices), "linear_feature_id")
        return materialize(lines, name, self.written)

    @cached_property
    def point_lines(self) -> DataFrame:
        """The segments of the lines that the raw points name, with geometry."""
        return self._lines(self.points_src, "blue_line_key", "point-lines", self.LINE_COLS)

    @cached_property
    def listed_lines(self) -> DataFrame:
        """The geometry of the segments that occur in the output."""
        return self._lines(self.stream_list_all, "linear_feature_id", "listed-lines", ["linear_feature_id"])

    # ---- main path ----------------------------------------------------------------------
    WORK_COLS = ["linear_feature_id", "blue_line_key", "watershed_key", "downstream_route_measure",
                 "upstream_route_measure", "wscode", "localcode", "fwa_watershed_code", "watershed_group_code"]

    ON_POINT_LINE = "on_point_line"  # whether a point lies on the row's line

    @cached_property
    def flagged_work(self) -> DataFrame:
        """Segments upstream of a point, holding one, or unplaceable channels with a point's code;
        only the columns the later stages read, and whether a point lies on the line (materialised)."""
        return materialize(upstream.work_lines(self.segments.select(*self.WORK_COLS), self.kpoints, self.tolerance, self.written,
                                               self.ON_POINT_LINE), "work", self.written)

    @cached_property
    def work(self) -> DataFrame:
        return self.flagged_work.drop(self.ON_POINT_LINE)

    @cached_property
    def breakpoints(self) -> DataFrame:
        return materialize(breaking.breakpoints(self.points), "breakpoints", self.written)

    @cached_property
    def flagged_pieces(self) -> DataFrame:
        """Work segments cut at the points. Only lines that hold points have cuts, and a key names its line, so only
        their pieces are shuffled and written; the other segments are read as they were stored."""
        work, here = self.flagged_work, F.col(self.ON_POINT_LINE)
        cut = breaking.break_lines(work.where(here), self.breakpoints)
        cut = materialize(cut, "pieces", self.written)
        return breaking.whole_pieces(work.where(~here)).unionByName(cut)

    @cached_property
    def pieces(self) -> DataFrame:
        return self.flagged_pieces.drop(self.ON_POINT_LINE)

    def main_pairs(self) -> DataFrame:
        # the small piece table is shuffled by line id once; pairing (broadcast join) and the
        # list aggregation by line then run in the same stage, so the pairs are never shuffled
        main = self.pieces.where(F.col("localcode").isNotNull()).repartition("linear_feature_id")
        return upstream.upstream_pairs(main, self.kpoints, self.tolerance)

    @staticmethod
    def _lists(pairs: DataFrame, distinct: bool) -> DataFrame:
        agg = pairs.groupBy(*PIECE_ATTRS).agg(lists.collect_ordered(distinct))
        return lists.with_list_columns(agg).select("segmented_stream_id", *OUTPUT_COLS, "watershed_group_code")

    @cached_property
    def stream_list(self) -> DataFrame:
        """Per piece with a local code: the ordered list of the points downstream of it; the part
        inherited from ancestor codes is built once for all codes above the same points (``lists.shared_lists``)."""
        main = self.flagged_pieces.where(F.col("localcode").isNotNull())
        out = lists.shared_list_columns(main, self.kpoints, PIECE_ATTRS, self.tolerance, self.written, self.ON_POINT_LINE)
        return out.select("segmented_stream_id", *OUTPUT_COLS, "watershed_group_code")

    @cached_property
    def stream_list_direct(self) -> DataFrame:
        """The same lists from one row per (piece, point) pair (reference for the shared form)."""
        return self._lists(self.main_pairs(), distinct=False)

    # ---- side channels ------------------------------------------------------------------
    @cached_property
    def positions(self) -> DataFrame:
        return sidechannels.line_positions(self.points, self.flagged_pieces.where(self.ON_POINT_LINE), self.written)

    @cached_property
    def starts(self) -> DataFrame:
        return sidechannels.start_of_route(self.positions, self.side_count_points)

    @cached_property
    def multi_codes(self) -> DataFrame:
        return sidechannels.multi_point_codes(self.points)

    @cached_property
    def side_pieces(self) -> DataFrame:
        return sidechannels.side_pieces(self.pieces, self.starts, self.multi_codes, self.points,
                                        correlated=self.side_correlated)

    def side_pairs(self) -> DataFrame:
        res = upstream.upstream_residual(self.tolerance) | upstream.same_code_residual()
        side = self.side_pieces.repartition("linear_feature_id")
        return upstream.line_point_pairs(side, self.kpoints, res).drop("_k")

    @cached_property
    def side_list(self) -> DataFrame:
        """Per side-channel piece: its list; a point reached through both tags counts once."""
        return self._lists(self.side_pairs(), distinct=True)

    @cached_property
    def stream_list_all(self) -> DataFrame:
        """Main and side-channel lists (materialised: the output, read by sinks and geometry)."""
        return materialize(self.stream_list.unionByName(self.side_list), "stream-list", self.written)

    # ---- snapping -----------------------------------------------------------------------
    @cached_property
    def points_src(self) -> DataFrame:
        src = self._given["points_src"]
        return materialize(fixtures.points_src(self.tables, self.segments) if src is None else src, "points-src", self.written)

    @cached_property
    def snapped(self) -> DataFrame:
        """Points snapped to the nearest segment of their line and located on it (``schemas.NOTATIONS``)."""
        near = materialize(snapping.nearest_segment(self.points_src, self.point_lines), "nearest", self.written)
        return materialize(snapping.with_location(near, self.point_lines), "snapped", self.written)

    @cached_property
    def stream_output(self) -> DataFrame:
        """The lists of all pieces with the geometry of each piece."""
        return snapping.with_geometry(self.stream_list_all, self.listed_lines)
