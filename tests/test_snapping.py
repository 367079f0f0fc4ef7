"""Snapping, locating and clipping on hand-made geometry."""

import pytest
from pyspark.sql import functions as F

from bluelines import schemas
from bluelines.operators import snapping
from bluelines.plans.pipeline import Network
from bluelines.sources import fixtures

SEGS = [
    # lfid, blk, wk, dm, um, len, wscode, localcode, fwa, wsg
    (1, 10, 10, 0.0, 10.0, 10.0, "100", "100", "100", "G"),
    (2, 10, 10, 10.0, 20.0, 10.0, "100", "100.000010", "100", "G"),
    (3, 11, 11, 0.0, 10.0, 10.0, "101", "101", "101", "G"),
]
VERTS = [  # straight lines along x; line 11 lies on y = 5
    (1, 0, 0.0, 0.0, 0.0), (1, 1, 10.0, 0.0, 10.0),
    (2, 0, 10.0, 0.0, 10.0), (2, 1, 20.0, 0.0, 20.0),
    (3, 0, 0.0, 5.0, 0.0), (3, 1, 10.0, 5.0, 10.0),
]
SRC = [
    ("A", "FR", "1 - x", 10, 4.0, 3.0),     # above segment 1, 3 m away
    ("B", "OR", None, 10, 10.0, 2.0),       # above the shared vertex: equidistant to 1 and 2
    ("C", "AR", None, 10, 25.0, 0.0),       # beyond the end of the line: closest is the end of 2
    ("D", "PWS", None, 99, 1.0, 1.0),       # no segment on its line: drops out
]


@pytest.fixture(scope="module")
def net(spark):
    seg = spark.createDataFrame(SEGS, schemas.SEGMENTS)
    vert = spark.createDataFrame(VERTS, "linear_feature_id bigint, seq int, x double, y double, m double")
    src = spark.createDataFrame([(*r, k, None, None) for k, r in enumerate(SRC)], schemas.POINTS_SRC)
    return Network(spark, segments=seg, points_src=src, vertices=vert,
                   points=spark.createDataFrame([], schemas.PLACED_POINTS))


def test_nearest_segment(net):
    got = {r.notation_id: (r.linear_feature_id, round(r.distance_to_stream, 9), round(r.downstream_route_measure, 9))
           for r in net.snapped.collect()}
    assert got["A"] == (1, 3.0, 4.0)
    assert got["B"] == (1, 2.0, 10.0)        # tie on distance: the smaller line id
    assert got["C"] == (2, 5.0, 20.0)
    assert "D" not in got


def test_locate_along(net):
    got = {r.notation_id: (r.x, r.y) for r in snapping.locate_along(net.snapped, net.point_lines).collect()}
    assert got == {"A": (4.0, 0.0), "B": (10.0, 0.0), "C": (20.0, 0.0)}


def test_clip_pieces(spark, net):
    pieces = spark.createDataFrame([("10.2500", 1, 2.5, 7.5), ("10.10000", 2, 10.0, 20.0)],
                                   "segmented_stream_id string, linear_feature_id bigint, "
                                   "downstream_route_measure double, upstream_route_measure double")
    got = sorted((r.segmented_stream_id, r.vertex_index, r.x, r.y)
                 for r in snapping.clip_pieces(pieces, net.point_lines).collect())
    assert got == [("10.10000", 0, 10.0, 0.0), ("10.10000", 1, 20.0, 0.0),
                   ("10.2500", 0, 2.5, 0.0), ("10.2500", 1, 7.5, 0.0)]


def test_repeated_id_keeps_its_nearest_row(spark):
    seg = spark.createDataFrame(SEGS, schemas.SEGMENTS)
    vert = spark.createDataFrame(VERTS, "linear_feature_id bigint, seq int, x double, y double, m double")
    src = spark.createDataFrame([("E", "FR", "far", 10, 15.0, 4.0, 1, None, None), ("E", "OR", "near", 10, 5.0, 1.0, 2, None, None)],
                                schemas.POINTS_SRC)
    n = Network(spark, segments=seg, points_src=src, vertices=vert,
                points=spark.createDataFrame([], schemas.PLACED_POINTS))
    got = [(r.notation_id, r.notation_type, r.linear_feature_id, round(r.distance_to_stream, 9))
           for r in n.snapped.collect()]
    assert got == [("E", "OR", 1, 1.0)]


def test_snapped_table_in_full(net):
    got = {r.notation_id: (r.wls_wn_sysid, r.distance_to_stream, (r.geom.x, r.geom.y)) for r in net.snapped.collect()}
    assert set(net.snapped.columns) == {f.name for f in schemas.NOTATIONS.fields}
    assert got == {"A": (0, 3.0, (4.0, 0.0)), "B": (1, 2.0, (10.0, 0.0)), "C": (2, 5.0, (20.0, 0.0))}


def test_only_lines_of_points_get_geometry(net):
    assert {r.linear_feature_id for r in net.point_lines.collect()} == {1, 2}


# ---- lines in parts -------------------------------------------------------------------------
PARTS = "array<array<struct<x:double,y:double,m:double>>>"


def _line(*parts):
    return [[(float(m), 0.0, float(m)) for m in part] for part in parts]


def _cut(spark, line, m0, m1):
    pieces = spark.createDataFrame([("k", 1, float(m0), float(m1))],
                                   "segmented_stream_id string, linear_feature_id long, downstream_route_measure double, upstream_route_measure double")
    lines = spark.createDataFrame([(1, line)], f"linear_feature_id long, parts {PARTS}")
    return [(r.part, [v.x for v in r.geom]) for r in snapping.with_geometry(pieces, lines).orderBy("part").collect()]


def test_a_cut_over_a_gap_gives_parts(spark):
    line = _line([0, 10, 40], [60, 100], [100, 120])
    assert _cut(spark, line, 5, 70) == [(0, [5, 10, 40]), (1, [60, 70])]
    assert _cut(spark, line, 0, 120) == [(0, [0, 10, 40]), (1, [60, 100]), (2, [100, 120])]
    assert _cut(spark, line, 45, 55) == [] and _cut(spark, line, 200, 300) == []      # in the gap, beyond the end
    assert _cut(spark, line, 40, 60) == []                                          # touches both ends only
    assert _cut(spark, line, 20, 30) == [(0, [20, 30])] and _cut(spark, line, 70, 70) == [(0, [70, 70])]
    assert _cut(spark, [], 0, 10) == [] and _cut(spark, None, 0, 10) == [] and _cut(spark, [[]], 0, 10) == []


def test_points_on_lines_in_parts(spark):
    line = [[(0.0, 0.0, 0.0), (10.0, 0.0, 10.0)], [(30.0, 0.0, 30.0), (30.0, 20.0, 50.0)]]
    lines = spark.createDataFrame([(1, 7, 0.0, 50.0, 50.0, "1", "1", "W1", line)], f"""linear_feature_id long, blue_line_key long,
        downstream_route_measure double, upstream_route_measure double, length_metre double, wscode string, localcode string,
        watershed_group_code string, parts {PARTS}""")
    at = spark.createDataFrame([("a", 7, 4.0), ("gap", 7, 20.0), ("b", 7, 40.0), ("end", 7, 30.0)],
                               "notation_id string, blue_line_key long, downstream_route_measure double")
    assert {r.notation_id: (r.x, r.y) for r in snapping.locate_along(at, lines).collect()} == {
        "a": (4.0, 0.0), "b": (30.0, 10.0), "end": (30.0, 0.0)}
    src = spark.createDataFrame([("p", "FR", "", 7, 29.0, 15.0, 1), ("q", "FR", "", 7, 12.0, 3.0, 2)],
                                "notation_id string, notation_type string, notation_description string, blue_line_key long, x double, y double, wls_wn_sysid int")
    near = {r.notation_id: r for r in snapping.nearest_segment(src, lines).collect()}
    # 30 m of line in all: p is 10 + 15 along it, q at the end of the first part
    assert abs(near["p"].downstream_route_measure - 25 / 30 * 50) < 1e-9 and near["p"].distance_to_stream == 1.0
    assert abs(near["q"].downstream_route_measure - 10 / 30 * 50) < 1e-9


def test_vertices_with_parts_become_lines_of_parts(spark):
    vert = spark.createDataFrame([(1, 0, 1, 1.0), (1, 0, 0, 0.0), (1, 1, 0, 5.0), (1, 1, 1, 6.0), (2, 0, 0, 0.0), (2, 0, 1, 3.0)],
                                 "linear_feature_id long, part int, seq int, m double").withColumns({"x": F.col("m"), "y": F.lit(0.0)})
    got = {r.linear_feature_id: [[v.m for v in p] for p in r.parts] for r in fixtures.line_geometry(vert).collect()}
    assert got == {1: [[0.0, 1.0], [5.0, 6.0]], 2: [[0.0, 3.0]]}


def test_a_line_is_cut_once(spark):
    """The cut of a piece is in the plan once: not again in a test of its size, nor again in each use of its ends."""
    lines = spark.createDataFrame([(1, [[(0.0, 0.0, 0.0), (4.0, 0.0, 4.0)]])], "linear_feature_id bigint, parts array<array<struct<x:double,y:double,m:double>>>")
    pieces = spark.createDataFrame([("s", 1, 1.0, 2.0)], "segmented_stream_id string, linear_feature_id bigint, downstream_route_measure double, upstream_route_measure double")
    cut = snapping.clip_pieces(pieces, lines)
    assert cut._jdf.queryExecution().executedPlan().toString().count("sequence(0") == 2  # one for each end
    assert [(r.part, r.vertex_index, r.x) for r in cut.orderBy("vertex_index").collect()] == [(0, 0, 1.0), (0, 1, 2.0)]


def test_vertices_by_segment_are_shuffled_once(spark):
    """Vertices that lie together by segment become lines of parts where they are."""
    vert = spark.createDataFrame([(1, 1, 0, 5.0, 0.0, 5.0), (1, 0, 1, 2.0, 0.0, 2.0), (1, 0, 0, 0.0, 0.0, 0.0)],
                                 "linear_feature_id bigint, part int, seq int, x double, y double, m double").repartition(3, "linear_feature_id")
    lines = fixtures.line_geometry(vert)
    assert lines._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    assert [[[v.m for v in p] for p in r.parts] for r in lines.collect()] == [[[0.0, 2.0], [5.0]]]
