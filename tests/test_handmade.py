"""A hand-made river: main stem, a tributary with its own tributary, side channels, points at a
segment end, two points at one place, an unknown type. Checked against the definition-form SQL
run by DuckDB on the same rows, plus hand-derived facts."""

import duckdb
import pandas as pd
import pytest

from bluelines import schemas
from bluelines.plans import oracle as O
from bluelines.plans.pipeline import Network

SEG_COLS = [f.name for f in schemas.SEGMENTS.fields]
SEGMENTS = [
    # lfid, blk, wk, dm, um, len, wscode, localcode, fwa, wsg
    (11, 1, 1, 0.0, 100.0, 100.0, "100", "100", "100", "AAAA"),
    (12, 1, 1, 100.0, 200.0, 100.0, "100", "100.000100", "100", "AAAA"),
    (13, 1, 1, 200.0, 300.0, 100.0, "100", "100.000200", "100", "AAAA"),
    (21, 2, 2, 0.0, 100.0, 100.0, "100.000150", "100.000150", "100-000150", "BBBB"),
    (22, 2, 2, 100.0, 200.0, 100.0, "100.000150", "100.000150.000100", "100-000150", "BBBB"),
    (51, 5, 5, 0.0, 80.0, 80.0, "100.000150.000120", "100.000150.000120", "100-000150-000120", "BBBB"),
    (31, 3, 5, 0.0, 60.0, 60.0, "100.000150.000120", None, "100-000150-000120", "BBBB"),  # side channel
    (41, 4, 4, 0.0, 50.0, 50.0, "100", None, "100", "AAAA"),      # own flow line, no local code
    (61, 6, 6, 0.0, 90.0, 90.0, "101", "101", "101", "CCCC"),    # another river, nothing on it
]
PT_COLS = [f.name for f in schemas.PLACED_POINTS.fields]
POINTS = [
    # id, type, description, lfid, blk, meas, wscode, localcode, wsg
    ("NO1", "FR", "12 - PWS - 2011/09/29", 11, 1, 50.0, "100", "100", "AAAA"),
    ("NO2", "OR", "117 MILE CREEK - FR - 1986/06/23", 13, 1, 200.4, "100", "100.000200", "AAAA"),
    ("NO3", "PWS", "12 -X", 22, 2, 150.0, "100.000150", "100.000150.000100", "BBBB"),
    ("NO4", "FR-EXC", None, 22, 2, 150.0, "100.000150", "100.000150.000100", "BBBB"),
    ("NO5", "XX", "5 - AR", 12, 1, 120.0, "100", "100.000100", "AAAA"),
    ("NO6", "AR", "6 - AR", 21, 2, 99.5, "100.000150", "100.000150", "BBBB"),
    ("NO7", "OR", "7 - OR", 51, 5, 40.0, "100.000150.000120", "100.000150.000120", "BBBB"),
]


@pytest.fixture(scope="module")
def net(spark):
    seg = spark.createDataFrame(SEGMENTS, schemas.SEGMENTS)
    pts = spark.createDataFrame(POINTS, schemas.PLACED_POINTS)
    return Network(spark, segments=seg, points=pts)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    seg = pd.DataFrame(SEGMENTS, columns=SEG_COLS)
    pts = pd.DataFrame(POINTS, columns=PT_COLS)
    c.register("segments", seg)
    c.register("points", pts)
    return c


def _spark_rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_lists_match_sql(net, con):
    sql = O.with_ctes(*O.ON_POINTS) + " " + O.ALL_LIST
    want = sorted(tuple(r) for r in con.execute(sql).fetchall())
    got = _spark_rows(net.stream_list_all.select(*O.LIST_COLS.replace("round(", "").split(", ")[:6],
                                                 "downstream_route_measure", "upstream_route_measure"))
    assert got == [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in want]
    assert len(got) > 0


def test_pieces_match_sql(net, con):
    sql = O.with_ctes(O.WORK, O.BREAK) + (" SELECT segmented_stream_id, linear_feature_id, downstream_route_measure,"
                                          " upstream_route_measure FROM pieces")
    want = sorted(tuple(r) for r in con.execute(sql).fetchall())
    got = _spark_rows(net.pieces.select("segmented_stream_id", "linear_feature_id", "downstream_route_measure",
                                        "upstream_route_measure"))
    assert got == want


def test_breaking_by_hand(net):
    pieces = {(r.linear_feature_id, r.downstream_route_measure, r.upstream_route_measure)
              for r in net.pieces.collect()}
    assert {(11, 0.0, 50.0), (11, 50.0, 100.0)} <= pieces            # cut at the point
    assert (13, 200.0, 300.0) in pieces                                # 0.4 m from the end: no cut
    assert {(22, 100.0, 150.0), (22, 150.0, 200.0)} <= pieces         # two points, one cut
    assert (21, 0.0, 100.0) in pieces                                  # 0.5 m from the end: no cut
    assert not any(p[0] == 61 for p in pieces)                        # nothing upstream of a point


def test_lists_by_hand(net):
    rows = {(r.linear_feature_id, r.downstream_route_measure): r for r in net.stream_list_all.collect()}
    top = rows[(13, 200.0)]
    # same line: all three points below, ordered by local code desc
    assert top.notation_id_list == "NO2;NO5;NO1"
    assert top.primary_notation_type == "OR"
    assert top.secondary_notation_types == "XX;FR"
    trib = rows[(22, 150.0)]
    # two points at one place: same code and measure, priority decides (FR-EXC before PWS)
    assert trib.notation_id_list.startswith("NO4;NO3")
    # the tributary enters above NO1 and NO5 (at 150 > 100.000100), not above NO2
    assert trib.notation_id_list == "NO4;NO3;NO6;NO5;NO1"
    # the sub-tributary: its own point only above the cut, then everything its stream enters above
    assert rows[(51, 40.0)].notation_id_list == "NO7;NO4;NO3;NO6;NO5;NO1"
    assert rows[(51, 0.0)].notation_id_list == "NO4;NO3;NO6;NO5;NO1"
    assert (31, 0.0) in rows and (41, 0.0) not in rows               # side channel placed; own line not


def test_side_channel_list(net):
    side = {r.linear_feature_id: r for r in net.side_list.collect()}
    assert set(side) == {31}
    # downstream on its own line (none) plus every point with the same code
    assert side[31].notation_id_list == "NO7"


def test_multi_point_code_excludes_side_channels(net):
    # '100' holds points 150 m apart, '100.000150' points 50.5 m apart; the sub-tributary's code one
    assert {r.wscode for r in net.multi_codes.collect()} == {"100", "100.000150"}


def test_shared_lists_equal_direct_pairs(net):
    cols = ["segmented_stream_id", "notation_id_list", "primary_notation_type", "secondary_notation_types"]
    a, b = net.stream_list.select(*cols), net.stream_list_direct.select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_point_of_an_ancestor_code_on_the_same_line_counts_once(spark):
    """A flow line that changes code: the point on its lower code is both 'same line' and
    'ancestor code' for the upper segment; it must be listed once."""
    seg = spark.createDataFrame([
        (71, 7, 7, 0.0, 100.0, 100.0, "200", "200", "200", "DDDD"),
        (72, 7, 7, 100.0, 200.0, 100.0, "200.000100", "200.000100", "200-000100", "DDDD"),
        (81, 8, 8, 0.0, 100.0, 100.0, "200.000100", "200.000100.000050", "200-000100", "DDDD"),
    ], schemas.SEGMENTS)
    pts = spark.createDataFrame([("NO9", "FR", None, 71, 7, 10.0, "200", "200", "DDDD")], schemas.PLACED_POINTS)
    n = Network(spark, segments=seg, points=pts)
    got = {(r.linear_feature_id, r.notation_id_list) for r in n.stream_list.collect()}
    assert (72, "NO9") in got and (81, "NO9") in got
    direct = {(r.linear_feature_id, r.notation_id_list) for r in n.stream_list_direct.collect()}
    assert got == direct


def test_side_channel_option_correlated(spark):
    """B-4: a start point admits every channel of its group unless ``side_correlated``, which also
    needs the channel's code to be a start point's code."""
    seg = spark.createDataFrame(SEGMENTS + [
        (32, 9, 5, 0.0, 40.0, 40.0, "100.000150.000120", None, "100-000150-000120", "AAAA")], schemas.SEGMENTS)
    pts = spark.createDataFrame(POINTS, schemas.PLACED_POINTS)
    loose = Network(spark, segments=seg, points=pts)
    strict = Network(spark, segments=seg, points=pts, side_correlated=True)
    # group AAAA has start points (on code '100'); channel 32 has NO7's code, which is in BBBB
    assert {r.linear_feature_id for r in loose.side_pieces.collect()} == {31, 32}
    assert {r.linear_feature_id for r in strict.side_pieces.collect()} == {31}


def test_side_channel_option_count_points(spark):
    """B-5: pieces are numbered over points x pieces (the reference), or as distinct pieces."""
    seg = spark.createDataFrame([
        (i, 1, 1, 100.0 * (i - 1), 100.0 * i, 100.0, "300", "300" if i == 1 else f"300.{100 * (i - 1):06d}", "300", "EEEE")
        for i in range(1, 5)], schemas.SEGMENTS)
    pts = spark.createDataFrame([
        ("A", "FR", None, 3, 1, 260.0, "300", "300.000200", "EEEE"),
        ("B", "OR", None, 4, 1, 360.0, "300", "300.000300", "EEEE")], schemas.PLACED_POINTS)
    # pieces in work: 200-260, 260-300, 300-360, 360-400; B's segment starts at position 2
    by_points = {r.notation_id: r.near_start for r in Network(spark, segments=seg, points=pts).starts.collect()}
    by_pieces = {r.notation_id: r.near_start for r in
                 Network(spark, segments=seg, points=pts, side_count_points=False).starts.collect()}
    assert by_points == {"A": True, "B": False}     # 2 * 2 + 1 = 5 > 3
    assert by_pieces == {"A": True, "B": True}      # 2 + 1 = 3


def test_input_report(spark):
    from bluelines.operators.checks import point_problems
    seg = spark.createDataFrame(SEGMENTS, schemas.SEGMENTS)
    src = spark.createDataFrame([
        ("NO1", "FR", 1), ("NO2", "XX", 1), ("NO3", None, 2), ("NO4", "OR", 77), ("NO5", "AR", None),
        ("NO6", "PWS", 2), ("NO6", "PWS", 2)], "notation_id string, notation_type string, blue_line_key bigint")
    got = sorted((r.notation_id, r.problem) for r in point_problems(src, seg).collect())
    assert got == [("NO2", "unknown type"), ("NO3", "null type"), ("NO4", "no segment on line"),
                   ("NO5", "no line key"), ("NO6", "duplicate id")]


def test_lists_are_the_same_when_nothing_is_broadcast(spark):
    """With broadcasts off every point join is a shuffle join; the lists must not change."""
    cols = ["segmented_stream_id", "notation_id_list", "primary_notation_type", "secondary_notation_types"]
    seg = spark.createDataFrame(SEGMENTS, schemas.SEGMENTS)
    pts = spark.createDataFrame(POINTS, schemas.PLACED_POINTS)
    want = Network(spark, segments=seg, points=pts).stream_list_all.select(*cols)
    rows = sorted(map(tuple, want.collect()))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        n = Network(spark, segments=seg, points=pts)
        plan = n.stream_list._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "CartesianProduct" not in plan
        assert sorted(map(tuple, n.stream_list_all.select(*cols).collect())) == rows
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_segments_with_one_start_keep_one_piece_per_key(spark, con):
    """Two segments of a line start together: the smaller id stays; a cut whose key is a segment's start
    is skipped."""
    seg = spark.createDataFrame(SEGMENTS + [
        (14, 1, 1, 0.0, 60.0, 60.0, "100", "100", "100", "AAAA"),      # starts with 11
        (15, 1, 1, 50.0, 80.0, 30.0, "100", "100.000050", "100", "AAAA"),  # starts where NO1 cuts 11
    ], schemas.SEGMENTS)
    n = Network(spark, segments=seg, points=spark.createDataFrame(POINTS, schemas.PLACED_POINTS))
    rows = {r.segmented_stream_id: (r.linear_feature_id, r.downstream_route_measure, r.upstream_route_measure) for r in n.pieces.collect()}
    assert n.pieces.count() == len(rows)
    assert rows["1.0"] == (11, 0.0, 50.0) and rows["1.50000"] == (15, 50.0, 80.0)


def test_release_removes_written_tables(spark):
    import os
    seg = spark.createDataFrame(SEGMENTS, schemas.SEGMENTS)
    pts = spark.createDataFrame(POINTS, schemas.PLACED_POINTS)
    n = Network(spark, segments=seg, points=pts)
    before = sorted(tuple(r) for r in n.stream_list_all.collect())
    paths = list(n.written)
    assert paths and all(os.path.exists(p.replace("file:", "")) for p in paths)
    assert n.release() == len(paths)
    assert not any(os.path.exists(p.replace("file:", "")) for p in paths)
    assert sorted(tuple(r) for r in n.stream_list_all.collect()) == before   # recomputed
    n.release()
