"""Segments that points reach: each once, and only lines that hold points are cut, shuffled and written."""

import itertools

from pyspark.sql import functions as F

from bluelines.operators import upstream
from bluelines.plans import catalogue
from testdata import SF_SMALL

SEGMENTS = ("linear_feature_id long, blue_line_key long, watershed_key long, downstream_route_measure double, "
            "upstream_route_measure double, wscode string, localcode string")
POINTS = ("notation_id string, notation_type string, blue_line_key long, downstream_route_measure double, "
          "wscode string, localcode string")


def _tables(spark):
    codes = [("1", "1"), ("1", "1.005"), ("1.020", "1.020"), ("1.020", "1.020.3"), ("1.020", None), ("2", "2")]
    segments = [(k, k % 4 + 1, 1, 10.0 * n, 10.0 * n + 10, w, lc)
                for k, (n, (w, lc)) in enumerate(itertools.product(range(4), codes))]
    segments += [(101, 1, 1, None, None, "1", "1")]
    points = [("a", "FR", 1, 15.0, "1", "1"), ("b", "FR", 2, 3.0, "1", "1.005"), ("c", "FR", 2, None, "1.020", "1.020.3"),
              ("d", "FR", None, 5.0, "1.020", "1.020"), ("e", "FR", 4, 29.5, "2", None)]
    return spark.createDataFrame(segments, SEGMENTS), spark.createDataFrame(points, POINTS)


def _truth(segments, points, others):
    s, p = segments.alias("s"), points.alias("p")
    c = F.col
    up = upstream.d_up(c("s.blue_line_key"), c("s.downstream_route_measure"), c("s.wscode"), c("s.localcode"),
                       c("p.blue_line_key"), c("p.downstream_route_measure"), c("p.wscode"), c("p.localcode"))
    if others:
        on = (c("s.blue_line_key") == c("p.blue_line_key")) & (c("p.downstream_route_measure") >= c("s.downstream_route_measure")) & (
            c("p.downstream_route_measure") < c("s.upstream_route_measure"))
        channel = (c("s.wscode") == c("p.wscode")) & c("s.localcode").isNull() & (c("s.blue_line_key") != c("s.watershed_key"))
        up = up | F.coalesce(on, F.lit(False)) | F.coalesce(channel, F.lit(False))
    return sorted(r[0] for r in s.crossJoin(p).where(up).select("s.linear_feature_id").distinct().collect())


def test_reached_segments_come_once(spark):
    segments, points = _tables(spark)
    for others in (True, False):
        kpoints = upstream.keyed_points(points)
        got = sorted(r[0] for r in upstream.reached_lines(segments, kpoints, others=others).select("linear_feature_id").collect())
        assert got == _truth(segments, points, others) and 0 < len(got) < segments.count()


def test_only_lines_with_points_are_written_as_pieces(spark):
    n = catalogue.network(spark, SF_SMALL)
    pieces = n.pieces
    stored = spark.read.parquet(next(p for p in n.written if "bluelines-pieces-" in p and "of-points" not in p))
    assert 0 < stored.count() < pieces.count()
    lines = n.points.select("blue_line_key").distinct()
    assert stored.join(lines, "blue_line_key", "left_anti").count() == 0
    assert pieces.select("segmented_stream_id").distinct().count() == pieces.count()


def test_segments_stay_by_line_up_to_one_row_per_key(spark):
    """Without broadcasts the rows of a segment are shuffled once, by line, for the ties and for their keys."""
    n = catalogue.network(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        work = upstream.work_lines(n.segments.select(*n.WORK_COLS), n.kpoints)
        p = work._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(_key" not in p and "hashpartitioning(_line" in p and "hashpartitioning(linear_feature_id" not in p


def test_stored_lines_are_not_shuffled(spark):
    """The network is stored by line: neither the points, the ties nor the segments upstream shuffle its rows, also without broadcasts."""
    n = catalogue.network(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        work = upstream.work_lines(n.segments.select(*n.WORK_COLS), n.kpoints)
        p = work._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = p.split("\n")
    stored = [k for k, line in enumerate(lines) if "FileScan" in line and "Bucketed: true" in line and "fwa_watershed_code" in line]
    assert stored and not any("Exchange" in line for k in stored[:1] for line in lines[k - 3:k])


def test_points_on_long_lines(spark):
    """Line numbers over 9 give ids that name another line; a point lies on every segment with its id, as before."""
    from bluelines.sources import fixtures

    rows = [(1, 12, 5), (2, 2, 6), (2, None, 7), (None, 1, 8), (3, 1, 9)]
    li = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_partkey long")
    seg = spark.createDataFrame([(22, 1, 0.0), (22, 2, 10.0), (31, 3, 0.0), (None, 2, 20.0)],
                                "linear_feature_id long, blue_line_key long, downstream_route_measure double")
    for c in ("wscode", "localcode", "watershed_group_code", "priority"):
        seg = seg.withColumn(c, F.lit("1-X"))
    seg = seg.withColumn("length_metre", F.lit(10.0))

    class Given:
        lineitem = li

    got = sorted((r.wls_wn_sysid, r.linear_feature_id, r.blue_line_key) for r in fixtures.points(Given, seg).collect())
    assert got == [(5, 22, 1), (5, 22, 2), (6, 22, 1), (6, 22, 2), (9, 31, 3)]
