"""The SQL forms of the engine's functions agree with the DataFrame forms."""

from pyspark.sql import functions as F

from bluelines.functions import lists, rounding
from bluelines.functions.sql import register_locate_along, register_sql_functions
from bluelines.operators import snapping
from bluelines.operators import upstream
from bluelines.plans import catalogue
from testdata import SF_SMALL


def test_sql_is_upstream_equals_keyed_join(spark):
    register_sql_functions(spark)
    n = catalogue.network(spark, SF_SMALL)
    n.points.createOrReplaceTempView("t_points")
    n.segments.createOrReplaceTempView("t_segments")
    by_sql = spark.sql("""
        SELECT a.notation_id, b.linear_feature_id FROM t_points a JOIN t_segments b
        ON is_upstream(a.blue_line_key, a.downstream_route_measure, a.wscode, a.localcode,
                       b.blue_line_key, b.downstream_route_measure, b.wscode, b.localcode)""")
    keyed = upstream.upstream_pairs(n.segments, n.kpoints).select(
        F.col("p_notation_id").alias("notation_id"), "linear_feature_id")
    assert by_sql.count() == keyed.count() > 0
    assert by_sql.exceptAll(keyed).count() == 0
    down = spark.sql("""
        SELECT count(*) AS c FROM t_segments b JOIN t_points a
        ON is_downstream(b.blue_line_key, b.downstream_route_measure, b.wscode, b.localcode,
                         a.blue_line_key, a.downstream_route_measure, a.wscode, a.localcode)""").first().c
    assert down == keyed.count()


def test_sql_scalar_functions(spark):
    register_sql_functions(spark)
    df = spark.createDataFrame([("A" * 29, 7, 12.5), ("B" * 30, 7, 0.0), (None, 1, 2.5)],
                               "s string, b bigint, m double")
    df.createOrReplaceTempView("t_vals")
    got = spark.sql("SELECT cut_label(s) AS c, piece_key(b, m) AS k, code_within('1.2', '1') AS w FROM t_vals").collect()
    want = df.select(lists.cut_label(F.col("s")).alias("c"),
                     rounding.piece_key(F.col("b"), F.col("m")).alias("k")).collect()
    assert [(r.c, r.k) for r in got] == [(r.c, r.k) for r in want]
    assert all(r.w for r in got)


def _lines_in_parts(spark):
    rows = [(1, 7, 0.0, 60.0, [[(0.0, 0.0, 0.0), (40.0, 0.0, 40.0)], [(50.0, 5.0, 50.0), (60.0, 5.0, 60.0)]]),
            (2, 7, 60.0, 2500.0, [[(60.0, 9.0, 60.0), (2500.0, 9.0, 2500.0)]]),
            (3, 8, 0.0, 10.0, [[(0.0, 1.0, 0.0), (0.0, 1.0, 0.0), (10.0, 11.0, 10.0)]])]
    return spark.createDataFrame(rows, """linear_feature_id long, blue_line_key long, downstream_route_measure double,
        upstream_route_measure double, parts array<array<struct<x:double,y:double,m:double>>>""")


def test_locate_along_from_sql(spark, capsys):
    lines = _lines_in_parts(spark)
    points = spark.createDataFrame([(f"{b}-{m}", b, float(m)) for b in (7, 8, 9) for m in (0, 5, 10, 40, 45, 50, 60, 61, 1000, 1999.5, 2500, 2501)],
                                   "notation_id string, blue_line_key long, downstream_route_measure double")
    register_locate_along(spark, lines)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = spark.sql("SELECT p.notation_id, l.x, l.y FROM {points} p, LATERAL locate_along(p.blue_line_key, p.downstream_route_measure) l", points=points)
        got.explain()
        plan = capsys.readouterr().out
        assert "NestedLoop" not in plan and "Cartesian" not in plan
        found = sorted(map(tuple, got.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = sorted(map(tuple, snapping.locate_along(points, lines).collect()))
    assert found == want and len(want) == 13
    assert ("7-60", 60.0, 5.0) in found and ("7-50", 50.0, 5.0) in found   # a shared end: the lower; after a gap: its own
    assert spark.sql("SELECT * FROM locate_along(7, 20D)").collect()[0].x == 20.0
    assert spark.sql("SELECT * FROM locate_along(7, 45D)").count() == 0
