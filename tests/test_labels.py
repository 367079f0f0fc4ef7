"""Ancestor tests by order against prefix tests on every pair."""

import random

import pytest
from pyspark.sql import functions as F

from bluelines.operators import labels, upstream
from bluelines.operators.numbering import running_sum
from bluelines.plans import catalogue
from testdata import SF_SMALL


def tree(r, n):
    codes = ["100", "101", "999"]
    while len(codes) < n:
        codes.append(r.choice(codes) + f".{r.choice([1, 5, 500, 501, 999999]):06d}")
    return codes


def within(code, root):
    return (code + ".").startswith(root + ".")


def entered(w, pw, pl):
    """Case 3 of D-UP from its definition."""
    return pl is not None and w != pw and within(w, pw) and (pl == pw or (w > pl and not within(w, pl)))


@pytest.mark.parametrize("seed", range(4))
def test_codes_entered_and_rows_below(spark, seed):
    r = random.Random(seed)
    codes = sorted(set(tree(r, 120)))
    points = []
    for _ in range(60):
        w = r.choice(codes)
        local = r.choice([w, None, w + f".{r.choice([1, 5, 500, 700]):06d}", w + ".000500.000001", r.choice(codes), w[:3]])
        points.append((w, local))
    points += [(None, None), (None, "100"), points[0], points[0]]
    df = spark.createDataFrame([(c,) for c in codes] + [(None,)], "wscode string")
    got = dict(labels.codes_entered(df, spark.createDataFrame(points, "p_wscode string, p_localcode string")).collect())
    want = {c: sum(entered(c, w, pl) for w, pl in points if w) for c in codes}
    assert got == {c: n for c, n in want.items() if n}
    counted = spark.createDataFrame([(c, k + 1) for k, c in enumerate(codes)] + [(None, 5)], "wscode string, n long")
    below = dict(labels.rows_below(counted, spark.createDataFrame([(w,) for w, _ in points] + [("55",)], "wscode string")).collect())
    assert below == {w: sum(k + 1 for k, c in enumerate(codes) if within(c, w)) for w, _ in points if w}


def test_running_sum_over_many_ranges(spark):
    r = random.Random(5)
    rows = [(i, r.randrange(300), r.randrange(-3, 4)) for i in range(3000)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        got = running_sum(spark.createDataFrame(rows, "id long, k long, v long"), [F.col("k").asc(), F.col("id").asc()], "v").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    total, want = 0, {}
    for i, _, v in sorted(rows, key=lambda x: (x[1], x[0])):
        total += v
        want[i] = total
    assert {x.id: x.running for x in got} == want


def test_segments_on_the_points_own_line_do_not_count(spark):
    """Case 3 asks for another flow line: a segment of the point's line with a lower code is not reached through it."""
    schema = catalogue.schemas.SEGMENTS
    segments = spark.createDataFrame([
        (1, 10, 10, 0.0, 10.0, 10.0, "100", "100", "100", "G"), (2, 10, 10, 0.0, 5.0, 5.0, "100.000700", "100.000700", "x", "G"),
        (3, 20, 20, 0.0, 5.0, 5.0, "100.000700", "100.000700", "x", "G")], schema)
    for points, want in (([("a", "FR", "", 1, 10, 8.0, "100", "100", "G")], {3}),
                         ([("a", "FR", "", 1, 10, 8.0, "100", "100", "G"), ("b", "FR", "", 1, 30, 8.0, "100", "100", "G")], {1, 2, 3})):
        pts = spark.createDataFrame(points, catalogue.schemas.PLACED_POINTS)
        got = {x.linear_feature_id for x in upstream.upstream_lines(segments, upstream.keyed_points(pts)).collect()}
        pairs = {x.linear_feature_id for x in upstream.upstream_pairs(segments, upstream.keyed_points(pts)).collect()}
        assert got == pairs == want


def test_no_prefix_rows_in_the_plan(spark):
    n = catalogue.network(spark, SF_SMALL)
    for df in (n.work, catalogue.QUERIES["upstream_segments"](spark, SF_SMALL), catalogue.QUERIES["code_descendant"](spark, SF_SMALL)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "sequence(" not in plan and "substring_index" not in plan and "SinglePartition" not in plan
    tagged = upstream.keyed_lines(n.segments, "direct")
    assert tagged.count() <= 2 * n.segments.count()


@pytest.mark.parametrize("seed", range(3))
def test_stretches_give_every_point_below_a_code(spark, seed):
    r = random.Random(100 + seed)
    codes = sorted(set(tree(r, 80)))
    points = [(k, r.choice(codes), None) for k in range(40)]
    points = [(k, w, r.choice([w, None, w + f".{r.choice([1, 5, 500, 700]):06d}", w + ".000500.000001", r.choice(codes)])) for k, w, _ in points]
    df = spark.createDataFrame([(c,) for c in codes], "wscode string")
    of_code, pairs = labels.shared_stretches(df, spark.createDataFrame(points, "p_prank long, p_wscode string, p_localcode string"))
    below = {}
    for x in pairs.collect():
        below.setdefault(x.stretch, []).append(x.p_prank)
    assert all(len(p) == len(set(p)) for p in below.values())
    at = dict(of_code.collect())
    for c in codes:
        assert sorted(below.get(at.get(c), [])) == [k for k, w, pl in points if entered(c, w, pl)]
    assert set(below) <= set(at.values()) and len(below) <= min(len(codes), 2 * len(points))


@pytest.mark.parametrize("seed", range(2))
def test_shared_lists_equal_pairs_on_odd_networks(spark, seed):
    """Lines that carry several codes, points on lines of other codes, missing local codes."""
    r = random.Random(200 + seed)
    codes = sorted(set(tree(r, 40)))
    segments, points = [], []
    for i in range(150):
        w = r.choice(codes)
        dm = float(r.randrange(0, 500, 10))
        segments.append((i, r.randrange(40), r.randrange(40), dm, dm + 10, 10.0, w, r.choice([w, None, w + ".000300"]), w.replace(".", "-"), f"G{i % 3}"))
    for k in range(50):
        w = r.choice(codes)
        points.append((f"n{k}", r.choice(["FR", "OR", "X"]), "", r.randrange(150), r.randrange(40), float(r.randrange(500)), w,
                       r.choice([w, None, w + ".000200", w + ".000500"]), "G0"))
    net = catalogue.Network(spark, segments=spark.createDataFrame(segments, catalogue.schemas.SEGMENTS),
                            points=spark.createDataFrame(points, catalogue.schemas.PLACED_POINTS))
    shared, direct = net.stream_list.collect(), net.stream_list_direct.collect()
    assert len(direct) > 40 and sorted(map(tuple, shared), key=repr) == sorted(map(tuple, direct), key=repr)
