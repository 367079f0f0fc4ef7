"""Properties of the pipeline on the sf0.001 fixture and on random small networks."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from bluelines import schemas
from bluelines.operators import breaking, changes, upstream
from bluelines.plans import catalogue
from testdata import SF_SMALL


def test_pieces_cover_segments_without_gap_or_overlap(spark):
    n = catalogue.network(spark, SF_SMALL)
    w = Window.partitionBy("linear_feature_id").orderBy("downstream_route_measure")
    p = n.pieces.withColumn("next_dm", F.lead("downstream_route_measure").over(w))
    gaps = p.where(F.col("next_dm").isNotNull() & (F.col("next_dm") != F.col("upstream_route_measure"))).count()
    assert gaps == 0
    span = n.pieces.groupBy("linear_feature_id").agg(F.min("downstream_route_measure").alias("lo"),
                                                      F.max("upstream_route_measure").alias("hi"))
    seg = n.segments.select("linear_feature_id", "downstream_route_measure", "upstream_route_measure")
    bad = span.join(seg, "linear_feature_id").where(
        (F.col("lo") != F.col("downstream_route_measure")) | (F.col("hi") != F.col("upstream_route_measure")))
    assert bad.count() == 0
    assert n.pieces.where(F.col("upstream_route_measure") <= F.col("downstream_route_measure")).count() == 0


def test_breaking_twice_changes_nothing(spark):
    n = catalogue.network(spark, SF_SMALL)
    cols = ["linear_feature_id", "downstream_route_measure", "upstream_route_measure"]
    again = breaking.break_lines(n.pieces.drop("segmented_stream_id", "piece_index", "parent_stream_id"),
                                 n.breakpoints)
    assert again.select(*cols).exceptAll(n.pieces.select(*cols)).count() == 0
    assert again.count() == n.pieces.count()


def test_secondary_lists_have_no_equal_neighbours(spark):
    n = catalogue.network(spark, SF_SMALL)
    parts = n.stream_list_all.where(F.col("secondary_notation_types").isNotNull()).select(
        F.split(F.regexp_replace("secondary_notation_types", r"\.\.$", ""), ";").alias("t"))
    rep = parts.where(F.exists(F.sequence(F.lit(1), F.greatest(F.size("t") - 1, F.lit(1))),
                               lambda i: (F.size("t") > 1) & (F.get(F.col("t"), i) == F.get(F.col("t"), i - 1))))
    assert rep.count() == 0


def test_every_listed_point_is_downstream(spark):
    """Each point in a main list is D-UP of that piece, checked with the plain boolean form."""
    n = catalogue.network(spark, SF_SMALL)
    listed = n.stream_list.select("segmented_stream_id", F.explode(F.split("notation_id_list", ";")).alias("nid"))
    pieces = n.pieces.select("segmented_stream_id", "blue_line_key", "downstream_route_measure", "wscode", "localcode")
    pts = n.points.select(F.col("notation_id").alias("nid"), F.col("blue_line_key").alias("pb"),
                          F.col("downstream_route_measure").alias("pm"), F.col("wscode").alias("pw"),
                          F.col("localcode").alias("pl"))
    j = listed.join(pieces, "segmented_stream_id").join(pts, "nid")
    ok = upstream.d_up(F.col("blue_line_key"), F.col("downstream_route_measure"), F.col("wscode"), F.col("localcode"),
                       F.col("pb"), F.col("pm"), F.col("pw"), F.col("pl"))
    assert j.where(~ok).count() == 0
    assert j.count() > 0


def test_sync_then_status_is_unchanged(spark):
    o = catalogue.orders_objects(catalogue.Tables(spark, SF_SMALL).orders)
    current = changes.fingerprint(o, ["path"])
    state = spark.createDataFrame([], schemas.CHANGE_STATE)
    envs = ["prod"]
    first = changes.change_status(current, state, envs)
    assert first.where("has_changed").count() == first.count() > 0          # no cache: changed
    synced = changes.sync_state(state, current, "prod")
    again = changes.change_status(current, synced, envs)
    assert again.where("has_changed").count() == 0


# ---- D-UP: keyed equi join == plain definition, on random small networks -------------------
def py_up(p, s, tol=1.0):
    """D-UP in plain Python (the truth table): p = (blk, meas, W, L), s = (blk, dm, W, L)."""
    pb, pm, pw, pl = p
    sb, sd, sw, sl = s
    if sb == pb:
        return sd + tol >= pm
    if sl is None or pl is None:
        return False
    if sw == pw:
        return sl >= pl
    if (sw + ".").startswith(pw + "."):
        return pl == pw or (sw > pl and not (sw + ".").startswith(pl + "."))
    return False


label = st.sampled_from(["000100", "000200", "000300"])
code = st.lists(label, min_size=0, max_size=2).map(lambda xs: ".".join(["100"] + xs))
local = st.one_of(st.none(), st.tuples(code, st.sampled_from(["", ".000050", ".000250"])).map(lambda t: t[0] + t[1]))
row = st.tuples(st.integers(1, 4), st.integers(0, 4).map(lambda x: x * 50.0), code, local)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(pts=st.lists(row, min_size=1, max_size=6), segs=st.lists(row, min_size=1, max_size=12))
def test_keyed_join_equals_definition(spark, pts, segs):
    p = spark.createDataFrame([(f"P{i}", "FR", b, m, w, l, i) for i, (b, m, w, l) in enumerate(pts)],
                              "notation_id string, notation_type string, blue_line_key bigint, "
                              "downstream_route_measure double, wscode string, localcode string, prank bigint")
    s = spark.createDataFrame([(i, b, m, w, l) for i, (b, m, w, l) in enumerate(segs)],
                              "linear_feature_id bigint, blue_line_key bigint, downstream_route_measure double, "
                              "wscode string, localcode string")
    kp = upstream.keyed_points(p, extra=["prank"])
    got = {(r.p_notation_id, r.linear_feature_id) for r in upstream.upstream_pairs(s, kp).collect()}
    want = {(f"P{i}", j) for i, pp in enumerate(pts) for j, ss in enumerate(segs) if py_up(pp, ss)}
    assert got == want
