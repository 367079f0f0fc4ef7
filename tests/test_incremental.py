"""Rebuilding touched groups only, against full runs."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from bluelines.operators import changes, incremental
from bluelines.plans import catalogue, sinks
from bluelines.plans.pipeline import OUTPUT_COLS, Network
from bluelines.session import work_path
from testdata import SF_SMALL

GROUP = "watershed_group_code"
COLS = [*OUTPUT_COLS, "segmented_stream_id", GROUP]


@pytest.fixture(scope="module")
def tables(spark):
    """The fixture with 60 groups dealt over the lines, so that streams and their tributaries lie in different groups."""
    n = catalogue.network(spark, SF_SMALL)
    path = work_path(spark, "test-incremental")
    group = F.concat(F.lit("G"), (F.col("blue_line_key") % 60).cast("string"))
    n.segments.withColumn(GROUP, group).write.parquet(f"{path}/s")
    n.points.drop("prank").withColumn(GROUP, group).write.parquet(f"{path}/p")
    return spark.read.parquet(f"{path}/s"), spark.read.parquet(f"{path}/p")


def full(spark, segments, points):
    return Network(spark, segments=segments, points=points).stream_list_all.select(COLS)


def files(path):
    return {g: sorted((f, os.stat(f).st_mtime_ns) for f in glob.glob(f"{g}/*.parquet")) for g in glob.glob(f"{path.removeprefix('file://').removeprefix('file:')}/{GROUP}=*")}


def edit(segments, points, r):
    ids = sorted(x.notation_id for x in points.select("notation_id").collect())
    seg = sorted(x.linear_feature_id for x in segments.select("linear_feature_id").collect())
    gone, moved, retyped, new = (r.sample(ids, 2) for _ in range(4))
    bare, off = r.sample(seg, 2), r.sample(seg, 1)
    after = points.where(~F.col("notation_id").isin(gone) & ~F.col("linear_feature_id").isin(off)).withColumns({
        "downstream_route_measure": F.when(F.col("notation_id").isin(moved), F.col("downstream_route_measure") + 2.5).otherwise(F.col("downstream_route_measure")),
        "notation_type": F.when(F.col("notation_id").isin(retyped), "ZZ").otherwise(F.col("notation_type"))})
    added = points.where(F.col("notation_id").isin(new)).withColumns({"notation_id": F.concat(F.lit("NX"), "notation_id"), "wls_wn_sysid": F.col("wls_wn_sysid") + 10**6})
    net = segments.where(~F.col("linear_feature_id").isin(off)).withColumn(
        "localcode", F.when(F.col("linear_feature_id").isin(bare), None).otherwise(F.col("localcode")))
    return net, after.unionByName(added)


@pytest.mark.parametrize("seed", [1, 3])
def test_merged_output_equals_a_full_run(spark, tables, seed):
    segments, points = tables
    path = work_path(spark, "test-groups")
    before = full(spark, segments, points)
    sinks.write_all_groups(before, path)
    net, placed = edit(segments, points, random.Random(seed))
    touched = incremental.touched_groups(segments, net, points, placed)
    groups = sorted(r[0] for r in touched.collect())
    kept = {g: f for g, f in files(path).items() if g.rsplit("=", 1)[1] not in groups}
    part = Network(spark, segments=incremental.needed_segments(net, touched), points=placed)
    sinks.refresh_groups(part.stream_list_all.select(COLS), path, groups)
    want, got = full(spark, net, placed), spark.read.parquet(path).select(COLS)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert len(kept) > 5 and {g: f for g, f in files(path).items() if g in kept} == kept  # untouched groups keep their files
    # every group whose rows differ is among the touched ones
    changed = before.exceptAll(want).unionByName(want.exceptAll(before)).select(GROUP).distinct()
    assert {r[0] for r in changed.collect()} <= set(groups)


def test_nothing_touched(spark, tables):
    segments, points = tables
    assert incremental.touched_groups(segments, segments, points, points).count() == 0


def test_an_edit_reaches_other_groups_along_the_code_tree(spark):
    """A point on the main stem: the tributary above it lies in another group, the one below it in a third."""
    schema = catalogue.schemas.SEGMENTS
    rows = [(1, 10, 10, 0.0, 100.0, 100.0, "100", "100", "100", "stem"), (2, 10, 10, 100.0, 200.0, 100.0, "100", "100.000500", "100", "stem"),
            (3, 20, 20, 0.0, 50.0, 50.0, "100.000700", "100.000700", "100-000700", "above"),
            (4, 30, 30, 0.0, 50.0, 50.0, "100.000200", "100.000200", "100-000200", "below"),
            (5, 40, 10, 0.0, 50.0, 50.0, "100", None, "100", "channel"), (6, 50, 50, 0.0, 9.0, 9.0, "200", "200", "200", "elsewhere")]
    segments = spark.createDataFrame(rows, schema)
    point = ("NO1", "FR", "", 2, 10, 150.0, "100", "100.000500", "stem")
    none, one = (spark.createDataFrame(p, catalogue.schemas.PLACED_POINTS) for p in ([], [point]))
    for before, after in ((none, one), (one, none)):
        got = {r[0] for r in incremental.touched_groups(segments, segments, before, after).collect()}
        assert got == {"stem", "above", "channel"}
    longer = segments.withColumn("upstream_route_measure", F.when(F.col("linear_feature_id") == 6, 12.0).otherwise(F.col("upstream_route_measure")))
    assert {r[0] for r in incremental.touched_groups(segments, longer, one, one).collect()} == {"elsewhere"}
    assert {r.linear_feature_id for r in incremental.needed_segments(segments, spark.createDataFrame([("stem",)], f"{GROUP} string")).collect()} == {1, 2}


def test_touched_groups_join_by_keys(spark, tables, capsys):
    segments, points = tables
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        incremental.touched_groups(segments, segments.where("linear_feature_id % 97 <> 0"), points, points.where("wls_wn_sysid % 31 <> 0")).explain()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_versions_of_edited_keys(spark):
    """New, gone, other, moved and repeated keys, null keys and lines: all rows of the keys that differ, as a join on the key gives
    them, met by the written keys."""
    def rows(data):
        ties = [(i, line, line, 0.0, float(m), "1", "1", f"G{line}") for i, line, m in data]
        return spark.createDataFrame(ties, "linear_feature_id long, blue_line_key long, watershed_key long, downstream_route_measure double, "
                                           "upstream_route_measure double, wscode string, localcode string, watershed_group_code string")

    key = "linear_feature_id"
    before = rows([(1, 10, 1), (2, 10, 1), (3, 10, 1), (4, 10, 1), (5, 10, 1), (5, 11, 1), (6, 12, 1), (6, 12, 1), (None, 10, 1), (7, None, 1), (8, None, 1), (9, 10, 1)])
    after = rows([(1, 10, 1), (2, 10, 2), (4, 11, 1), (5, 10, 1), (5, 11, 3), (6, 12, 1), (None, 10, 2), (7, None, 2), (8, None, 1), (9, 10, 1), (9, None, 1), (10, 13, 1)])
    got = incremental.both_versions(before, after, key, incremental.TIES)
    joined = before.unionByName(after).join(changes.snapshot_diff(before, after, [key]), key, "left_semi").select(incremental.TIES)
    assert sorted(map(str, got.collect())) == sorted(map(str, joined.collect()))
    assert {r[0] for r in got.collect()} == {2, 3, 4, 5, 7, 9, 10}
    assert any("bluelines-edited-keys" in f for f in got.inputFiles())
