"""Plan checks: the rewrites must stay equi joins, and no single-partition window or exchange."""

import pytest

from bluelines.plans import catalogue
from testdata import SF_SMALL

BAD_JOINS = ("BroadcastNestedLoopJoin", "CartesianProduct")
PAIR_QUERIES = ["upstream_pairs", "upstream_segments", "downstream_points", "work_segments", "stream_list",
                "side_channels", "stream_list_all", "point_on_segment", "side_channel_candidates",
                "code_descendant", "start_of_route", "break_segments", "snap_measure", "locate_along",
                "clip_lines", "attr_link", "run_collapse"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", PAIR_QUERIES)
def test_no_nested_loop_or_product(spark, name):
    p = plan(catalogue.QUERIES[name](spark, SF_SMALL))
    for bad in BAD_JOINS:
        assert bad not in p, f"{name} plans a {bad}"


@pytest.mark.parametrize("name", PAIR_QUERIES)
def test_no_single_partition_exchange(spark, name):
    """A window without PARTITION BY (or a global sort into one task) shows as SinglePartition."""
    p = plan(catalogue.QUERIES[name](spark, SF_SMALL))
    assert "SinglePartition" not in p


def test_lists_do_not_shuffle_pairs(spark):
    """Pairs are built and aggregated in one stage: the only exchange of the pair-form list plan is
    the repartition of the (small) piece table by line id."""
    n = catalogue.network(spark, SF_SMALL)
    p = n.stream_list_direct._jdf.queryExecution().executedPlan().toString()
    shuffles = p.count("Exchange") - p.count("BroadcastExchange")
    assert shuffles == 1 and "REPARTITION_BY_COL" in p
    assert "BroadcastHashJoin" in p


def test_shared_lists_plan(spark):
    """The shared form pairs pieces only with their own line and code; ancestor lists are joined
    on the code with a hash join, never a product."""
    n = catalogue.network(spark, SF_SMALL)
    p = n.stream_list._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
    assert "SinglePartition" not in p


def test_scan_prunes_columns(spark):
    """Only the needed columns reach the Parquet scan of lineitem in the network build."""
    n = catalogue.network(spark, SF_SMALL)
    from bluelines.sources import fixtures
    p = fixtures.network(n.tables)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in p and "l_shipdate" not in p


def test_group_read_prunes_partitions(spark):
    p = plan(catalogue.QUERIES["group_output"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(watershed_group_code" in p or "PartitionFilters: [" in p
    assert "W001" in p


def test_fan_out_repartition_survives(spark):
    """The explicit repartition of the points before they are spread over their stretches stays in the plan even when the
    shuffle partition count equals the default parallelism (as in this test session)."""
    from bluelines.operators.labels import shared_stretches

    assert spark.conf.get("spark.sql.shuffle.partitions") == str(spark.sparkContext.defaultParallelism)
    n = catalogue.network(spark, SF_SMALL)
    points = n.kpoints.where("startswith(_pk, 'w:')")
    _, pairs = shared_stretches(n.segments.select("wscode").distinct(), points)
    assert "REPARTITION_BY_NUM" in plan(pairs)


def test_lists_read_stored_parts(spark):
    """Pieces carry the number of a stretch; finished texts and entries are joined on it."""
    lists = catalogue.network(spark, SF_SMALL).stream_list
    read = {f.split("bluelines-")[-1].split("/")[0].rsplit("-", 1)[0] for f in lists.inputFiles()}
    assert read == {"list-parts", "inherited-lists"} and "Generate" not in plan(lists)


def test_snapping_prunes_before_grouping_vertices(spark):
    """Given a vertex table, the semi joins stand below the grouping of vertices."""
    from bluelines.plans.pipeline import Network

    n = catalogue.network(spark, SF_SMALL)
    given = Network(spark, segments=n.segments, points=n.points.drop("prank"), points_src=n.points_src, vertices=n.vertices)
    lines = given.segments.join(given.points_src.select("blue_line_key").distinct(), "blue_line_key", "left_semi")
    v = given.vertices.join(lines.select("linear_feature_id"), "linear_feature_id", "left_semi")
    from bluelines.sources.fixtures import line_geometry
    p = plan(line_geometry(v))
    assert p.index("Aggregate") < p.index("LeftSemi")
    assert given.point_lines.count() == n.point_lines.count() < n.segments.count()


def test_breaking_joins_on_line_and_bucket(spark):
    n = catalogue.network(spark, SF_SMALL)
    from bluelines.operators.breaking import cuts
    p = plan(cuts(n.work, n.breakpoints))
    assert "blue_line_key" in p and "_b" in p and not any(b in p for b in BAD_JOINS)


def test_counts_per_code_before_points(spark):
    """Points are joined with one count per code, which comes from the order of codes: no row per prefix."""
    p = plan(catalogue.QUERIES["code_descendant"](spark, SF_SMALL))
    assert p.index("Join") < p.index("HashAggregate") and "Generate" not in p
