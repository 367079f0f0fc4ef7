"""Numbering by prefix sums against a plain sort."""

import random

import pytest
from pyspark.sql import functions as F

from bluelines.operators.numbering import number_within


def brute(rows, key):
    out = {}
    for g, v in sorted(rows, key=key):
        out.setdefault(g, []).append(v)
    return out


@pytest.fixture(scope="module", params=["64m", "2k"])
def sized(spark, request):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", request.param)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    yield spark
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    for c in ("advisoryPartitionSizeInBytes", "coalescePartitions.parallelismFirst"):
        spark.conf.unset(f"spark.sql.adaptive.{c}")


def test_one_group_holds_most_rows(sized):
    r = random.Random(3)
    rows = [("hot" if i % 4 else r.choice(["a", "b", None, ""]), r.randrange(10**6)) for i in range(4000)]
    df = sized.createDataFrame(rows, "g string, v long")
    got = number_within(df, ["g"], [F.col("v").asc()]).collect()
    want = brute(rows, lambda x: (x[0] is not None, x[0] or "", x[1]))
    assert len(got) == len(rows)
    for g, values in want.items():
        mine = sorted((x for x in got if x.g == g), key=lambda x: x.nth)
        assert [x.nth for x in mine] == list(range(len(values))) and [x.v for x in mine] == values
        assert {x.n for x in mine} == {len(values)}


def test_equal_rows_spread_over_ranges(sized):
    df = sized.createDataFrame([("a", 1)] * 3000 + [("b", 2)], "g string, v long")
    out = number_within(df, ["g"], [F.col("v").desc()])
    assert sorted(x.nth for x in out.where("g = 'a'").collect()) == list(range(3000))


def test_whole_table_empty_table_and_clashing_names(sized):
    df = sized.createDataFrame([(5, "x"), (3, None), (4, "y")], "v long, shift string")
    assert [(x.v, x.place, x.all) for x in number_within(df, [], [F.col("v").asc()], nth="place", total="all").orderBy("v").collect()] == [
        (3, 0, 3), (4, 1, 3), (5, 2, 3)]
    assert number_within(df.where("v > 9"), ["shift"], [F.col("v").asc()]).count() == 0


def test_no_window_over_the_rows(sized, capsys):
    df = sized.createDataFrame([("a", 1)], "g string, v long")
    number_within(df, ["g"], [F.col("v").asc()]).explain("simple")
    plan = capsys.readouterr().out
    assert "NestedLoop" not in plan and "SinglePartition" not in plan


def test_a_long_line_spans_many_tasks(spark):
    """Positions of points on one line that holds most pieces: the largest range is near the median."""
    from bluelines.operators.sidechannels import line_positions

    n = 6000
    pieces = spark.createDataFrame([(i, 1 if i < n else 2, "G", float(i * 7 % n), 0) for i in range(n + 50)],
                                   "linear_feature_id long, blue_line_key long, watershed_group_code string, downstream_route_measure double, piece_index int")
    points = spark.createDataFrame([(f"p{i}", i, 1, float(i * 7 % n)) for i in range(0, n, 500)] + [("q", n + 3, 2, 0.0)],
                                   "notation_id string, linear_feature_id long, blue_line_key long, downstream_route_measure double")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        written = []
        got = {r.notation_id: (r.pos, r.k) for r in line_positions(points, pieces, written).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert all(got[f"p{i}"] == (i * 7 % n, n // 500) for i in range(0, n, 500)) and got["q"][1] == 1
    sizes = sorted(r["count"] for r in spark.read.parquet(written[-1]).groupBy(F.input_file_name()).count().collect())
    assert len(sizes) >= 11 and sizes[-1] < 2 * sizes[len(sizes) // 2]
