"""Run collapse over hourly buckets equals a plain per-key lag, also with one dominant key."""

import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from bluelines.operators.numbering import in_ranges
from bluelines.operators.runs import run_starts


def _events(spark):
    t0 = datetime.datetime(2024, 1, 1)
    rows, eid = [], 0
    # user 1 holds most rows, spread over 30 hours; runs continue across hour edges
    for i in range(3000):
        rows.append((eid, t0 + datetime.timedelta(seconds=37 * i), 1, "view" if (i // 7) % 3 else "click"))
        eid += 1
    for u in range(2, 12):
        for i in range(20):
            rows.append((eid, t0 + datetime.timedelta(minutes=45 * i), u, ["a", "a", "b"][i % 3]))
            eid += 1
    # equal timestamps: the event id orders them
    rows.append((eid, t0, 2, "z"))
    return spark.createDataFrame(rows, "event_id bigint, ts timestamp, user_id bigint, event_type string")


def test_bucketed_runs_equal_plain_lag(spark):
    ev = _events(spark)
    got = run_starts(ev, "user_id", ["ts", "event_id"], "event_type", F.date_trunc("hour", F.col("ts")))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    want = (ev.withColumn("prev", F.lag("event_type").over(w))
            .where(F.col("prev").isNull() | (F.col("prev") != F.col("event_type"))).drop("prev"))
    cols = ["event_id", "user_id", "event_type"]
    assert got.select(*cols).exceptAll(want.select(*cols)).count() == 0
    assert want.select(*cols).exceptAll(got.select(*cols)).count() == 0
    assert got.where("user_id = 1").count() > 100


def _hot(spark):
    t0 = datetime.datetime(2024, 1, 1)
    rows = [(i, t0 + datetime.timedelta(milliseconds=i), 1, "ab"[(i // 3) % 2]) for i in range(4000)]
    rows += [(5000 + i, t0 + datetime.timedelta(days=i), 1, "c") for i in range(40)]
    rows += [(6000, None, 2, "x"), (6001, t0, None, "x"), (6002, t0, None, "x"), (6003, t0, None, "y")]
    return spark.createDataFrame(rows, "event_id bigint, ts timestamp, user_id bigint, event_type string")


def _plain(ev):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    return ev.withColumn("prev", F.lag("event_type").over(w)).where("prev is null or prev <> event_type").drop("prev")


def test_ranges_split_a_hot_user_and_hour(spark):
    ev = _hot(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        dealt = in_ranges(ev, [F.col("user_id").asc_nulls_first(), F.col("ts").asc(), F.col("event_id").asc()])
        sizes = [r["count"] for r in dealt.groupBy("range").count().collect()]
        assert len(sizes) == 8 and max(sizes) < 2 * 4044 / 8
        got = run_starts(ev, "user_id", ["ts", "event_id"], "event_type")
        assert sorted(r.event_id for r in got.collect()) == sorted(r.event_id for r in _plain(ev).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_plan_does_not_grow_with_the_ranges(spark):
    ev = _hot(spark)

    def plan(n):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            got = run_starts(ev, "user_id", ["ts", "event_id"], "event_type")
            return got, len(got._jdf.queryExecution().optimizedPlan().toString())
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")

    few, small = plan(4)
    many, large = plan(20_000)
    assert abs(large - small) < 200
    assert sorted(r.event_id for r in many.collect()) == sorted(r.event_id for r in few.collect()) == sorted(r.event_id for r in _plain(ev).collect())
