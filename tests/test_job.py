"""The scheduled job end to end on stored tables: runs when any input changed, skips when none did."""

from pyspark.sql import functions as F

from bluelines import schemas
from bluelines.plans import catalogue
from bluelines.plans.job import run_job
from bluelines.session import work_path
from bluelines.sources import fixtures
from testdata import SF_SMALL


POINT_COLS = [f.name for f in schemas.POINTS_SRC.fields]


def _tables(spark, root):
    n = catalogue.network(spark, SF_SMALL)
    paths = {k: f"{root}/{k}" for k in ("segments", "vertices", "points", "aquifers", "state", "out")}
    n.segments.drop("priority").write.parquet(paths["segments"])
    n.vertices.write.parquet(paths["vertices"])
    n.points_src.write.parquet(paths["points"])
    fixtures.aquifers(n.tables).write.parquet(paths["aquifers"])
    return paths, [paths[k] for k in ("segments", "vertices", "points", "aquifers", "state", "out")]


def _rows(spark, path):
    return sorted((tuple(r) for r in spark.read.parquet(path).collect()), key=repr)


def test_job_reruns_on_any_change_and_leaves_nothing_stale(spark):
    root = work_path(spark, "job")
    paths, args = _tables(spark, root)
    assert run_job(spark, *args) is True
    streams = spark.read.parquet(f"{paths['out']}/streams")
    want = catalogue.QUERIES["full_run"](spark, SF_SMALL).drop("downstream_route_measure", "upstream_route_measure")
    got = streams.select(*want.columns).withColumn("blue_line_key", F.col("blue_line_key").cast("bigint"))
    assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    assert [f.name for f in schemas.STREAM_OUTPUT.fields] == streams.columns[:-1]
    assert {f.name: f.dataType for f in streams.schema.fields}["blue_line_key"] == schemas.STREAM_OUTPUT["blue_line_key"].dataType
    assert streams.where("geom is null or size(geom) < 2").count() == 0
    aq = spark.read.parquet(f"{paths['out']}/aquifers")
    assert aq.count() == catalogue.QUERIES["attr_link"](spark, SF_SMALL).count() and "geom" in aq.columns
    assert spark.read.parquet(paths["state"]).where(F.col("env") == "prod").count() == 4
    assert run_job(spark, *args) is False           # same inputs: the gate skips the run

    moved = spark.createDataFrame(spark.read.parquet(paths["points"]).withColumn("x", F.col("x") + 500).select(POINT_COLS).collect(), schemas.POINTS_SRC)
    moved.write.mode("overwrite").parquet(paths["points"])
    assert run_job(spark, *args) is True and run_job(spark, *args) is False

    few = spark.createDataFrame(moved.where("wls_wn_sysid <= 3").collect(), schemas.POINTS_SRC)
    few.write.mode("overwrite").parquet(paths["points"])
    assert run_job(spark, *args) is True            # fewer points: groups without rows are gone
    fresh = [*args[:4], f"{root}/state2", f"{root}/out2"]
    assert run_job(spark, *fresh) is True
    left = _rows(spark, f"{paths['out']}/streams")
    assert 0 < len(left) < want.count() and left == _rows(spark, f"{root}/out2/streams")

    seg = spark.createDataFrame(spark.read.parquet(paths["segments"]).where("blue_line_key % 2 = 0")
                                .select([f.name for f in schemas.SEGMENTS.fields]).collect(), schemas.SEGMENTS)
    seg.write.mode("overwrite").parquet(paths["segments"])
    assert run_job(spark, *args) is True            # the network alone changed


def test_job_rebuilds_touched_groups_only(spark):
    import glob
    import os

    root = work_path(spark, "job-groups")
    paths, args = _tables(spark, root)
    assert run_job(spark, *args) is True

    def files():
        folder = f"{paths['out']}/streams".removeprefix("file://").removeprefix("file:")
        return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{folder}/watershed_group_code=*/*.parquet")}

    first = files()
    pts = spark.read.parquet(paths["points"])
    one = pts.orderBy("notation_id").first().notation_id
    edited = pts.withColumn("notation_type", F.when(F.col("notation_id") == one, "OR*").otherwise(F.col("notation_type")))
    spark.createDataFrame(edited.select(POINT_COLS).collect(), schemas.POINTS_SRC).write.mode("overwrite").parquet(paths["points"])
    assert run_job(spark, *args) is True
    second = files()
    kept = {f for f in first if second.get(f) == first[f]}
    assert 0 < len(set(first) - kept) < len(first) / 4       # the edited point's group is written again, the others are not
    fresh = [*args[:4], f"{root}/state2", f"{root}/out2"]
    assert run_job(spark, *fresh) is True
    assert _rows(spark, f"{paths['out']}/streams") == _rows(spark, f"{root}/out2/streams")

    vert = spark.read.parquet(paths["vertices"])
    moved = vert.withColumn("y", F.when(F.col("linear_feature_id") == vert.first().linear_feature_id, F.col("y") + 1).otherwise(F.col("y")))
    spark.createDataFrame(moved.collect(), vert.schema).write.mode("overwrite").parquet(paths["vertices"])
    assert run_job(spark, *args) is True                     # geometry alone
    assert 0 < len(set(second) - {f for f in second if files().get(f) == second[f]}) < len(first) / 4

    aq = spark.read.parquet(paths["aquifers"])
    spark.createDataFrame(aq.where("aquifer_id % 2 = 0").collect(), aq.schema).write.mode("overwrite").parquet(paths["aquifers"])
    third = files()
    assert run_job(spark, *args) is True and files() == third   # polygons do not touch the streams
    folder = f"{paths['state']}.snapshots/prod".removeprefix("file://").removeprefix("file:")
    assert len([x for x in os.listdir(folder) if x != "current"]) == 1  # one snapshot is kept
