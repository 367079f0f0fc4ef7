"""Points from JSON with bad rows apart; fingerprints by file."""

import json

import pytest
from pyspark.sql import functions as F

from bluelines import schemas
from bluelines.operators import changes
from bluelines.session import work_path
from bluelines.sources.points import read_points_json

GOOD = {"notation_id": "NO1", "notation_type": "FR", "notation_description": "1 - PWS", "blue_line_key": 7, "x": 1.5, "y": 2.0,
        "wls_wn_sysid": 1, "latitude": 49.0, "longitude": -125.0}


def read(spark, lines):
    path = work_path(spark, "json-test")
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(path)
    good, bad = read_points_json(spark, path)
    assert [(f.name, f.dataType) for f in good.schema.fields] == [(f.name, f.dataType) for f in schemas.POINTS_SRC.fields]
    return good.collect(), sorted(((r.reason, r.notation_id, r.record) for r in bad.collect()), key=repr)


def row(**changed):
    return json.dumps({k: v for k, v in {**GOOD, **changed}.items() if v != "-"})


def test_reasons(spark):
    lines = [row(), row(notation_id="NO2", extra=1), row(notation_id="NO3")[:-4], "not json", "[1, 2", row(notation_id="NO4", x="east"),
             row(notation_id=None), row(notation_id="-"), row(notation_id="NO5", notation_type=None), row(notation_id="NO6", blue_line_key=None)]
    good, bad = read(spark, lines)
    assert sorted(r.notation_id for r in good) == ["NO1", "NO2", "NO6"]
    reasons = [b[0] for b in bad]
    assert reasons == ["malformed"] * 4 + ["null notation_id"] * 2 + ["null notation_type"]
    assert {b[2] for b in bad if b[0] == "malformed"} == {lines[2], lines[3], lines[4], lines[5]}
    assert all(json.loads(b[2])["wls_wn_sysid"] == 1 for b in bad[4:])


def test_one_row_of_a_key_stays(spark):
    lines = [row(x=3.0), row(x=1.0), row(x=1.0), row(x=2.0)] + [row(notation_id="HOT", x=5.0)] * 500
    good, bad = read(spark, lines)
    assert sorted((r.notation_id, r.x) for r in good) == [("HOT", 5.0), ("NO1", 1.0)]
    assert [b[0] for b in bad] == ["repeated key"] * 502


def test_empty_file(spark):
    good, bad = read(spark, [""])
    assert good == [] and bad == []


@pytest.fixture
def folder(spark):
    path = work_path(spark, "files-test")
    for k in range(4):
        spark.range(k * 100, k * 100 + 100).withColumn("v", F.col("id") * 0.5).coalesce(1).write.parquet(f"{path}/{'ab'[k % 2]}/{k}")
    return path


def test_only_changed_files_are_read(spark, folder):
    read_paths = []

    def reader(*paths):
        read_paths.extend(paths)
        return spark.read.parquet(*paths)

    first = changes.file_fingerprints(spark, changes.list_files(spark, folder), read=reader)
    assert len(read_paths) == 4 and first.where("hashed").count() == 4
    stored = work_path(spark, "files-cache")
    first.write.parquet(stored)
    read_paths.clear()
    spark.range(100, 150).withColumn("v", F.lit(1.0)).coalesce(1).write.mode("overwrite").parquet(f"{folder}/b/1")
    spark.range(5).withColumn("v", F.lit(2.0)).coalesce(1).write.parquet(f"{folder}/c/9")
    now = changes.file_fingerprints(spark, changes.list_files(spark, folder), spark.read.parquet(stored), reader)
    assert len(read_paths) == 2 and {p.split("/")[-2] for p in read_paths} == {"1", "9"}
    whole = changes.fingerprint(spark.read.option("recursiveFileLookup", "true").parquet(folder)).first()
    assert tuple(changes.combined(now).first()) == tuple(whole)
    read_paths.clear()
    spark.createDataFrame(now.collect(), now.schema).write.parquet(stored + "2")
    again = changes.file_fingerprints(spark, changes.list_files(spark, folder), spark.read.parquet(stored + "2"), reader)
    assert read_paths == [] and again.count() == 5 and again.where("hashed").count() == 0


def test_listing_below_a_prefix(spark, folder):
    names = lambda prefix: {r.name.rsplit("/", 1)[0] for r in changes.list_files(spark, folder, prefix).collect()}
    assert names("") == {"a/0", "a/2", "b/1", "b/3"} and names("b/") == {"b/1", "b/3"} and names("b/3") == {"b/3"} and names("x") == set()
    assert changes.file_fingerprints(spark, changes.list_files(spark, folder, "x")).count() == 0
    assert changes.list_files(spark, folder).where("length > 0 and modified is not null").count() == 4
