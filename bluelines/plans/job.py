"""The whole job over stored tables, as run on a schedule.

    python -m bluelines.plans.job --segments S --vertices V --points P --aquifers A \
        --state STATE --out OUT [--env prod]

Inputs are Parquet tables: segments (``schemas.SEGMENTS``), vertices (linear_feature_id, seq,
x, y, m), raw points (``schemas.POINTS_SRC``), aquifers (aquifer_id, geom). The change gate
compares a fingerprint of every column of all four inputs with the state table (``path, env, etag``);
only when one differs (or there is none) does the job run: snap, override, break, lists, side
channels, aquifer link. Outputs are written under ``OUT`` by the declared schemas: ``streams`` laid out by work
group, ``aquifers`` as a whole.

A run keeps a snapshot of what it worked on (placed points, and per segment its ties and a hash of its row and
vertices) beside the state. The next run compares with it and rebuilds only the work groups that the edits touch
(``operators.incremental``); the files of the others stay. Without a snapshot or an output everything is written, and
groups that no longer exist go. Outputs come first, then the snapshot, then the state: after a crash between
them the next run finds the state unchanged, compares with the snapshot it finds and ends with the same output.
"""

from __future__ import annotations

import argparse
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bluelines import schemas
from bluelines.operators import changes, incremental
from bluelines.operators.links import link_by_text_key
from bluelines.plans import sinks
from bluelines.plans.catalogue import override_codes
from bluelines.plans.pipeline import Network
from bluelines.session import apply_defaults, remove_paths


def _stored(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """A stored table, None where there is none yet."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except Exception as e:
        if not any(x in str(e) for x in ("PATH_NOT_FOUND", "does not exist", "UNABLE_TO_INFER_SCHEMA")):
            raise
        return None


def _read_state(spark: SparkSession, path: str) -> DataFrame:
    state = _stored(spark, path, schemas.CHANGE_STATE)
    return spark.createDataFrame([], schemas.CHANGE_STATE) if state is None else state


def _segment_ties(seg: DataFrame, vert: DataFrame) -> DataFrame:
    """What a snapshot keeps of a segment: its ties to lines, codes and its group, and one hash of its row and vertices."""
    geometry = changes.fingerprint(vert, ["linear_feature_id"]).select("linear_feature_id", F.col("etag").alias("_geometry"))
    rows = seg.withColumn("_row", changes.row_hash(seg, seg.columns)).join(geometry, "linear_feature_id", "left")
    return rows.select(*incremental.TIES, F.concat_ws("/", "_row", "_geometry").alias("etag"))


def _refresh_streams(spark: SparkSession, segments: DataFrame, vertices: DataFrame, points: DataFrame, snapshot: str,
                     previous: str | None, path: str) -> None:
    """Bring the streams output up to date: all groups, or those that differ from the previous snapshot's run."""
    written: list[str] = []
    group = incremental.GROUP

    def streams(seg: DataFrame) -> tuple[Network, DataFrame]:
        net = Network(spark, segments=seg, points=points, vertices=vertices)
        return net, sinks.typed(net.stream_output, schemas.STREAM_OUTPUT, [group])

    net = None
    try:
        if previous is None or _stored(spark, path) is None:
            net, out = streams(segments)
            sinks.write_all_groups(out, path)
            return
        ties = spark.read.parquet(f"{previous}/segments"), spark.read.parquet(f"{snapshot}/segments")
        touched = incremental.touched_groups(*ties, spark.read.parquet(f"{previous}/points"), points, segment_compare=["etag"], written=written)
        groups = sorted(r[0] for r in touched.collect())
        if groups:
            net, out = streams(incremental.needed_segments(segments, touched))
            sinks.refresh_groups(out, path, groups)
    finally:
        if net is not None:
            net.release()
        remove_paths(spark, written)


def run_job(spark: SparkSession, segments: str, vertices: str, points: str, aquifers: str,
            state: str, out: str, env: str = "prod") -> bool:
    """Run the job if an input changed; returns whether it ran."""
    apply_defaults(spark)
    pts = spark.read.schema(schemas.POINTS_SRC).parquet(points)
    seg = spark.read.schema(schemas.SEGMENTS).parquet(segments)
    vert, aq = spark.read.parquet(vertices), spark.read.parquet(aquifers)
    current = None
    for path, df in ((segments, seg), (vertices, vert), (points, pts), (aquifers, aq)):
        one = changes.fingerprint(df).select(F.lit(path).alias("path"), "etag")
        current = one if current is None else current.unionByName(one)
    current = spark.createDataFrame(current.collect(), current.schema)  # four rows, computed once
    old_state = _read_state(spark, state)
    status = changes.change_status(current, old_state, [env])
    if not status.agg(F.max(F.col("has_changed").cast("int")).alias("c")).first()["c"]:
        return False

    base = Network(spark, segments=seg, points_src=pts, vertices=vert,
                   points=spark.createDataFrame([], schemas.PLACED_POINTS))
    next_state, snapshots = f"{state}.next", f"{state}.snapshots/{env}"
    snapshot, current_snapshot = f"{snapshots}/{uuid.uuid4().hex}", _stored(spark, f"{snapshots}/current", "folder string")
    previous = None if current_snapshot is None else (current_snapshot.first() or [None])[0]
    try:
        notations = override_codes(base.snapped).select(*[f.name for f in schemas.PLACED_POINTS.fields])
        notations.write.parquet(f"{snapshot}/points")
        _segment_ties(seg, vert).write.parquet(f"{snapshot}/segments")
        _refresh_streams(spark, seg, vert, spark.read.parquet(f"{snapshot}/points"), snapshot, previous, f"{out}/streams")
        linked = link_by_text_key(base.points_src, aq).orderBy("aquifer_id", "notation_description")
        sinks.write_refresh(sinks.typed(linked, schemas.AQUIFER_OUTPUT), f"{out}/aquifers")
        sinks.write_refresh(spark.createDataFrame([(snapshot,)], "folder string"), f"{snapshots}/current")
        # the new state is computed from the old one, so it is written to a side folder first and then copied over the old folder
        changes.sync_state(old_state, current, env).write.mode("overwrite").parquet(next_state)
        spark.read.parquet(next_state).write.mode("overwrite").parquet(state)
        if previous:
            remove_paths(spark, [previous])
    finally:
        base.release()
        remove_paths(spark, [next_state])
    return True


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n")[0])
    for name in ("segments", "vertices", "points", "aquifers", "state", "out"):
        ap.add_argument(f"--{name}", required=True)
    ap.add_argument("--env", default="prod")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("bluelines-job").getOrCreate()
    ran = run_job(spark, a.segments, a.vertices, a.points, a.aquifers, a.state, a.out, a.env)
    print("ran" if ran else "unchanged, skipped")


if __name__ == "__main__":
    main()
