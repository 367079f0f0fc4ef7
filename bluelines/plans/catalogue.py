"""The query catalogue: one entry per operator group of the survey's inventory.

Every query takes ``(spark, sf_dir)``, reads the input tables of that folder (or what Spark
derives from them) and returns a DataFrame of scalar columns; doubles are given to 6 places.
The matching SQL is in ``plans/oracle.py`` (``ORACLE``).
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bluelines import schemas
from bluelines.functions.rounding import piece_key
from bluelines.functions.sql import register_locate_along
from bluelines.operators import changes, checks, incremental, labels, lists, runs, snapping, upstream
from bluelines.operators.common import first_per_key, insert_ignore, round6
from bluelines.operators.links import link_by_text_key
from bluelines.plans import sinks
from bluelines.plans.pipeline import OUTPUT_COLS, Network
from bluelines.session import materialize, work_path
from bluelines.sources import fixtures
from bluelines.sources.points import read_points_json
from bluelines.sources.tables import TABLES, Tables
from bluelines.streaming.ingest import ingest_available_now

_NETWORKS: dict = {}


def network(spark: SparkSession, sf_dir: str) -> Network:
    """One ``Network`` per (application, data folder): stages are materialised once and shared."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _NETWORKS:
        _NETWORKS[key] = Network(spark, sf_dir)
    return _NETWORKS[key]


def forget() -> None:
    """Delete the tables that the shared networks wrote; the next query builds its own."""
    for n in reversed(_NETWORKS.values()):
        n.release()
    _NETWORKS.clear()


def _out(df: DataFrame) -> DataFrame:
    """Stream output columns with measures given to 6 places."""
    return df.select("linear_feature_id", "notation_id_list", "primary_notation_type", "secondary_notation_types",
                     "fwa_watershed_code", "blue_line_key", round6("downstream_route_measure").alias("downstream_route_measure"),
                     round6("upstream_route_measure").alias("upstream_route_measure"))


# ---- sources ------------------------------------------------------------------------------
def q_points_src(spark, d):
    """The raw points as stored, read by their declared schema."""
    path = work_path(spark, "points")
    network(spark, d).points_src.write.parquet(path)
    src = spark.read.schema(schemas.POINTS_SRC).parquet(path)
    return src.select(*[c for c in src.columns if c not in ("x", "y", "latitude", "longitude")],
                      *[round6(c).alias(c) for c in ("x", "y", "latitude", "longitude")])


def q_points_json(spark, d):
    """The raw points as JSON lines, some of them cut off, without a key, with a text for a number, or twice; read by the
    declared schema, bad rows apart with their reason."""
    n = network(spark, d)
    src = n.points_src.select([f.name for f in schemas.POINTS_SRC.fields])
    sysid = F.col("wls_wn_sysid")
    line = F.to_json(F.struct(*[F.when(sysid % 13 != 0, F.col(c)).alias(c) if c == "notation_id" else F.col(c) for c in src.columns]))
    line = F.when(sysid % 11 == 0, F.expr("substring(line, 1, length(line) - 5)")).when(
        sysid % 19 == 0, F.expr("replace(line, '\"x\":', '\"x\":\"east\",\"z\":')")).otherwise(F.col("line")), line
    lines = src.withColumn("line", line[1]).withColumn("line", line[0])
    lines = lines.select(F.explode(F.array_repeat("line", F.when(sysid % 17 == 0, 2).otherwise(1))).alias("value"))
    path = work_path(spark, "json")
    lines.write.text(path)
    good, bad = read_points_json(spark, path, written=n.written)
    number = F.coalesce("wls_wn_sysid", F.regexp_extract("record", '"wls_wn_sysid":([0-9]+)', 1).cast("int"))
    cols = ["notation_id", "notation_type", "notation_description", "blue_line_key"]
    good = good.select(F.lit(None).cast("string").alias("reason"), sysid, *cols, round6("x").alias("x"))
    bad = bad.select("reason", number.alias("wls_wn_sysid"), *[F.when(F.col("reason") != "malformed", F.col(c)).alias(c) for c in cols],
                     F.when(F.col("reason") != "malformed", round6("x")).alias("x"))
    return good.unionByName(bad)


def q_segments_src(spark, d):
    s = network(spark, d).segments
    return s.select("linear_feature_id", "blue_line_key", "watershed_key",
                    round6("downstream_route_measure").alias("downstream_route_measure"),
                    round6("upstream_route_measure").alias("upstream_route_measure"),
                    round6("length_metre").alias("length_metre"), "wscode", "localcode", "fwa_watershed_code",
                    "watershed_group_code")


def q_group_list(spark, d):
    return network(spark, d).points.select("watershed_group_code").distinct()


def q_output_contract(spark, d):
    n = network(spark, d)
    return sinks.output_contract(n.stream_list_all, q_attr_link(spark, d))


def q_key_check(spark, d):
    n = network(spark, d)
    t = Tables(spark, d)

    def dup(df, key, name):
        c = df.groupBy(*key).agg(F.count(F.lit(1)).alias("c"))
        return c.agg(F.lit(name).alias("table_name"), F.sum("c").cast("bigint").alias("n_rows"),
                     F.count(F.lit(1)).cast("bigint").alias("n_keys"),
                     F.count_if(F.col("c") > 1).cast("bigint").alias("n_duplicated_keys"))
    return (dup(n.segments, schemas.KEYS["segments"], "segments")
            .unionByName(dup(n.points, schemas.KEYS["notations"], "notations"))
            .unionByName(dup(n.pieces, schemas.KEYS["pieces"], "pieces"))
            .unionByName(dup(conflict_network(spark, d).pieces, schemas.KEYS["pieces"], "pieces of conflicting segments"))
            .unionByName(dup(t.lineitem, ["l_orderkey", "l_linenumber"], "lineitem")))


# The one code override of the reference (a confluence moved just downstream).
OVERRIDE_RULES = [("300.432687.380566.184025", "300.432687.380566.173400")]


def override_codes(points: DataFrame, rules: list[tuple[str, str]] | DataFrame = OVERRIDE_RULES) -> DataFrame:
    """``update ... set localcode = new where localcode = old`` as a left join with the rule table."""
    r = points.sparkSession.createDataFrame(rules, "old_code string, new_code string") if isinstance(rules, list) else rules
    return (points.join(r, F.col("localcode") == F.col("old_code"), "left")
            .withColumn("localcode", F.coalesce("new_code", "localcode")).drop("old_code", "new_code"))


def q_override_rules(spark, d):
    """The reference's rule and one for every point whose id ends in an even digit: its local code is
    moved to the start of its stream."""
    pts = network(spark, d).points
    moved = pts.where(F.col("notation_id").rlike("[02468]$") & F.col("localcode").isNotNull())
    rules = moved.select(F.col("localcode").alias("old_code"), F.col("wscode").alias("new_code")).distinct()
    fixed = spark.createDataFrame(OVERRIDE_RULES, rules.schema)
    return override_codes(pts, rules.unionByName(fixed)).select("notation_id", "localcode")


def conflict_network(spark: SparkSession, d: str) -> Network:
    """The fixture with piece-key conflicts: every fifth line has a second, half as long segment at its
    start, under another id."""
    key = ("conflicts", spark.sparkContext.applicationId, d)
    if key not in _NETWORKS:
        n = network(spark, d)
        start = n.segments.where((F.col("blue_line_key") % 5 == 0) & (F.col("downstream_route_measure") == 0))
        twice = start.withColumns({"linear_feature_id": F.col("linear_feature_id") + 8,
                                   "upstream_route_measure": F.col("upstream_route_measure") / 2,
                                   "length_metre": F.col("length_metre") / 2})
        _NETWORKS[key] = Network(spark, segments=n.segments.unionByName(twice), points=n.points.drop("prank"))
    return _NETWORKS[key]


def q_key_conflicts(spark, d):
    """Pieces where segments share a start: the first segment per key stays, cuts whose key exists are skipped."""
    return conflict_network(spark, d).pieces.select(
        "segmented_stream_id", "linear_feature_id", round6("downstream_route_measure").alias("downstream_route_measure"),
        round6("upstream_route_measure").alias("upstream_route_measure"))


def q_segment_key(spark, d):
    s = network(spark, d).segments
    return s.select("linear_feature_id",
                    piece_key(F.col("blue_line_key"), F.col("downstream_route_measure")).alias("segmented_stream_id"))


def q_input_report(spark, d):
    """Points that would drop out or sort oddly (no segment on their line, no key, NULL/unknown
    type, duplicate id), over the raw points: the fixture's points, where low-priority orders carry a
    line key made from the customer instead (such lines do not exist) and pending orders an
    unknown type."""
    n = network(spark, d)
    src = n.points_src.join(n.points.select("notation_id", "linear_feature_id"), "notation_id")
    orders = Tables(spark, d).orders.select(F.col("o_orderkey").alias("_ok"), "o_custkey", "o_orderstatus",
                                            "o_orderpriority")
    raw = (src.join(orders, F.col("blue_line_key") == F.col("_ok"))
           .select("notation_id",
                   F.when(F.col("o_orderstatus") == "P", F.lit("XX")).otherwise(F.col("notation_type")).alias("notation_type"),
                   F.when(F.col("o_orderpriority") == "5-LOW", F.col("o_custkey") * 1000 + 7)
                    .otherwise(F.col("blue_line_key"))
                    .alias("blue_line_key")))
    return checks.point_problems(raw, n.segments)


def q_code_descendant(spark, d):
    """Per point: how many segments have a code at or below the point's code (``<@``): the segments between the opening
    and the closing place of the code in the order of codes."""
    n = network(spark, d)
    per_code = materialize(n.segments.groupBy("wscode").agg(F.count(F.lit(1)).alias("n")), "segments-per-code", n.written)
    below = labels.rows_below(per_code, n.points, n.written).withColumnsRenamed({"wscode": "_root", "n": "n_segments"})
    return n.points.join(below, F.col("wscode") == F.col("_root")).select("notation_id", "n_segments")


LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
              "l_returnflag", "l_linestatus", "l_shipdate"]
LINE_COLS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"]


def q_insert_ignore(spark, d):
    li = Tables(spark, d).lineitem
    key = ["l_orderkey", "l_linenumber"]
    target = first_per_key(li.where(F.col("l_returnflag") == "R"), key, LINE_ORDER)
    res = insert_ignore(target, li, key, LINE_ORDER)
    return res.select(*LINE_COLS)


def q_first_per_key(spark, d):
    o = Tables(spark, d).orders
    r = first_per_key(o.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority"),
                      ["o_custkey"], ["o_orderdate", "o_orderkey"])
    return r.select("o_custkey", "o_orderkey", round6("o_totalprice").alias("o_totalprice"), "o_orderpriority")


# ---- upstream / downstream ----------------------------------------------------------------
def _segment_lists(n: Network) -> DataFrame:
    """Per segment, the ordered points downstream (shared per code, see ``lists.shared_lists``)."""
    return lists.shared_lists(n.segments, n.kpoints, ["linear_feature_id"], upstream.TOLERANCE, n.written)


def q_upstream_pairs(spark, d):
    """Every (point, segment upstream of it) pair: the per-segment lists, one row per element."""
    return _segment_lists(network(spark, d)).select(
        F.explode("pts").alias("p"), "linear_feature_id").select(F.col("p.notation_id").alias("notation_id"),
                                                                 "linear_feature_id")


def q_upstream_segments(spark, d):
    n = network(spark, d)
    return upstream.upstream_lines(n.segments, n.kpoints, written=n.written).select("linear_feature_id")


def q_downstream_points(spark, d):
    """Per segment, the points below it in list order with their position (1 = first)."""
    agg = _segment_lists(network(spark, d))
    return agg.select("linear_feature_id", F.posexplode("pts").alias("pos", "p")).select(
        "linear_feature_id", F.col("p.notation_id").alias("notation_id"),
        (F.col("pos") + 1).cast("bigint").alias("position"))


def q_point_on_segment(spark, d):
    n = network(spark, d)
    pairs = upstream.line_point_pairs(n.segments, n.kpoints, upstream.on_segment_residual())
    return pairs.select(F.col("p_notation_id").alias("notation_id"), "linear_feature_id")


def q_side_channel_candidates(spark, d):
    n = network(spark, d)
    pairs = upstream.line_point_pairs(n.segments, n.kpoints, upstream.side_candidate_residual())
    return pairs.select(F.col("p_notation_id").alias("notation_id"), "linear_feature_id")


def q_work_segments(spark, d):
    w = network(spark, d).work
    return w.select("linear_feature_id", "blue_line_key", "watershed_key",
                    round6("downstream_route_measure").alias("downstream_route_measure"),
                    round6("upstream_route_measure").alias("upstream_route_measure"), "watershed_group_code",
                    piece_key(F.col("blue_line_key"), F.col("downstream_route_measure")).alias("segmented_stream_id"))


def q_break_segments(spark, d):
    p = network(spark, d).pieces
    return p.select("segmented_stream_id", "linear_feature_id", "blue_line_key",
                    round6("downstream_route_measure").alias("downstream_route_measure"),
                    round6("upstream_route_measure").alias("upstream_route_measure"))


def q_next_break(spark, d):
    """The new pieces with the key of the segment they were cut from (the ``lead`` step)."""
    p = network(spark, d).pieces
    return p.where(F.col("piece_index") > 0).select(
        F.col("parent_stream_id").alias("segmented_stream_id"), "linear_feature_id",
        round6("downstream_route_measure").alias("downstream_route_measure"),
        round6("upstream_route_measure").alias("upstream_route_measure"))


def q_point_id_list(spark, d):
    return network(spark, d).stream_list.select("segmented_stream_id", "notation_id_list")


def q_primary_type(spark, d):
    return network(spark, d).stream_list.select("segmented_stream_id", "primary_notation_type")


def q_run_collapse(spark, d):
    """Events per user ordered by time: the rows where the event type changes (runs of one type
    collapse to their first row). Dealt into ranges of user and time, so that neither a heavy user nor
    a heavy hour is one task."""
    ev = Tables(spark, d).events.select("event_id", "ts", "user_id", "event_type")
    r = runs.run_starts(ev, "user_id", ["ts", "event_id"], "event_type")
    return r.select("user_id", "event_id", "event_type")


def q_stream_list(spark, d):
    return _out(network(spark, d).stream_list)


def q_start_of_route(spark, d):
    return network(spark, d).starts


def q_multi_point_codes(spark, d):
    return network(spark, d).multi_codes


def q_side_channels(spark, d):
    return _out(network(spark, d).side_list)


def q_stream_list_all(spark, d):
    return _out(network(spark, d).stream_list_all)


# ---- linear referencing ------------------------------------------------------------------
def q_nearest_segment(spark, d):
    s = network(spark, d).snapped
    return s.select("notation_id", "linear_feature_id", round6("distance_to_stream").alias("distance_to_stream"))


def q_snap_measure(spark, d):
    s = network(spark, d).snapped
    return s.select("notation_id", "linear_feature_id", "blue_line_key",
                    round6("downstream_route_measure").alias("downstream_route_measure"),
                    "wscode", "localcode", "watershed_group_code")


def q_snapped_table(spark, d):
    """The snapped point table in full (``schemas.NOTATIONS``), its location as two numbers."""
    s = sinks.typed(network(spark, d).snapped, schemas.NOTATIONS)
    return s.select(*[c for c in s.columns if c not in ("geom", "downstream_route_measure", "distance_to_stream")],
                    round6("downstream_route_measure").alias("downstream_route_measure"),
                    round6("distance_to_stream").alias("distance_to_stream"),
                    round6("geom.x").alias("x"), round6("geom.y").alias("y"))


def q_locate_along(spark, d):
    n = network(spark, d)
    return snapping.locate_along(n.snapped, n.point_lines).select("notation_id", round6("x").alias("x"), round6("y").alias("y"))


def q_locate_sql(spark, d):
    """The same from SQL: a table function with two arguments in a lateral join."""
    n = network(spark, d)
    register_locate_along(spark, n.point_lines)
    return spark.sql("""SELECT p.notation_id, round(l.x, 6) AS x, round(l.y, 6) AS y
                        FROM {points} p, LATERAL locate_along(p.blue_line_key, p.downstream_route_measure) l""", points=n.snapped)


def q_clip_lines(spark, d):
    n = network(spark, d)
    return snapping.clip_pieces(n.stream_list_all, n.listed_lines).select(
        "segmented_stream_id", "vertex_index", round6("x").alias("x"), round6("y").alias("y"))


def gap_network(spark: SparkSession, d: str) -> Network:
    """The fixture with lines in several parts, measure gaps between them."""
    key = ("gaps", spark.sparkContext.applicationId, d)
    if key not in _NETWORKS:
        n = network(spark, d)
        _NETWORKS[key] = Network(spark, segments=n.segments, points=n.points.drop("prank"),
                                 points_src=fixtures.points_src(n.tables, n.segments),  # written only if asked for
                                 vertices=fixtures.gap_vertices(n.segments))
    return _NETWORKS[key]


def q_clip_parts(spark, d):
    """Pieces of lines with gaps: one row set per part that the piece covers, none where it lies in a gap."""
    n = gap_network(spark, d)
    return snapping.clip_pieces(n.stream_list_all, n.listed_lines).select(
        "segmented_stream_id", "part", "vertex_index", round6("x").alias("x"), round6("y").alias("y"))


def q_locate_parts(spark, d):
    """Where each point's measure lies on its line in parts; points in a gap are nowhere."""
    n = gap_network(spark, d)
    return snapping.locate_along(n.points, n.point_lines).select("notation_id", round6("x").alias("x"), round6("y").alias("y"))


def q_stream_export(spark, d):
    """The published streams by the declared schema, written over the empty template and read back;
    each geometry is given by its number of vertices and its two ends."""
    n = network(spark, d)
    path = work_path(spark, "stream-export")
    sinks.template(spark, schemas.STREAM_OUTPUT, path)
    sinks.typed(n.stream_output, schemas.STREAM_OUTPUT).write.mode("append").option("compression", "zstd").parquet(path)
    out = spark.read.schema(schemas.STREAM_OUTPUT).parquet(path)
    first, last = F.get("geom", 0), F.element_at("geom", -1)
    return out.select("linear_feature_id", "notation_id_list", "primary_notation_type", "secondary_notation_types",
                      "fwa_watershed_code", "blue_line_key", F.size("geom").alias("n_vertices"),
                      round6(first["x"]).alias("x_first"), round6(first["y"]).alias("y_first"),
                      round6(last["x"]).alias("x_last"), round6(last["y"]).alias("y_last"))


def snapped_network(spark: SparkSession, d: str) -> Network:
    """The whole job as the reference runs it: raw points snapped to the nearest segment of their
    line, the code override applied, then work segments, breaking and lists on those points."""
    key = ("snapped", spark.sparkContext.applicationId, d)
    if key not in _NETWORKS:
        base = network(spark, d)
        notations = override_codes(base.snapped).select(*[f.name for f in schemas.PLACED_POINTS.fields])
        _NETWORKS[key] = Network(spark, segments=base.segments, points=notations)
    return _NETWORKS[key]


def q_full_run(spark, d):
    return _out(snapped_network(spark, d).stream_list_all)


def q_attr_link(spark, d):
    """Points linked to aquifers through the number in their text, ordered as published (a range-
    partitioned sort, not one task); the multipolygon is summarised by its polygon count and its
    largest x, so the carried geometry is checked too."""
    n = network(spark, d)
    aq = fixtures.aquifers(n.tables)
    linked = link_by_text_key(n.points_src, aq)
    xs = F.flatten(F.transform(F.flatten("geom"), lambda ring: F.transform(ring, lambda p: p["x"])))
    return (linked.select("aquifer_id", "notation_id", "notation_description",
                          F.size("geom").alias("n_polygons"), round6(F.array_max(xs)).alias("x_max"))
            .orderBy("aquifer_id", "notation_description"))


# ---- change detection ---------------------------------------------------------------------
# Fixed parameters of the fixture: which order objects were edited since the cached snapshot.
EDITED_PRIORITIES = ["1-URGENT", "2-HIGH"]
ENVS = ["prod", "test"]


def orders_objects(orders: DataFrame) -> DataFrame:
    """Orders as objects: one object (path) per order priority."""
    return orders.withColumn("path", F.concat(F.lit("orders/"), F.col("o_orderpriority"), F.lit(".parquet")))


def orders_previous(orders: DataFrame) -> DataFrame:
    """The snapshot the cache was taken from: 'P' orders of two priorities did not exist yet."""
    return orders.where(~((F.col("o_orderstatus") == "P") & F.col("o_orderpriority").isin(*EDITED_PRIORITIES)))


def _change_inputs(spark, d):
    o = orders_objects(Tables(spark, d).orders)
    current = changes.fingerprint(o, ["path"])
    state = changes.fingerprint(orders_previous(o), ["path"]).select("path", F.lit("prod").alias("env"), "etag")
    return o, current, state, ENVS


def q_table_fingerprint(spark, d):
    t = Tables(spark, d)
    out = None
    for name in TABLES:
        fp = changes.fingerprint(getattr(t, name)).select(F.lit(name).alias("table_name"), "n_rows", "hash_high", "hash_low")
        out = fp if out is None else out.unionByName(fp)
    return out


def q_file_fingerprints(spark, d):
    """Orders as files below one folder per first digit of the priority; then two folders are written anew, one of them with other
    rows. Fingerprints per folder from those of its files, of which only the new ones are read again; one folder is
    left out by its prefix."""
    o, path = Tables(spark, d).orders, work_path(spark, "order-files")
    digit = F.substring("o_orderpriority", 1, 1)
    for k in "12345":
        o.where(digit == k).write.parquet(f"{path}/orders/{k}")
    first = materialize(changes.file_fingerprints(spark, changes.list_files(spark, path, "orders/")), "file-fingerprints")
    o.where((digit == "2") & (F.col("o_orderstatus") != "P")).write.mode("overwrite").parquet(f"{path}/orders/2")
    o.where(digit == "4").write.mode("overwrite").parquet(f"{path}/orders/4")
    now = changes.list_files(spark, path, "orders/").where(~F.startswith("name", F.lit("orders/5/")))
    now = changes.file_fingerprints(spark, now, first).withColumn("folder", F.substring("name", 1, 8))
    per_folder = changes.combined(now, ["folder"]).drop("etag")
    read = now.groupBy(F.col("folder").alias("_of")).agg(F.max("hashed").alias("hashed"))
    return per_folder.join(read, F.col("folder") == F.col("_of")).drop("_of")


def q_object_listing(spark, d):
    """The files that hold the rows of the input tables, with their row counts, and an existence test of
    every input table's file plus one that is not there."""
    t = Tables(spark, d)
    listing = changes.list_objects({name: getattr(t, name) for name in TABLES})
    expected = listing.select("table_name", "object_name").unionByName(
        spark.createDataFrame([("retired", "retired.parquet")], "table_name string, object_name string"))
    return changes.objects_exist(expected, listing)


def q_change_status(spark, d):
    _, current, state, envs = _change_inputs(spark, d)
    return changes.change_status(current, state, envs)


def q_change_sync(spark, d):
    """State after a successful 'prod' run: prod fingerprints replaced by the current ones (a stale
    entry of a retired object goes), 'test' entries kept, then one cached entry removed."""
    _, current, state, _ = _change_inputs(spark, d)
    test = state.where(F.col("path") < "orders/4").withColumn("env", F.lit("test"))
    stale = spark.createDataFrame([("orders/9-RETIRED.parquet", "prod", "0:0:0")], "path string, env string, etag string")
    synced = changes.sync_state(state.unionByName(test).unionByName(stale), current, "prod")
    drop = spark.createDataFrame([("orders/3-MEDIUM.parquet", "test")], "path string, env string")
    return changes.remove_state(synced, drop)


def q_change_route(spark, d):
    o, current, state, envs = _change_inputs(spark, d)
    status = changes.change_status(current, state, envs).where(F.col("env") == "prod")
    rows = o.select("o_orderkey", "path", F.col("_metadata.file_name").alias("source_file"))
    return changes.route_rows(rows, status).select("o_orderkey", "path", "port", "source_file")


# Fixed parameters of the path rule: bucket name and target environment.
BUCKET = "en"
ENV = "prod"


def edited_network(n: Network) -> tuple[DataFrame, DataFrame]:
    """Segments and points of the fixture after edits in four work groups: in W011 the later segments of every
    line are gone with their points, in W007 some lines lose their local codes, in W003 points go, change type or move
    up, in W020 new points come."""
    group, sysid = F.col("watershed_group_code"), F.col("wls_wn_sysid")
    gone = (group == "W011") & (F.col("linear_feature_id") % 10 >= 4)
    bare = (group == "W007") & (F.col("blue_line_key") % 5 == 0)
    local = F.when(~bare, F.col("localcode")).alias("localcode")
    segments = n.segments.where(~gone)
    segments = segments.select(*[local if c == "localcode" else c for c in segments.columns])
    points = n.points.drop("prank").where(~gone & ~((group == "W003") & (sysid % 4 == 0)))
    edit, measure = (group == "W003") & (sysid % 4 == 1), F.col("downstream_route_measure")
    points = points.withColumns({"localcode": local, "notation_type": F.when(edit, "PWS").otherwise(F.col("notation_type")),
                                 "downstream_route_measure": F.when(edit, measure + 1.5).otherwise(measure)})
    new = n.points.drop("prank").where((group == "W020") & (sysid % 6 == 0))
    new = new.withColumns({"notation_id": F.concat(F.lit("NX"), sysid.cast("string")), "downstream_route_measure": measure + 3})
    return segments, points.unionByName(new)


def q_incremental_run(spark, d):
    """An output laid out by work group, after edits brought up to date by rebuilding only the groups that the edits touch:
    the same rows as a full run."""
    n = network(spark, d)
    path = work_path(spark, "streams-by-group")
    cols = [*_out(n.stream_list_all).columns, "watershed_group_code"]
    sinks.write_all_groups(n.stream_list_all.select(cols), path)
    segments, points = edited_network(n)
    touched = incremental.touched_groups(n.segments, segments, n.points.drop("prank"), points, written=n.written)
    touched = materialize(touched, "touched-groups", n.written)  # read twice
    groups = sorted(r[0] for r in touched.collect())  # work groups, not rows
    needed = materialize(incremental.needed_segments(segments, touched), "needed-segments", n.written, bucket="blue_line_key")
    part = Network(spark, segments=needed, points=points)
    sinks.refresh_groups(part.stream_list_all.select(cols), path, groups)
    return _out(sinks.read_output(spark, path))


def q_url_to_path(spark, d):
    pages = Tables(spark, d).pages
    path = changes.object_path(F.col("url"), BUCKET)
    return pages.select("page_id", path.alias("object_path")).withColumn(
        "cache_key", changes.cache_key(F.col("object_path"), ENV))


def orders_after(orders: DataFrame) -> DataFrame:
    """An edited copy of orders: 'P' orders removed, urgent orders' priority text changed, the price
    of some 'F' orders raised by a cent, the date of others moved by a day, and the removed keys of one
    priority re-added with another customer."""
    keep = orders.where(F.col("o_orderstatus") != "P")
    edited = keep.withColumn("o_orderpriority",
                             F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("1-URGENT*"))
                              .otherwise(F.col("o_orderpriority")))
    edited = edited.withColumns({
        "o_totalprice": F.when(F.col("o_orderpriority") == "2-HIGH", F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice")),
        "o_orderdate": F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"))
                        .otherwise(F.col("o_orderdate"))})
    readded = orders.where((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "3-MEDIUM")) \
                    .withColumn("o_custkey", F.col("o_custkey") + 1)
    return edited.unionByName(readded)


def q_snapshot_diff(spark, d):
    o = Tables(spark, d).orders
    b = o.where(F.col("o_orderpriority") != "5-LOW")
    return changes.snapshot_diff(b, orders_after(o), ["o_orderkey"])


def q_fingerprint_edits(spark, d):
    """Whether the fingerprint sees an edit of one column only: a price, a date, one component of an
    embedding, a NULL that swaps columns with a text; and a copy that is only reordered."""
    t = Tables(spark, d)
    orders, vectors = t.orders, t.embeddings
    texts = orders.select("o_orderkey", F.col("o_orderstatus").alias("a"), F.lit(None).cast("string").alias("b"))
    cases = [
        ("price", orders, orders.withColumn("o_totalprice", F.when(F.col("o_orderkey") == 1, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")))),
        ("date", orders, orders.withColumn("o_orderdate", F.when(F.col("o_orderkey") == 1, F.col("o_orderdate") + F.expr("INTERVAL 1 SECOND")).otherwise(F.col("o_orderdate")))),
        ("embedding", vectors, vectors.withColumn("embedding", F.transform(
            "embedding", lambda x, i: F.when((i == 3) & (F.col("vec_id") == 1), x + F.lit(1).cast("float")).otherwise(x)))),
        ("null swap", texts, texts.select("o_orderkey", F.col("b").alias("a"), F.col("a").alias("b"))),
        ("order of rows", orders, orders.orderBy(F.col("o_orderkey").desc())),
    ]
    out = None
    for name, before, after in cases:
        x = changes.fingerprint(before).select(F.lit(name).alias("edit"), F.col("etag").alias("x"))
        one = changes.fingerprint(after).withColumn("edit", F.lit(name)).join(x, "edit").select(
            "edit", "n_rows", (F.col("etag") != F.col("x")).alias("seen"))
        out = one if out is None else out.unionByName(one)
    return out


# ---- sinks, gate, streaming ---------------------------------------------------------------
def q_sink_refresh(spark, d):
    n = network(spark, d)
    path = work_path(spark, "streams")
    out = _out(n.stream_list_all)
    sinks.template(spark, out.schema, path)  # the empty table first
    sinks.write_refresh(out, path)           # then the full refresh
    return sinks.read_output(spark, path)


def q_sink_by_group(spark, d):
    """An earlier run wrote all groups with its own lists; this run refreshes the groups up to 'W012', of
    which 'W005' has no rows any more: listed groups are replaced or gone, the others keep the earlier rows."""
    n = network(spark, d)
    path = work_path(spark, "streams-by-group")
    out = n.stream_list_all.select(*_out(n.stream_list_all).columns, "watershed_group_code")
    sinks.write_all_groups(out.withColumn("notation_id_list", F.concat(F.lit("earlier;"), F.col("notation_id_list"))), path)
    groups = [f"W{k:03d}" for k in range(13)]
    sinks.refresh_groups(out.where(F.col("watershed_group_code") != "W005"), path, groups)
    return sinks.read_output(spark, path).select(*OUTPUT_COLS)


# Fixed parameter of the per-group read: the work group to publish.
GROUP = "W001"


def q_group_output(spark, d):
    """One work group's output, read from the per-group layout with an equality filter on the
    partition column (partition pruning: only that group's files are listed and read)."""
    n = network(spark, d)
    path = work_path(spark, "streams-by-group")
    out = n.stream_list_all.select(*_out(n.stream_list_all).columns, "watershed_group_code")
    sinks.write_by_group(out, path)
    return sinks.read_group(spark, path, GROUP).select(*OUTPUT_COLS)


def q_gated_run(spark, d):
    """The gate both ways: 'prod' has a cached fingerprint that differs, so the lists are made anew; 'test'
    was synced with the current fingerprints, so the previous output (of one group) is returned."""
    n = network(spark, d)
    _, current, state, envs = _change_inputs(spark, d)
    path = work_path(spark, "gated")
    out = n.stream_list_all.select(*_out(n.stream_list_all).columns, "watershed_group_code")
    sinks.write_refresh(out.where(F.col("watershed_group_code") == GROUP).select(*OUTPUT_COLS), path)
    status = changes.change_status(current, changes.sync_state(state, current, "test"), envs)
    result = None
    for env in envs:
        one = sinks.gated(status.where(F.col("env") == env), lambda: _out(n.stream_list_all), lambda: sinks.read_output(spark, path))
        one = one.withColumn("env", F.lit(env))
        result = one if result is None else result.unionByName(one)
    return result


def q_ingest_available_now(spark, d):
    """Events arrive as files in a landing folder (two drops, the second repeating one event
    type); one available-now streaming run loads them into the target, each event id once."""
    ev = Tables(spark, d).events
    landing, target, ckpt = (work_path(spark, "landing"), work_path(spark, "events"), work_path(spark, "ingest-ckpt"))
    ev.write.mode("append").parquet(landing)
    ev.where(F.col("event_type") == "click").write.mode("append").parquet(landing)
    ingest_available_now(spark, landing, ev.schema, target, ckpt, ["event_id"], ["ts", "user_id", "event_type", "value", "props"],
                         F.floor(F.col("event_id") / 100_000))
    return spark.read.parquet(target).select("event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("ts_micros"), "user_id",
                                             "event_type", round6("value").alias("value"), "props")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "points_src": q_points_src,
    "points_json": q_points_json,
    "segments_src": q_segments_src,
    "group_list": q_group_list,
    "output_contract": q_output_contract,
    "key_check": q_key_check,
    "override_rules": q_override_rules,
    "input_report": q_input_report,
    "key_conflicts": q_key_conflicts,
    "segment_key": q_segment_key,
    "code_descendant": q_code_descendant,
    "insert_ignore": q_insert_ignore,
    "first_per_key": q_first_per_key,
    "upstream_pairs": q_upstream_pairs,
    "upstream_segments": q_upstream_segments,
    "downstream_points": q_downstream_points,
    "point_on_segment": q_point_on_segment,
    "side_channel_candidates": q_side_channel_candidates,
    "work_segments": q_work_segments,
    "break_segments": q_break_segments,
    "next_break": q_next_break,
    "point_id_list": q_point_id_list,
    "primary_type": q_primary_type,
    "run_collapse": q_run_collapse,
    "stream_list": q_stream_list,
    "start_of_route": q_start_of_route,
    "multi_point_codes": q_multi_point_codes,
    "side_channels": q_side_channels,
    "stream_list_all": q_stream_list_all,
    "nearest_segment": q_nearest_segment,
    "snap_measure": q_snap_measure,
    "snapped_table": q_snapped_table,
    "locate_along": q_locate_along,
    "locate_sql": q_locate_sql,
    "clip_lines": q_clip_lines,
    "clip_parts": q_clip_parts,
    "locate_parts": q_locate_parts,
    "stream_export": q_stream_export,
    "full_run": q_full_run,
    "attr_link": q_attr_link,
    "table_fingerprint": q_table_fingerprint,
    "file_fingerprints": q_file_fingerprints,
    "object_listing": q_object_listing,
    "change_status": q_change_status,
    "change_sync": q_change_sync,
    "change_route": q_change_route,
    "url_to_path": q_url_to_path,
    "snapshot_diff": q_snapshot_diff,
    "fingerprint_edits": q_fingerprint_edits,
    "sink_refresh": q_sink_refresh,
    "sink_by_group": q_sink_by_group,
    "group_output": q_group_output,
    "gated_run": q_gated_run,
    "incremental_run": q_incremental_run,
    "ingest_available_now": q_ingest_available_now,
}
