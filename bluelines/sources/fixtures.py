"""The fixture network, derived from the input tables.

The test tables hold no rivers, so a network is derived from them (the same rules are
written as plain SQL in ``plans/oracle.py`` for the independent check):

* an order is a flow line (``blue_line_key``), its line items are the segments of the line,
  in line-number order, each ``10 * quantity`` metres long;
* every customer is a stream: its hierarchical code is region, nation and one level per digit of
  the customer key, so the tree deepens with the data and a stream has as many ancestors as its
  key has digits; the orders of a customer run on its stream, ``watershed_key`` is the lowest;
* the local code of a segment is the code plus a label that grows with its start measure; every
  17th line has no local codes (side channels that cannot be placed exactly);
* every part is a notation point: it lies on the segment of one of its line items, the first in an order that
  shuffles the order keys, so the points are spread over the whole network; 5 to 95 % along the segment
  by the last digit of the part key, typed from the order priority.

Everything here is lazy DataFrame code; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bluelines.sources.tables import Tables

# Fixed values of the fixture: notation types by the first character of the order priority.
TYPE_BY_PRIORITY = {"1": "FR", "2": "FR-EXC", "3": "OR", "4": "PWS"}
OTHER_TYPE = "AR"


def network(t: Tables) -> DataFrame:
    """Segments of the fixture network (schema ``schemas.SEGMENTS`` plus ``priority``)."""
    li = (t.lineitem
          .select(F.col("l_orderkey").alias("ok"), F.col("l_linenumber").alias("ln"), "l_quantity")
          # one shuffle by line serves both the de-duplication of line numbers and the measure window
          .repartition("ok")
          .groupBy("ok", "ln").agg(F.min("l_quantity").alias("q")))
    # running length along the line; a line has at most a handful of segments
    run = Window.partitionBy("ok").orderBy("ln").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    m = (li.withColumn("um", F.sum(F.col("q") * 10).over(run))
           .withColumn("dm", F.col("um") - F.col("q") * 10))

    # the labels are joined as numbers and short texts; codes are spelled out once the segments are together
    nations = t.nation.select("n_nationkey", (F.col("n_regionkey") + 100).cast("string").alias("region_code"),
                              F.lpad((F.col("n_nationkey") * 100).cast("string"), 6, "0").alias("nation_label"))
    first = t.orders.groupBy(F.col("o_custkey").alias("_ck")).agg(F.min("o_orderkey").alias("watershed_key"))
    streams = (t.customer.select("c_custkey", "c_nationkey").join(nations.where(F.col("region_code").isNotNull()), F.col("c_nationkey") == F.col("n_nationkey"))
               .join(first, F.col("c_custkey") == F.col("_ck")).drop("_ck", "c_nationkey"))
    o = (t.orders.select(F.col("o_orderkey").alias("ok"), "o_custkey", F.col("o_orderpriority").alias("priority"))
         .join(streams, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey"))
    customer_labels = F.col("c_custkey").cast("string")
    for digit in "0123456789":  # a label of six equal digits per digit
        customer_labels = F.replace(customer_labels, F.lit(digit), F.lit("." + 6 * digit))
    code = F.concat("region_code", F.lit("."), "nation_label", customer_labels)

    dm_label = F.lpad((F.col("dm") * 200).cast("int").cast("string"), 6, "0")
    # the lines stay where their measures were laid out: the segments are shuffled once, as order, number and quantity
    return (m.join(o, "ok").withColumn("wscode", code)
            .select((F.col("ok") * 10 + F.col("ln")).alias("linear_feature_id"),
                    F.col("ok").alias("blue_line_key"),
                    "watershed_key",
                    F.col("dm").cast("double").alias("downstream_route_measure"),
                    F.col("um").cast("double").alias("upstream_route_measure"),
                    (F.col("um") - F.col("dm")).cast("double").alias("length_metre"),
                    "wscode",
                    F.when(F.col("ok") % 17 == 0, F.lit(None).cast("string"))
                     .when(F.col("dm") == 0, F.col("wscode"))
                     .otherwise(F.concat_ws(".", "wscode", dm_label)).alias("localcode"),
                    F.translate("wscode", ".", "-").alias("fwa_watershed_code"),
                    F.concat(F.lit("W"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0")).alias("watershed_group_code"),
                    "priority"))


def _notation_type(priority: F.Column) -> F.Column:
    first = F.substring(priority, 1, 1)
    expr = None
    for k, v in TYPE_BY_PRIORITY.items():
        expr = (F.when(first == k, v) if expr is None else expr.when(first == k, v))
    return expr.otherwise(OTHER_TYPE)


def _description(blk: F.Column) -> F.Column:
    # three forms of free text: a valid aquifer key, letters before the dash, a dash but no number
    n = (blk % 200).cast("string")
    return (F.when(blk % 3 == 0, F.concat(n, F.lit(" - PWS - 2011/09/29")))
             .when(blk % 3 == 1, F.concat(n, F.lit(" MILE CREEK - FR - 1986/06/23")))
             .otherwise(F.concat(n, F.lit(" -FR"))))


# Fixed values of the fixture: a prime and a factor that shuffle the order keys.
PRIME, FACTOR = 1_000_003, 7_919


def point_places(t: Tables) -> DataFrame:
    """One segment for every part, of its line items the first in shuffled order (partial minima per task)."""
    shuffled = (F.col("l_orderkey") % PRIME) * FACTOR % PRIME
    first = F.min(F.struct(shuffled.alias("h"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("linear_feature_id")))
    return t.lineitem.groupBy("l_partkey").agg(first.alias("f")).select("l_partkey", "f.linear_feature_id")


def points(t: Tables, seg: DataFrame) -> DataFrame:
    """Snapped notation points (schema ``schemas.NOTATIONS`` plus x, y, before snapping: no distance)."""
    blk = F.col("blue_line_key")
    along = F.lit(0.05) + F.lit(0.1) * (F.col("l_partkey") % 10)
    meas = F.col("downstream_route_measure") + along * F.col("length_metre")
    # met on the line, by which the network is stored; ids that do not name their line (line numbers over 9) on the id
    fid = F.col("linear_feature_id")
    named = (fid >= blk * 10) & (fid < blk * 10 + 10)
    place = point_places(t).select("l_partkey", fid.alias("_id"), F.floor(fid / 10).alias("_line"))
    on_line = seg.where(named).join(place, (blk == F.col("_line")) & (fid <= F.col("_id")) & (fid >= F.col("_id")))
    others = seg.where(~F.coalesce(named, F.lit(False))).join(place, fid == F.col("_id"))
    return (on_line.unionByName(others)
            .select(F.concat(F.lit("NO"), F.col("l_partkey").cast("string")).alias("notation_id"),
                    F.col("l_partkey").cast("int").alias("wls_wn_sysid"),
                    _notation_type(F.col("priority")).alias("notation_type"),
                    _description(blk).alias("notation_description"),
                    "linear_feature_id", "blue_line_key",
                    meas.alias("downstream_route_measure"),
                    "wscode", "localcode", "watershed_group_code",
                    meas.alias("x"),
                    ((blk % 7) * 10 + 2).cast("double").alias("y")))


def points_src(t: Tables, seg: DataFrame) -> DataFrame:
    """Points as they arrive, before snapping (``schemas.POINTS_SRC``)."""
    return points(t, seg).select("notation_id", "notation_type", "notation_description", "blue_line_key", "x", "y", "wls_wn_sysid",
                                 (F.lit(49.0) + F.col("y") / 1000).alias("latitude"), (F.lit(-125.0) + F.col("x") / 1000).alias("longitude"))


def _vertex(seq: int) -> F.Column:
    """Vertex ``seq`` (0, 1, 2) of a fixture segment: along x at the measure, a bump in y in the middle."""
    pos = F.col("downstream_route_measure") + F.lit(seq) * (F.col("length_metre") / 2)
    bump = (F.col("linear_feature_id") % 10) if seq == 1 else F.lit(0)
    y = ((F.col("blue_line_key") % 7) * 10 + bump).cast("double")
    return F.struct(pos.alias("x"), y.alias("y"), pos.alias("m"))


def vertices(seg: DataFrame) -> DataFrame:
    """Line geometry as rows: three vertices per segment with x, y and measure m."""
    v = seg.select("linear_feature_id", "blue_line_key",
                   F.posexplode(F.array(*[_vertex(i) for i in range(3)])).alias("seq", "v"))
    return v.select("linear_feature_id", "blue_line_key", "seq", "v.x", "v.y", "v.m")


def segment_geometry(seg: DataFrame) -> DataFrame:
    """The segments with the same geometry as an ``array<struct<x,y,m>>`` column ``geom`` on each
    row (no regrouping of vertex rows)."""
    return seg.withColumn("geom", F.array(*[_vertex(i) for i in range(3)]))


# Fixed values of the fixture: measure shares of the vertices of lines with gaps, by part, and which segments have them.
GAPS = {1: [[0.0, 0.2, 0.45], [0.55, 1.0]], 2: [[0.3, 0.5], [0.5, 0.7], [0.8, 0.9]]}


def gap_vertices(seg: DataFrame) -> DataFrame:
    """Line geometry as rows with a ``part``: segments with ids 1 and 2 modulo 3 come in parts with gaps between them
    (or at their ends), the others as ``vertices`` has them."""
    rest = F.col("linear_feature_id") % 3
    shares = F.lit(None).cast("array<array<double>>")
    for k, parts in GAPS.items():
        shares = F.when(rest == k, F.array(*[F.array(*[F.lit(x) for x in part]) for part in parts])).otherwise(shares)
    v = seg.where(rest != 0).select("linear_feature_id", "blue_line_key", "downstream_route_measure", "length_metre",
                                    F.posexplode(shares).alias("part", "_s"))
    v = v.select("*", F.posexplode("_s").alias("seq", "share"))
    m = F.col("downstream_route_measure") + F.col("share") * F.col("length_metre")
    y = ((F.col("blue_line_key") % 7) * 10 + F.col("part") + F.col("seq")).cast("double")
    v = v.select("linear_feature_id", "blue_line_key", "part", "seq", m.alias("x"), y.alias("y"), m.alias("m"))
    whole = vertices(seg.where(rest == 0)).withColumn("part", F.lit(0))
    return v.unionByName(whole)


def line_geometry(vert: DataFrame) -> DataFrame:
    """One row per segment with its vertices as an ordered ``array<struct<x,y,m>>`` (``geom``), or, where the
    vertices have a ``part``, as an array of such arrays (``parts``).

    Groups are single segments (a handful of vertices), so the collect is bounded.
    """
    keys = [c for c in ("linear_feature_id", "part") if c in vert.columns]
    one = (vert.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("seq", "x", "y", "m"))).alias("v"))
           .select(*keys, F.transform("v", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), p["m"].alias("m"))).alias("geom")))
    if "part" not in keys:
        return one
    # parts met by segment: vertices that lie together by segment stay where they are
    return (one.groupBy("linear_feature_id").agg(F.array_sort(F.collect_list(F.struct("part", "geom"))).alias("p"))
            .select("linear_feature_id", F.transform("p", lambda p: p["geom"]).alias("parts")))


def aquifers(t: Tables) -> DataFrame:
    """Polygon table of the text-key link: the part table stands in (``aquifer_id`` = part key).

    ``geom`` is one polygon (``array`` of rings of ``struct<x,y>``): a square of side ``p_size``
    at ``x = p_partkey``. It is carried through, never computed on, like the reference's polygons."""
    k, s = F.col("p_partkey").cast("double"), F.col("p_size").cast("double")
    corner = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    zero = F.lit(0.0)
    ring = F.array(corner(k, zero), corner(k + s, zero), corner(k + s, s), corner(k, s), corner(k, zero))
    return t.part.select(F.col("p_partkey").cast("int").alias("aquifer_id"), F.col("p_name").alias("aquifer_name"),
                         F.array(ring).alias("geom"))
