"""Per-piece ordered lists of the points downstream.

Order of a list (most downstream point first in code terms): code desc, local code desc,
measure desc, type priority asc (unknown types last), notation id asc. PostgreSQL-style NULL
placement: NULLs first in descending keys.

The order is turned into one ``bigint`` rank on the (small) point table -- a global sort of the
points followed by ``monotonically_increasing_id``, which grows along the sort -- so a pair row
carries only ``(rank, id, type)`` and a list is ``array_sort`` of those structs. The point table
is materialised before use, so every reader sees the same ranks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bluelines.functions.lists import LIST_SEPARATOR, collapse_runs, cut_label, type_priority
from bluelines.session import materialize


def point_order() -> list:
    return [F.col("wscode").desc_nulls_first(), F.col("localcode").desc_nulls_first(),
            F.col("downstream_route_measure").desc_nulls_first(),
            type_priority(F.col("notation_type")).asc_nulls_last(), F.col("notation_id").asc_nulls_last()]


def rank_points(points: DataFrame) -> DataFrame:
    """Add ``prank``: a bigint that grows along the list order of the points."""
    return points.orderBy(*point_order()).withColumn("prank", F.monotonically_increasing_id())


ENTRY = ["prank", "notation_id", "notation_type"]


def point_entry_fields(prefix: str = "p_") -> list[F.Column]:
    return [F.col(prefix + c).alias(c) for c in ENTRY]


def point_entry(prefix: str = "p_") -> F.Column:
    return F.struct(*point_entry_fields(prefix))


def collect_ordered(distinct: bool = False) -> F.Column:
    """Aggregate of the pair rows of one piece into its ordered point list."""
    c = F.collect_set(point_entry()) if distinct else F.collect_list(point_entry())
    return F.array_sort(c).alias("pts")


def with_list_columns(df: DataFrame, pts: str = "pts") -> DataFrame:
    """Replace the ordered point list ``pts`` by the output columns (id list, primary type,
    secondary types). Intermediate arrays are separate projections, so each is computed once."""
    d = df.withColumns({
        "_ids": F.transform(F.col(pts), lambda p: p["notation_id"]),
        "_types": F.transform(F.col(pts), lambda p: p["notation_type"])}).drop(pts)
    d = d.withColumn("_rest", F.slice("_types", 2, F.greatest(F.size("_types") - 1, F.lit(0))))
    d = d.withColumn("_runs", collapse_runs(F.col("_rest")))
    d = d.withColumn("_sec", F.array_join("_runs", LIST_SEPARATOR))
    return d.withColumns({
        "notation_id_list": F.array_join("_ids", LIST_SEPARATOR),
        "primary_notation_type": F.get(F.col("_types"), 0),
        "secondary_notation_types": F.when(F.size("_runs") > 0, cut_label(F.col("_sec"))),
    }).drop("_ids", "_types", "_rest", "_runs", "_sec")


def _shared_parts(main: DataFrame, kpoints: DataFrame, attrs: list[str], tolerance: float,
                  written: list[str] | None, flag: str | None = None, merge: bool = True) -> tuple[DataFrame, DataFrame]:
    """Per piece its ``direct`` entries (points on its own line or code, unsorted), ``own`` (it lies above a point of its own
    line by code, too) and a reference ``stretch`` to the list that its code inherits; and those lists, one row each:
    ``inherited`` (sorted), ``inherited_lines`` (their flow lines), ``inh_ids``, ``inh_primary``, ``inh_secondary``."""
    from bluelines.operators import labels, upstream  # local import: upstream imports nothing from here

    points = kpoints.where(F.startswith("_pk", F.lit("w:"))).drop("_pk", "p_ld")
    codes = materialize(main.where(F.col("localcode").isNotNull()).select("wscode").distinct(), "codes", written)
    of_code, inherits = labels.shared_stretches(codes, points, written)
    entry = F.struct(*point_entry_fields(), F.col("p_blue_line_key").alias("pblk"))
    listed = inherits.groupBy("stretch").agg(F.array_sort(F.collect_list(entry)).alias("_inh"),
                                             F.min_by("p_notation_type", "p_prank").alias("_first"))
    listed = listed.select("stretch", "_first", F.transform("_inh", lambda e: F.struct(*[e[c].alias(c) for c in ENTRY])).alias("inherited"),
                           F.transform("_inh", lambda e: e["pblk"]).alias("inherited_lines"))
    listed = with_list_columns(listed.withColumn("_pts", F.col("inherited")), "_pts").withColumnsRenamed({
        "notation_id_list": "inh_ids", "secondary_notation_types": "inh_secondary"})
    listed = listed.withColumn("inh_primary", F.col("_first")).drop("_first", "primary_notation_type")
    listed = materialize(listed, "inherited-lists", written)
    # every piece kept (left joins). Few lines hold points: their pieces meet those by line; then all pieces meet the points of their
    # code and find their stretch in one table of codes, so that they are shuffled once, by code, and no pairs are
    keys = list(dict.fromkeys([*attrs, "blue_line_key", "wscode", "localcode"]))
    main = main.select(*dict.fromkeys([*keys, "downstream_route_measure", *([flag] if flag else [])]))
    w, lc, blk, pw, pl = F.col("wscode"), F.col("localcode"), F.col("blue_line_key"), F.col("p_wscode"), F.col("p_localcode")
    entry = F.struct(*[F.col("p_" + c).alias("p_" + c) for c in [*ENTRY, "blue_line_key", "downstream_route_measure", "wscode", "localcode"]])
    by_line = (kpoints.where(F.startswith("_pk", F.lit("b:"))).groupBy(F.col("p_blue_line_key").alias("_pblk"))
               .agg(F.collect_list(entry).alias("_line")))
    by_code = points.where(pw.isNotNull() & pl.isNotNull()).groupBy(pw.alias("_of")).agg(F.collect_list(entry).alias("_points"))
    of_code = of_code.withColumnRenamed("wscode", "_sc")
    code = codes.where("wscode is not null").withColumnRenamed("wscode", "_code")
    code = code.join(of_code, F.col("_code") == F.col("_sc"), "left").join(by_code, F.col("_code") == F.col("_of"), "left").drop("_sc", "_of")
    none = F.array().cast(T.ArrayType(T.StructType([T.StructField(c, points.schema["p_" + c].dataType) for c in ENTRY])))
    entries = lambda column, holds: F.coalesce(F.transform(F.filter(column, holds), lambda p: F.struct(*[p["p_" + c].alias(c) for c in ENTRY])), none)
    dm = F.col("downstream_route_measure")
    lies_above = lambda p: upstream.is_within(w, p["p_wscode"]) & upstream.enters_above(
        w, p["p_wscode"], p["p_localcode"], upstream.is_within(w, p["p_localcode"]))
    found = {"_up": entries("_line", lambda p: upstream.on_line_above(dm, p["p_downstream_route_measure"], tolerance)),
             "own": F.coalesce(F.exists("_line", lies_above), F.lit(False))}
    here = F.lit(True) if flag is None else F.col(flag)
    lined = main.where(here).join(by_line, blk == F.col("_pblk"), "left").select(*keys, *[c.alias(n) for n, c in found.items()])
    if flag:
        lined = lined.unionByName(main.where(~here).select(*keys, none.alias("_up"), F.lit(False).alias("own")))
    beside = entries("_points", lambda p: (blk != p["p_blue_line_key"]) & (lc >= p["p_localcode"]))
    joined = lined.join(code, (w == F.col("_code")), "left")
    parts = joined.select(*keys, F.concat("_up", beside).alias("direct"), "own", F.when(lc.isNotNull(), F.col("stretch")).alias("stretch"))
    if merge:  # rows that repeat all attributes count as one; the code is among them, so they are together
        parts = parts.groupBy(*keys).agg(F.flatten(F.collect_list("direct")).alias("direct"), F.max("own").alias("own"), F.max("stretch").alias("stretch"))
    return materialize(parts.select(*dict.fromkeys([*attrs, "blue_line_key"]), "direct", "own", "stretch"), "list-parts", written), listed


def _merged(j: DataFrame) -> F.Column:
    """The full ordered list of a piece from its parts."""
    blk = F.col("blue_line_key")
    # a point of an ancestor code on the piece's own flow line is not inherited (it is paired
    # directly); the element-wise filter runs only where such a point exists
    inh = (F.when(F.col("own"), F.filter("inherited", lambda e, i: F.get(F.col("inherited_lines"), i) != blk))
            .otherwise(F.col("inherited")))
    return (F.when(F.col("inherited").isNull(), F.array_sort("direct"))
             .when(F.size("direct") == 0, inh)
             .otherwise(F.array_sort(F.concat(F.col("direct"), inh))))


def shared_lists(main: DataFrame, kpoints: DataFrame, attrs: list[str], tolerance: float, written: list[str] | None = None) -> DataFrame:
    """Ordered point lists of line pieces; the part inherited from ancestor codes is built once for all codes
    that lie above the same points.

    The points downstream of a piece are (a) points on its own flow line below it, (b) points on
    its own code below its local code, and (c) points on every ancestor code that its stream enters
    above. (a) and (b) depend on the piece and are paired directly (few per piece); (c) depends only
    on the piece's code, whose list is referred to by number (``labels.shared_stretches``) and joined here. The parts are
    disjoint; ``array_sort`` on the point rank merges them. Returns ``attrs`` + ``pts`` for pieces with at least one
    point. ``attrs`` must start with ``linear_feature_id``.
    """
    parts, listed = _shared_parts(main, kpoints, attrs, tolerance, written)
    j = parts.join(listed.select("stretch", "inherited", "inherited_lines"), "stretch", "left")
    return j.select(*attrs, _merged(j).alias("pts")).where(F.size("pts") > 0)


def shared_list_columns(main: DataFrame, kpoints: DataFrame, attrs: list[str], tolerance: float, written: list[str] | None = None,
                        flag: str | None = None) -> DataFrame:
    """``attrs`` + the output columns (id list, primary type, secondary types) of every piece with
    at least one point downstream. A piece whose list is exactly the inherited one (the common case) carries a number only
    and takes the finished texts at the end; only the others meet the entries and merge them. ``main`` holds one row per piece
    (no two agree in ``attrs``). ``flag``: a column of ``main`` that tells whether a point lies on the line (without it, all are asked)."""
    parts, listed = _shared_parts(main, kpoints, attrs, tolerance, written, flag, merge=False)
    plain = F.col("stretch").isNotNull() & (F.size("direct") == 0) & ~F.col("own")
    texts = listed.select("stretch", F.col("inh_ids").alias("notation_id_list"), F.col("inh_primary").alias("primary_notation_type"),
                          F.col("inh_secondary").alias("secondary_notation_types"))
    out = ["notation_id_list", "primary_notation_type", "secondary_notation_types"]
    finished = parts.where(plain).select(*attrs, "stretch").join(texts, "stretch").select(*attrs, *out)
    rest = parts.where(~plain).join(listed.select("stretch", "inherited", "inherited_lines"), "stretch", "left")
    rest = rest.select(*attrs, _merged(rest).alias("pts")).where(F.size("pts") > 0)
    return finished.unionByName(with_list_columns(rest).select(*attrs, *out))
