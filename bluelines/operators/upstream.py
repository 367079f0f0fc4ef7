"""Upstream / downstream relations between points and pieces of line, as one equi join.

**Definition D-UP** (its three cases are the three functions below; the SQL form is tested against them). Point *a* = (blk, meas, W, L),
line piece *b* = (blk', dm', W', L'). *b* is upstream of *a* when

1. ``blk' = blk`` and ``dm' + tolerance >= meas`` (same flow line, starts at or above the point);
2. ``blk' != blk``, ``W' = W`` and ``L' >= L`` (same code, at or above the point's position);
3. ``blk' != blk``, ``W'`` lies strictly below ``W``, and either ``L = W`` (the point sits in the
   lowest segment of its stream) or ``W' > L`` and ``W'`` is not ``L`` or below it (the
   tributary enters above the point).

A NULL local code on either side makes 2 and 3 false. "Downstream" is the same relation read
from the piece's side: the points downstream of *b* are the *a* with D-UP(a, b).

**Spark form.** A theta join on this condition plans a nested loop. Instead every line row is
tagged with its join keys -- ``b:<blk>`` and ``w:<prefix>`` for every prefix of its code (at most
one per level) -- and every point with ``b:<blk>`` and ``w:<W>``. One equi join on the tag finds
all candidates (case 1 through ``b:``, cases 2 and 3 through ``w:``), and a residual filter
decides. The two tag kinds are disjoint, so a pair is produced once per kind that holds. Where only the lines are asked
for, not the pairs, the ancestor codes need no rows at all (``reached_lines``, ``operators.labels``).
While the point side is small Spark broadcasts it by its size in bytes and the line side streams and
keeps its partitioning, so later aggregations by line need no extra shuffle; beyond that the tags are
shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bluelines.functions.codes import depth, is_within, level_range, prefix
from bluelines.functions.rounding import piece_key
from bluelines.operators.common import first_per_key
from bluelines.operators.labels import codes_entered
from bluelines.session import materialize

TOLERANCE = 1.0  # metres; pieces start at a rounded measure

# point columns are renamed with this prefix inside the join
P = "p_"
POINT_COLS = ["notation_id", "notation_type", "blue_line_key", "downstream_route_measure", "wscode", "localcode"]


def on_line_above(dm: Column, p_meas: Column, tolerance: float) -> Column:
    """Case 1 for rows of one flow line."""
    return dm + F.lit(tolerance) >= p_meas


def on_code_above(w: Column, lc: Column, p_w: Column, p_lc: Column) -> Column:
    """Case 2 for rows of different flow lines with local codes."""
    return (w == p_w) & (lc >= p_lc)


def enters_above(w: Column, p_w: Column, p_lc: Column, w_under_local: Column) -> Column:
    """Case 3 for a code that lies below the point's code; ``w_under_local``: it lies at or below the
    point's local code."""
    return (w != p_w) & p_lc.isNotNull() & ((p_lc == p_w) | ((w > p_lc) & ~w_under_local))


def d_up(blk: Column, dm: Column, w: Column, lc: Column,
         p_blk: Column, p_meas: Column, p_w: Column, p_lc: Column, tolerance: float = TOLERANCE) -> Column:
    """D-UP as a plain boolean over both rows (used for small inputs and as the truth table)."""
    by_code = lc.isNotNull() & p_lc.isNotNull() & (blk != p_blk) & (
        on_code_above(w, lc, p_w, p_lc)
        | (is_within(w, p_w) & enters_above(w, p_w, p_lc, is_within(w, p_lc))))
    return F.coalesce(((blk == p_blk) & on_line_above(dm, p_meas, tolerance)) | by_code, F.lit(False))


def point_keys(blk: Column, w: Column) -> Column:
    return F.array(F.concat(F.lit("b:"), blk.cast("string")), F.concat(F.lit("w:"), w))


def keyed_points(points: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Points renamed with ``p_`` and exploded to their two join tags; ``p_ld`` is the local code
    with a trailing '.', computed once here instead of once per candidate pair."""
    cols = [c for c in POINT_COLS + (extra or []) if c in points.columns]
    renamed = points.select(*[F.col(c).alias(P + c) for c in cols],
                            F.concat(F.col("localcode"), F.lit(".")).alias("p_ld"))
    return renamed.withColumn("_pk", F.explode(point_keys(F.col(P + "blue_line_key"), F.col(P + "wscode"))))


HELPERS = ["_k", "_kb", "_wd", "_pk", "p_ld"]


def keyed_lines(lines: DataFrame, which: str = "all") -> DataFrame:
    """Line rows exploded to their tags: ``_k`` the tag, ``_kb`` true for the line tag, ``_wd`` the
    code with a trailing '.' (per row, not per candidate pair).

    ``which``: ``all`` (line, every prefix of the code: for pairs) or ``direct`` (line and the code itself). With ``all``,
    level 0 is the line tag, level n the first n levels of the code; one row per level, no lambda functions."""
    blk, w = F.col("blue_line_key"), F.col("wscode")
    line_tag = F.concat(F.lit("b:"), blk.cast("string"))
    if which == "direct":
        tags = F.array(F.struct(line_tag.alias("_k"), F.lit(True).alias("_kb")), F.struct(F.concat(F.lit("w:"), w).alias("_k"), F.lit(False).alias("_kb")))
        return lines.select("*", F.concat(w, F.lit(".")).alias("_wd"), F.inline(tags))
    if which != "all":
        raise ValueError(which)
    levels = level_range(0, F.coalesce(depth(w), F.lit(0)))
    out = lines.select("*", F.concat(w, F.lit(".")).alias("_wd"), F.explode(levels).alias("_lv"))
    tag = F.when(F.col("_lv") == 0, line_tag).otherwise(F.concat(F.lit("w:"), prefix(w, F.col("_lv"))))
    return out.withColumn("_k", tag).withColumn("_kb", F.col("_lv") == 0).drop("_lv")


def _by_line() -> Column:
    return F.col("_kb")


def _by_code() -> Column:
    return ~F.col("_kb")


def upstream_residual(tolerance: float = TOLERANCE) -> Column:
    """D-UP restricted to the rows one tag kind brings together."""
    blk, dm, w, lc = F.col("blue_line_key"), F.col("downstream_route_measure"), F.col("wscode"), F.col("localcode")
    pb, pm, pw, pl = (F.col(P + "blue_line_key"), F.col(P + "downstream_route_measure"),
                      F.col(P + "wscode"), F.col(P + "localcode"))
    by_line = _by_line() & on_line_above(dm, pm, tolerance)
    codes = lc.isNotNull() & pl.isNotNull() & (blk != pb)
    by_code = _by_code() & codes & (on_code_above(w, lc, pw, pl) | ancestor_condition())
    return F.coalesce(by_line | by_code, F.lit(False))


def ancestor_condition() -> Column:
    """Case 3 of D-UP for a ``w:`` tag: the point's code is a proper prefix of the line's code and
    the line's stream enters above the point. Depends on the line's code only (not its flow line
    or measure), so it can be evaluated once per distinct code."""
    w, pw, pl = F.col("wscode"), F.col(P + "wscode"), F.col(P + "localcode")
    return enters_above(w, pw, pl, F.startswith(F.col("_wd"), F.col("p_ld")))  # is_within without allocation


def on_segment_residual() -> Column:
    """The point falls on the piece: same line, ``dm <= meas < um``."""
    pm = F.col(P + "downstream_route_measure")
    return _by_line() & (pm >= F.col("downstream_route_measure")) & (pm < F.col("upstream_route_measure"))


def side_candidate_residual() -> Column:
    """Side channel with the point's code and no local code (cannot be placed exactly)."""
    return (_by_code() & (F.col("wscode") == F.col(P + "wscode")) & F.col("localcode").isNull()
            & (F.col("blue_line_key") != F.col("watershed_key")))


def same_code_residual() -> Column:
    return _by_code() & (F.col("wscode") == F.col(P + "wscode"))


def line_point_pairs(lines: DataFrame, kpoints: DataFrame, residual: Column) -> DataFrame:
    """All (line row, point) pairs for which ``residual`` holds; ``kpoints`` from ``keyed_points``
    (already marked for broadcast by the caller)."""
    return keyed_lines(lines).join(kpoints, (F.col("_k") == F.col("_pk")) & residual).drop(*HELPERS)


def upstream_pairs(lines: DataFrame, kpoints: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """(line row, point) for every line row upstream of the point (D-UP)."""
    return line_point_pairs(lines, kpoints, upstream_residual(tolerance))


def _entered(ties: DataFrame, points: DataFrame, written: list[str] | None) -> DataFrame:
    """The (line, code) rows of ``ties`` that case 3 of D-UP gives: the code lies above a point of another flow line. The number
    of such points comes per distinct code (``labels.codes_entered``); those on the line itself are taken off."""
    codes = materialize(ties.where("has_local").select("wscode").distinct(), "codes", written)
    entered = codes_entered(codes, points, written).withColumnRenamed("wscode", "_code")
    blk, w, pw, pl = F.col("blue_line_key"), F.col("wscode"), F.col(P + "wscode"), F.col(P + "localcode")
    above = is_within(w, pw) & enters_above(w, pw, pl, is_within(w, pl))
    own = (ties.where("has_local").join(points, (blk == F.col(P + "blue_line_key")) & (w != pw) & above)
           .groupBy(blk.alias("_ob"), w.alias("_ow")).agg(F.count(F.lit(1)).alias("_n")))
    hit = ties.where("has_local").select(blk, w).join(entered, w == F.col("_code")).drop("_code")
    hit = hit.join(own, (blk == F.col("_ob")) & (w == F.col("_ow")), "left")
    return hit.where(F.col("n_points") > F.coalesce("_n", F.lit(0))).select(blk, w, F.lit(True).alias("entered"))


def _on_codes(ties: DataFrame, points: DataFrame) -> DataFrame:
    """The rows of ``ties`` whose code holds a point, with ``code_min``: the lowest local code of those on other flow lines
    (the lowest of the code, or, on the line that has it, the lowest of its other lines)."""
    pw, pb, pl = F.col(P + "wscode"), F.col(P + "blue_line_key"), F.col(P + "localcode")
    lowest = points.where(pw.isNotNull()).groupBy(pw.alias("_c"), pb.alias("_b")).agg(F.min(pl).alias("_l"))
    placed = lowest.where(F.col("_b").isNotNull() & F.col("_l").isNotNull())
    first = placed.groupBy("_c").agg(F.min(F.struct("_l", "_b")).alias("_f")).select(F.col("_c").alias("_c1"), F.col("_f._l").alias("_l1"), F.col("_f._b").alias("_b1"))
    second = (placed.join(first, (F.col("_c") == F.col("_c1")) & (F.col("_b") != F.col("_b1"))).groupBy(F.col("_c").alias("_c2"))
              .agg(F.min("_l").alias("_l2")))
    codes = (lowest.select("_c").distinct().join(first, F.col("_c") == F.col("_c1"), "left")
             .join(second, F.col("_c") == F.col("_c2"), "left"))
    blk = F.col("blue_line_key")
    other = F.when(blk != F.col("_b1"), F.col("_l1")).when(blk == F.col("_b1"), F.col("_l2"))
    return ties.join(codes, F.col("wscode") == F.col("_c")).select("blue_line_key", "wscode", other.alias("code_min"), F.lit(True).alias("on_code"))


def reached_lines(segments: DataFrame, kpoints: DataFrame, tolerance: float = TOLERANCE, others: bool = True,
                  written: list[str] | None = None) -> DataFrame:
    """Segments upstream of a point and, with ``others``, those that hold one and unplaceable side channels with a
    point's code, each once."""
    placed, nowhere = _reached(segments, kpoints, tolerance, others, written)
    return placed.unionByName(nowhere)


def _reached(segments: DataFrame, kpoints: DataFrame, tolerance: float, others: bool, written: list[str] | None,
             flag: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``reached_lines`` in two parts, the segments with and without a line; ``flag`` names a boolean to be added: a point
    lies on the line.

    No pairs: what the points ask of a segment depends on its line and code alone. On a line the lowest point decides (a
    segment that starts below it holds a point only if it holds this one), on a code the lowest local code of another line,
    above a code the order of codes. So the distinct (line, code) ties meet the points, and every segment meets the ties
    that a point concerns by its line: shuffled once, or where it is if the segments are stored by line."""
    blk, w, lc = F.col("blue_line_key"), F.col("wscode"), F.col("localcode")
    dm, um = F.col("downstream_route_measure"), F.col("upstream_route_measure")
    points = kpoints.where(F.startswith("_pk", F.lit("w:")))
    lines = (kpoints.where(F.col(P + "blue_line_key").isNotNull()).groupBy(F.col(P + "blue_line_key").alias("blue_line_key"))
             .agg(F.min(P + "downstream_route_measure").alias("line_min"), F.lit(True).alias("on_line")))
    ties = segments.groupBy("blue_line_key", "wscode").agg(F.max(lc.isNotNull()).alias("has_local"))
    ties = materialize(ties, "ties", written)
    empty = {"line_min": "double", "on_line": "boolean", "code_min": "string", "on_code": "boolean", "entered": "boolean"}

    def column(df):  # the ties that one kind of point concerns, with the columns of all kinds
        return df.select("blue_line_key", "wscode", *[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in empty.items()])

    asked = (column(ties.join(lines, "blue_line_key")).unionByName(column(_on_codes(ties, points)))
             .unionByName(column(_entered(ties, points, written))))
    # shuffled once, by line, for the group and for the segments
    asked = asked.select(blk.alias("_line"), w.alias("_w"), *empty).repartition("_line").groupBy("_line", "_w").agg(*[F.max(c).alias(c) for c in empty])
    # joined on the line alone (a line has few codes), so that rows of a line stay together for what follows
    same = F.coalesce(w == F.col("_w"), w.isNull() & F.col("_w").isNull())
    low = F.col("line_min")
    hit = F.coalesce(on_line_above(dm, low, tolerance), F.lit(False)) | F.coalesce(lc >= F.col("code_min"), F.lit(False)) | (
        lc.isNotNull() & F.coalesce("entered", F.lit(False)))
    if others:
        channel = lc.isNull() & F.coalesce("on_code", F.lit(False)) & (blk != F.col("watershed_key"))
        hit = hit | F.coalesce((low >= dm) & (low < um), F.lit(False)) | F.coalesce(channel, F.lit(False))
    added = [F.coalesce("on_line", F.lit(False)).alias(flag)] if flag else []
    placed = segments.where(blk.isNotNull()).join(asked.where("_line is not null"), (blk == F.col("_line")) & same)
    nowhere = segments.where(blk.isNull()).join(asked.where("_line is null"), w.eqNullSafe(F.col("_w")))
    return tuple(part.where(hit).select(*segments.columns, *added) for part in (placed, nowhere))


def upstream_lines(lines: DataFrame, kpoints: DataFrame, tolerance: float = TOLERANCE, written: list[str] | None = None) -> DataFrame:
    """Line rows with at least one point downstream (a semi join: ``select distinct`` over the
    pair join without building the pairs)."""
    placed, nowhere = _reached(lines, kpoints, tolerance, False, written)
    return placed.distinct().unionByName(nowhere.distinct())


def work_lines(segments: DataFrame, kpoints: DataFrame, tolerance: float = TOLERANCE, written: list[str] | None = None,
               flag: str | None = None) -> DataFrame:
    """Segments to work on (``reached_lines``). One row per piece key stays (segments of a line with the same start: the
    smallest id). The key names the line, so the rows of a line are reduced where they are."""
    key = piece_key(F.col("blue_line_key"), F.col("downstream_route_measure"))
    placed, nowhere = (first_per_key(part.withColumn("_key", key), ["blue_line_key", "_key"], ["linear_feature_id"])
                       for part in _reached(segments, kpoints, tolerance, True, written, flag))
    return placed.unionByName(nowhere).select(*segments.columns, *([flag] if flag else []))
