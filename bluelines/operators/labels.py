"""Ancestor tests by order instead of by prefix rows.

Codes are labels joined by dots, and a dot sorts before every digit, so in byte order a code is followed by all codes
below it; ``code + '/'`` (the byte after the dot) closes that stretch. What a point reaches through its code is one
stretch too: the codes strictly below the point's code, or, if the point sits higher on its stream, those of them that
follow everything below its local code. So over the ordered codes a point opens a stretch (+1) and closes it (-1), and
the running sum at a code is the number of points whose streams it enters above: no row per prefix of a code, and
no pair. Likewise the segments below a code are those between its opening and closing place.

Codes between two neighbouring openings or closings lie above the same points, so they share one list
(``shared_stretches``). The order is a range-partitioned sort of distinct codes and points (``numbering.running_sum``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bluelines.operators.numbering import running_sum
from bluelines.session import materialize

CLOSE = "/"  # sorts right after the dot that joins labels
_EVENT = ["key", "kind", "step", "code"]


def _events(df: DataFrame, key, kind: int, step, code=None) -> DataFrame:
    code = F.lit(None).cast("string") if code is None else code
    return df.select(key.alias("key"), F.lit(kind).alias("kind"), F.lit(step).cast("long").alias("step") if isinstance(step, int) else step.cast("long").alias("step"),
                     code.alias("code"))


def _opened(points: DataFrame) -> DataFrame:
    """``points`` that reach any code, with the keys at which their stretch begins and ends."""
    w, local = F.col("p_wscode"), F.col("p_localcode")
    # a point at the start of its stream opens after the code itself, another one after what lies below its local code
    begin = F.when(local == w, w).otherwise(F.greatest(F.concat(local, F.lit(CLOSE)), w))
    known = points.where(w.isNotNull() & local.isNotNull())
    return known.withColumns({"begin": begin, "end": F.concat(w, F.lit(CLOSE))}).where("begin < end")


def codes_entered(codes: DataFrame, points: DataFrame, written: list[str] | None = None) -> DataFrame:
    """(wscode, n_points) for the distinct ``codes`` (column wscode) that lie above points on a code over theirs (case 3
    of D-UP without its test for different flow lines). ``points``: p_wscode, p_localcode, one row per point."""
    stretches = _opened(points)
    events = (_events(codes.where("wscode is not null"), F.col("wscode"), 0, 0, F.col("wscode"))
              .unionByName(_events(stretches, F.col("begin"), 1, 1)).unionByName(_events(stretches, F.col("end"), 1, -1)))
    events = materialize(events, "code-events", written)
    summed = running_sum(events, [F.col("key").asc(), F.col("kind").asc()], "step", "n_points", "codes-entered", written)
    return summed.where("kind = 0 and n_points > 0").select(F.col("code").alias("wscode"), "n_points")


def rows_below(codes: DataFrame, roots: DataFrame, written: list[str] | None = None) -> DataFrame:
    """(wscode, n) per distinct code of ``roots``: how many rows of ``codes`` (wscode, n) counted by n lie at or below it."""
    roots = roots.where("wscode is not null").select("wscode").distinct()
    events = (_events(codes.where("wscode is not null"), F.col("wscode"), 1, F.col("n"))
              .unionByName(_events(roots, F.col("wscode"), 0, 0, F.col("wscode")))
              .unionByName(_events(roots, F.concat(F.col("wscode"), F.lit(CLOSE)), 2, 0, F.col("wscode"))))
    events = materialize(events, "code-events", written)
    summed = running_sum(events, [F.col("key").asc(), F.col("kind").asc()], "step", "upto", "rows-below", written)
    ends = summed.where("kind <> 1").groupBy(F.col("code").alias("wscode"))
    return ends.agg((F.max("upto") - F.min("upto")).cast("long").alias("n")).where("n > 0")


def shared_stretches(codes: DataFrame, points: DataFrame, written: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Codes that lie above the same points share one stretch: between two neighbouring openings or closings the set of
    points does not change. Returns (wscode, stretch) for the codes above any point, and one row per (stretch,
    point) with the columns of ``points``.

    ``points``: p_prank (distinct), p_wscode, p_localcode and what else is to be carried. Stretches without a code are
    not numbered, so there are at most as many as codes, and at most two per point."""
    opened = materialize(_opened(points), "opened-points", written)
    point = F.col("p_prank")
    events = (codes.where("wscode is not null").select(F.col("wscode").alias("key"), F.lit(0).alias("kind"), F.lit(0).cast("long").alias("step"),
                                                       F.col("wscode").alias("code"), F.lit(None).cast("long").alias("point"))
              .unionByName(opened.select(F.col("begin").alias("key"), F.lit(1).alias("kind"), F.lit(1).cast("long").alias("step"),
                                         F.lit(None).cast("string").alias("code"), point.alias("point")))
              .unionByName(opened.select(F.col("end").alias("key"), F.lit(2).alias("kind"), F.lit(1).cast("long").alias("step"),
                                         F.lit(None).cast("string").alias("code"), point.alias("point"))))
    events = materialize(events, "code-events", written)
    order = [F.col("key").asc(), F.col("kind").asc(), F.col("point").asc()]
    placed = materialize(running_sum(events, order, "step", "place", "code-places", written), "code-places", written)
    # the same once more over the places that hold codes: a point covers the held places from its opening up to its closing
    held = placed.where("kind = 0").select("place").distinct()
    marks = (held.select("place", F.lit(1).alias("kind"), F.lit(1).cast("long").alias("step"), F.lit(None).cast("long").alias("point"))
             .unionByName(placed.where("kind = 1").select("place", F.lit(0).alias("kind"), F.lit(0).cast("long").alias("step"), "point"))
             .unionByName(placed.where("kind = 2").select((F.col("place") - 1).alias("place"), F.lit(2).alias("kind"), F.lit(0).cast("long").alias("step"), "point")))
    marks = materialize(marks, "code-marks", written)
    order = [F.col("place").asc(), F.col("kind").asc(), F.col("point").asc()]
    numbered = materialize(running_sum(marks, order, "step", "stretch", "code-stretches", written), "code-stretches", written)
    covers = numbered.where("kind <> 1").groupBy("point").agg(F.min("stretch").alias("_before"), F.max("stretch").alias("_last"))
    covers = covers.where("_last > _before")
    pairs = opened.drop("begin", "end").join(covers, point == F.col("point")).drop("point")
    # few bytes that fan out: spread over all shuffle partitions, which an exchange of its own would coalesce by size
    pairs = pairs.repartition(int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")), "p_prank")
    pairs = pairs.select(*points.columns, F.explode(F.sequence(F.col("_before") + 1, F.col("_last"))).alias("stretch"))
    at = numbered.where("kind = 1").select(F.col("place").alias("_place"), "stretch")
    of_code = placed.where("kind = 0").join(at, F.col("place") == F.col("_place")).select(F.col("code").alias("wscode"), "stretch")
    return of_code, pairs
