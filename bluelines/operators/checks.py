"""Input reports: rows that the job would silently drop or mis-order, listed instead.

The reference drops points whose line key has no segment (inner join) and loses a list step
for a NULL type; these reports make both visible. The segment table is only probed for the line keys
the points use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bluelines.functions.lists import TYPE_PRIORITY


def point_problems(points_src: DataFrame, segments: DataFrame) -> DataFrame:
    """``(notation_id, problem)`` for every point with: no line key, no segment on its line,
    a NULL or unknown type, or an id used more than once."""
    pts = points_src.select("notation_id", "notation_type", "blue_line_key")
    lines_with_segments = (segments.select("blue_line_key")
                           .join(points_src.select("blue_line_key").distinct(), "blue_line_key",
                                 "left_semi").distinct())
    no_segment = (pts.where(F.col("blue_line_key").isNotNull())
                  .join(lines_with_segments, "blue_line_key", "left_anti")
                  .select("notation_id", F.lit("no segment on line").alias("problem")))
    no_key = pts.where(F.col("blue_line_key").isNull()).select(
        "notation_id", F.lit("no line key").alias("problem"))
    bad_type = pts.where(F.col("notation_type").isNull() | ~F.col("notation_type").isin(*TYPE_PRIORITY)).select(
        "notation_id", F.when(F.col("notation_type").isNull(), F.lit("null type"))
                        .otherwise(F.lit("unknown type")).alias("problem"))
    dup = (pts.groupBy("notation_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
           .select("notation_id", F.lit("duplicate id").alias("problem")))
    return no_segment.unionByName(no_key).unionByName(bad_type).unionByName(dup)
