"""The engine's column functions as Spark SQL functions (``CREATE TEMPORARY FUNCTION ... RETURN``).

For ad-hoc SQL over the engine's tables: ``SELECT ... WHERE is_upstream(...)``. A join whose
only condition is one of these functions plans a nested loop, so the engine's own operators use
the tagged equi join (``operators/upstream.py``); these are for filters, small inputs and checks.
The bodies restate ``functions.codes``, ``operators.upstream.d_up`` and ``functions.lists`` in SQL;
``tests/test_sql_functions.py`` keeps the two forms equal.

``register_locate_along`` makes the point of a route at a measure callable with two arguments, as a table function
for lateral joins: ``FROM points p, LATERAL locate_along(p.blue_line_key, p.measure) l``. Its body joins the
arguments, as a row, with vertex pairs on line and measure bucket. So Spark joins the distinct (line, measure) of
the calls with the pairs and the result with the calls, both by equi joins; arguments used in the
select list of a filter, a ``LIMIT`` or an aggregate would make it plan a product.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bluelines.functions.lists import SECONDARY_KEEP, SECONDARY_SUFFIX, SECONDARY_WIDTH
from bluelines.operators.upstream import TOLERANCE

FUNCTIONS = {
    "code_within": """(code STRING, root STRING) RETURNS BOOLEAN
        RETURN startswith(code || '.', root || '.')""",
    "is_upstream": f"""(a_blk BIGINT, a_meas DOUBLE, a_ws STRING, a_lc STRING,
                        b_blk BIGINT, b_dm DOUBLE, b_ws STRING, b_lc STRING) RETURNS BOOLEAN
        RETURN coalesce(
          (b_blk = a_blk AND b_dm + {TOLERANCE} >= a_meas)
          OR (b_blk <> a_blk AND a_lc IS NOT NULL AND b_lc IS NOT NULL AND (
                (b_ws = a_ws AND b_lc >= a_lc)
             OR (startswith(b_ws || '.', a_ws || '.') AND b_ws <> a_ws
                 AND (a_lc = a_ws OR (b_ws > a_lc AND NOT startswith(b_ws || '.', a_lc || '.')))))),
          false)""",
    "is_downstream": """(a_blk BIGINT, a_dm DOUBLE, a_ws STRING, a_lc STRING,
                         b_blk BIGINT, b_meas DOUBLE, b_ws STRING, b_lc STRING) RETURNS BOOLEAN
        RETURN is_upstream(b_blk, b_meas, b_ws, b_lc, a_blk, a_dm, a_ws, a_lc)""",
    "piece_key": """(blk BIGINT, dm DOUBLE) RETURNS STRING
        RETURN concat_ws('.', CAST(blk AS STRING), CAST(CAST(rint(dm * 1000) AS BIGINT) AS STRING))""",
    "cut_label": f"""(s STRING) RETURNS STRING
        RETURN CASE WHEN length(s) < {SECONDARY_WIDTH} THEN s
                    ELSE concat(substring(s, 1, {SECONDARY_KEEP}), '{SECONDARY_SUFFIX}') END""",
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create the functions as temporary SQL functions of the session; returns their names."""
    for name, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(FUNCTIONS)


BUCKET = 1000.0  # metres of route that share a join key
ROUTES = "route_pairs"

LOCATE_ALONG = f"""(blk BIGINT, m DOUBLE) RETURNS TABLE(x DOUBLE, y DOUBLE)
    RETURN SELECT r.ax + (a.at - r.low) / (r.high - r.low) * (r.bx - r.ax), r.ay + (a.at - r.low) / (r.high - r.low) * (r.by - r.ay)
           FROM (SELECT locate_along.blk AS line, locate_along.m AS at) a
           JOIN {ROUTES} r ON r.blue_line_key = a.line AND r.bucket = CAST(floor(a.at / {BUCKET}) AS BIGINT)
             AND (r.low < a.at OR (r.closed AND r.low = a.at)) AND a.at <= r.high"""


def route_pairs(lines: DataFrame) -> DataFrame:
    """Vertex pairs of routes by line and measure bucket: (blue_line_key, bucket, low, high, closed, ax, ay, bx, by). A
    pair holds its upper end; its lower end only if no pair of the line ends there (``closed``: start of the
    route, end of a gap), so that a measure has one pair on a network whose segments do not overlap.

    ``lines``: blue_line_key and ``geom`` or ``parts`` (see ``operators.snapping``)."""
    part = lines.select("blue_line_key", F.explode("parts").alias("g")) if "parts" in lines.columns else lines.select("blue_line_key", F.col("geom").alias("g"))
    at = part.where(F.size("g") > 1).select("blue_line_key", "g", F.explode(F.sequence(F.lit(0), F.size("g") - 2)).alias("i"))
    a, b = F.get("g", F.col("i")), F.get("g", F.col("i") + 1)
    pairs = at.select("blue_line_key", a["m"].alias("low"), b["m"].alias("high"), a["x"].alias("ax"), a["y"].alias("ay"),
                      b["x"].alias("bx"), b["y"].alias("by"))
    pairs = pairs.where("high > low")  # two vertices at one measure hold nothing between them
    ends = pairs.select(F.col("blue_line_key").alias("of"), F.col("high").alias("end")).distinct()
    pairs = pairs.join(ends, (F.col("blue_line_key") == F.col("of")) & (F.col("low") == F.col("end")), "left")
    span = F.sequence(F.floor(F.col("low") / BUCKET), F.floor(F.col("high") / BUCKET))
    return pairs.select("blue_line_key", F.explode(span).alias("bucket"), "low", "high", F.col("end").isNull().alias("closed"), "ax", "ay", "bx", "by")


def register_locate_along(spark: SparkSession, lines: DataFrame) -> str:
    """Create the table function ``locate_along(blk, m)`` over ``lines``; give stored lines, they are read by each call."""
    route_pairs(lines).createOrReplaceTempView(ROUTES)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION locate_along{LOCATE_ALONG}")
    return "locate_along"
