"""Link points to a polygon table through a number written at the start of their free text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The text must start with digits, a space and a dash; the key is the text before
# the first ' - '.
KEY_PATTERN = r"^[0-9]+ -.*$"
KEY_SEPARATOR = " - "


def text_key(desc: F.Column) -> F.Column:
    """The integer key of a description, NULL when the text does not hold one.

    ``try_cast``: a text such as ``12 -X`` passes the pattern but is no number; it drops out
    instead of failing the job."""
    return F.when(desc.rlike(KEY_PATTERN),
                  F.split_part(desc, F.lit(KEY_SEPARATOR), F.lit(1)).try_cast("int"))


def link_by_text_key(points: DataFrame, polygons: DataFrame, key_col: str = "aquifer_id") -> DataFrame:
    """``(aquifer_id, notation_id, notation_description)`` plus the polygon table's other columns;
    a polygon ``geom`` is wrapped as a multipolygon (an array of polygons)."""
    keyed = points.select("notation_id", "notation_description",
                          text_key(F.col("notation_description")).alias(key_col)).where(F.col(key_col).isNotNull())
    out = polygons.join(keyed, key_col)
    return out.withColumn("geom", F.array(F.col("geom"))) if "geom" in polygons.columns else out
