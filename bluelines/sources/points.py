"""Raw points from JSON lines: rows that fit the declared table, and the others with the reason they do not."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bluelines.schemas import KEYS, POINTS_SRC
from bluelines.session import materialize

RECORD = "_record"  # the text of a line that does not parse by the schema
MALFORMED, REPEATED = "malformed", "repeated key"


def read_points_json(spark: SparkSession, path: str, schema: T.StructType = POINTS_SRC, key: list[str] = KEYS["notations"],
                     written: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(good, bad) rows of JSON lines. ``good``: the declared columns. ``bad``: reason, the declared columns as far as they
    could be read, and ``record`` (the line if it is malformed, else the row as JSON).

    Reasons, first match: ``malformed`` (no JSON, or a value of another type), ``null <column>`` (a column that must not be
    null), ``repeated key`` (of the rows with one key the first by their values stays). Rows are parsed once and stored;
    the first row of a key is a partial aggregation on row numbers, so a key with very many rows makes no large task."""
    names = [f.name for f in schema.fields]
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields] + [T.StructField(RECORD, T.StringType(), True)])
    rows = spark.read.schema(nullable).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RECORD).json(path)
    reason = F.when(F.col(RECORD).isNotNull(), MALFORMED)
    for f in schema.fields:
        if not f.nullable:
            reason = reason.when(F.col(f.name).isNull(), f"null {f.name}")
    rows = rows.withColumn("_reason", reason).withColumn("_row", F.monotonically_increasing_id())
    rows = materialize(rows, "json-points", written)
    fit = rows.where("_reason is null")
    values = [F.col(c) for c in names if c not in key]
    first = fit.groupBy(*key).agg(F.min_by("_row", F.struct(*values, "_row")).alias("_row")).select("_row")
    good = fit.join(first, "_row", "left_semi").select(names)
    text = F.coalesce(RECORD, F.to_json(F.struct(*names), {"ignoreNullFields": "false"})).alias("record")
    again = fit.join(first, "_row", "left_anti").withColumn("_reason", F.lit(REPEATED))
    bad = rows.where("_reason is not null").unionByName(again).select(F.col("_reason").alias("reason"), *names, text)
    return good, bad
