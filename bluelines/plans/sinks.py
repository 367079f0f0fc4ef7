"""Sinks: full refresh, per-group refresh, typed export, and the change-gated run.

Outputs are Parquet written by Spark's commit protocol (a task lost mid-write is retried; the
job commits atomically). Paths are shared storage (below ``spark.checkpoint.dir`` for scratch
outputs), never a machine-local folder.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bluelines.schemas import AQUIFER_OUTPUT_WIDTHS, STREAM_OUTPUT_WIDTHS
from bluelines.session import remove_paths


def write_refresh(df: DataFrame, path: str, compression: str = "zstd") -> None:
    """Replace the whole output (drop + create / truncate + insert)."""
    df.write.mode("overwrite").option("compression", compression).parquet(path)


def write_by_group(df: DataFrame, path: str, group_col: str = "watershed_group_code",
                   compression: str = "zstd") -> None:
    """Replace only the groups present in ``df``; other groups' files stay (dynamic overwrite).

    Rows are clustered by group before the write so each task writes few files; the ``rebalance``
    hint lets AQE split a group that holds a large share of the rows over several tasks instead of
    one (a plain ``repartition(group)`` would send a hot group to a single task)."""
    (df.hint("rebalance", group_col).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(group_col).option("compression", compression).parquet(path))


def refresh_groups(df: DataFrame, path: str, groups: list[str], group_col: str = "watershed_group_code",
                   compression: str = "zstd") -> None:
    """Replace the listed groups by their rows in ``df``: a listed group without rows is removed, others stay."""
    present = {r[0] for r in df.where(F.col(group_col).isin(groups)).select(group_col).distinct().collect()}
    write_by_group(df.where(F.col(group_col).isin(groups)), path, group_col, compression)
    remove_paths(df.sparkSession, [f"{path}/{group_col}={g}" for g in groups if g not in present])


def write_all_groups(df: DataFrame, path: str, group_col: str = "watershed_group_code", compression: str = "zstd") -> None:
    """Replace the whole output, laid out by group: groups that ``df`` does not hold are gone afterwards."""
    (df.hint("rebalance", group_col).write.mode("overwrite").option("partitionOverwriteMode", "static")
     .partitionBy(group_col).option("compression", compression).parquet(path))


def read_output(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_group(spark: SparkSession, path: str, group: str, group_col: str = "watershed_group_code") -> DataFrame:
    """One group of a per-group output: an equality filter on the partition column, which Spark
    turns into partition pruning (only that group's folder is read). The group is a bound
    parameter (``:grp``), never pasted into the SQL text."""
    return spark.sql(f"SELECT * FROM {{out}} WHERE {group_col} = :grp", args={"grp": group},
                     out=spark.read.parquet(path))


def typed(df: DataFrame, schema: T.StructType, extra: list[str] | None = None) -> DataFrame:
    """The columns of a declared output, in its order and cast to its types (plus ``extra`` columns)."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields], *(extra or []))


def template(spark: SparkSession, schema: T.StructType, path: str) -> None:
    """Write the empty table of a declared schema (the ``limit 0`` template)."""
    write_refresh(spark.createDataFrame([], schema), path)


def width_report(df: DataFrame, widths: dict[str, int], table: str) -> DataFrame:
    """Per text column of an output: its width limit, the longest value, and how many rows exceed
    the limit (values are never cut here; the report lists the breach). One aggregation."""
    aggs = []
    for c in widths:
        aggs += [F.max(F.length(c)).alias(f"{c}__max"),
                 F.count_if(F.length(c) > widths[c]).alias(f"{c}__over")]
    one = df.agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                 F.lit(widths[c]).alias("width_limit"),
                 F.coalesce(F.col(f"{c}__max"), F.lit(0)).cast("int").alias("max_length"),
                 F.col(f"{c}__over").cast("bigint").alias("n_over")) for c in widths]))
    return one.select(rows.alias("r")).select("r.*")


def output_contract(stream_out: DataFrame, aquifer_out: DataFrame) -> DataFrame:
    return width_report(stream_out, STREAM_OUTPUT_WIDTHS, "streams").unionByName(
        width_report(aquifer_out, AQUIFER_OUTPUT_WIDTHS, "aquifers"))


def gated(status: DataFrame, run: Callable[[], DataFrame], previous: Callable[[], DataFrame]) -> DataFrame:
    """Run the job only when an input changed; otherwise return the previous output.

    ``status`` has a boolean ``has_changed`` per object; the decision needs one aggregated boolean
    on the driver (a single row), not the data."""
    changed = status.agg(F.max(F.col("has_changed").cast("int")).alias("c")).first()["c"]
    return run() if changed else previous()
