"""Declared schemas, keys and output contracts of the engine's tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Input points before snapping: id, type, free text, the line they belong to, planar coordinates, the
# source's number and geographic coordinates (carried, not computed on).
POINTS_SRC = T.StructType([
    T.StructField("notation_id", T.StringType(), False),
    T.StructField("notation_type", T.StringType(), False),
    T.StructField("notation_description", T.StringType(), True),
    T.StructField("blue_line_key", T.LongType(), True),
    T.StructField("x", T.DoubleType(), True),
    T.StructField("y", T.DoubleType(), True),
    T.StructField("wls_wn_sysid", T.IntegerType(), True),
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("longitude", T.DoubleType(), True),
])

POINT_2D = T.StructType([T.StructField("x", T.DoubleType(), True), T.StructField("y", T.DoubleType(), True)])

# Network segments (one row per segment; geometry is kept in a separate vertex table).
SEGMENTS = T.StructType([
    T.StructField("linear_feature_id", T.LongType(), False),
    T.StructField("blue_line_key", T.LongType(), False),
    T.StructField("watershed_key", T.LongType(), False),
    T.StructField("downstream_route_measure", T.DoubleType(), False),
    T.StructField("upstream_route_measure", T.DoubleType(), False),
    T.StructField("length_metre", T.DoubleType(), False),
    T.StructField("wscode", T.StringType(), False),
    T.StructField("localcode", T.StringType(), True),
    T.StructField("fwa_watershed_code", T.StringType(), False),
    T.StructField("watershed_group_code", T.StringType(), False),
])

# Points placed on the network: what breaking and lists read.
PLACED_POINTS = T.StructType([
    T.StructField("notation_id", T.StringType(), False),
    T.StructField("notation_type", T.StringType(), False),
    T.StructField("notation_description", T.StringType(), True),
    T.StructField("linear_feature_id", T.LongType(), False),
    T.StructField("blue_line_key", T.LongType(), False),
    T.StructField("downstream_route_measure", T.DoubleType(), False),
    T.StructField("wscode", T.StringType(), False),
    T.StructField("localcode", T.StringType(), True),
    T.StructField("watershed_group_code", T.StringType(), False),
])

# The snapped point table in full: placed points, the source's number, how far they were moved, where they are.
NOTATIONS = T.StructType([*PLACED_POINTS.fields,
                          T.StructField("wls_wn_sysid", T.IntegerType(), True),
                          T.StructField("distance_to_stream", T.DoubleType(), True),
                          T.StructField("geom", POINT_2D, True)])

# Keys that must be unique.
KEYS = {
    "segments": ["linear_feature_id"],
    "notations": ["notation_id"],
    "pieces": ["segmented_stream_id"],
}

# Fixed values of the published output layout: maximum text widths per column.
STREAM_OUTPUT_WIDTHS = {
    "notation_id_list": 200,
    "primary_notation_type": 12,
    "secondary_notation_types": 30,
    "fwa_watershed_code": 150,
}
AQUIFER_OUTPUT_WIDTHS = {
    "notation_id": 10,
    "notation_description": 140,
}

STREAM_OUTPUT = T.StructType([
    T.StructField("linear_feature_id", T.LongType(), False),
    T.StructField("notation_id_list", T.StringType(), True),
    T.StructField("primary_notation_type", T.StringType(), True),
    T.StructField("secondary_notation_types", T.StringType(), True),
    T.StructField("fwa_watershed_code", T.StringType(), True),
    T.StructField("blue_line_key", T.IntegerType(), True),
    T.StructField("geom", T.ArrayType(POINT_2D), True),
])

AQUIFER_OUTPUT = T.StructType([
    T.StructField("aquifer_id", T.IntegerType(), False),
    T.StructField("notation_id", T.StringType(), False),
    T.StructField("notation_description", T.StringType(), True),
    T.StructField("geom", T.ArrayType(T.ArrayType(T.ArrayType(POINT_2D))), True),
])

# Change-detection state: one fingerprint per object and target environment.
CHANGE_STATE = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("env", T.StringType(), False),
    T.StructField("etag", T.StringType(), False),
])
