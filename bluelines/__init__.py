"""bluelines: linear-network analytics on Spark.

Snap points to the lines of a network, cut lines at the points, find what
lies upstream of each point from hierarchical codes and route measures, and
build for every piece of line the ordered list of points below it. All of it
is written with DataFrame / Spark SQL column expressions.

Layout:
  sources/    table readers and the fixture network derived from the test tables
  functions/  column-expression helpers (codes, rounding, lists, geometry, text)
  operators/  relational operators (upstream join, breaking, lists, snapping, ...)
  plans/      end-to-end jobs, sinks, the query catalogue
  streaming/  incremental ingestion with Structured Streaming
"""

__version__ = "0.1.0"
