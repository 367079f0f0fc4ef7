"""Small frames for the operator tests."""

from pyspark.sql import types as T


def documents(spark, rows, extra=()):
    """rows: (doc_id, text, lang, source) tuples, shorter ones are filled with nulls."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                           T.StructField("n_chars", T.LongType())]
                          + [T.StructField(c, T.StringType()) for c in extra])
    full = [(*r, *[None] * (4 - len(r)), None if len(r) < 2 or r[1] is None else len(r[1]), *["x"] * len(extra)) for r in rows]
    return spark.createDataFrame(full, schema)


def words(n, seed=0, size=500):
    import random
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(size)}" for _ in range(n))
