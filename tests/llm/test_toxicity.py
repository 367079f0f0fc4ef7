import random

import numpy as np
from helpers import documents, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bluelines.llm import toxicity
from bluelines.llm.common import table
from bluelines.llm.queries import op6_toxic_segments

SF = "/root/testdata/sf0.1"


def brute_segments(scores):
    """By definition: take the highest-scoring segment (the shortest), go on left and right of it."""
    def best(a, b):
        top = max(((sum(scores[i:j]), -(j - i), -i) for i in range(a, b) for j in range(i + 1, b + 1)), default=(0, 0, 0))
        if top[0] <= 0:
            return []
        i, j = -top[2], -top[2] - top[1]
        return best(a, i) + [(i, j, top[0])] + best(j, b)
    return best(0, len(scores))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(-6, 6), max_size=14))
def test_segments_by_definition(scores):
    got = toxicity.segments(np.array(scores, float))
    assert [s for _, _, s in got] == [s for _, _, s in brute_segments(scores)]
    assert all(sum(scores[a:b]) == s for a, b, s in got)


def test_held_out_quality(spark):
    got = op6_toxic_segments(spark, SF).join(table(spark, SF, "labels").select("doc_id", "toxic"), "doc_id").where("held_out").toPandas()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    hit = got.predicted == got.toxic
    assert hit.mean() > 0.95 and hit[got.toxic == 1].mean() > 0.8 and hit[got.toxic == 0].mean() > 0.97
    ranks = got.score.rank()
    n1, n0 = (got.toxic == 1).sum(), (got.toxic == 0).sum()
    assert (ranks[got.toxic == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) > 0.95


def small(spark, extra=()):
    r = random.Random(1)
    rows, labels = [], []
    for i in range(400):
        text = words(60, i)
        text = " ".join("x" + w.replace("1", "a").replace("2", "b").replace("3", "c") for w in text.split())
        if i % 4 == 0:
            parts = text.split()
            for _ in range(4):
                parts.insert(r.randrange(20), r.choice(["vilea", "vileb", "nasty"]))
            text = " ".join(parts)
        rows.append((i, text))
        labels.append((i, 0, int(i % 4 == 0)))
    return rows, labels


def frames(spark, rows, labels):
    return documents(spark, rows, extra=("toxic", "score", "id")), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_labels_of_held_out_rows_are_not_learned(spark):
    rows, labels = small(spark)
    docs, known = frames(spark, rows, labels)
    turned = known.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, known) == toxicity.train(docs, turned)


def test_edge_cases(spark):
    rows, labels = small(spark)
    odd = [(900, None), (901, ""), (902, "123 !!"), (903, "vilea vileb nasty " * 20000), (None, "vilea " * 9), (904, "vilezzz vileyyy vilexxx"), (904, "vilezzz vileyyy vilexxx")]
    docs, known = frames(spark, rows + odd, labels + [(0, 0, 1), (3, 1, None), (5000, 0, 1)])
    got = toxicity.score(docs, known).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert all(by[i].predicted == 0 and by[i].passages == 0 for i in (900, 901, 902)) and by[903].predicted == 1
    assert by[904].predicted == 1  # words never seen, of a class that was
    assert np.mean([by[i].predicted == (i % 4 == 0) for i in range(400)]) > 0.97


def test_one_class_and_empty_tables(spark):
    docs, known = frames(spark, [(1, "a b c"), (2, "d e f")], [(1, 0, 0), (2, 0, 0)])
    assert {(r.score < 1e-9, r.predicted) for r in toxicity.score(docs, known).collect()} == {(True, 0)}
    docs, known = frames(spark, [], [])
    assert toxicity.score(docs, known).count() == 0


def test_passages_are_located(spark):
    rows, labels = small(spark)
    model = toxicity.train(*frames(spark, rows, labels))
    text = "xwa xwb xwc " * 30 + "vilea nasty vileb " + "xwa xwb xwc " * 30
    (a, b, p), = model.passages(text)
    assert (a, b) == (90, 93) and p < 0.05
