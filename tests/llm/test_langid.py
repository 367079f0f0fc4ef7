from helpers import documents, words
from pyspark.sql import functions as F

from bluelines.llm import langid
from bluelines.llm.common import table
from bluelines.llm.queries import op10_compression_langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = op10_compression_langid(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    r = got.where("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double")).alias("a"),
                                  F.avg(F.col("rejected").cast("double")).alias("r"), F.min("score").alias("lo"), F.max("score").alias("hi")).first()
    assert r.a > 0.95 and r.r < 0.02 and 0 <= r.lo <= r.hi <= 1


def test_no_label_of_a_held_out_row_is_learned(spark):
    docs = table(spark, SF, "documents")
    spoiled = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit("zz")).otherwise(F.col("lang")))
    assert langid.train(docs) == langid.train(spoiled)


def test_edge_cases(spark):
    rows = [(i, words(30, i), "aa") for i in range(40)] + [(100 + i, words(30, i).replace("w", "ü") + " öäß", "bb") for i in range(40)]
    odd = [(200, None, "aa"), (201, "", None), (202, "123 ... 456", "aa"), (203, "ü " * 200000, None), (None, words(30, 3), "aa"), (204, words(30, 1), None)]
    docs = documents(spark, rows + odd + odd[-1:], extra=("j", "lang_pred", "margin"))
    got = [r.asDict() for r in langid.identify(docs).collect()]
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 87 and all((by[i]["lang_pred"], by[i]["score"], by[i]["rejected"]) == ("und", 0.0, True) for i in (200, 201, 202))
    assert by[203]["lang_pred"] in ("aa", "bb") and by[None]["held_out"]
    kept = langid.keep_known(docs)
    assert kept.columns == docs.columns and {200, 201, 202}.isdisjoint(r.doc_id for r in kept.collect())


def test_without_labels(spark):
    docs = documents(spark, [(1, "some words", None), (2, "more words", None)])
    assert {(r.lang_pred, r.score) for r in langid.identify(docs).collect()} == {("und", 0.0)}
    assert langid.identify(documents(spark, [])).count() == 0


def test_exact_tie_is_narrow():
    assert langid.classify("abc", (("a", b"zzzz" * 20), ("b", b"zzzz" * 20)))[1:] == (0.5, 0.0)


def test_short_texts_are_kept_and_told_apart(spark):
    docs = table(spark, SF, "documents").where("lang is not null")
    model = tuple(langid.train(docs))
    short = [(r.lang, " ".join(w[k:k + 4])) for r in docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0).collect()
             for w in [(r.text or "").split()] for k in range(0, min(len(w) - 3, 40), 4)]
    got = [(lang, langid._decide(t, model)) for lang, t in short if langid.letters(t)]
    assert len(got) > 500 and sum(g[3] for _, g in got) <= 0.002 * len(got)
    assert sum(lang == g[0] for lang, g in got) > 0.9 * len(got)


def test_number_signs_are_no_letters(spark):
    model = (("a", b"some words " * 20), ("b", b"einige andere " * 20))
    for text in ("½ ²", "① Ⅷ", "٣٤", "...", "²½_", "\u0301"):
        assert langid._decide(text, model) == ("und", 0.0, 0.0, True), text
    assert langid.letters("a½b x²") == b"a b x"
    rows = [(i, words(30, i), "aa") for i in range(40)] + [(100, "½ ² ①"), (101, "Ⅷ")]
    docs = documents(spark, rows)
    assert {r.lang_pred for r in langid.identify(docs).where("doc_id >= 100").collect()} == {"und"}
    assert langid.keep_known(docs).where("doc_id >= 100").count() == 0


def test_code_length_against_plain_counts():
    from math import log2

    d = b"some words and more words " * 7
    grams = langid._grams((("a", d),))[0]
    seen = lambda x: sum(d[k:k + len(x)] == x for k in range(len(d) - max(len(x), 1) + 1))
    for text in (b"words", b"x", b"more and", "ä".encode()):
        data, want = b" " + text + b" ", 0.0
        for k in range(1, len(data)):
            p = 1 / 256
            for n in range(min(k + 1, langid.GRAM)):
                p = (seen(data[k - n:k + 1]) + langid.PRIOR * p) / (seen(data[k - n:k]) + langid.PRIOR)
            want -= log2(p)
        assert abs(langid._bits(text, grams) - want) < 1e-9
