"""The pipeline against plain Python stages that use the operators' per-row parts only."""

import zlib
from collections import Counter

import numpy as np
from helpers import documents, words
from test_near_dedup import brute, edited

import corpus_pipeline
from bluelines.llm import decontaminate, langid, mixing
from bluelines.llm.common import table


def test_stages_against_brute_force(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    bench = [(r.item_id, r.text) for r in table(spark, sf, "benchmark").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = [r.asDict() for r in docs.collect()]
        stage(spark, docs, sf).write.parquet(f"{tmp_path}/{name}")
        out = spark.read.parquet(f"{tmp_path}/{name}")
        rows = [r.asDict() for r in out.collect()]
        ids = Counter(r["doc_id"] for r in rows)
        if name != "token_output":
            assert out.columns == docs.columns
        if name == "language_id":
            model = tuple(langid.train(docs))
            judged = {r["doc_id"]: langid.classify(r["text"], model) for r in before}
            assert ids == Counter(i for i, (lang, _, margin) in judged.items() if lang != "und" and margin >= langid.NARROW)
        elif name == "near_dedup":
            assert ids == Counter(r[0] for r in brute([(r["doc_id"], r["text"]) for r in before]) if r[3])
        elif name == "decontamination":
            matcher = decontaminate.Matcher([(k, decontaminate.normal(t)) for k, t in bench])
            assert ids == Counter(r["doc_id"] for r in before if not matcher.hits(r["text"])) and len(ids) < len(before)
        elif name == "mixing":
            plan = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
            assert ids == Counter({k: v for k, v in plan.items() if v})
        else:
            from tokenizers import Tokenizer

            tok, start, want = Tokenizer.from_file(corpus_pipeline.tokenizer_file()), 0, []
            for r in sorted(before, key=lambda r: r["doc_id"]):
                own = np.array(tok.encode(r["text"], add_special_tokens=False).ids + [2], "<u4")
                want.append((r["doc_id"], start, len(own), zlib.crc32(own.tobytes())))
                start += len(own)
            assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows) == want
        docs = out


def test_odd_rows_pass_through(spark, tmp_path):
    base = words(60, 1)
    rows = [(i, words(40, i), "en", "s") for i in range(30)] + [(100 + i, edited(base, 1, i), "en", None) for i in range(5)]
    rows += [(200, None, "en", "s"), (201, "", None, "s"), (None, words(30, 77), None, "t"), (202, words(20, 5), None, None), (202, words(20, 5), None, None)]
    docs = documents(spark, rows, extra=("gone id", "mix key", "copies"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs_out = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs_out.columns == docs.columns
        docs_out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert corpus_pipeline.token_ids(spark, docs, "").count() == docs.count() > 0


def test_empty_documents(spark):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() == 0
