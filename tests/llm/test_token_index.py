import zlib

import numpy as np
import pytest
from helpers import documents, words
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bluelines.llm import files, mphf, token_index
from bluelines.llm.queries import op5_token_index
from bluelines.session import work_path
from corpus_pipeline import tokenizer_file


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file())


def whole(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \t\n\r\x0b\x0c\x1c\x85\xa0 'sAé́Σß<|endoftext|>9."), st.characters(codec="utf-8")), max_size=60))
def test_words_give_the_ids_of_the_whole_text(tokenizer, text):
    assert token_index.encode(text, tokenizer_file()).tolist() == whole(tokenizer, text)


def expected(tokenizer, rows):
    out, start = [], 0
    for i, t in sorted(((r[0], r[1]) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array(whole(tokenizer, t) + [2], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return sorted(out, key=repr)


def build(spark, rows, extra=()):
    docs, folder = documents(spark, rows, extra), work_path(spark, "test-tokens")
    return docs, folder, token_index.write(docs, folder, tokenizer_file())


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_round_trip(spark, tokenizer):
    rows = [(i * 7 % 501, words(1 + i % 30, i)) for i in range(501)]
    rows += [(1000, None), (1001, ""), (1002, " \n"), (1003, "tail <|endoftext|> It's ÀÉ 12"), (1004, words(50000, 3)),
             (-5, "negative"), (None, "no id"), (7, "same id"), (7, "same id"), (7, None), (1006, "x" * 100000)]
    docs, folder, buckets = build(spark, rows, extra=("key", "shard"))
    assert got(token_index.read(spark, folder, docs.select("doc_id"), buckets)) == expected(tokenizer, rows)
    few = docs.where("doc_id in (5, 1004)").select("doc_id").unionByName(spark.createDataFrame([(99999,), (123456,)], "doc_id long"))
    assert {r[0] for r in got(token_index.read(spark, folder, few, buckets))} == {5, 1004}


def test_keyed_access_to_raw_payload(spark, tokenizer):
    rows = [(i, words(1 + i % 9, i)) for i in range(300)]
    _, folder, buckets = build(spark, rows)
    keys = spark.createDataFrame([(17,)], "doc_id long")
    e = token_index.lookup(keys, folder, buckets).first()
    shard = token_index.Shard(folder, e["shard"])
    n = int(shard.counts(e["ordinal"], 1)[0])
    assert shard.ids(e["offset"], n).tolist() == whole(tokenizer, rows[17][1]) + [2]


def test_get_by_key(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(token_index, "BUCKET_KEYS", 40)
    rows = [(i * 3 - 50, words(1 + i % 9, i)) for i in range(200)] + [(None, "none"), (4, "twice"), (4, "twice more")]
    _, folder, buckets = build(spark, rows)
    assert buckets > 3
    for i, t in rows[:60:7]:
        assert [x.tolist() for x in token_index.get(folder, i, buckets)] == [whole(tokenizer, u) + [2] for j, u in sorted(rows[:-3] + rows[-2:], key=lambda r: r[1]) if j == i]
    assert [x.tolist() for x in token_index.get(folder, None, buckets)] == [whole(tokenizer, "none") + [2]]
    assert token_index.get(folder, 10**9, buckets) == []


def test_one_id_on_most_rows_spans_shards(spark, tokenizer):
    rows = [(7, words(3 + i % 5, i // 2)) for i in range(400)] + [(None, "same text")] * 200 + [(i, words(4, i)) for i in range(8, 60)]
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs, folder, buckets = build(spark, rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    spans = spark.read.parquet(f"{folder}/spans").collect()
    assert sum(r.key == 7 for r in spans) > 1 and sum(r.key == token_index.NULL_KEY for r in spans) > 1
    per_shard = [r.n_docs for r in spark.read.parquet(f"{folder}/manifest").collect()]
    assert max(per_shard) < 0.5 * len(rows)
    plain = lambda found: sorted((i, n, c) for i, _, n, c in found if i is not None)  # noqa: E731  the order of equal ids is free
    read = got(token_index.read(spark, folder, docs.select("doc_id"), buckets))
    assert plain(read) == plain(expected(tokenizer, rows)) and sum(r[0] is None for r in read) == 200
    assert sorted(r[1] for r in read) == sorted(np.cumsum([0, *(r[2] for r in sorted(read, key=lambda r: r[1]))])[:-1].tolist())
    for key in (7, None, 8):
        assert sorted(x.tolist() for x in token_index.get(folder, key, buckets)) == sorted(whole(tokenizer, t) + [2] for i, t in rows if i == key)


def test_empty_table(spark):
    docs, folder, buckets = build(spark, [])
    assert got(token_index.read(spark, folder, docs.select("doc_id"), buckets)) == []


def test_perfect_hash_is_minimal():
    for n in (0, 1, 2, 1000, 20000):
        keys = np.random.default_rng(n).permutation(np.arange(n) * 3 - n)
        data = b"".join(mphf.dump(keys, np.zeros(n), np.arange(n), np.arange(n), np.ones(n)))
        tree, entries = mphf.load(data)
        assert sorted(tree.numbers(keys).tolist()) == list(range(n))
        assert (entries["offset"][mphf.find(tree, entries, keys)] == np.arange(n)).all()
        assert (mphf.find(tree, entries, keys + 10**9) == -1).all()
        assert n < 1000 or sum(map(len, tree.levels)) < 3.2 * n


def test_repeated_publish_replaces(tmp_path):
    uri = f"file://{tmp_path}/a/b.bin"
    files.publish(uri, [b"one"])
    files.publish(uri, [b"three"])
    assert files.open_input(uri).read() == b"three" and len(list((tmp_path / "a").iterdir())) == 1


def test_query_against_brute_force(spark, tokenizer):
    import pyarrow.parquet as pq

    t = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    assert got(op5_token_index(spark, "/root/testdata/sf0.001")) == expected(tokenizer, list(zip(t["doc_id"], t["text"])))
