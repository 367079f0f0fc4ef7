import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from helpers import documents, words
from hypothesis import given, settings
from hypothesis import strategies as st

from bluelines.llm import packing
from bluelines.llm.queries import op11_bestfit_packing
from corpus_pipeline import tokenizer_file


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file())


def brute_pieces(tokenizer, rows, capacity):
    out = []
    for key, text, *_ in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        out += [(key, k, s, len(ids[s:s + capacity]), zlib.crc32(ids[s:s + capacity].tobytes())) for k, s in enumerate(range(0, len(ids), capacity))]
    return sorted(out, key=repr)


def check(df, tokenizer, rows, capacity=4096):
    """Pieces against encoding every text alone; places without gap or overlap. Returns the number of sequences."""
    got = df.collect()
    assert df.columns[:7] == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute_pieces(tokenizer, rows, capacity)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in by.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity
    return len(by), -(-sum(r.length for r in got) // capacity)


ROWS = [(i, words(1 + i * 37 % 300, i)) for i in range(400)]


def test_pieces_and_places(spark, tokenizer):
    made, least = check(packing.pack(documents(spark, ROWS, extra=("piece", "node")).repartition(5), tokenizer_file(), capacity=512), tokenizer, ROWS, 512)
    assert made <= 1.02 * least + 1


def test_reduction_over_several_levels(spark, tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "FAN", 2)
    made, least = check(packing.pack(documents(spark, ROWS).repartition(9), tokenizer_file(), capacity=512, most=4), tokenizer, ROWS, 512)
    assert made <= 1.1 * least


def test_edge_cases(spark, tokenizer):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "no id"), (None, None), (7, "same"), (7, "same"), (7, None),
            (8, words(30000, 3)), (9, "x" * 50000), (10, "tail <|endoftext|> It's ÀÉ 12"), (-1, "z")]
    made, least = check(packing.pack(documents(spark, rows, extra=("offset", "key")), tokenizer_file()), tokenizer, rows)
    assert made <= least + 1
    empty = packing.pack(documents(spark, []), tokenizer_file())
    assert empty.count() == 0


def test_exactly_full_pieces(spark, tokenizer):
    rows = [(i, "w1 " * n) for i, n in enumerate((4095, 4096, 8191, 1, 4095 // 2))]
    n = [sum(p[3] for p in brute_pieces(tokenizer, [r], 4096)) for r in rows]
    made, least = check(packing.pack(documents(spark, rows), tokenizer_file(), capacity=n[0]), tokenizer, rows, n[0])
    assert made <= least + 1


def test_reruns_agree(spark):
    docs = documents(spark, ROWS).repartition(3)
    a, b = (sorted(map(tuple, packing.pack(docs, tokenizer_file(), capacity=512).collect())) for _ in range(2))
    assert a == b


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120), st.integers(1, 9))
def test_bins_against_a_search_of_all_bins(lengths, most):
    bins, free, closed = packing.Bins(50, most), {}, []
    for k, n in enumerate(lengths):
        bins.place(k, n)
        fit = [f for f in free.values() if f >= n]
        if fit:
            took = next(b for b, rows in [*bins.done, *bins.rest()] if rows[-1][0] == k)
            assert free[took] == min(fit)
        else:
            if len(free) >= most and n < 50:
                least = min(free.values())
                gone = {b for b, _ in bins.done} & set(free)
                assert len(gone) == 1 and free[min(gone)] == least
                del free[min(gone)]
            took = next(b for b, rows in [*bins.done, *bins.rest()] if rows[-1][0] == k)
            free[took] = 50
        free[took] -= n
        if not free[took]:
            del free[took]
        assert set(free) == {b for b, _ in bins.rest()} and len(free) <= most
        assert bins.bits == sum({1 << f for f in free.values()})
    placed = sorted(r for _, rows in [*bins.done, *bins.rest()] for r in rows)
    assert [k for k, _ in placed] == list(range(len(lengths)))


def test_query_on_the_whole_table(spark, tokenizer):
    t = pq.read_table("/root/testdata/sf0.001/documents.parquet").to_pydict()
    made, least = check(op11_bestfit_packing(spark, "/root/testdata/sf0.001"), tokenizer, list(zip(t["doc_id"], t["text"])))
    assert made <= 1.01 * least + 1
