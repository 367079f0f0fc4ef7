import random

from helpers import documents, words
from hypothesis import given, settings
from hypothesis import strategies as st

from bluelines.llm import decontaminate
from bluelines.llm.bitparallel import banded_distance, best_occurrence, positions


def distance_row(pattern, text, anywhere):
    row = list(range(len(pattern) + 1))
    ends = [row[-1]]
    for j, c in enumerate(text, 1):
        new = [0 if anywhere else j]
        for i, p in enumerate(pattern, 1):
            new.append(min(row[i - 1] + (p != c), row[i] + 1, new[-1] + 1))
        row = new
        ends.append(row[-1])
    return ends


@settings(max_examples=400, deadline=None)
@given(st.text("abc", min_size=1, max_size=80), st.text("abcd", max_size=120))
def test_bit_parallel_occurrence(pattern, text):
    ends = distance_row(pattern, text, True)
    best = best_occurrence(positions(pattern), len(pattern), text)
    assert best == (min(ends), ends.index(min(ends)))


@settings(max_examples=600, deadline=None)
@given(st.text("abc", max_size=24), st.text("abc", max_size=24), st.integers(0, 4))
def test_banded_distance(a, b, limit):
    true = distance_row(a, b, False)[-1]
    assert banded_distance(a, b, limit) == min(true, limit + 1)


def brute(rows, items):
    out = []
    for i, t in rows:
        for k, x in items:
            x, n = decontaminate.normal(x), decontaminate.normal(t)
            if x and n:
                ends = distance_row(x, n, True)
                if min(ends) <= int(decontaminate.ERROR_RATE * len(x)):
                    out.append((i, k, min(ends)))
    return sorted(out, key=repr)


def edit(text, n, r):
    chars = list(text)
    for _ in range(n):
        at = r.randrange(len(chars))
        r.choice([lambda: chars.insert(at, "q"), lambda: chars.pop(at), lambda: chars.__setitem__(at, "#")])()
    return "".join(chars)


def items_frame(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def test_matches_brute_force(spark):
    r = random.Random(1)
    items = [(k, words(8 + k % 20, 50 + k)) for k in range(12)] + [(20, None), (21, ""), (22, "short"), (None, "an item without an id at all"), (0, words(9, 99))]
    rows = [(i, words(40, i)) for i in range(20)]
    for i in range(40):
        item = items[i % 12][1]
        rows.append((100 + i, words(20, 300 + i) + " " + edit(item, i % 4, r) + " " + words(15, 400 + i)))
    rows += [(200, None), (201, ""), (202, items[3][1].upper().replace(" ", "\n\t ")), (203, "xshortx"), (None, items[1][1]),
             (204, items[2][1]), (204, items[2][1]), (205, items[4][1][:-6]), (206, "ab " * 5000 + items[5][1]), (207, "An item WITHOUT an id at all")]
    docs = documents(spark, rows, extra=("item_id", "h"))
    got = sorted(((r.doc_id, r.item_id, r.distance) for r in decontaminate.matches(docs, items_frame(spark, items)).collect()), key=repr)
    assert got == brute(rows, items)
    kept = decontaminate.keep_clean(docs, items_frame(spark, items))
    assert kept.columns == docs.columns and kept.count() == len(rows) - len({k for k, x in enumerate(rows) if brute([x], items)})


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 100)
    items = [(k, words(12, k)) for k in range(8)]
    rows = [(i, words(5, 70 + i) + " " + items[i % 8][1]) for i in range(24)] + [(99, words(30, 5000))]
    docs = documents(spark, rows)
    assert len(list(decontaminate.blocks(items_frame(spark, items)))) > 1
    got = sorted(((r.doc_id, r.item_id, r.distance) for r in decontaminate.matches(docs, items_frame(spark, items)).collect()), key=repr)
    assert got == brute(rows, items)
    assert [r.doc_id for r in decontaminate.keep_clean(docs, items_frame(spark, items)).collect()] == [99]


def test_one_block_at_a_time(spark, monkeypatch):
    """The hits of a block are written before the next block is read, for matches and for the filter."""
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 100)
    events, read, write = [], decontaminate.blocks, decontaminate.materialize

    def blocks(benchmark):
        for b in read(benchmark):
            events.append("read")
            yield b

    def stored(df, name, written=None):
        events.append(name)
        return write(df, name, written)

    monkeypatch.setattr(decontaminate, "blocks", blocks)
    monkeypatch.setattr(decontaminate, "materialize", stored)
    items = items_frame(spark, [(k, words(12, k)) for k in range(8)])
    docs = documents(spark, [(i, words(5, 70 + i)) for i in range(5)])
    for run in (decontaminate.matches, decontaminate.keep_clean):
        events.clear()
        run(docs, items)
        assert events[:6] == ["read", "item-hits"] * 3


def test_empty_tables(spark):
    none, docs = items_frame(spark, []), documents(spark, [(1, "text")])
    assert decontaminate.matches(docs, none).columns == ["doc_id", "item_id", "distance", "end_char"]
    assert decontaminate.matches(docs, none).count() == 0 and decontaminate.keep_clean(docs, none).count() == 1
    assert decontaminate.matches(documents(spark, []), items_frame(spark, [(1, "item")])).count() == 0


def test_query_finds_every_exact_passage(spark):
    import pyarrow.parquet as pq

    from bluelines.llm.queries import op8_pigeonhole_decontamination

    sf = "/root/testdata/sf0.01"
    docs, bench = (pq.read_table(f"{sf}/{t}.parquet").to_pydict() for t in ("documents", "benchmark"))
    items = [(k, decontaminate.normal(t)) for k, t in zip(bench["item_id"], bench["text"])]
    exact = {(i, k) for i, t in zip(docs["doc_id"], docs["text"]) for k, x in items if x in decontaminate.normal(t)}
    got = {(r.doc_id, r.item_id): r.distance for r in op8_pigeonhole_decontamination(spark, sf).collect()}
    assert exact and all(got.get(x) == 0 for x in exact) and {x for x, d in got.items() if d == 0} == exact
