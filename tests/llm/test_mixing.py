import re
from collections import defaultdict

import numpy as np
from helpers import documents, words
from hypothesis import given, settings
from hypothesis import strategies as st

from bluelines.llm import mixing
from bluelines.llm.common import table


def brute_targets(sizes):
    """Reshares the excess until no source is above three times its size."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: k % 3 + 1 for k, s in enumerate(order)}
    left, free, out = float(sum(sizes.values())), set(order), {}
    while free:
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] >= 3 * sizes[s]]
        if not above:
            return out | share
        for s in above:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
            free.discard(s)
    return out


def check(df, rows, slack=0.5):
    got = df.collect()
    count = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _, _ in rows]
    by = defaultdict(int)
    for n, r in zip(count, rows):
        by[r[3]] += n
    goal, source = brute_targets(by), {r[0]: r[3] for r in rows}
    taken, largest = defaultdict(int), defaultdict(int)
    for r in got:
        s = source[r.doc_id]
        assert r.source_size == by[s] and abs(r.target - goal[s]) < 1e-6 * (1 + goal[s])
        assert r.taken % max(r.size, 1) == 0 and 0 <= r.taken <= 3 * r.size
        taken[s] += r.taken
        largest[s] = max(largest[s], r.size)
    assert sorted(((r.doc_id, r.size) for r in got), key=repr) == sorted(((r[0], n) for n, r in zip(count, rows)), key=repr)
    for s in by:
        assert abs(taken[s] - goal[s]) <= slack * largest[s] + 1e-6 * goal[s] + 1e-6, s
    return got


ROWS = [(i, words(1 + i * 7 % 90, i), None, ("a", "b", "c", "Z", "é", None)[(i % 11) % 6 if i % 3 else 0]) for i in range(900)]


def test_targets_and_taken_words(spark):
    first = check(mixing.mix(documents(spark, ROWS, extra=("size", "key", "copies"))), ROWS)
    again = mixing.mix(documents(spark, ROWS[::-1]).repartition(7)).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


def test_reduction_tree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "GROUP_ROWS", 20)
    monkeypatch.setattr(mixing, "FAN", 3)
    check(mixing.mix(documents(spark, ROWS)), ROWS)


def test_edge_cases(spark):
    rows = [(1, None, None, "a"), (2, "", None, "a"), (3, "x " * 50000, None, "b"), (4, "y", None, None), (5, None, None, "empty"), (6, "one two", None, "a")]
    check(mixing.mix(documents(spark, rows)), rows)
    twice = documents(spark, [(7, "same words here", None, "a")] * 3 + [(None, "no id", None, "a"), (None, None, None, None), (8, "z " * 9, None, "b")])
    got = mixing.mix(twice).collect()
    assert len(got) == 6 and len({r.taken for r in got if r.doc_id == 7}) == 1
    assert mixing.mix(documents(spark, [])).count() == 0
    assert mixing.mix(documents(spark, [(1, None, None, "a")])).first().taken == 0


def test_mixed_rows_repeat(spark):
    docs = documents(spark, ROWS[:300], extra=("copies",))
    plan = {r.doc_id: r.copies for r in mixing.mix(docs).collect()}
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    seen = defaultdict(int)
    for r in out.collect():
        seen[r.doc_id] += 1
    assert dict(seen) == {k: v for k, v in plan.items() if v}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 50), st.floats(0.01, 0.99)), min_size=1, max_size=30), st.integers(0, 9))
def test_settling_keeps_the_words(items, seed):
    w, p = np.array([x for x, _ in items], float), np.array([x for _, x in items])
    mass = (w * p).sum()
    at = mixing.settle(w, p, np.random.default_rng(seed).random)
    assert abs((w * p).sum() - mass) < 1e-6 and ((p >= 0) & (p <= 1)).all()
    assert {k for k in range(len(p)) if 0 < p[k] < 1} <= {at}


def test_settling_is_unbiased():
    rng, total = np.random.default_rng(1), np.zeros(4)
    for _ in range(4000):
        p = np.array([0.3, 0.5, 0.2, 0.9])
        mixing.settle(np.array([5.0, 1.0, 3.0, 2.0]), p, rng.random)
        total += p
    assert np.abs(total / 4000 - [0.3, 0.5, 0.2, 0.9]).max() < 0.03


def test_query_over_the_table(spark):
    import pyarrow.parquet as pq

    from bluelines.llm.queries import op9_pivotal_mixing

    t = pq.read_table("/root/testdata/sf0.01/documents.parquet").to_pydict()
    check(op9_pivotal_mixing(spark, "/root/testdata/sf0.01"), list(zip(t["doc_id"], t["text"], t["lang"], t["source"])))
    assert table(spark, "/root/testdata/sf0.01", "documents").count() == len(t["doc_id"])
