import hashlib
import zlib

import pytest
from helpers import documents, words
from hypothesis import given, settings
from hypothesis import strategies as st

from bluelines.llm import merkle
from bluelines.session import work_path

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    doc_id, text, lang, source, n = row
    values = (doc_id, source, lang, None if n is None else n + more, text)
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(level, at):
    """Whole levels of the tree above ``level``; siblings of place ``at``: (digest or None, on the left)."""
    path = []
    while len(level) > 1:
        run = level[at // 2 * 2:at // 2 * 2 + 2]
        path.append((run[1 - at % 2] if len(run) == 2 else None, at % 2 == 1))
        level, at = [H(*level[k:k + 2]) for k in range(0, len(level), 2)], at // 2
    return level[0], path


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(r)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for g in langs:
        by[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    subroots = [climb([leaf(r) for r in by[g]], 0)[0] for g in langs]
    out = []
    for k, g in enumerate(langs):
        for at, r in enumerate(by[g]):
            subroot, low = climb([leaf(x) for x in by[g]], at)
            root, high = climb(subroots, k)
            hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            d = leaf(r, 1 if hit else 0)
            for s, left in low + high:
                d = H(d) if s is None else H(s, d) if left else H(d, s)
            out.append((r[0], leaf(r), subroot, root, H(*(s for s, _ in low + high if s)), d, d == root))
    return sorted(out, key=repr)


def run(spark, rows, levels=14, extra=()):
    frame = [(i, t, lang, source) for i, t, lang, source, _ in rows]
    docs, folder = documents(spark, frame, extra), work_path(spark, "test-merkle")
    found, groups = merkle.manifest(docs, folder, levels=levels)
    return merkle.proofs(found, folder, groups, levels), folder


def full(rows):
    return [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in rows]


@pytest.mark.parametrize("levels", [1, 2, 3, 14])
def test_against_whole_trees(spark, levels):
    rows = full([(i, words(3 + i % 7, i), ["de", "en", None, "fr", "é", ""][(i * i) % 13 % 6], f"s{i % 3}") for i in range(90)] + [(500, "alone", "zz", None)])
    df, _ = run(spark, rows, levels)
    assert df.columns[:7] == COLUMNS
    got = sorted((tuple(r)[:7] for r in df.collect()), key=repr)
    assert got == brute(rows) and 0 < sum(not r[6] for r in got) < 40


def test_edge_cases(spark):
    rows = full([(None, None, None, None), (None, "no id", "de", None), (7, "same", "de", "a"), (7, "same", "de", "a"), (7, "other", "de", "a"),
                 (14, "", "", ""), (-3, "x:1-", "de", "1:a"), (2**62, "ä€😀" * 40000, "de", "-"), (9, None, "de", "b")])
    df, _ = run(spark, rows, 2, extra=("group", "n", "nth", "leaf"))
    assert sorted((tuple(r)[:7] for r in df.collect()), key=repr) == brute(rows)
    assert run(spark, [])[0].count() == 0
    one = full([(3, "single", "en", "a")])
    got = run(spark, one)[0].first()
    assert tuple(got)[:7] == brute(one)[0] and got.root == got.leaf and got.proof_sha256 == H()


def test_one_proof_from_the_logs(spark):
    rows = full([(i, words(4, i), "de" if i % 5 else "en", "a") for i in range(70)])
    df, folder = run(spark, rows, 2)
    at = {r.doc_id: r for r in df.collect()}
    mine = sorted(r[0] for r in rows if r[2] == "de")
    for k in (0, 1, 17, len(mine) - 1):
        siblings, root = merkle.proof_of(spark, folder, "de", k, 2)
        r = at[mine[k]]
        assert root.hex() == r.root and H(*(d.hex() for d, _ in siblings if d is not None)) == r.proof_sha256
        assert merkle.fold(bytes.fromhex(r.leaf), siblings) == root
        assert merkle.fold(bytes.fromhex(at[mine[k - 1]].leaf), siblings) != root


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 200), st.integers(0, 3))
def test_places_in_the_order_of_completion(n, above):
    top = merkle.height(n) + above
    digests = [bytes([k % 256, k // 256]) * 16 for k in range(n)]
    log = merkle.postorder(digests, top)
    assert len(log) == merkle.subtree_size(n, top)
    level = digests
    for h in range(top + 1):
        assert [log[merkle.place(h, k, n)] for k in range(len(level))] == level
        level = [merkle.parent(*level[k:k + 2]) for k in range(0, len(level), 2)]
    assert [merkle.place(0, k, n) for k in range(n)] == [2 * k - k.bit_count() for k in range(n)]


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 3000), st.integers(1, 6), st.data())
def test_tiers_cover_the_height(n, levels, data):
    nth = data.draw(st.integers(0, n - 1))
    tiers = merkle.builders(nth, n, levels)
    assert sum(top for *_, top in tiers) == merkle.height(n) and all(w < m <= 1 << levels for _, _, w, m, _ in tiers)
