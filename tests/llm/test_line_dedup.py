import random

import numpy as np
import pyarrow as pa
from helpers import documents, words
from test_decontaminate import distance_row, edit

from bluelines.llm import line_dedup


def brute(rows):
    lines = [(i, n, x.strip(" \t\r\x0b\x0c")) for i, t in rows if t is not None for n, x in enumerate(t.split("\n"))]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    texts = sorted({x for _, _, x in lines if x})
    first = {x: min((l for l in lines if l[2] == x), key=key)[:2] for x in texts}
    link = {x: [y for y in texts if y != x and min(len(x), len(y)) >= line_dedup.SHORT and abs(len(x) - len(y)) <= line_dedup.EDITS
                and distance_row(x, y, False)[-1] <= line_dedup.EDITS] for x in texts}
    name = {}
    for x in texts:
        seen, todo = {x}, [x]
        while todo:
            todo += [y for y in link[todo.pop()] if y not in seen and not seen.add(y)]
        name[x] = min((first[y] for y in seen), key=lambda f: key((*f, "")))
    return sorted(((i, n, *(name[x] if x else (None, None)), len(link[x]) if x else None, not x or (i, n) == name[x]) for i, n, x in lines), key=repr)


def check(spark, rows):
    df = line_dedup.line_classes(documents(spark, rows, extra=("id", "line_no", "key")))
    assert df.columns == ["doc_id", "line_no", "class_doc_id", "class_line_no", "links", "kept"]
    assert sorted(map(tuple, df.collect()), key=repr) == brute(rows)


def case(seed, n=60):
    r = random.Random(seed)
    bases = ["".join(r.choice("abé ") for _ in range(r.randrange(18, 34))) for _ in range(6)]
    return [(i, "\n".join(edit(r.choice(bases), r.randrange(4), r) for _ in range(r.randrange(1, 4)))) for i in range(n)]


def test_matches_brute_force(spark):
    for seed in range(3):
        check(spark, case(seed))


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 5)
    check(spark, case(9, 50))


def test_edge_cases(spark):
    common = words(12, 3)
    rows = [(1, None), (2, ""), (3, "\n\n \t\n"), (4, common + "\r\n" + common), (5, "  " + common), (6, common[:-1]), (None, common + "x"), (None, "only here in a row without an id"),
            (7, "short line\nshort lime\nshort line"), (8, "a" * 40 + "\n" + "a" * 41 + "\n" + "a" * 43), (8, "a" * 44), (8, "a" * 44), (9, words(9000, 1)), (10, words(9000, 1) + "!"), (11, "ü" * 19 + "\n" + "ü" * 20 + "\n" + "ü" * 21)]
    df = line_dedup.line_classes(documents(spark, rows))
    got, want = sorted(map(tuple, df.collect()), key=repr), brute([r for r in rows if r[0] not in (9, 10)])
    assert [g for g in got if g[0] not in (9, 10)] == want
    assert [g[2:] for g in got if g[0] in (9, 10)] == [(9, 0, 1, False), (9, 0, 1, True)]
    assert line_dedup.line_classes(documents(spark, [])).count() == 0


def test_any_two_close_lines_share_a_key():
    r = random.Random(5)
    for _ in range(400):
        x = "".join(r.choice("ab") for _ in range(r.randrange(20, 40)))
        y = edit(x, r.randrange(1, line_dedup.EDITS + 1), r)
        if min(len(x), len(y)) < line_dedup.SHORT:
            continue
        lines = line_dedup.Lines([x, y])
        sets, own = [set(), set()], [set(), set()]
        for line, key, mine in lines.keys():
            for k, v in zip(line.tolist(), key.tolist()):
                sets[k].add(v)
                if mine:
                    own[k].add(v)
        assert (own[0] & sets[1]) | (own[1] & sets[0])


def test_hashes_are_of_content_alone():
    a, b = line_dedup.Lines(["xx\nabcdef ghi"]), line_dedup.Lines(["longer line before\nq\nabcdef ghi", None, ""])
    assert a.ids()[1] == b.ids()[2] and len(set(b.ids().tolist())) == 4
    assert np.array_equal(a.hash(a.start[1:] + 3, np.array([3])), b.hash(b.start[2:3] + 3, np.array([3])))


def close(x, y):
    limit = max(line_dedup.EDITS, max(len(x), len(y)) // line_dedup.RATE)
    return min(len(x), len(y)) >= line_dedup.SHORT and abs(len(x) - len(y)) <= limit and distance_row(x, y, False)[-1] <= limit


def long_lines(seed):
    """Lines of 100 to 420 characters, with and without spaces, some with one word changed or a few edits."""
    r, out = random.Random(seed), []
    for k in range(12):
        n = r.randrange(100, 420)
        base = (words(n, 31 * seed + k) if k % 3 else "".join(r.choice("abcdé") for _ in range(n)))[:n].strip()
        out.append(base)
        for _ in range(4):
            parts = base.split(" ")
            parts[r.randrange(len(parts))] = r.choice(["word", "x", "other"]) if len(parts) > 1 else base
            out += [" ".join(parts), edit(base, r.randrange(1, n // 30 + 2), r)]
    return [x.strip() for x in out]


def test_edits_grow_with_the_line(spark):
    texts = long_lines(1)
    want = {t: sum(t != u and close(t, u) for u in set(texts)) for t in texts}
    assert sum(1 for t in set(texts) for u in set(texts) if t < u and close(t, u) and distance_row(t, u, False)[-1] > line_dedup.EDITS) > 20
    got = line_dedup.line_classes(documents(spark, list(enumerate(texts)))).collect()
    assert [r.links for r in sorted(got)] == [want[t] for t in texts]


def test_close_long_lines_share_a_key():
    for seed in range(3, 8):
        texts = sorted(set(long_lines(seed)))
        lines, keys, own = line_dedup.Lines(texts), [set() for _ in texts], [set() for _ in texts]
        for line, key, mine in lines.keys():
            for k, v in zip(line.tolist(), key.tolist()):
                keys[k].add(v)
                if mine:
                    own[k].add(v)
        for a, x in enumerate(texts):
            for b in range(a):
                assert not close(x, texts[b]) or own[a] & keys[b] or own[b] & keys[a]


def cells(texts, key=1):
    """Rows of one pair of blocks of lines with one open key."""
    lines = line_dedup.Lines(texts)
    n = len(texts)
    return pa.table({"key": pa.array([key] * n, pa.int64()), "i": pa.array([0] * n, pa.int32()), "j": pa.array([0] * n, pa.int32()),
                     "side": pa.array([0] * n, pa.int32()), "id": lines.ids(), "check": lines.hash(lines.start, lines.length, 1).view(np.int64),
                     "size": lines.length, "bins": pa.array([b.tobytes() for b in line_dedup._pair_counts(texts)], pa.binary()), "line": texts,
                     "keys": [[key]] * n})


def test_texts_follow_only_where_a_partner_is_possible():
    for seed in range(4):
        texts = sorted(set(long_lines(seed)))
        stays = set(line_dedup._candidates(cells(texts)).column(4).to_pylist())
        ids = line_dedup.Lines(texts).ids().tolist()
        assert {i for i, x in zip(ids, texts) if any(x != y and close(x, y) for y in texts)} <= stays
    assert line_dedup._candidates(cells([words(60, k) for k in range(50)])).num_rows == 0


def test_pairs_of_blocks_go_on_in_the_next_batch():
    texts = long_lines(2)
    rows = pa.concat_tables([cells(texts[:20], 1), cells(texts[20:41], 2), cells(texts[41:], 3)])
    want = sorted(map(str, line_dedup._verify(rows).to_pylist()))
    for size in (1, 7, 20, 1000):
        got = [r for b in line_dedup._per_cell(line_dedup._verify)(iter(rows.to_batches(max_chunksize=size))) for r in b.to_pylist()]
        assert sorted(map(str, got)) == want and len(want) > 20


def test_few_edits_in_long_lines_are_found_by_steps_not_length():
    """Time follows the limit: two edits far apart in a line of two million characters."""
    import time

    from bluelines.llm.bitparallel import banded_distance

    a = "abcdefghij" * 200_000
    b = a[:10] + "X" + a[11:-10] + "YZ" + a[-10:]
    begin = time.perf_counter()
    assert [banded_distance(a, b, k) for k in (0, 2, 3, 5)] == [1, 3, 3, 3]
    assert banded_distance(b, a, 2) == 3 and time.perf_counter() - begin < 2


def test_pairs_of_texts_at_once_as_one_by_one():
    from bluelines.llm.bitparallel import Texts, banded_distance

    for seed, letters in enumerate(("ab", "abcé ", "abcdefgh €", "ab\U0001f600c")):
        r, texts = random.Random(seed), ["", "a"]
        for _ in range(40):
            base = "".join(r.choice(letters) for _ in range(r.randrange(15, 200)))
            texts += [base, *(edit(base, r.randrange(12), r) for _ in range(3))]
        pairs = [(a, max(0, min(len(texts) - 1, a + r.randrange(-3, 4))), r.randrange(16)) for a in range(len(texts)) for _ in range(12)]
        got = Texts(texts).within(*(np.array(c) for c in zip(*pairs)))
        assert got.tolist() == [banded_distance(texts[a], texts[b], k) <= k for a, b, k in pairs] and 100 < got.sum() < len(pairs) - 100


def test_few_keys_per_long_line():
    """About as many as a partner can have edits, not all windows at some words."""
    for seed in range(3):
        texts = [words(80, 50 * seed + k) for k in range(20)]
        lines = line_dedup.Lines(texts)
        found = np.concatenate([line for line, *_ in lines.keys()])
        most = lines.length // (line_dedup.RATE - 1)
        assert (np.bincount(found) > most).all() and len(found) < 2 * (most + 1).sum()


def open_lines(texts, block, size=10_000):
    """Cells of all keys of some texts, dealt to one part."""
    rows = pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts}).to_batches(max_chunksize=size)
    dealt = [b for b in line_dedup._occurrences(1)(iter(rows)) if b.column("part").null_count == 0]
    assert sum(b.num_rows for b in dealt) == 1
    return [r for b in line_dedup._open(block)(iter(b.select(["part", "keys"]) for b in dealt)) for r in b.to_pylist()]


def test_open_keys_bring_all_close_lines_together():
    texts = sorted(set(long_lines(3)))
    ids = line_dedup.Lines(texts).ids().tolist()
    want = {frozenset((ids[a], ids[b])) for a, x in enumerate(texts) for b, y in enumerate(texts) if a < b and close(x, y)}
    for block, size in ((1000, 10_000), (1000, 7), (2, 10_000)):
        cells, met = {}, set()
        for r in open_lines(texts, block, size):
            cells.setdefault((r["key"], r["i"], r["j"]), [[], []])[r["side"]] += r["ids"]
            assert len(r["ids"]) <= 2 * block
        for (_, i, j), (left, right) in cells.items():
            met |= {frozenset((a, b)) for a in left for b in (left if i == j else right) if a != b}
        assert len(want) > 20 and want <= met


def test_equal_passages_at_other_places_do_not_meet():
    passage = " the same passage of words in all of these lines"
    texts = [words(30, k) + passage + " " + words(2 + 9 * k, 90 + k) for k in range(8)]
    assert open_lines(texts, 1000) == []
    assert len(open_lines([*texts, texts[3][:-2]], 1000)) > 0


def test_keys_in_doubt_are_compared_whole():
    """Lines that share a key only beyond the first ones, and lines that share none before."""
    texts = sorted(set(long_lines(4)))
    rows = cells(texts, 500)
    alone = rows.set_column(9, "keys", pa.array([[*range(9 * k, 9 * k + 8), 10_000] for k in range(len(texts))], pa.list_(pa.int64())))
    alone = alone.set_column(0, "key", pa.array([10_000] * len(texts), pa.int64()))
    assert line_dedup._verify(alone).num_rows == line_dedup._verify(rows).num_rows > 20
    shared = rows.set_column(9, "keys", pa.array([[499, 500, *range(-1 - 9 * k, -9 - 9 * k, -1)] for k in range(len(texts))], pa.list_(pa.int64())))
    assert line_dedup._verify(shared).num_rows == 0
