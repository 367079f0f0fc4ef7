import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from helpers import documents
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bluelines.llm import spelling

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def brute_words(rows):
    out = Counter()
    for i, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 7 and n >= 2}


def distance_one(a, b):
    """By the whole table of edit distances."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1] == 1


def brute(words):
    near = defaultdict(list)
    for a in words:
        for b in words:
            if a < b and abs(len(a) - len(b)) < 2 and distance_one(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda o: (-words[o], o))
        if words[top] >= 10 * words[w]:
            form[w] = top
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out, key=repr)


def got(df):
    assert df.columns[:6] == COLUMNS
    return sorted((tuple(r)[:6] for r in df.collect()), key=repr)


def texts(seed, documents=60, base=25):
    """Documents of words and their one- and two-letter changes, frequent ones among them."""
    r = random.Random(seed)
    letters = "abcdeéßÿ"
    words = ["".join(r.choice(letters) for _ in range(r.randrange(6, 11))) for _ in range(base)]
    out = []
    for i in range(documents):
        row = []
        for _ in range(r.randrange(40)):
            w = words[min(int(r.expovariate(0.3)), base - 1)]
            for _ in range(r.choice((0, 0, 0, 0, 1, 1, 2))):
                k = r.randrange(len(w))
                w = r.choice((w[:k] + w[k + 1:], w[:k] + r.choice(letters) + w[k:], w[:k] + r.choice(letters) + w[k + 1:]))
            row.append(w if r.random() < 0.9 else w.upper().replace("É", "é"))
        out.append((i, "".join(w + r.choice((" ", ", ", "\n", "9", "·")) for w in row)))
    return out


@pytest.mark.parametrize("part_words", [10_000, 30, 3])
def test_against_all_pairs(spark, part_words):
    rows = texts(part_words)
    want = brute(brute_words(rows))
    assert sum(f is not None for _, f, *_ in want) > 5 and max(x[4] for x in want) > 3
    assert got(spelling.variants(documents(spark, rows, extra=("word", "n", "part")), part_words=part_words)) == want


def test_words_of_one_letter_stock(spark):
    """Arrangements of the same letters share every path, so they are matched by spelling."""
    r = random.Random(1)
    stock = ["".join(r.sample("abcdefg", 7)) for _ in range(60)]
    some = set(stock)
    for w in stock[:30]:
        k = r.randrange(7)
        some |= {w[:k] + r.choice("abq") + w[k:], w[:k] + w[k] + w[k:], w[:k] + "q" + w[k + 1:], w[:k] + "á" + w[k + 1:], w + w[-1]}
    words = {w: 2 + 40 * (k % 7 == 0) for k, w in enumerate(sorted(some))}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    near = {x.word: (x.n_near, x.best.n, x.best.word) for x in spelling.near_words(df, part_words=1).collect()}
    want = defaultdict(list)
    for a in words:
        for b in words:
            if a != b and abs(len(a) - len(b)) < 2 and distance_one(a, b):
                want[a].append(b)
    assert len(want) > 100
    assert near == {a: (len(o), *(lambda t: (words[t], t))(min(o, key=lambda x: (-words[x], x)))) for a, o in want.items()}


def test_forms_are_followed_to_the_last(spark):
    chain = [(f"w{k}", f"w{k + 1}") for k in range(9)] + [("x", "w4"), ("y", "w9")]
    roots = dict(spelling.follow(spark.createDataFrame(chain, "word string, form string")).collect())
    assert roots == {w: "w9" for w, _ in chain}


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "Short ab1c"), (None, "spelling spelling"), (None, "spelling"), (5, "elephant Elephant"), (5, "elephant"),
            (6, "elephent " * 2 + "x" * 400 + " " + "x" * 400), (7, "ELEPHANT×÷ß " * 40), (8, "elephant " * 5000), (9, "x" * 401 + " " + "x" * 401)]
    want = brute(brute_words(rows))
    assert len(want) >= 4
    assert got(spelling.variants(documents(spark, rows, extra=("rest", "best")))) == want
    assert spelling.variants(documents(spark, [])).count() == 0
    assert spelling.variants(documents(spark, [(1, "seldom words only")])).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text("abcpqé", min_size=1, max_size=9), st.text("abcpqé", min_size=1, max_size=9))
def test_one_edit(a, b):
    if a != b:
        assert spelling.one_edit(a, b) == distance_one(a, b)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("abq", min_size=3, max_size=6), min_size=2, max_size=25, unique=True))
def test_search_meets_every_near_vector(words):
    vectors = [v.tobytes() for v in spelling.counts_of(words)]
    root = spelling.trie(vectors)
    for v in set(vectors):
        met = list(spelling.near_vectors(root, v))
        want = {u for u in vectors if sum(max(x - y, 0) for x, y in zip(u, v)) <= 1 and sum(max(y - x, 0) for x, y in zip(u, v)) <= 1}
        assert len(met) == len(set(met)) and set(met) == want


def test_words_of_the_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = dict(spelling.occurrences(docs).where(F.col("n") >= 2).collect())
    assert found == brute_words([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
