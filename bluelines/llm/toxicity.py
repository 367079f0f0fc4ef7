"""Operator 6: toxicity by maximum-scoring segments over token log-odds.

Tokens are lower-cased words (runs of letters). A token's score is the log ratio of its rates in toxic
and clean labelled texts under Dirichlet priors of a few pseudo-occurrences: those of a word are split
between the two as its stem class (first ``STEM`` letters) is, those of a class as all tokens are;
unseen words take the score of their class.
``DRIFT`` is taken off every score, so that neutral text scores below zero on average. A linear scan
gives all maximal-scoring segments of a whole text (Ruzzo and Tompa). Their scores follow an
extreme-value law in clean text of n tokens: P(best >= s) = 1 - exp(-K n exp(-lambda s)), with lambda from
the token scores and K by maximum likelihood over clean texts. A text's evidence is the sum of
lambda * s - ln(K n) over its segments where that is positive; a logistic curve in log(1 + evidence)
gives the score from 0 to 1.

Fit: at most ``SAMPLE_ROWS`` labelled rows that are not held out, by hash of the id; four fifths give the
token counts, the rest lambda, K and the curve. Words with at least ``LEAST`` occurrences in the sample are
kept; the bound on its rows bounds the model. Labels, language, source and id are no input of a score; the
id only chooses rows.

Edge cases: very long texts are scanned whole; an empty table gives no row; null and empty texts get the score of no evidence; a label that repeats counts once
(the largest); null labels are skipped; without both classes every score is 0; repeated rows give
repeated results; extra columns are not read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from math import exp, log, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bluelines.llm.common import held_out, text_batches
from bluelines.session import materialize

SAMPLE_ROWS = 20_000
LEAST, STEM = 3, 4
PRIOR_WORD, PRIOR_CLASS = 5.0, 2.0  # pseudo-occurrences
DRIFT = 2.0
_WORD = re.compile(r"[^\W\d_]+")


def tokens(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments (from, to, score), in order: disjoint, none of them can be extended or
    shortened for more, in time linear in the number of scores."""
    positive = np.concatenate([[False], scores > 0, [False]])
    edges = np.flatnonzero(positive[1:] != positive[:-1])
    total = np.concatenate([[0.0], np.cumsum(scores)])
    kept: list[list] = []  # from, to, total before, total after, index of the nearest kept one with a smaller total before
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        now = [a, b, float(total[a]), float(total[b]), -1]
        while True:
            j = len(kept) - 1
            while j >= 0 and kept[j][2] >= now[2]:
                j = kept[j][4]
            if j >= 0 and kept[j][3] < now[3]:
                now[0], now[2] = kept[j][0], kept[j][2]
                del kept[j:]
            else:
                now[4] = j
                kept.append(now)
                break
    return [(a, b, right - left) for a, b, left, right, _ in kept]


@dataclass
class Model:
    words: dict[str, float] = field(default_factory=dict)
    stems: dict[str, float] = field(default_factory=dict)
    decay: float = 1.0  # lambda
    k: float = 1.0
    slope: float = 0.0
    base: float = -50.0

    def scores(self, words: list[str]) -> np.ndarray:
        get, stem = self.words.get, self.stems.get
        return np.array([x if (x := get(w)) is not None else stem(w[:STEM], -DRIFT) for w in words], float)

    def significance(self, score: float, n: int) -> float:
        """lambda * s - ln(K n): about minus the log of the chance of such a segment in clean text."""
        return self.decay * score - log(self.k * max(n, 1))

    def evidence(self, found: list[float], n: int) -> float:
        return sum(e for s in found if (e := self.significance(s, n)) > 0)

    def probability(self, evidence: float) -> float:
        x = self.base + self.slope * log1p(evidence)
        return 1 / (1 + exp(-x)) if x > -700 else 0.0

    def score(self, text: str | None) -> float:
        words = tokens(text)
        return self.probability(self.evidence([s for _, _, s in segments(self.scores(words))], len(words)))

    def passages(self, text: str | None) -> list[tuple[int, int, float]]:
        """(first word, word after the last, p value) of every segment expected less than once in clean text."""
        words = tokens(text)
        found = ((a, b, self.significance(s, len(words))) for a, b, s in segments(self.scores(words)))
        return [(a, b, 1 - exp(-exp(-e))) for a, b, e in found if e > 0]


def _count(batches):
    for batch in batches:
        seen: dict[tuple[str, bool], list[int]] = {}
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            for w in tokens(text):
                for key in ((w, False), (w[:STEM], True)):
                    seen.setdefault(key, [0, 0])[toxic] += 1
        keys = list(seen)
        yield pa.RecordBatch.from_pydict({"token": pa.array([k[0] for k in keys], pa.string()), "stem": pa.array([k[1] for k in keys], pa.bool_()),
                                          "clean": pa.array([seen[k][0] for k in keys], pa.int64()), "toxic": pa.array([seen[k][1] for k in keys], pa.int64())})


def weigh(words: dict[str, tuple[int, int]], stems: dict[str, tuple[int, int]]) -> Model:
    """Log-odds from (clean, toxic) counts; the stems cover all tokens."""
    total = np.array(list(stems.values()), float).sum(0) + 1e-9
    model, split = Model(), {}
    for stem, n in stems.items():
        expected = np.array(n) + PRIOR_CLASS * total / total.sum()  # pooled: as often as in all texts
        split[stem] = expected / expected.sum()
        model.stems[stem] = float(np.log(expected[1] / total[1]) - np.log(expected[0] / total[0])) - DRIFT
    for word, n in words.items():
        expected = np.array(n) + PRIOR_WORD * split[word[:STEM]]
        model.words[word] = float(np.log(expected[1] / total[1]) - np.log(expected[0] / total[0])) - DRIFT
    return model


def calibrate(model: Model, rows: list[tuple[int, int, list[float]]], values: np.ndarray, counts: np.ndarray) -> None:
    """rows: (toxic, tokens, segment scores); values and counts: token scores of clean texts. Sets lambda,
    K and the logistic curve."""
    p = counts / max(counts.sum(), 1)
    if len(values) and values.max() > 0 > (p * values).sum():
        low, high = 1e-6, 50.0 / values.max()
        for _ in range(100):
            middle = (low + high) / 2
            low, high = (low, middle) if (p * np.exp(middle * values)).sum() > 1 else (middle, high)
        model.decay = low
    clean = [(n, max(found, default=0.0)) for toxic, n, found in rows if not toxic and n]
    if clean:
        model.k = len(clean) / sum(n * exp(-model.decay * s) for n, s in clean)
    x = np.log1p([model.evidence(r[2], r[1]) for r in rows])
    y = np.array([r[0] for r in rows], float)
    w = np.array([0.0, 0.0])
    design = np.stack([np.ones(len(x)), x], 1)
    for _ in range(100):  # Newton steps of a logistic regression with a little ridge
        mu = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (mu - y) + 0.02 * w
        hessian = (design * (mu * (1 - mu))[:, None]).T @ design + 0.02 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    model.base, model.slope = float(w[0]), max(0.0, float(w[1]))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", written: list[str] | None = None) -> Model:
    known = labels.where(~held_out(F.col("doc_id")) & F.col("toxic").isin(0, 1)).groupBy(F.col("doc_id").alias("id")).agg(F.max("toxic").alias("toxic"))
    known = known.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS)  # bounded: sent to all executors
    known = materialize(known.select("id", (F.col("toxic") == 1).alias("toxic"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(5)) == 0).alias("later")), "tox-labels", written)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(known), "id")
    texts = materialize(texts.select("text", "toxic", "later"), "tox-sample", written)
    if texts.select("toxic").distinct().count() < 2:
        return Model()
    counted = texts.where("not later").select("text", "toxic").mapInArrow(_count, "token string, stem boolean, clean long, toxic long")
    counted = counted.groupBy("token", "stem").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    counted = materialize(counted, "tox-counts", written)
    least = F.when(F.col("stem"), 1).otherwise(LEAST)
    words, stems = {}, {}
    for r in counted.where(F.col("clean") + F.col("toxic") >= least).toArrow().to_pylist():
        (stems if r["stem"] else words)[r["token"]] = (r["clean"], r["toxic"])
    if not stems:
        return Model()
    model = weigh(words, stems)

    def measure(batches):
        kinds = pa.schema([("toxic", pa.bool_()), ("n", pa.int64()), ("found", pa.list_(pa.float64())),
                           ("values", pa.list_(pa.float64())), ("counts", pa.list_(pa.int64()))])
        for batch in batches:
            rows = [model.scores(tokens(t)) for t in batch.column(0).to_pylist()]
            seen = [np.unique(np.round(r, 2), return_counts=True) for r in rows]
            yield pa.RecordBatch.from_pydict({"toxic": batch.column(1), "n": [len(r) for r in rows], "found": [[s for _, _, s in segments(r)] for r in rows],
                                              "values": [v.tolist() for v, _ in seen], "counts": [c.tolist() for _, c in seen]}, kinds)

    later = texts.where("later").select("text", "toxic").mapInArrow(
        measure, "toxic boolean, n long, found array<double>, values array<double>, counts array<long>")
    later = materialize(later, "tox-measured", written)
    of_clean = later.where("not toxic").select(F.explode(F.arrays_zip("values", "counts")).alias("v"))
    of_clean = of_clean.groupBy(F.col("v.values").alias("value")).agg(F.sum("v.counts").alias("n")).orderBy("value").collect()
    calibrate(model, [(int(r.toxic), r.n, r.found) for r in later.select("toxic", "n", "found").orderBy("toxic", "n", "found").collect()],
              np.array([r.value for r in of_clean]), np.array([r.n for r in of_clean], float))
    return model


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", written: list[str] | None = None) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted, passages), one per input row; passages: how many segments
    are expected less than once in clean text of that length."""
    text_batches(docs.sparkSession)
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col, text_col, written))

    @F.arrow_udf("score double, passages int")
    def scored(texts: pa.Array) -> pa.Array:
        out = []
        for t in texts.to_pylist():
            words = tokens(t)
            found = [s for _, _, s in segments(model.value.scores(words))]
            out.append((model.value.probability(model.value.evidence(found, len(words))),
                        sum(model.value.significance(s, len(words)) > 0 for s in found)))
        return pa.StructArray.from_arrays([pa.array([x[0] for x in out], pa.float64()), pa.array([x[1] for x in out], pa.int32())], ["score", "passages"])

    s = docs.select(F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), scored(F.col(text_col).cast("string")).alias("s"))
    return s.select("doc_id", "held_out", "s.score", (F.col("s.score") >= 0.5).cast("int").alias("predicted"), "s.passages")
