"""Operator 1: URL filter by rules and by a character language-model ratio.

Rules (host and path prefix) judge a URL if its host is the rule's or a subdomain and its path starts
with the rule's; the longest rule wins. What the rules accept and reject trains two variable-order
Markov models over characters (A-Z lowered, digits as one symbol, a few marks, one symbol for the
rest): contexts of 0 to ``ORDER`` characters, every n-gram kept with its counts, however rare, and both classes
weighed alike, however unequal. Probabilities are smoothed from the shorter context to the longer with weight
``PRIOR``. URLs without a rule are judged by (log P_accepted - log P_rejected) / transitions against a threshold,
which is calibrated on the fifth of the ruled URLs (by hash of the URL) that the models do not learn from: it has the
best mean of both classes' accuracies.

The counts are a Spark table that grows with the input and never leaves the executors. URLs are scored in blocks of
about ``BLOCK_SYMBOLS`` characters: a block asks for the distinct n-grams and contexts of its URLs, these are joined with
the counts, and block and counts meet in one task. Only totals and a histogram of ``BINS`` scores per class reach the driver.

Edge cases: a null URL or one without ``://`` has empty host and path, no rule and ratio 0;
if the rules accept or reject nothing, every ratio and the threshold are 0, which allows; repeated
URLs count each; a very long URL is scored whole; an empty table gives no row; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bluelines.llm.common import FOLDS, ascii_lower
from bluelines.session import materialize

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
ORDER = 5
PRIOR = 4.0
BINS, REACH = 4096, 4.0  # calibration histogram: bins over ratios from -REACH to REACH
MARKS = "-._~/?=&%#+:@,"
START, OTHER = 1, 2
SIZE = 64  # symbols are below this, so an n-gram of ORDER + 1 takes 36 bits
KEY_BITS = 40  # above them a key holds twice the order, plus 1 for a context
BLOCK_SYMBOLS = 250_000
CHUNK_SYMBOLS = 500_000


def symbols(url: str) -> np.ndarray:
    """The URL as symbols, with a start and an end mark."""
    raw = np.frombuffer(url.encode("utf-8", "replace"), np.uint8)
    return np.concatenate([[START], _table()[raw], [0]]).astype(np.int64)


def _table() -> np.ndarray:
    t = np.full(256, OTHER, np.int64)
    for c in range(26):
        t[ord("a") + c] = t[ord("A") + c] = 10 + c
    t[ord("0"):ord("9") + 1] = 3
    for k, c in enumerate(MARKS):
        t[ord(c)] = 40 + k
    return t


def joined(urls: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols of all URLs one after the other, each symbol's place in its URL, and where the URLs start."""
    sequences = [symbols(u) for u in urls]
    sizes = np.array([len(x) for x in sequences], np.int64)
    starts = np.cumsum(sizes) - sizes
    return np.concatenate(sequences), np.arange(int(sizes.sum())) - np.repeat(starts, sizes), starts


def keys_of(seq: np.ndarray, place: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the transitions with ``order`` symbols before them: their index in ``seq``, and the keys of their n-grams
    and contexts. The first symbol of a URL is never a transition."""
    at = np.flatnonzero(place >= max(order, 1))
    code = np.zeros(len(at), np.int64)
    for k in range(order, 0, -1):
        code = code * SIZE + seq[at - k]
    context = code
    return at, (code * SIZE + seq[at]) | (2 * order << KEY_BITS), context | (2 * order + 1 << KEY_BITS)


def ratios(urls: list[str], keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Length-normalised log-likelihood difference of each URL, from the ``counts`` (n, 2: accepted, rejected) of the sorted ``keys``."""
    if not urls:
        return np.zeros(0)
    seq, place, starts = joined(urls)
    p = np.full((len(seq), 2), 1.0 / SIZE)
    for order in range(ORDER + 1):
        at, gram, context = keys_of(seq, place, order)
        known = _find(keys, context)
        use = known >= 0
        at, total, found = at[use], counts[known[use]], _find(keys, gram[use])
        seen = np.where((found >= 0)[:, None], counts[found], 0.0)
        p[at] = (seen + PRIOR * p[at]) / (total + PRIOR)
    gain = np.where(place > 0, np.log(p[:, 0]) - np.log(p[:, 1]), 0.0)
    return np.add.reduceat(gain, starts) / (np.diff(np.append(starts, len(seq))) - 1)


def _find(table: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Place of each value in a sorted table, -1 where it is missing."""
    if not len(table):
        return np.full(len(values), -1)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return np.where(table[at] == values, at, -1)


def chunks(urls: list[str], limit: int = CHUNK_SYMBOLS):
    """Slices (from, to) of about ``limit`` characters; a longer URL makes one of its own."""
    start = total = 0
    for i, u in enumerate(urls):
        if i > start and total + len(u) > limit:
            yield start, i
            start, total = i, 0
        total += len(u)
    if start < len(urls):
        yield start, len(urls)


def parts(url: Column) -> tuple[Column, Column]:
    """(host, path): what lies after the first ``://`` up to / ? # or the end, and then up to ? or #."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(ascii_lower(host), F.lit("")), F.coalesce(path, F.lit(""))


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for word, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        h, p = text[:text.index("/")], text[text.index("/"):]
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(word)).otherwise(verdict)
    return rule, verdict


def _spread(batches):
    """Counts of n-grams and contexts: (key, accepted, rejected), combined per chunk before Spark sums them."""
    for batch in batches:
        texts, labels = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
        for a, b in chunks(texts):
            seq, place, starts = joined(texts[a:b])
            owner = np.repeat(labels[a:b], np.diff(np.append(starts, len(seq))))
            every = [(np.concatenate([gram, context]), np.tile(owner[at], 2))
                     for at, gram, context in (keys_of(seq, place, k) for k in range(ORDER + 1))]
            found, back = np.unique(np.concatenate([k for k, _ in every]), return_inverse=True)
            accepted = np.bincount(back, np.concatenate([o for _, o in every]).astype(float), len(found)).astype(np.int64)
            total = np.bincount(back, minlength=len(found))
            yield pa.RecordBatch.from_pydict({"key": found, "accepted": accepted, "rejected": total - accepted})


def _wanted(batches):
    """Distinct keys of the URLs of each block: (block, key), per chunk."""
    for batch in batches:
        texts, blocks = batch.column(0).to_pylist(), batch.column(1).to_numpy()
        order = np.argsort(blocks, kind="stable")
        for part in np.split(order, np.flatnonzero(np.diff(blocks[order])) + 1) if len(order) else []:
            mine = [texts[i] for i in part]
            for a, b in chunks(mine):
                seq, place, _ = joined(mine[a:b])
                found = np.unique(np.concatenate([k for o in range(ORDER + 1) for k in keys_of(seq, place, o)[1:]]))
                yield pa.RecordBatch.from_pydict({"block": np.full(len(found), blocks[part[0]]), "key": found})


def _score(scale: np.ndarray):
    def run(left, right):
        keys = right["key"].to_numpy()
        order = np.argsort(keys)
        counts = np.stack([right["accepted"].to_numpy(), right["rejected"].to_numpy()], 1)[order] * scale
        texts, out = left["url"].to_pylist(), []
        for a, b in chunks(texts):
            out.append(ratios(texts[a:b], keys[order], counts))
        return left.append_column("ratio", pa.array(np.concatenate(out) if out else [], pa.float64()))

    return run


def train(judged: DataFrame, written: list[str] | None = None) -> tuple[DataFrame, np.ndarray | None]:
    """The counts (key, accepted, rejected) of ``judged`` (url, accepted) and the weight of a count of either class; no weights if
    a class is missing."""
    counted = judged.mapInArrow(_spread, "key long, accepted long, rejected long")
    counted = counted.groupBy("key").agg(F.sum("accepted").alias("accepted"), F.sum("rejected").alias("rejected"))
    counted = materialize(counted, "url-counts", written)
    total = counted.where(F.shiftright("key", KEY_BITS) % 2 == 0).agg(F.sum("accepted"), F.sum("rejected")).first()
    if not total[0] or not total[1]:
        return counted, None
    sums = np.array([total[0], total[1]], float)
    return counted, sums.mean() / sums  # both classes weigh the same in the smoothing


def score(rows: DataFrame, counted: DataFrame, scale: np.ndarray, written: list[str] | None = None) -> DataFrame:
    """``rows`` (with a column url, not null, no column block) with their ratio."""
    size = rows.agg(F.sum(F.length("url") + 2)).first()[0] or 0
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(-(-size // BLOCK_SYMBOLS) or 1)).cast("int")
    rows = materialize(rows.withColumn("block", block), "url-blocks", written)
    wanted = rows.select("url", "block").mapInArrow(_wanted, "block int, key long").distinct()
    known = wanted.join(counted, "key")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields), "ratio double"])
    return rows.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(_score(scale), schema).drop("block")


def threshold(histogram: np.ndarray) -> float:
    """The ratio from which on URLs are accepted with the best mean of both accuracies (the middle of
    the best thresholds); 0 if a class is missing."""
    if not histogram.sum(1).all():
        return 0.0
    below = np.concatenate([np.zeros((2, 1)), np.cumsum(histogram / histogram.sum(1, keepdims=True), 1)], 1)
    gain = below[0] + 1 - below[1]
    best = np.flatnonzero(gain >= gain.max() - 1e-12)
    return float(best[len(best) // 2] * (2 * REACH / BINS) - REACH)


def judge(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", written: list[str] | None = None) -> DataFrame:
    """Rows (page_id, host, path, rule, verdict, ratio), one per input row."""
    url = F.col(url_col).cast("string")
    host, path = parts(url)
    split = pages.select(F.col(id_col).alias("page_id"), url.alias("url"), host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"))
    ruled = split.withColumn("rule", rule).withColumn("ruled", verdict).withColumn("fold", F.crc32(F.col("url").cast("binary")) % FOLDS)
    ruled = materialize(ruled, "url-parts", written)
    accepted = (F.col("ruled") == "allow").alias("accepted")
    counted, scale = train(ruled.where("ruled is not null and fold != 0").select("url", accepted), written)
    out, limit = ruled.withColumn("ratio", F.lit(0.0)), 0.0
    if scale is not None:
        scored = materialize(score(ruled.where("host != ''"), counted, scale, written), "url-scores", written)
        out = scored.unionByName(out.where("host = ''"))
        bins = F.greatest(F.lit(0), F.least(F.lit(BINS - 1), F.floor((F.col("ratio") + REACH) * (BINS / (2 * REACH)))))
        histogram = np.zeros((2, BINS))
        for r in scored.where("ruled is not null and fold = 0").groupBy(accepted, bins.alias("bin")).count().collect():
            histogram[int(r.accepted), r.bin] = r["count"]
        limit = threshold(histogram)
    by_model = F.when(F.col("ratio") >= limit, "allow").otherwise("block")
    return out.select("page_id", "host", "path", "rule", F.coalesce("ruled", by_model).alias("verdict"), "ratio")
