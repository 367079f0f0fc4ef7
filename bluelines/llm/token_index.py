"""Operator 5: token ids in raw binary shards, with a minimal perfect hash index from document key to
shard offset.

Layout of an output folder:
  shards/shard-<k>.ids   magic, width of an id in bytes; the ids of its documents; the number of ids of
                         each document (uint64 each); documents, ids (uint64 each)
  index/bucket-<b>.mph   perfect hash of the keys of one hash bucket with entries (fingerprint, first shard,
                         offset in ids, number of the document in its shard, rows with that key)
  manifest/              Parquet: shard, documents, ids, ids of all shards before it
  spans/                 Parquet: the runs of the keys whose rows lie in several shards

Documents are range-partitioned and sorted by id, so shards and the documents in them ascend; rows that
repeat an id stand next to each other (ordered by text within a shard) and share an index entry. An id with
more rows than a shard takes goes on in the next ones, so no id makes a task of its own. Buckets
hold about ``BUCKET_KEYS`` hashed distinct keys each, whatever the input. The ids are those of the whole
text: words between ASCII white space are encoded apart and kept in a bounded cache, which gives the
same ids because this kind of tokenizer never joins across white space.

Edge cases: null and empty texts give the end id alone; a null document id is stored under the
reserved key -2**63, so it comes first; extra columns are not read; an empty table gives no shard.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bluelines.llm import files, mphf
from bluelines.llm.common import BATCH_ROWS, in_chunks, text_batches
from bluelines.llm.word_ids import CHUNK, with_end, word_ids
from bluelines.session import materialize

MAGIC = b"BLIDS001"
END_ID = 2
BUCKET_KEYS = 20_000
NULL_KEY = -(2**63)
ENTRIES = "key long, shard int, ordinal long, offset long, n_ids long"


def encode(text: str | None, tokenizer: str) -> np.ndarray:
    """Ids of one text, without the end id."""
    return word_ids(tokenizer).encode(pa.array([text], pa.string()))[0]


def _shard_uri(folder: str, shard: int) -> str:
    return f"{folder}/shards/shard-{shard:06d}.ids"


def _shards(folder: str) -> list[int]:
    return [int(m[1]) for m in (re.fullmatch(r"shard-(\d+)\.ids", n) for n in files.names(f"{folder}/shards")) if m]


def _bucket_uri(folder: str, bucket: int) -> str:
    return f"{folder}/index/bucket-{bucket:06d}.mph"


def _writer(folder: str, tokenizer: str, end_id: int):
    def run(batches):
        enc, shard = word_ids(tokenizer), TaskContext.get().partitionId()
        width = np.dtype(enc.dtype).itemsize
        keys, counts = [], []

        def chunks():
            empty = True
            for batch in batches:
                for a, b in in_chunks(batch.column(1), CHUNK):
                    if empty:
                        yield MAGIC + struct.pack("<Q", width)
                        empty = False
                    ids, sizes = with_end(*enc.encode(batch.column(1)[a:b]), end_id)
                    keys.append(batch.column(0)[a:b].to_numpy())
                    counts.append(sizes.astype(np.uint64))
                    yield ids.tobytes()
            if not empty:
                n = np.concatenate(counts)
                yield n.tobytes() + struct.pack("<QQ", len(n), int(n.sum()))

        stream = chunks()
        head = next(stream, None)
        if head is None:
            return

        def whole():
            yield head
            yield from stream

        files.publish(_shard_uri(folder, shard), whole())
        n = np.concatenate(counts).astype(np.int64)
        yield pa.RecordBatch.from_pydict({
            "key": np.concatenate(keys), "shard": np.full(len(n), shard, np.int32),
            "ordinal": np.arange(len(n)), "offset": np.cumsum(n) - n, "n_ids": n})

    return run


def _index_writer(folder: str):
    def run(key, part):
        cols = [part[c].to_numpy() for c in ("key", "shard", "offset", "ordinal", "copies")]
        size = files.publish(_bucket_uri(folder, key[0].as_py()), mphf.dump(*cols))
        return pa.table({"bucket": [key[0].as_py()], "n_keys": [part.num_rows], "n_bytes": [size]})

    return run


def _bucket(key, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
          end_id: int = END_ID, written: list[str] | None = None) -> int:
    """Writes shards, index and manifest below ``folder``; returns the number of index buckets."""
    spark = docs.sparkSession
    text_batches(spark)
    src = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NULL_KEY)).alias("key"), F.col(text_col).cast("string").alias("text"))
    # the start and hash of a text, then the place of its row, cut an id with very many rows into ranges
    src = src.withColumn("row", F.monotonically_increasing_id())
    src = src.repartitionByRange("key", F.substring("text", 1, 16), F.xxhash64("text"), "row").sortWithinPartitions("key", "text").drop("row")
    entries = materialize(src.mapInArrow(_writer(folder, tokenizer, end_id), ENTRIES), "token-entries", written)
    totals = entries.groupBy("shard").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_ids").alias("n_ids")).orderBy("shard").collect()
    before, manifest = 0, []  # one row per shard, not per document
    for r in totals:
        manifest.append((r.shard, r.n_docs, r.n_ids, before))
        before += r.n_ids
    spark.createDataFrame(manifest, "shard int, n_docs long, n_ids long, start long").coalesce(1).write.parquet(f"{folder}/manifest")
    first = F.min(F.struct("shard", "offset", "ordinal"))
    runs = entries.groupBy("key", "shard").agg(F.min("offset").alias("offset"), F.min("ordinal").alias("ordinal"), F.count(F.lit(1)).alias("copies"))
    runs = materialize(runs, "token-runs", written)
    keys = runs.groupBy("key").agg(first.alias("first"), F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("shards"))
    spans = runs.join(keys.where("shards > 1").select("key"), "key", "left_semi")
    spans.coalesce(1).write.parquet(f"{folder}/spans")  # at most one key goes on into each shard
    keys = keys.select("key", "first.*", "copies")
    buckets = max(1, -(-sum(r.n_docs for r in totals) // BUCKET_KEYS))
    built = keys.withColumn("bucket", _bucket("key", buckets)).groupBy("bucket")
    built = built.applyInArrow(_index_writer(folder), "bucket long, n_keys long, n_bytes long")
    materialize(built, "token-buckets", written)
    return buckets


def _finder(folder: str):
    def run(batches):
        at, tree, entries = None, None, None
        for batch in batches:
            key, bucket = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            for part in np.split(np.arange(len(key)), cuts) if len(key) else []:
                if bucket[part[0]] != at:
                    at = bucket[part[0]]
                    with files.open_input(_bucket_uri(folder, int(at))) as f:
                        tree, entries = mphf.load(f.read())
                found = mphf.find(tree, entries, key[part])
                part, found = part[found >= 0], found[found >= 0]
                yield pa.RecordBatch.from_pydict({
                    "key": key[part], **{c: entries[c][found].astype(np.int64) for c in ("shard", "offset", "ordinal", "copies")}})

    return run


def lookup(keys: DataFrame, folder: str, buckets: int) -> DataFrame:
    """Index entries of the distinct keys of ``keys`` (its first column); unknown keys give no row."""
    keys = keys.select(F.coalesce(F.col(keys.columns[0]).cast("long"), F.lit(NULL_KEY)).alias("key")).distinct()
    keys = keys.withColumn("bucket", _bucket("key", buckets)).repartition("bucket").sortWithinPartitions("bucket")
    return keys.mapInArrow(_finder(folder), "key long, shard long, offset long, ordinal long, copies long")


class Shard:
    """An open shard: ids and counts of its documents by position."""

    def __init__(self, folder: str, shard: int):
        self.file = files.open_input(_shard_uri(folder, shard))
        if self.file.read_at(8, 0) != MAGIC:
            raise ValueError("not a shard file")
        self.width = struct.unpack("<Q", self.file.read_at(8, 8))[0]
        self.n_docs, self.n_ids = struct.unpack("<QQ", self.file.read_at(16, self.file.size() - 16))

    def counts(self, ordinal: int, copies: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at(8 * copies, 16 + self.n_ids * self.width + 8 * ordinal), "<u8")

    def ids(self, offset: int, n: int) -> np.ndarray:
        return np.frombuffer(self.file.read_at(n * self.width, 16 + offset * self.width), f"<u{self.width}")

    def close(self):
        self.file.close()


def _reader(folder: str):
    schema = pa.schema([(c, pa.int64()) for c in ("key", "start", "n_tokens", "ids_crc32")])

    def run(batches):
        at, shard = None, None
        for batch in batches:
            out = {c: [] for c in schema.names}
            for r in batch.to_pylist():
                if r["shard"] != at:
                    if shard:
                        shard.close()
                    at, shard = r["shard"], Shard(folder, r["shard"])
                offset = r["offset"]
                for n in shard.counts(r["ordinal"], r["copies"]).tolist():
                    ids = shard.ids(offset, n)
                    out["key"].append(r["key"])
                    out["start"].append(r["start"] + offset)
                    out["n_tokens"].append(n)
                    out["ids_crc32"].append(zlib.crc32(ids.astype("<u4").tobytes()))
                    offset += n
                    if len(out["key"]) == BATCH_ROWS:
                        yield pa.RecordBatch.from_pydict(out, schema)
                        out = {c: [] for c in schema.names}
            yield pa.RecordBatch.from_pydict(out, schema)

    return run


def read(spark: SparkSession, folder: str, keys: DataFrame, buckets: int) -> DataFrame:
    """One row per stored document of ``keys``: key, start, n_tokens, ids_crc32, read through the index
    from the shard files in shard order."""
    manifest = spark.read.parquet(f"{folder}/manifest").select(F.col("shard").cast("long"), "start")
    run = ("shard", "offset", "ordinal", "copies")
    spans = spark.read.parquet(f"{folder}/spans").select("key", *(F.col(c).cast("long").alias(f"{c} there") for c in run))
    found = lookup(keys, folder, buckets).join(spans, "key", "left")
    found = found.select("key", *(F.coalesce(f"{c} there", c).alias(c) for c in run)).join(manifest, "shard")
    found = found.repartition("shard").sortWithinPartitions("shard", "offset")
    out = found.select("key", "shard", "offset", "ordinal", "copies", "start").mapInArrow(
        _reader(folder), "key long, start long, n_tokens long, ids_crc32 long")
    return out.select(F.when(F.col("key") != NULL_KEY, F.col("key")).alias("doc_id"), "start", "n_tokens", "ids_crc32")


def get(folder: str, key: int | None, buckets: int) -> list[np.ndarray]:
    """Ids of the documents stored under one key (none: not stored), without Spark: one index file, one
    probe of the perfect hash, and the bytes of just those documents."""
    import xxhash

    key = NULL_KEY if key is None else key
    signed = np.array([xxhash.xxh64_intdigest(struct.pack("<q", key), seed=42)], np.uint64).view(np.int64)[0]  # as Spark hashes a long
    try:
        with files.open_input(_bucket_uri(folder, int(signed) % buckets)) as f:
            tree, entries = mphf.load(f.read())
    except FileNotFoundError:
        return []
    at = mphf.find(tree, entries, np.array([key]))[0]
    if at < 0:
        return []
    e, out = entries[at], []
    left, number, ordinal, offset = (int(e[c]) for c in ("copies", "shard", "ordinal", "offset"))
    while True:
        shard = Shard(folder, number)
        here = min(left, shard.n_docs - ordinal)
        for n in shard.counts(ordinal, here).tolist():
            out.append(shard.ids(offset, n))
            offset += n
        shard.close()
        left -= here
        if not left:
            return out
        number, ordinal, offset = min(k for k in _shards(folder) if k > number), 0, 0
