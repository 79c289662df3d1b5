"""Quartile bucket digests of texts, and their likeness.

Byte triplets (three of any four bytes in a row, the first one always among
them) are hashed into ``BUCKETS`` counts. A digest writes for each bucket
which quartile of the counts it lies in, two bits each, and the length of the
text on a log scale. The difference of two digests adds up the quartile steps
(three steps count six) and the steps in length; likeness is 1 less the share
of it in ``BOUND``, and 0 beyond.

``edited_pairs`` sets each document beside an edited text, its last third
replaced by the begin of the next document in descending order of id (after
the last comes the first). Documents are sorted within ranges of the id; each
range gets a copy of the first document of the next one, so text is moved once
and no task sees more than its range. An id with a large share of the rows, and
rows without one, are spread over several ranges by a hash of their text.

Defined cases: a null or empty text has the digest of no triplets, which is
like itself; rows of one id go by a hash of their text, the greatest first; null
ids come last; a single document is its own next one; an empty table gives an
empty result; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffbook.llm.common import text_or_empty
from tariffbook.llm.ranges import ranges_of

BUCKETS, BOUND, LENGTH_STEP = 512, 1024, 4
PATTERNS = [(1, 2), (1, 3), (2, 3)]  # of a triplet: the places after its first byte
SLICE = 1 << 20  # bytes worked on at a time


def counts(data: np.ndarray) -> np.ndarray:
    total = np.zeros(BUCKETS, np.int64)
    for at in range(0, len(data), SLICE):
        d = data[at : at + SLICE + 3].astype(np.uint32)
        n = min(SLICE, len(data) - at)
        for number, (i, j) in enumerate(PATTERNS):
            m = min(n, len(d) - j)
            if m > 0:
                x = (d[:m] << np.uint32(16)) | (d[i : i + m] << np.uint32(8)) | d[j : j + m]
                x = (x + np.uint32(number << 24)) * np.uint32(0x9E3779B1)
                total += np.bincount((x ^ (x >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(23), minlength=BUCKETS)
    return total


class Digest:
    def __init__(self, text: str):
        raw = text.encode()
        found = counts(np.frombuffer(raw, np.uint8))
        ordered = np.sort(found)
        cuts = ordered[[BUCKETS // 4 - 1, BUCKETS // 2 - 1, 3 * BUCKETS // 4 - 1]]
        self.codes = (found[:, None] > cuts).sum(1).astype(np.uint8)
        self.length = int(round(8 * np.log2(1 + len(raw))))

    def __str__(self) -> str:
        four = self.codes.reshape(-1, 4)
        packed = (four[:, 0] << 6) | (four[:, 1] << 4) | (four[:, 2] << 2) | four[:, 3]
        return f"{self.length:04x}{packed.tobytes().hex()}"

    def likeness(self, other: Digest) -> float:
        steps = np.abs(self.codes.astype(np.int16) - other.codes)
        difference = int(steps.sum() + 3 * (steps == 3).sum()) + LENGTH_STEP * abs(self.length - other.length)
        return 1.0 - min(difference, BOUND) / BOUND


def parse(digest: str) -> Digest:
    """The digest that a string was written from."""
    made = Digest.__new__(Digest)
    made.length = int(digest[:4], 16)
    packed = np.frombuffer(bytes.fromhex(digest[4:]), np.uint8)
    made.codes = np.stack([(packed >> s) & 3 for s in (6, 4, 2, 0)], axis=1).ravel()
    return made


def fingerprint(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([str(Digest(t)) for t in batch.column(1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), made], ["doc_id", "fingerprint"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, fingerprint string")


PAIRS_SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, doc_id, text, copy) in order; the copy ends a shard."""
    names = [c.split()[0] for c in PAIRS_SCHEMA.split(", ")]
    first = held = None  # (shard, doc_id, text, digest)

    def row(one: tuple, after: tuple) -> tuple:
        text, n = one[2], len(one[2])
        edited = text[: n - n // 3] + after[2][: n // 3]
        changed = Digest(edited)
        return (
            one[1], n, hashlib.sha256(edited.encode()).hexdigest(), str(one[3]), str(changed),
            one[3].likeness(changed), one[3].likeness(after[3]),
        )

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({n: list(c) for n, c in zip(names, zip(*rows))})

    for batch in batches:
        rows = []
        for shard, key, text, copy in zip(*(batch.column(i).to_pylist() for i in range(4))):
            now = (shard, key, text, Digest(text))
            if held is not None:
                rows.append(row(held, now if held[0] == shard else first))
            if held is None or held[0] != shard:
                first = now
            held = None if copy else now
        if rows:
            yield table(rows)
    if held is not None:
        yield table([row(held, first)])


def edited_pairs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    ranges = ranges_of(rows, "doc_id", int(spark.conf.get("spark.sql.shuffle.partitions")))

    @F.arrow_udf("bigint")
    def number(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        return pa.array(ranges.number(ids, hashes.to_numpy()), pa.int64())

    hashed = rows.withColumn("hash", F.xxhash64("text"))
    rows = hashed.select(number("doc_id", "hash").alias("shard"), "doc_id", "hash", "text")
    # The first document of each range goes to the one before; at most as many rows as there are ranges.
    heads = rows.groupBy("shard").agg(F.max(F.struct("doc_id", "hash")).alias("head")).orderBy("shard").collect()
    all_rows = rows.withColumn("copy", F.lit(False))
    if len(heads) > 1:
        table = [(heads[(k + 1) % len(heads)]["shard"], *heads[k]["head"]) for k in range(len(heads))]
        asked = F.broadcast(spark.createDataFrame(table, "shard bigint, doc_id bigint, hash bigint"))
        here = rows["doc_id"].eqNullSafe(asked["doc_id"]) & (rows["hash"] == asked["hash"])
        firsts = rows.join(asked, here).groupBy(asked["shard"], asked["doc_id"], asked["hash"])
        all_rows = all_rows.unionByName(firsts.agg(F.min("text").alias("text")).withColumn("copy", F.lit(True)))
    return (
        all_rows.repartitionById(ranges.count, F.col("shard").cast("int"))
        .sortWithinPartitions("shard", "copy", F.desc_nulls_last("doc_id"), F.desc("hash"), "text")
        .select("shard", "doc_id", "text", "copy")
        .mapInArrow(_compare, PAIRS_SCHEMA)
    )


def op10_document_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_pairs(spark.read.parquet(f"{sf_dir}/documents.parquet"))
