"""Token-id shards with a minimal perfect hash index.

``write`` encodes the documents, deals them into shards by ranges of their id
and writes, in ascending order of id, three Parquet tables under one folder:

- ``blocks``: whole documents' ids put together to raw payloads, little-endian
  unsigned 16 or 32-bit by the size of the vocabulary, some ``BLOCK`` ids each;
- ``shards``: how many ids and rows lie before each shard;
- ``index``: per bucket of keys a minimal perfect hash function (hash and
  displace), and for each of its slots a fingerprint of the key and its run:
  the address (shard, block, offset, length) of the ids of its first row, that
  row's place among all rows, and how many rows it has from there on. A lookup is
  two hashes, one displacement, one slot and a comparison of the fingerprint.

``lookup`` finds the runs of many keys; ``slices`` reads the payloads, each row
by its place; ``read_back`` brings the two together.

Text is encoded before the one shuffle that sorts it, so ids move, at two bytes
each. Ranges come from quantiles of the id column alone; an id with a large share
of the rows, and rows without one, are spread over several shards by a hash of
their text, and their run goes on from shard to shard.

Defined cases: a null or empty text holds the end id alone; repeated rows of an
id are all written, side by side, in the order of a hash of their text, and the
key finds the run of them; rows with a null id are written first, have no key and
are told by their places; an unknown key has no
address (but for a 32-bit fingerprint that is equal by chance); an empty table
gives empty files and results; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffbook.llm.common import new_path, text_or_empty
from tariffbook.llm.ranges import ranges_of
from tariffbook.llm.tokenizing import json_encoder

BLOCK = 1 << 16  # ids of a block; a longer document has a block of its own
BUCKET, TRIALS = 4096, 32  # keys of an index bucket, on average; displacements tried at a time
BLOCKS_SCHEMA = (
    "shard bigint, block bigint, start bigint, row bigint, n_ids bigint, payload binary, "
    "keys array<bigint>, offsets array<bigint>, lengths array<bigint>"
)
INDEX_SCHEMA = "bucket bigint, n bigint, displace binary, prints binary, shard binary, block binary, offset binary, length binary, place binary, rows binary"
SHARDS_SCHEMA = "shard bigint, base bigint, rows_base bigint, nulls bigint, width int"
ADDRESS = ["shard", "block", "offset", "length"]
RUN = [*ADDRESS, "place", "rows"]


def mix(keys: np.ndarray, seed: int | np.ndarray) -> np.ndarray:
    """A 64-bit mix of integer keys; a seed for all or one for each."""
    with np.errstate(over="ignore"):
        z = keys.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * (np.asarray(seed).astype(np.uint64) + np.uint64(1))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def build_hash(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Displacements and slots of a minimal perfect hash function of distinct keys.

    Keys that share a group are moved together by the least displacement that
    gives all of them free slots, large groups first, ``TRIALS`` tried at a
    time; the key of a group of one gets a free slot outright, kept as a
    negative number.
    """
    n = len(keys)
    groups = max(1, n // 2)
    group = (mix(keys, 0) % np.uint64(groups)).astype(np.int64)
    displace, taken, slots = np.zeros(groups, np.int64), np.zeros(n, bool), np.zeros(n, np.int64)
    order = np.argsort(group, kind="stable")
    members = np.split(order, np.flatnonzero(np.diff(group[order])) + 1) if n else []
    single = []
    for rows in sorted(members, key=lambda m: -len(m)):
        if len(rows) == 1:
            single.append(rows[0])
            continue
        first, found = 1, np.zeros(0, np.int64)
        while not len(found):
            tried = np.arange(first, first + TRIALS)
            at = (mix(keys[rows][None, :], tried[:, None]) % np.uint64(n)).astype(np.int64)
            ordered = np.sort(at, axis=1)
            found = np.flatnonzero(~taken[at].any(1) & (ordered[:, 1:] != ordered[:, :-1]).all(1))
            first += TRIALS
        at = at[found[0]]
        displace[group[rows[0]]], slots[rows], taken[at] = tried[found[0]], at, True
    for row, slot in zip(single, np.flatnonzero(~taken)):
        displace[group[row]], slots[row] = -slot - 1, slot
    return displace, slots


def find_slots(keys: np.ndarray, displace: np.ndarray, n: int) -> np.ndarray:
    """The slot of each key; any slot for keys that the function was not built for."""
    d = displace[(mix(keys, 0) % np.uint64(len(displace))).astype(np.int64)]
    return np.where(d < 0, -d - 1, (mix(keys, np.maximum(d, 0)) % np.uint64(n)).astype(np.int64))


def prints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 1_000_003) >> np.uint64(32)).astype(np.uint32)


@lru_cache(maxsize=4)
def _encoder(path: str, kind: str):
    import tokenizers

    narrow = tokenizers.Tokenizer.from_file(path).get_vocab_size() <= 1 << 16
    return json_encoder(path, kind, "<u2" if narrow else "<u4")


def _slices(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def _blocks(width: int):
    """Turns sorted rows (shard, doc_id, ids) into block rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block, start, first, payload, keys, lengths = None, 0, 0, 0, [], [], []

        def close() -> pa.RecordBatch:
            ends = np.cumsum(lengths)
            row = {
                "shard": shard, "block": block, "start": start, "row": first, "n_ids": int(ends[-1]), "payload": b"".join(payload),
                "keys": keys, "offsets": (ends - lengths).tolist(), "lengths": lengths,
            }
            return pa.RecordBatch.from_pylist([row], schema=BLOCKS_ARROW)

        held = 0
        for batch in _slices(batches, 512):
            for s, key, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                n = len(ids) // width
                if keys and (s != shard or held + n > BLOCK):
                    yield close()
                    block, start, first = (block + 1, start + held, first + len(keys)) if s == shard else (0, 0, 0)
                    payload, keys, lengths, held = [], [], [], 0
                shard = s
                payload.append(ids)
                keys.append(key)
                lengths.append(n)
                held += n
        if keys:
            yield close()

    return run


BLOCKS_ARROW = pa.schema(
    [("shard", pa.int64()), ("block", pa.int64()), ("start", pa.int64()), ("row", pa.int64()), ("n_ids", pa.int64()), ("payload", pa.binary()),
     ("keys", pa.list_(pa.int64())), ("offsets", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64()))]
)


def _index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Turns rows (bucket, key, run), one a key, sorted by bucket into one index row per bucket."""

    def row(part: pd.DataFrame) -> pa.RecordBatch:
        keys = part["key"].to_numpy()
        displace, slots = build_hash(keys)
        at = np.argsort(slots)
        columns = {name: [part[name].to_numpy(np.int64)[at].tobytes()] for name in RUN}
        columns |= {"displace": [displace.tobytes()], "prints": [prints(keys)[at].tobytes()]}
        columns |= {"bucket": [int(part["bucket"].iloc[0])], "n": [len(keys)]}
        return pa.RecordBatch.from_pydict({name.split()[0]: columns[name.split()[0]] for name in INDEX_SCHEMA.split(", ")})

    rest = None
    for batch in batches:
        frame = batch.to_pandas()
        frame = frame if rest is None else pd.concat([rest, frame])
        last = frame["bucket"] == frame["bucket"].iloc[-1]
        for _, part in frame[~last].groupby("bucket", sort=False):
            yield row(part)
        rest = frame[last]
    if rest is not None and len(rest):
        yield row(rest)


def write(
    docs: DataFrame, folder: str, path: str, end_id: int = 0, kind: str = "byte",
    doc_id: str = "doc_id", text: str = "text",
) -> None:
    """Writes blocks, shards and index under ``folder``, which all executors share."""
    spark = docs.sparkSession
    width = np.dtype(_encoder(path, kind).dtype).itemsize
    end = int(end_id).to_bytes(width, "little")

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges_of(rows, "doc_id", count)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, kind)
        for batch in _slices(batches, 2048):
            shard = pa.array(ranges.number(batch.column(0), batch.column(2).to_numpy()), pa.int64())
            ids = encoder.encode_all(batch.column(1), end)
            yield pa.RecordBatch.from_arrays([shard, batch.column(0), batch.column(2), ids], ["shard", "doc_id", "hash", "ids"])

    (
        rows.select("doc_id", "text", F.xxhash64("text").alias("hash"))
        .mapInArrow(encode, "shard bigint, doc_id bigint, hash bigint, ids binary")
        .repartitionById(ranges.count, F.col("shard").cast("int"))
        .sortWithinPartitions("shard", "doc_id", "hash", "ids")
        .select("shard", "doc_id", "ids")
        .mapInArrow(_blocks(width), BLOCKS_SCHEMA)
        .write.parquet(f"{folder}/blocks")
    )
    blocks = spark.read.schema(BLOCKS_SCHEMA).parquet(f"{folder}/blocks")
    without = F.sum(F.size(F.filter("keys", lambda k: k.isNull())))
    totals = blocks.groupBy("shard").agg(F.sum("n_ids"), F.sum(F.size("keys")), without).orderBy("shard").collect()
    bases, rows_bases = (np.cumsum([0, *(t[k] for t in totals)]).tolist() for k in (1, 2))
    nulls = sum(t[3] for t in totals)
    table = [(t[0], base, before, nulls, width) for t, base, before in zip(totals, bases, rows_bases)]
    spark.createDataFrame(table, SHARDS_SCHEMA).coalesce(1).write.parquet(f"{folder}/shards")

    buckets = max(1, -(-rows_bases[-1] // BUCKET))
    before = spark.read.schema(SHARDS_SCHEMA).parquet(f"{folder}/shards").select("shard", "rows_base")
    (
        blocks.select("shard", "block", "row", F.posexplode(F.arrays_zip("keys", "offsets", "lengths")).alias("k", "e"))
        .where("e.keys IS NOT NULL")
        .join(before, "shard")
        .select(
            F.col("e.keys").alias("key"), (F.col("rows_base") + F.col("row") + F.col("k")).alias("place"),
            "shard", "block", F.col("e.offsets").alias("offset"), F.col("e.lengths").alias("length"),
        )
        .groupBy("key")
        .agg(F.min(F.struct("place", *ADDRESS)).alias("first"), F.count("*").alias("rows"))
        .select(F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"), "key", "first.*", "rows")
        .repartition(count, "bucket")
        .sortWithinPartitions("bucket", "key")
        .mapInArrow(_index, INDEX_SCHEMA)
        .withColumn("buckets", F.lit(buckets))
        .write.parquet(f"{folder}/index")
    )


def lookup(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """``key, shard, block, offset, length, place, rows`` of the distinct non-null values of the first column of ``keys``; nulls if unknown.

    The address is that of the key's first row, ``place`` the number of rows before it; ``rows`` counts those
    that follow it, itself included.
    """
    index = spark.read.schema(INDEX_SCHEMA + ", buckets int").parquet(f"{folder}/index")
    buckets = index.select("buckets").head()
    name = keys.columns[0]
    asked = keys.select(F.col(name).cast("bigint").alias("key")).where("key IS NOT NULL").distinct()
    asked = asked.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets[0] if buckets else 1)))

    def find(asked: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"key": asked["key"]}).reindex(columns=["key", *RUN])
        out[RUN] = out[RUN].astype("Int64")
        if len(index) and len(asked):
            row, values = index.iloc[0], asked["key"].to_numpy(np.int64)
            slots = find_slots(values, np.frombuffer(row["displace"], np.int64), int(row["n"]))
            known = np.frombuffer(row["prints"], np.uint32)[slots] == prints(values)
            for column in RUN:
                address = np.frombuffer(row[column], np.int64)[slots]
                out[column] = pd.array(np.where(known, address, 0), "Int64")
                out.loc[~known, column] = pd.NA
        return out

    return (
        asked.groupBy("bucket").cogroup(index.groupBy("bucket"))
        .applyInPandas(find, "key bigint, " + ", ".join(f"{column} bigint" for column in RUN))
    )


def slices(spark: SparkSession, folder: str) -> DataFrame:
    """Each row's ids as the files hold them: ``doc_id, place, shard, block, offset, length, start, ids``.

    ``ids`` are little-endian unsigned 32-bit integers; ``place`` and ``start`` count the rows and the ids of all
    documents before.
    """
    blocks = spark.read.schema(BLOCKS_SCHEMA).parquet(f"{folder}/blocks")
    shards = spark.read.schema(SHARDS_SCHEMA).parquet(f"{folder}/shards")
    by_shard = {r["shard"]: (r["base"], r["rows_base"], r["width"]) for r in shards.collect()}  # one row per shard

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in _slices(batches, 1):
            row = one.to_pylist()[0]
            base, before, width = by_shard[row["shard"]]
            payload = np.frombuffer(row["payload"], f"<u{width}").astype("<u4")
            n, first = len(row["offsets"]), before + row["row"]
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array(row["keys"], pa.int64()), "place": range(first, first + n),
                "shard": [row["shard"]] * n, "block": [row["block"]] * n, "offset": row["offsets"],
                "length": row["lengths"], "start": [base + row["start"] + o for o in row["offsets"]],
                "ids": [payload[o : o + m].tobytes() for o, m in zip(row["offsets"], row["lengths"])],
            })

    schema = "doc_id bigint, place bigint, shard bigint, block bigint, offset bigint, length bigint, start bigint, ids binary"
    return blocks.mapInArrow(cut, schema)


def get(spark: SparkSession, folder: str, key: int) -> list[int] | None:
    """The ids of one key, or None: one index row and one block are read."""
    found = lookup(spark, folder, spark.createDataFrame([(key,)], "key bigint")).first()
    if found is None or found["shard"] is None:
        return None
    width = spark.read.parquet(f"{folder}/shards").select("width").first()[0]
    block = spark.read.parquet(f"{folder}/blocks").where(
        (F.col("shard") == found["shard"]) & (F.col("block") == found["block"])
    )
    payload = np.frombuffer(block.select("payload").first()[0], f"<u{width}")
    return payload[found["offset"] : found["offset"] + found["length"]].tolist()


def read_back(spark: SparkSession, folder: str, keys: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every row of the runs of ``keys``, and of every row without a key.

    Which rows are a key's is told by the places of its run, not by what the blocks store beside the payload.
    """
    runs = lookup(spark, folder, keys).where("shard IS NOT NULL")
    mine = runs.select(F.col("key").alias("doc_id"), F.explode(F.sequence("place", F.col("place") + F.col("rows") - 1)).alias("place"))
    shards = spark.read.schema(SHARDS_SCHEMA).parquet(f"{folder}/shards").select("nulls").head()
    nameless = spark.range(shards["nulls"] if shards else 0).select(F.lit(None).cast("bigint").alias("doc_id"), F.col("id").alias("place"))
    read = slices(spark, folder).select("place", "start", F.col("length").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
    return read.join(mine.unionAll(nameless), "place").select("doc_id", "start", "n_tokens", "ids_crc32")


def op9_id_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's ids, written and read back: runs from the index, ids from the payloads."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_path(spark, "id-shards")
    write(docs, folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_back(spark, folder, docs.select("doc_id"))
