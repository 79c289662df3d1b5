"""Ranges of ids with hot ids, and the operators that deal rows by them, at many partitions."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tariffbook.llm import common, digests, id_shards
from tariffbook.llm.ranges import ranges_of

BYTE = public_tokenizers.path("byte_bpe_50k.json")


def hashed(text):
    return int(np.array([xxhash.xxh64_intdigest(text.encode(), 42)], np.uint64).view(np.int64)[0])


@pytest.fixture(scope="module")
def rows():
    """A third of the rows has one id, another third none; ids at both ends of their range."""
    out = [(i * 7 - 900, f"text {i}") for i in range(250)] + [(-(2**63), "least"), (2**63 - 1, "greatest")]
    return out + [(50, f"hot {i} " * (i % 4)) for i in range(250)] + [(None, f"none {i}") for i in range(250)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(5)


@pytest.fixture
def partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield lambda n: spark.conf.set("spark.sql.shuffle.partitions", n)
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("count", [1, 2, 12, 300])
def test_ranges_are_in_order_and_even(frame, rows, count):
    ranges = ranges_of(frame, "doc_id", count)
    ordered = sorted(((i is not None, i or 0, hashed(t)), i, hashed(t)) for i, t in rows)
    numbers = ranges.number(pa.array([i for _, i, _ in ordered], pa.int64()), np.array([h for _, _, h in ordered]))
    assert (np.diff(numbers) >= 0).all()
    assert numbers.min() >= 0
    assert numbers.max() < ranges.count <= 2 * count + 2
    if count == 12:
        assert max(Counter(numbers.tolist()).values()) < 2.5 * len(rows) / count
        assert len({n for n, (_, i, _) in zip(numbers, ordered) if i == 50}) >= 3
        assert len({n for n, (_, i, _) in zip(numbers, ordered) if i is None}) >= 3


def test_ranges_of_nothing(spark, frame):
    for none in (frame.limit(0), frame.where("doc_id IS NULL")):
        ranges = ranges_of(none, "doc_id", 7)
        assert ranges.number(pa.array([None, 3], pa.int64()), np.array([-5, 5])).max() < ranges.count


def digest_rows(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), -hashed(r[1])))
    out = Counter()
    for k, (i, text) in enumerate(order):
        after, n = order[(k + 1) % len(order)][1], len(text) // 3
        edited = text[: len(text) - n] + after[:n]
        out[i, hashlib.sha256(edited.encode()).hexdigest(), digests.Digest(text).likeness(digests.Digest(after))] += 1
    return out


def shard_rows(rows):
    tokenizer, out, at = Tokenizer.from_file(BYTE), Counter(), 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashed(r[1]))):
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 0], "<u4")
        out[i, at, len(ids), zlib.crc32(ids.tobytes())] += 1
        at += len(ids)
    return out


@pytest.mark.parametrize("count", [1, 12, 1000])
def test_digests_at_many_partitions(frame, rows, partitions, count):
    partitions(count)
    found = digests.edited_pairs(frame).select("doc_id", "edited_sha256", "near_next")
    assert Counter(tuple(r) for r in found.collect()) == digest_rows(rows)


def test_plans_do_not_grow_with_partitions(frame, partitions):
    sizes = {}
    for count in (12, 5000):
        partitions(count)
        sizes[count] = len(digests.edited_pairs(frame)._jdf.queryExecution().executedPlan().toString())
    assert sizes[5000] < 1.2 * sizes[12]
    ranges = ranges_of(frame, "doc_id", 5000)
    assert ranges.number(pa.array([-(2**63), 50, None], pa.int64()), np.zeros(3, np.int64)).max() < ranges.count


@pytest.mark.parametrize("count", [1, 12, 600])
def test_id_shards_at_many_partitions(spark, frame, rows, partitions, count):
    partitions(count)
    folder = common.new_path(spark, "test-shards")
    id_shards.write(frame, folder, BYTE)
    partitions(8)
    found = id_shards.read_back(spark, folder, frame.select("doc_id"))
    assert Counter(tuple(r) for r in found.collect()) == shard_rows(rows)
    runs = {r["key"]: r["rows"] for r in id_shards.lookup(spark, folder, frame.select("doc_id")).collect()}
    assert runs[50] == 250 + sum(i == 50 for i, _ in rows[:252])
    if count == 12:
        hot = spark.read.parquet(f"{folder}/blocks").where(F.exists("keys", lambda k: k == 50))
        assert hot.select("shard").distinct().count() >= 3
