"""Token counts by a map-side two-tier lookup.

Tier one is a table of the lengths of the most frequent words of the whole
corpus: each task sums its own words and hands on its most frequent ones, the
sums give at most ``ENTRIES`` words, their lengths are made once and broadcast
(``ENTRIES`` words of at most ``LONGEST`` characters, a few MB). Tier two is a
bounded cache in each worker for what the table lacks. Words are never
shuffled by themselves; which words are in the table changes no result.

Defined cases: a null or empty text has 0 bytes and 0 tokens; every row gives
one row, repeated ones and null ids included; an empty table gives an empty
result; other columns of the input are not read.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffbook.llm.common import text_or_empty
from tariffbook.llm.tokenizing import PieceCounter

ENTRIES, LONGEST = 65_536, 64
PER_TASK, HELD = 16_384, 500_000  # words a task hands on, and counts at a time


def _task_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            for line in text.split("\n"):
                counts.update(line.split(" "))
            if len(counts) > HELD:
                counts = Counter(dict(counts.most_common(HELD // 4)))
    top = [(w, n) for w, n in counts.most_common(PER_TASK) if 0 < len(w) <= LONGEST and "▁" not in w]
    yield pa.RecordBatch.from_arrays(
        [pa.array([w for w, _ in top], pa.string()), pa.array([n for _, n in top], pa.int64())], ["word", "n"]
    )


def frequent_lengths(docs: DataFrame, path: str, text: str = "text") -> dict[str, int]:
    """Lengths of the corpus' most frequent words."""
    sums = docs.select(text_or_empty(text).alias("text")).mapInArrow(_task_words, "word string, n bigint")
    top = sums.groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(ENTRIES).collect()
    counter = PieceCounter(path)
    return {row["word"]: counter.whole(row["word"]) for row in top}


@lru_cache(maxsize=2)
def _held(path: str, run: str) -> list[PieceCounter]:
    """The counter of one run in this worker process, once it is made."""
    return []


def _worker_counter(path: str, run: str, table: Broadcast) -> PieceCounter:
    held = _held(path, run)
    if not held:
        held.append(PieceCounter(path, table.value))
    return held[0]


def count_tokens(
    docs: DataFrame, path: str, limit: int = 4096, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row by the sentencepiece model at ``path``."""
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text))
    run = uuid.uuid4().hex

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _worker_counter(path, run, table)
        for batch in batches:
            texts = batch.column(1)
            n = pa.array([counter.count(t) for t in texts.to_pylist()], pa.int64())
            n_bytes = pc.cast(pc.binary_length(texts), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, n], ["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    counted = rows.mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.select("*", (F.col("n_tokens") > limit).alias("over_limit"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
