"""Quality by importance resampling.

Two generative models over hashed n-grams (words and pairs of words in
``BUCKETS`` buckets): one of the raw text, counted over all documents, and one
of the target text, counted over labelled good documents. A document's
importance is the ratio of its probabilities under the two; ``k`` documents are
sampled without replacement in proportion to it by Gumbel top-k: to the log of
the ratio a Gumbel number is added, made from the id, and the ``k`` largest stay.
A long text outweighs a few bad words, so its worst passage counts too: the
least sum over its runs of ``PASSAGE`` words of log ratios of words alone, in
``WORDS`` buckets, where a word counts once a document. Each of the two numbers
has its level, which all but ``LOSS`` of the held-out good documents reach, or
all but ``PASSAGE_LOSS`` of their distinct worst passages, so that copies count
once; sampled is by the lower of both above their level, and ``k`` is the number
of documents that reach both, so the share kept follows the data.

The good documents are parted by a hash of their id: the target model is fitted
on at most ``LABELLED`` of one half, a uniform choice, and the levels are those
of all documents of the other half; all else covers all documents.

Defined cases: a null or empty text has the log ratio 0; repeated rows get the
same numbers; of rows that tie with the k-th all stay; a null id counts as one
more id; without labelled good documents, or in an empty table, all are kept;
other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffbook.llm import wordhash
from tariffbook.llm.common import kth_largest, release, staged, text_or_empty
from tariffbook.operators.skew import lookup_join

BUCKETS, LABELLED, LOSS, PRIOR = 1 << 14, 20_000, 0.005, 5.0
WORDS, PASSAGE, WORD_PRIOR, PASSAGE_LOSS = 1 << 18, 16, 2.0, 0.01
SLICE = 1 << 9  # documents worked on at a time


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - buckets.bit_length() + 1)).astype(np.int64)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all words and word pairs of the texts, the number of their text; the same of the words alone."""
    hashes, text = wordhash.words(texts)[:2]
    two, text_two = wordhash.pairs(hashes, text)
    both = bucket_of(np.concatenate([hashes, two]), BUCKETS)
    return both, np.concatenate([text, text_two]), bucket_of(hashes, WORDS), text


def worst_passages(values: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """The least sum of a run of ``PASSAGE`` words of each of ``n`` texts; 0 without words."""
    worst = np.zeros(n)
    if len(text):
        first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        place = np.arange(len(text)) - np.repeat(first, np.diff(np.append(first, len(text))))
        start = np.flatnonzero(place % PASSAGE == 0)
        worst[text[first]] = np.inf
        np.minimum.at(worst, text[start], np.add.reduceat(values, start))
    return worst


def labelled(labels: DataFrame, docs: DataFrame) -> tuple[list[int], DataFrame]:
    """Ids of good documents that are there, parted by a hash: at most ``LABELLED`` to fit on, and all others."""
    good = labels.where("quality = 1 AND coalesce(toxic, 0) = 0 AND doc_id IS NOT NULL").select("doc_id").distinct()
    there = good.join(docs.select(F.col("doc_id").cast("bigint").alias("doc_id")), "doc_id", "left_semi")
    hashed = there.withColumn("order", F.xxhash64("doc_id", F.lit("sample")))
    fit = hashed.where("order % 2 = 0").orderBy("order", "doc_id").limit(LABELLED).collect()
    return [r["doc_id"] for r in fit], hashed.where("order % 2 <> 0").select("doc_id")


def lower_quantile(df: DataFrame, column: str, share: float) -> float | None:
    """The exact quantile of a column, the lower of two values; None without any."""
    n = df.where(F.col(column).isNotNull()).count()
    return kth_largest(df, column, n - int(share * (n - 1))) if n else None


def log_ratios(rows: DataFrame, fit: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Log of target over raw probability of each bucket of n-grams and of words, drawn towards 0 where little was counted."""
    wanted = rows.sparkSession.sparkContext.broadcast(np.array(sorted(fit), np.int64))
    size = BUCKETS + WORDS  # words have the numbers after the n-grams

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                bucket, text, word, text_word = features(part.column(1))
                once = np.unique(text_word * WORDS + word)
                bucket, text = np.concatenate([bucket, once % WORDS + BUCKETS]), np.concatenate([text, once // WORDS])
                raw += np.bincount(bucket, minlength=size)
                ids = part.column(0)
                chosen = np.isin(ids.fill_null(0).to_numpy(), wanted.value) & ids.is_valid().to_numpy(zero_copy_only=False)
                target += np.bincount(bucket[chosen[text]], minlength=size)
        release()
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_pydict({"bucket": used, "raw": raw[used], "target": target[used]})

    counted = rows.mapInArrow(count, "bucket bigint, raw bigint, target bigint")
    sums = counted.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    raw, target = np.zeros(size), np.zeros(size)
    at = sums["bucket"].to_numpy()  # at most one row per bucket
    raw[at], target[at] = sums["raw"].to_numpy(), sums["target"].to_numpy()

    def ratios(raw: np.ndarray, target: np.ndarray, prior: float) -> np.ndarray:
        expected = raw * (target.sum() / max(raw.sum(), 1))
        return np.log((target + prior) / (expected + prior))

    return ratios(raw[:BUCKETS], target[:BUCKETS], PRIOR), ratios(raw[BUCKETS:], target[BUCKETS:], WORD_PRIOR)


def score(rows: DataFrame, ratios: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    tables = rows.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, alone = tables.value
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                bucket, text, word, text_word = features(part.column(1))
                sums = np.bincount(text, weights=both[bucket], minlength=len(part))
                worst = worst_passages(alone[word], text_word, len(part))
                columns = [part.column(0), *part.columns[2:], pa.array(sums), pa.array(worst)]
                yield pa.RecordBatch.from_arrays(columns, names)
        release()

    names = [c for c in rows.columns if c != "text"] + ["log_ratio", "worst"]
    kinds = [f"{c} bigint" for c in names[:-2]] + ["log_ratio double", "worst double"]
    return rows.mapInArrow(run, ", ".join(kinds))


def resample(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", row: str | None = None
) -> DataFrame:
    """``doc_id, log_ratio, worst, sample_key, keep`` of every row, and as ``row`` the key of rows in the column named so."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    fit, held_out = labelled(labels, rows)
    ratios = log_ratios(rows, fit) if fit else (np.zeros(BUCKETS), np.zeros(WORDS))
    uniform = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit("gumbel")), 11) + 0.5) / F.lit(float(1 << 53))
    carried = [F.col(row).cast("bigint").alias("row")] if row else []
    scored = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"), *carried)
    scored = staged(score(scored, ratios), "importance")
    # The levels are those of all held-out documents: one row for each id, whatever the order and number of its rows.
    least = F.min("log_ratio").alias("log_ratio"), F.min("worst").alias("worst")
    held = staged(lookup_join(scored, held_out, "doc_id").groupBy("doc_id").agg(*least), "held")
    level = lower_quantile(held, "log_ratio", LOSS)
    if level is None:
        key = F.least("log_ratio", "worst") - F.log(-F.log(uniform))
        return scored.withColumn("sample_key", key).withColumn("keep", F.lit(True))
    lowest = lower_quantile(held.select("worst").distinct(), "worst", PASSAGE_LOSS)
    above = F.least(F.col("log_ratio") - F.lit(level), F.col("worst") - F.lit(lowest))
    scored = scored.withColumn("sample_key", above - F.log(-F.log(uniform)))
    k = scored.where(above >= 0).count()
    cut = kth_largest(scored, "sample_key", k)
    return scored.withColumn("keep", F.col("sample_key") >= F.lit(cut))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return resample(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
