"""The corpus pipeline: stages over the documents table, each a call of one operator.

Stages take out rows, each by a key of its own, so that an id may repeat or be
null: the file a row lies in and its place there, where ``docs`` is read from
Parquet, else a number that is written with the rows. The keys to take out are
written before a stage returns, and what its operator wrote to find them is
removed. Each of the first three returns the columns of ``docs`` as they are,
whatever they are called; the last returns pieces of packed windows. An empty
table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffbook.llm import decontaminate, importance, packing, simhash
from tariffbook.llm.common import cleared, staged
from tariffbook.operators.skew import lookup_join


def _unused(name: str, docs: DataFrame) -> str:
    while name.lower() in (c.lower() for c in docs.columns):
        name += "_"
    return name


def _keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a key of each row, the same in all reads and retries, and the name of its column."""
    row, file, place = (_unused(name, docs) for name in ("_row", "_file", "_place"))
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(place))
    except AnalysisException:  # not read from files as it stands
        return staged(docs.withColumn(row, F.monotonically_increasing_id()), "rows", outlive=True), row
    # One row per file.
    files = placed.select(file).distinct().coalesce(1).withColumn(row, F.shiftleft(F.monotonically_increasing_id(), 40))
    numbered = placed.join(staged(files, "files", outlive=True), file)
    return numbered.select(*(numbered[c] for c in docs.columns), (F.col(row) + F.col(place)).alias(row)), row


def _without(docs: DataFrame, found: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """``docs`` without the rows whose key is in the one column that ``found`` gives for them."""
    with cleared(docs.sparkSession):
        keyed, row = _keyed(docs)
        gone = staged(found(keyed, row).toDF("_gone"), "gone", outlive=True)
    return keyed.join(gone, keyed[row] == gone["_gone"], "left_anti").drop(row)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _without(docs, lambda keyed, row: importance.resample(keyed, labels, row=row).where("NOT keep").select("row"))


def _repeats(keyed: DataFrame, row: str) -> DataFrame:
    """Rows of near-duplicate groups but for one of each: that of the least id, without one last, and of the least key."""
    grouped = staged(simhash.near_duplicates(keyed, doc_id=row).select(F.col("doc_id").alias("_key"), "component_id"), "groups")
    # A group is named by its least key, so most rows, alone in theirs, need no second look.
    shared = grouped.where("_key <> component_id").select("component_id").distinct()
    members = lookup_join(grouped, shared, "component_id")
    ids = keyed.select(F.col(row).alias("_key"), F.col("doc_id").cast("bigint").alias("_id"))
    first = F.min(F.struct(F.col("_id").isNull(), "_id", "_key"))["_key"].alias("_first")
    kept = members.join(ids, "_key").groupBy("component_id").agg(first).select("_first")
    return members.join(kept, F.col("_key") == F.col("_first"), "left_anti").select("_key")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates."""
    return _without(docs, _repeats)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    asked = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _without(docs, lambda keyed, row: decontaminate.decontaminate(keyed, asked, doc_id=row).select("doc_id"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in windows of 2048, with the checksum of their ids."""
    return packing.packed_digest(packing.pack_documents(docs))


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("packing", packed),
]
# Fingerprints, latent search and tokenizers are beyond SQL; tests hold rows of each stage against expected ones.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = staged(docs, "stage")
    return docs
