"""SimHash near-duplicates by a byte-position inverted index with count filtering.

Fingerprints of 64 bits that differ in at most three bits share at least five
of their eight positional bytes. The index files each distinct fingerprint under
sets of four positional bytes, chosen so that any five positions hold one of the
sets (both halves, and pairs of pairs of one matching of each half: 14 sets).
Fingerprints of one list are compared: the positional bytes that a pair shares
are tallied, pairs under the guaranteed minimum go, the rest is verified by its
bits. A list that is longer than ``PART`` is dealt into parts, and each pair of
parts is a cell of its own, so that no list is one task's work, nor does any
pair go uncompared. A cell hands on a spanning forest of its links, at most one
row per fingerprint in it.

Equal fingerprints are one class from the start; links hold between classes and
documents get their component by their class.

Defined cases: a null or empty text, or one without words, has fingerprint 0
and is linked like any other; repeated rows get equal results; a null id never
names a component unless it is alone in it, then the component is null; an
empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffbook.llm.common import release, staged, text_or_empty
from tariffbook.llm.components import components
from tariffbook.operators.skew import lookup_join

SHINGLE, DISTANCE, SEED = 3, 3, 42
POSITIONS, PART = 8, 1024
#: The three ways to part four things into two pairs.
MATCHINGS = [((0, 1), (2, 3)), ((0, 2), (1, 3)), ((0, 3), (1, 2))]
SETS = [(0, 1, 2, 3), (4, 5, 6, 7)] + [
    (*low, *(4 + p for p in high)) for matching in MATCHINGS for low, high in product(matching, matching)
]
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(1)


def simhash(text: bytes, n: int = SHINGLE) -> int:
    """The fingerprint as a signed number."""
    found = text.lower().split()
    if not found:
        return 0
    shingles = zip(*(found[i:] for i in range(n))) if len(found) >= n else [found]
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.array([digest(join(s), SEED) for s in shingles], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, n: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            made = pa.array([simhash(t.as_py(), n) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), made], ["doc_id", "fp"])
        release()

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, fp bigint")


def postings(distinct: DataFrame) -> DataFrame:
    """``key, fp``: a row for each set of positions; the key holds the set's number and the bytes there."""
    byte = [F.shiftrightunsigned("fp", 8 * i).bitwiseAND(F.lit(255)) for i in range(POSITIONS)]
    keys = [
        sum((F.shiftleft(byte[p], 8 * j) for j, p in enumerate(positions)), F.lit(number << 32).cast("bigint"))
        for number, positions in enumerate(SETS)
    ]
    return distinct.select(F.explode(F.array(*keys)).alias("key"), "fp")


def _compare(distance: int):
    least_shared = POSITIONS - distance

    def forest(rows: pd.DataFrame) -> pd.DataFrame:
        """Links of the pairs of each cell, as one link per fingerprint to the least of those it is linked with."""
        fp = rows["fp"].to_numpy(np.int64).view(np.uint64)
        cell = (rows[["key", "i", "j"]].ne(rows[["key", "i", "j"]].shift()).any(axis=1)).cumsum().to_numpy()
        root, step, at = np.arange(len(fp)), 1, np.arange(len(fp))
        edges = []
        while len(at):
            at = at[at + step < len(fp)]
            at = at[cell[at] == cell[at + step]]
            different = (fp[at] ^ fp[at + step]).view(np.uint8).reshape(-1, 8)
            tally = (different == 0).sum(1)
            good = (tally >= least_shared) & (BITS[different].sum(1) <= distance)
            edges.append(np.stack([at[good], at[good] + step]))
            step += 1
        a, b = np.concatenate(edges, axis=1) if edges else np.zeros((2, 0), np.int64)
        while True:
            low = np.minimum(root[a], root[b])
            before = root.copy()
            for end in (a, b):
                np.minimum.at(root, root[end], low)
            root = root[root]
            if (root == before).all():
                break
        linked = root != np.arange(len(root))
        signed = fp.view(np.int64)
        return pd.DataFrame({"a": signed[linked], "b": signed[root[linked]]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            last = (frame[["key", "i", "j"]] == frame[["key", "i", "j"]].iloc[-1]).all(axis=1)
            yield forest(frame[~last].reset_index(drop=True))
            rest = frame[last]
        if rest is not None:
            yield forest(rest.reset_index(drop=True))

    return run


def links(distinct: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``a, b``: links between distinct fingerprints, whose components are those of all pairs within the distance."""
    if not 0 <= distance <= 3:
        raise ValueError("the index finds distances up to 3")
    rows = postings(distinct)
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / PART)
    mine = F.pmod(F.xxhash64("fp"), F.col("parts"))
    cells = (
        lookup_join(rows, sizes, "key")
        .select("key", "fp", parts.alias("parts"))
        .select("key", "fp", mine.alias("p"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("q"))
        .select("key", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"), "fp")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "fp")
    )
    return cells.mapInPandas(_compare(distance), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, n: int = SHINGLE, distance: int = DISTANCE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    prints = staged(fingerprints(docs, n, doc_id, text), "simhash")
    classes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(classes.select("fp"), distance), "a", "b")
    joined = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    names = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    named = lookup_join(joined, names, "root").select("fp", "component_id")
    return lookup_join(prints, named, "fp", "left").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
