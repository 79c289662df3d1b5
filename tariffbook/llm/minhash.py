"""Near-duplicates by one-permutation MinHash, with links confirmed on full sets.

A text's set holds its distinct shingles of five words. One hash of each shingle
gives its bin and its value there; a bin's least value stands for it, and an
empty bin takes the value of the bin that its own sequence of probes meets first
(optimal densification). Bands of ``ROWS`` bins are the buckets of a text.

1. Texts of equal words are one node. Nodes that share a bucket with another one
   are kept, with their buckets.
2. A bucket is a star: its members are paired with its centre, the one of the
   least id, so a bucket of n members gives n - 1 pairs.
3. Pairs are told apart by sketches (a byte for each of 512 bins): sets that are
   alike enough differ in a bounded number of bins, as each shingle that only one
   of them has changes one bin at most; pairs beyond the bound go, and for large
   sets those beyond ``UNLIKE`` bins, eight standard deviations above what is to
   be expected. The others are confirmed on the whole sets; links make components.
4. A bucket whose members are all in one component is done. In the others the
   members that are not the centre are set side by side by their sketches. First
   the pairs of a spanning forest are confirmed, then all that still part
   components.

So no link between texts that share a bucket is lost, and two texts at the
least likeness share none with a probability of 6e-11. Buckets are joined, not
gathered; a large bucket is dealt into cells of parts that are compared in pairs.

Defined cases: a null or empty text, or one without words, has an empty set, is
linked with nothing and is its own component; one with fewer than five words has
its whole sequence as its only shingle; repeated rows come out equal, kept where
one of them is; a null id never names a component, unless there is no other id in
it, then the component is null and its rows are kept; an empty table gives an
empty result; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffbook.llm import wordhash
from tariffbook.llm.common import likely, staged, text_or_empty
from tariffbook.llm.components import components
from tariffbook.operators.skew import lookup_join

SHINGLE, PERCENT = 5, 85
BINS, ROWS = 128, 4
FINE, UNLIKE = 512, 140  # bins of a sketch; expected to differ at the least likeness: 77, deviation 8
PART, SLICE, PROBES = 1024, 512, 64
SEED = np.uint64(0x51ED270B9F2C1A35)


def sets(texts: pa.Array, n: int = SHINGLE) -> Iterator[tuple[bytes | None, np.ndarray]]:
    """Of each text a digest of its words (None without any) and its distinct shingles as sorted hashes."""
    hashes, number, _ = wordhash.words(texts, wordhash.SPACED)
    bounds = np.searchsorted(number, np.arange(len(texts) + 1))
    rolled = hashes
    for k in range(1, n):
        rolled = rolled[:-1] * wordhash.BASE + hashes[k:] if len(rolled) else rolled
    rolled = wordhash.mix(rolled ^ SEED)
    for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        own = hashes[start:end]
        if end - start >= n:
            found = np.unique(rolled[start : end - n + 1])
        else:  # the number of words tells sequences from longer ones
            whole = np.full(int(end > start), len(own), np.uint64)
            for value in own:
                whole = whole * wordhash.BASE + value
            found = wordhash.mix(whole + SEED)
        yield xxhash.xxh3_128_digest(own.tobytes()) if end > start else None, found


def _bins(values: np.ndarray, bins: int) -> tuple[np.ndarray, np.ndarray]:
    """The least of sorted hashes in each bin, told by their first bits, and which bins hold any."""
    edges = np.arange(bins, dtype=np.uint64) << np.uint64(64 - (bins.bit_length() - 1))
    first = np.searchsorted(values, edges)
    full = first < np.append(first[1:], len(values))
    return values[np.minimum(first, len(values) - 1)], full


@lru_cache(maxsize=64)
def _probes(block: int) -> np.ndarray:
    """Further bins that each bin tries: ``PROBES`` of them, the same for all texts."""
    tries = np.arange(BINS, dtype=np.uint64)[:, None] * np.uint64(1 << 32) + np.arange(PROBES, dtype=np.uint64)
    return (wordhash.mix(tries + np.uint64(block * PROBES) + SEED) % np.uint64(BINS)).astype(np.int64)


def densified(least: np.ndarray, full: np.ndarray) -> np.ndarray:
    """``least`` with the values of empty bins taken from the first full bin that each of them tries."""
    out, left, block = least.copy(), np.flatnonzero(~full), 0
    while len(left):
        tried = _probes(block)[left]
        hit = full[tried]
        found = hit.any(axis=1)
        out[left[found]] = least[tried[found, hit[found].argmax(axis=1)]]
        left, block = left[~found], block + 1
    return out


def bands(values: np.ndarray) -> np.ndarray:
    """The buckets of a set: a key for each band of ``ROWS`` bins."""
    rows = densified(*_bins(values, BINS)).reshape(-1, ROWS)
    keys = np.arange(len(rows), dtype=np.uint64)
    for k in range(ROWS):
        keys = wordhash.mix(keys * wordhash.BASE + rows[:, k])
    return keys.view(np.int64)


def sketch(values: np.ndarray) -> bytes:
    """A byte for each of ``FINE`` bins, 0 for an empty one."""
    least, full = _bins(values, FINE)
    return np.where(full, least % np.uint64(255) + np.uint64(1), 0).astype(np.uint8).tobytes()


def _texts(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            yield batch.slice(at, SLICE)


def _lists(found: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, found)]).astype(np.int32)
    values = np.concatenate(found) if found else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int64()))


def prints(docs: DataFrame, shingle: int = SHINGLE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, node, n, bands`` of every row; ``node`` is null and ``bands`` empty without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            nodes, sizes, keys = [], [], []
            for node, values in sets(batch.column(1), shingle):
                nodes.append(node)
                sizes.append(len(values))
                keys.append(bands(values) if len(values) else np.zeros(0, np.int64))
            arrays = [batch.column(0), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), _lists(keys)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "node", "n", "bands"])

    return _texts(docs, doc_id, text).mapInArrow(run, "doc_id bigint, node binary, n bigint, bands array<bigint>")


def full_sets(rows: DataFrame, shingle: int) -> DataFrame:
    """``node, shingles, sketch`` of rows ``doc_id, text`` that have words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            made = [(node, values) for node, values in sets(batch.column(1), shingle) if node is not None]
            arrays = [
                pa.array([node for node, _ in made], pa.binary()),
                _lists([values.view(np.int64) for _, values in made]),
                pa.array([sketch(values) for _, values in made], pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["node", "shingles", "sketch"])

    return rows.select("doc_id", "text").mapInArrow(run, "node binary, shingles array<bigint>, sketch binary")


def shared_buckets(classes: DataFrame) -> DataFrame:
    """``key, node, first, n, members, centre, centre_n`` for the buckets of more than one node.

    ``first`` is the least id of a node; the centre is the node of the least one.
    """
    postings = classes.select(F.explode("bands").alias("key"), "node", "first", "n")
    counts = staged(postings.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "counts")
    shared = staged(lookup_join(likely(postings, "key", counts), counts, "key"), "buckets")
    least = F.min(F.struct(F.col("first").isNull().alias("nameless"), "first", "node", "n")).alias("least")
    centres = shared.groupBy("key").agg(least).select("key", F.col("least.node").alias("centre"), F.col("least.n").alias("centre_n"))
    return staged(lookup_join(shared, centres, "key"), "stars")


def _within(sizes: np.ndarray, differ: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of so many shingles together, whose sketches differ in so many bins, may be alike enough."""
    return differ <= np.minimum(sizes * (100 - percent) // (100 + percent), UNLIKE)


def by_sketch(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs ``a, b, sizes`` that may be alike enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            one, two = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint8).reshape(-1, FINE) for k in (3, 4))
            good = _within(batch.column(2).to_numpy(), (one != two).sum(axis=1), percent)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    for side in ("b", "a"):
        pairs = lookup_join(pairs, sketches.select(F.col("node").alias(side), F.col("sketch").alias(f"of_{side}")), side)
    return pairs.select("a", "b", "sizes", "of_a", "of_b").mapInArrow(run, "a binary, b binary")


def confirmed(pairs: DataFrame, made: DataFrame, percent: int) -> DataFrame:
    """``a, b``: the pairs that are alike enough by their full sets. Each side is a join that can be split."""
    asked = pairs.select("a").unionAll(pairs.select("b")).distinct()
    kept = likely(made.select("node", "shingles"), "node", asked)
    whole = staged(kept.groupBy("node").agg(F.first("shingles").alias("shingles")), "sets")
    mine = whole.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    theirs = whole.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    found = lookup_join(lookup_join(pairs, mine, "b"), theirs, "a")
    both, sizes = F.size(F.array_intersect("of_a", "of_b")), F.size("of_a") + F.size("of_b")
    return found.where(100 * both >= percent * (sizes - both)).select("a", "b")


def _compare(percent: int, forest: bool):
    """Pairs of each cell in other components that may be alike; only a spanning forest of the likest if ``forest``."""

    def spanning(a: np.ndarray, b: np.ndarray, differ: np.ndarray, root: np.ndarray) -> np.ndarray:
        heads = {}

        def head(x):
            while heads.setdefault(x, x) != x:
                heads[x] = x = heads[heads[x]]
            return x

        kept = []
        for k in np.argsort(differ, kind="stable").tolist():
            x, y = head(root[a[k]]), head(root[b[k]])
            if x != y:
                heads[x] = y
                kept.append(k)
        return np.array(kept, np.int64)

    def cells(rows: pd.DataFrame) -> pd.DataFrame:
        cell = (rows[["key", "i", "j"]].ne(rows[["key", "i", "j"]].shift()).any(axis=1)).cumsum().to_numpy()
        size = rows["n"].to_numpy(np.int64)
        root = pd.factorize(rows["root"])[0]
        bins = np.frombuffer(b"".join(rows["sketch"]), np.uint8).reshape(len(rows), -1)
        at, step, found = np.arange(len(rows)), 1, []
        while len(at):
            at = at[at + step < len(rows)]
            at = at[cell[at] == cell[at + step]]
            less, more = np.minimum(size[at], size[at + step]), np.maximum(size[at], size[at + step])
            some = at[(root[at] != root[at + step]) & (100 * less >= percent * more)]
            for begin in range(0, len(some), 4096):
                one = some[begin : begin + 4096]
                differ = (bins[one] != bins[one + step]).sum(axis=1)
                good = _within(size[one] + size[one + step], differ, percent)
                found.append((one[good], one[good] + step, differ[good]))
            step += 1
        a, b, differ = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 3
        if forest and len(a):
            kept = [np.flatnonzero(cell[a] == c) for c in np.unique(cell[a])]
            kept = np.concatenate([k[spanning(a[k], b[k], differ[k], root)] for k in kept])
            a, b = a[kept], b[kept]
        node = rows["node"].to_numpy()
        return pd.DataFrame({"a": node[a], "b": node[b]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for frame in frames:
            frame = frame if rest is None else pd.concat([rest, frame], ignore_index=True)
            last = (frame[["key", "i", "j"]] == frame[["key", "i", "j"]].iloc[-1]).all(axis=1)
            yield cells(frame[~last].reset_index(drop=True))
            rest = frame[last]
        if rest is not None:
            yield cells(rest.reset_index(drop=True))

    return run


def parted_pairs(stars: DataFrame, roots: DataFrame, sketches: DataFrame, percent: int, forest: bool) -> DataFrame:
    """``a, b``: pairs of one bucket, neither its centre, that lie in different components and may be alike."""
    others = stars.where("members > 2")
    rooted = lookup_join(others, roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    parted = rooted.groupBy("key").agg(F.min("root").alias("one"), F.max("root").alias("two")).where("one <> two")
    rows = lookup_join(rooted.where("node <> centre"), parted.select("key"), "key")
    rows = lookup_join(rows.select("key", "node", "n", "root", "members"), sketches, "node")
    parts = F.ceil(F.col("members") / PART)
    dealt = (
        rows.withColumn("parts", parts)
        .withColumn("p", F.pmod(F.xxhash64("node"), F.col("parts")))
        .withColumn("q", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
        .select("key", F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"), "node", "n", "root", "sketch")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j", "node")
    )
    found = dealt.mapInPandas(_compare(percent, forest), "a binary, b binary")
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row."""
    if not 50 < percent <= 100:
        raise ValueError("bands and bounds are made for likenesses over a half")
    rows = staged(prints(docs, shingle, doc_id, text), "prints")
    classes = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("bands").alias("bands")
    )
    classes = staged(classes, "nodes")
    stars = shared_buckets(classes)

    # Texts of shared buckets only; a repeated id may bring others along, which no pair asks for.
    asked = stars.select(F.coalesce("first", F.lit(-1)).alias("asked")).distinct()
    texts = _texts(docs, doc_id, text).withColumn("asked", F.coalesce("doc_id", F.lit(-1)))
    # Ids asked for are distinct; a semi join would be moved in front of the filter and shuffle all texts.
    made = staged(full_sets(lookup_join(likely(texts, "asked", asked), asked, "asked"), shingle), "made")
    sketches = staged(made.groupBy("node").agg(F.first("sketch").alias("sketch")), "sketches")

    least, most, sizes = F.least("n", "centre_n"), F.greatest("n", "centre_n"), F.col("n") + F.col("centre_n")
    pairs = stars.where((F.col("node") != F.col("centre")) & (100 * least >= percent * most))
    pairs = pairs.select(F.col("centre").alias("a"), F.col("node").alias("b"), sizes.alias("sizes")).distinct()
    pairs = staged(by_sketch(pairs, sketches, percent), "pairs")
    links = staged(confirmed(pairs, made, percent), "links")
    roots = components(links, "a", "b")
    for forest in (True, False):
        pairs = staged(parted_pairs(stars, roots, sketches, percent, forest), "pairs")
        more = staged(confirmed(pairs, made, percent), "links")
        if not more.isEmpty():
            links = links.unionAll(more)
            roots = components(links, "a", "b")

    named = lookup_join(classes.select("node", "first"), roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = named.groupBy("root").agg(F.min("first").alias("component_id"))
    named = lookup_join(named, names, "root").select("node", "component_id")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")
    whole = lookup_join(rows.select("doc_id", "node", "n"), named, "node", "left")
    return whole.select("doc_id", F.col("n").alias("n_shingles"), component).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


# All pairs of documents that share a shingle.
OP11_SQL = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)] END) AS s
    FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS hits FROM shingles x JOIN shingles y ON x.s = y.s
    WHERE x.doc_id < y.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * hits >= 85 * (x.n + y.n - hits)),
steps AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(a, b) AS (
    SELECT doc_id, doc_id FROM documents UNION SELECT r.a, s.b FROM reached r JOIN steps s ON r.b = s.a),
named AS (SELECT a AS doc_id, min(b) AS component_id FROM reached GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept
FROM named LEFT JOIN sizes USING (doc_id)"""
