"""Benchmark decontamination by latent semantic retrieval.

Words, in lower case and without marks, are hashed to ``TERMS`` terms, weighted by their inverse document
frequency over the passages of all documents. A randomised SVD of TF-IDF
passages gives a basis of ``RANK`` dimensions: a random projection and
``ROUNDS`` rounds of subspace iteration, each a sum over passages that tasks
make and a shuffle adds up. The basis is the search index: it is fitted on every
passage of every document and on the benchmark's, which weigh ``OWN`` times as
much; more than ``EVEN`` passages of documents weigh as much as ``EVEN`` of them
together, so that items keep their share in a large table. The terms of the
passages are written once, for the weights and all rounds. The search covers
every passage of every document.

A document's words go in blocks of ``BLOCK``; windows are runs of blocks, by
half a window, about as long as the items asked for, so that whole texts are
covered. The latent product of a window and an item is a sum over the window's
words, so a table of terms by items gives it; divided by the TF-IDF lengths of
both it is their cosine. Windows and items that reach ``COSINE`` are candidates;
the words of the window and an item's length beyond it are then compared with
the item by their longest common subsequence. It is a copy from ``COPY`` of the
item's words on, and a paraphrase from ``PARAPHRASE`` on if the item's answer,
its last quarter, is there in order up to ``ANSWER``. The words compared lie
within a stretch of one and a half times the item's length.

Items are asked in blocks of ``ITEMS``, each with its own basis, and ``GROUP``
blocks in one pass over the documents, so a larger benchmark needs no larger
tasks; the first round over the documents is the same for all blocks. Items under ``SHORT`` words have no latent vector worth comparing: their
words are looked up as they stand, in order and without gaps, and nothing less
counts. An item of one word is so in every document that holds that word;
``least`` leaves out items under so many words.

Defined cases: null or empty texts match nothing; repeated rows get equal
results; a null id is kept; items of equal text are searched once and give a row
each; an empty benchmark or table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffbook.llm import wordhash
from tariffbook.llm.common import cleared, release, staged, text_or_empty
from tariffbook.operators.skew import lookup_join

TERMS, RANK, EXTRA, ROUNDS, FIT_DOCS, FIT_TASKS, OWN = 1 << 13, 288, 16, 2, 4_000, 4, 100
EVEN, ROW, PART, COMMON = 1 << 15, 4, 1024, 24  # passages a row of their table, rows worked on at a time
BLOCK, PASSAGE, ITEMS, GROUP, SHORT = 16, 64, 256, 4, 8
COSINE, COPY, PARAPHRASE, ANSWER = 0.33, 0.7, 0.5, 0.6
SLICE, BLOCKS = 256, 1 << 9  # documents and blocks worked on at a time
SCHEMA = "doc_id bigint, item_id bigint, cosine double, overlap double, answer boolean"
FOUND = SCHEMA.replace("item_id", "item")
PASSAGES = ["terms", "counts", "sizes"]
# Blocks of scripts that are written without spaces.
UNSPACED = r"([\x{e00}-\x{e7f}\x{3040}-\x{30ff}\x{3400}-\x{9fff}])"


def plain(texts: pa.Array) -> pa.Array:
    """In lower case, with spaces for marks beyond ASCII and around each sign of a script without spaces.

    Marks are U+0080 to U+00BF but for their letters, and general, CJK and full-width punctuation.
    """
    texts = pc.utf8_lower(texts)
    data, at = wordhash.buffers(texts)
    data = data.copy()
    two, three = np.flatnonzero(data == 0xC2), np.flatnonzero(data >= 0xE0)
    two = two[~np.isin(data[two + 1], [0xAA, 0xB5, 0xBA])]
    lead, second, third = data[three], data[three + 1], data[three + 2]
    unspaced = ((lead == 0xE0) & (second >= 0xB8)) | ((lead == 0xE3) & (second > 0x80)) | ((lead > 0xE3) & (lead < 0xEA))
    mark = ((lead == 0xE2) & (second <= 0x81)) | ((lead == 0xE3) & (second == 0x80))
    three = three[mark | ((lead == 0xEF) & (second == 0xBC) & (third <= 0x8F))]
    for place in (two, two + 1, three, three + 1, three + 2):
        data[place] = 32
    texts = pa.StringArray.from_buffers(len(texts), pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data))
    return pc.replace_substring_regex(texts, UNSPACED, r" \1 ") if unspaced.any() else texts


def words_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of letters and digits, and the number of their text."""
    texts = plain(texts)
    hashes, text, start = wordhash.words(texts)
    if not len(hashes):
        return hashes, text
    data, _ = wordhash.buffers(texts)
    real = wordhash._KIND[data[start]] == 1
    return hashes[real], text[real]


def terms_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - TERMS.bit_length() + 1)).astype(np.int64)


def _groups(text: np.ndarray, size: int) -> np.ndarray:
    """Where the runs of ``size`` words of each text start; ``text`` numbers the words' texts."""
    if not len(text):
        return np.zeros(0, np.int64)
    first = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    place = np.arange(len(text)) - np.repeat(first, np.diff(np.append(first, len(text))))
    return np.flatnonzero(place % size == 0)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), SLICE):
            yield batch.slice(at, SLICE)


def _cut(hashes: np.ndarray, text: np.ndarray) -> pa.RecordBatch:
    """A row for each ``ROW`` passages: their terms, how often each is there, and how many terms each passage has."""
    start = _groups(text, PASSAGE)
    passage = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(text))))
    key, n = np.unique(passage * TERMS + terms_of(hashes), return_counts=True)
    size = np.bincount(key // TERMS, minlength=len(start))
    row = np.append(np.arange(0, len(start), ROW), len(start))
    at = np.append(0, np.cumsum(size))[row]
    columns = ((at * 2, (key % TERMS).astype(np.uint16)), (at, n.astype(np.uint8)), (row, size.astype(np.uint8)))
    arrays = [
        pa.Array.from_buffers(pa.binary(), len(row) - 1, [None, pa.py_buffer(o.astype(np.int32)), pa.py_buffer(data)])
        for o, data in columns
    ]
    return pa.RecordBatch.from_arrays(arrays, PASSAGES)


def _parts(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Terms, their numbers and the passages' sizes, as ``_cut`` gives them, some rows at a time."""
    for at in range(0, len(batch), PART):
        term, n, size = (wordhash.buffers(c.cast(pa.binary()))[0] for c in batch.slice(at, PART).columns)
        yield term.view(np.uint16), n, size


def passages(rows: DataFrame) -> DataFrame:
    """The passages of all documents, written once; a table of them is given back as it is."""
    if rows.columns == PASSAGES:
        return rows

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            yield _cut(*words_of(part.column(1)))
        release()

    return staged(rows.mapInArrow(cut, ", ".join(f"{c} binary" for c in PASSAGES)), "passages")


def weights(rows: DataFrame) -> np.ndarray:
    """Inverse document frequency of each term over the passages of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(TERMS + 1, np.int64)
        for batch in batches:
            for term, _, size in _parts(batch):
                seen[:TERMS] += np.bincount(term, minlength=TERMS)
                seen[TERMS] += len(size)
        release()
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"term": used, "n": seen[used]})

    counts = passages(rows).mapInArrow(count, "term bigint, n bigint")
    sums = counts.groupBy("term").agg(F.sum("n").alias("n")).collect()
    seen = np.zeros(TERMS + 1)
    for r in sums:  # at most one row per term
        seen[r["term"]] = r["n"]
    return (np.log((1 + seen[TERMS]) / (1 + seen[:TERMS])) + 0.1).astype(np.float32)


def _run_sums(table: np.ndarray, at: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The sum of the table's rows ``at`` over each run, longest runs first, a few runs at a time so that they stay in cache."""
    total = np.empty((len(size), table.shape[1]), np.float32)
    row = np.empty((256, table.shape[1]), np.float32)
    for a in range(0, len(size), len(row)):
        some, n, begin = total[a : a + len(row)], size[a : a + len(row)], first[a : a + len(row)]
        for k, live in enumerate(np.searchsorted(-n, -np.arange(max(1, n[0]))).tolist()):
            if k:
                some[:live] += np.take(table, at[begin[:live] + k], axis=0, out=row[:live], mode="clip")
            else:
                np.take(table, at[begin[:live]], axis=0, out=some[:live], mode="clip")
                some[live:] = 0
    return total


def _gram_times(term: np.ndarray, n: np.ndarray, size: np.ndarray, idf: np.ndarray, table: np.ndarray, total: np.ndarray):
    """Adds A'A times the basis to ``total``, but for the terms' weights, which ``table`` has as factors of the basis.

    The rows of A are the passages, of unit length. Terms that more than one of
    ``COMMON`` passages hold are a product of full matrices, the rest a sum over
    single words.
    """
    if not len(size):
        return
    of = np.repeat(np.arange(len(size)), size)
    square = np.bincount(of, weights=(n * idf[term]) ** 2, minlength=len(size))
    usual = np.flatnonzero(np.bincount(term, minlength=TERMS) > len(size) / COMMON)
    column = np.full(TERMS, -1)
    column[usual] = np.arange(len(usual))
    place = column[term]
    full, single = np.flatnonzero(place >= 0), np.flatnonzero(place < 0)
    single = np.repeat(single, n[single])
    word, passage = term[single], of[single]
    words = np.bincount(passage, minlength=len(size))
    order = np.argsort(-words, kind="stable")
    rank = np.empty(len(size), np.int64)
    rank[order] = np.arange(len(size))
    dense = np.zeros((len(size), len(usual)), np.float32)
    dense[rank[of[full]], place[full]] = n[full]
    image = _run_sums(table, word, (np.cumsum(words) - words)[order], words[order])
    image += dense @ table[usual]
    image /= np.maximum(square[order], 1e-9).astype(np.float32)[:, None]
    total[usual] += dense.T @ image
    times = np.bincount(word, minlength=TERMS)
    order = np.argsort(-times, kind="stable")[: np.count_nonzero(times)]
    by_term = rank[passage[np.argsort(word, kind="stable")]]
    total[order] += _run_sums(image, by_term, (np.cumsum(times) - times)[order], times[order])


def _gram(batches: Iterable[pa.RecordBatch], idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """A'A times the basis, where the rows of A are the TF-IDF passages of unit length."""
    table, total = idf[:, None] * basis, np.zeros_like(basis)
    for batch in batches:
        for part in _parts(batch):
            _gram_times(*part, idf, table, total)
    return idf[:, None] * total


def fit_sample(rows: DataFrame) -> DataFrame:
    """At most ``FIT_DOCS`` different rows, the same in any order of the rows, for trial fits; no query cuts its rows so.

    A first cut by the hash leaves about twice as many, copies are one before the
    exact cut, and few tasks hold them, as each of them makes sums of its own.
    """
    share = min(1.0, 2 * FIT_DOCS / max(1, rows.count()))
    chosen = F.xxhash64("doc_id", "text", F.lit("fit"))
    some = rows.withColumn("order", chosen).where(F.col("order") <= min(2**63 - 1, int(-(2**63) + share * 2**64)))
    once = some.groupBy("order").agg(F.min("doc_id").alias("doc_id"), F.min("text").alias("text"))
    return staged(once.orderBy("order").limit(FIT_DOCS).select("doc_id", "text").repartition(FIT_TASKS), "fit")


def random_basis() -> np.ndarray:
    return np.random.default_rng(11).standard_normal((TERMS, RANK + EXTRA)).astype(np.float32)


def products(rows: DataFrame, idf: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """A'A times the basis, where the rows of A are the TF-IDF passages of all documents, which weigh as ``EVEN`` at most."""
    spark, cut, width, chunk = rows.sparkSession, passages(rows), basis.shape[1], 64
    share = min(1.0, EVEN / max(1, cut.agg(F.sum(F.length("sizes"))).first()[0] or 0))
    tasks = cut.rdd.getNumPartitions()  # each makes sums of its own, so small parts of the table are put together
    cut = cut.coalesce(max(2 * spark.sparkContext.defaultParallelism, tasks // 4))
    shared = spark.sparkContext.broadcast((idf, basis))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = _gram(batches, *shared.value)
        at = [i for i in range(0, TERMS, chunk) if total[i : i + chunk].any()]
        sums = pa.array([total[i : i + chunk].tobytes() for i in at], pa.binary())
        del total
        release()
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), sums], ["at", "sums"])

    def add(frame: pd.DataFrame) -> pd.DataFrame:
        total = reduce(np.add, (np.frombuffer(s, np.float32) for s in frame["sums"]))
        return pd.DataFrame({"at": frame["at"].iloc[:1], "sums": [total.tobytes()]})

    added = cut.mapInArrow(run, "at bigint, sums binary").groupBy("at").applyInPandas(add, "at bigint, sums binary")
    total = np.zeros((TERMS, width), np.float32)
    for r in added.collect():  # TERMS times width numbers, a few MB
        total[r["at"] : r["at"] + chunk] = np.frombuffer(r["sums"], np.float32).reshape(-1, width)
    return np.float32(share) * total


def latent_basis(rows: DataFrame, items: pa.Array, idf: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
    """An orthonormal basis, terms by ``RANK``, of the leading right singular vectors of the TF-IDF passages.

    ``first`` has the products with the random basis, which are the same for all items.
    """
    cut, own, basis = passages(rows), _cut(*words_of(items)), random_basis()
    for number in range(ROUNDS):
        total = first if number == 0 and first is not None else products(cut, idf, basis)
        total = total + np.float32(OWN) ** 2 * _gram([own], idf, basis)
        basis = np.linalg.qr(total.astype(np.float64))[0].astype(np.float32)
    return basis[:, :RANK]


class Items:
    """One block of benchmark items, as the tasks need it."""

    def __init__(self, ids: list, texts: pa.Array, idf: np.ndarray, basis: np.ndarray):
        hashes, text = words_of(texts)
        self.ids, self.words, self.masks, self.by_span, self.short = [], [], [], {}, {}
        vectors = idf[:, None] * basis
        bounds = np.searchsorted(text, np.arange(len(ids) + 1))
        for number in range(len(ids)):
            words = hashes[bounds[number] : bounds[number + 1]].tolist()
            if not words:
                continue
            if len(words) < SHORT:
                self.short.setdefault(len(words), {}).setdefault(tuple(words), []).append(ids[number])
                continue
            masks: dict[int, int] = {}
            for place, word in enumerate(words):
                masks[word] = masks.get(word, 0) | 1 << place
            span = 2
            while span * BLOCK < 1.2 * len(words):
                span *= 2
            self.by_span.setdefault(span, []).append(len(self.ids))
            self.ids.append(ids[number])
            self.words.append(words)
            self.masks.append(masks)
        self.square = (idf**2).astype(np.float32)
        columns = [self.square[:, None]]  # terms by their squared weights, and by the items of each span
        for numbers in self.by_span.values():
            terms = [terms_of(np.array(self.words[i], np.uint64)) for i in numbers]
            length = np.array([np.sqrt(self.square[t].sum()) for t in terms])
            latent = np.stack([vectors[t].sum(0) for t in terms]) / length[:, None]
            columns.append((vectors @ latent.T).astype(np.float32))
        self.table = np.concatenate(columns, axis=1)
        self.reach = {i: max(len(self.words[k]) for k in of) for of in self.by_span.values() for i in of}

    def shares(self, number: int, words: set[int]) -> bool:
        """Whether so many of the item's words are among these that it can be a paraphrase."""
        masks = self.masks[number]
        held = reduce(int.__or__, (masks[w] for w in masks.keys() & words), 0)
        return held.bit_count() >= PARAPHRASE * len(self.words[number])

    def judge(self, number: int, region: list[int]) -> tuple[float, bool]:
        """Share of the item's words, and whether its answer, is in the region, in order and close together."""
        masks, size = self.masks[number], len(self.words[number])
        if not self.shares(number, set(region)):
            return 0.0, False
        known = [(place, masks[w]) for place, w in enumerate(region) if w in masks]
        stretch, best, answer = size + size // 2, 0, False
        tail = max(3, size // 4)
        starts = range(0, max(1, len(region) - stretch + max(1, size // 4)), max(1, size // 4))
        for start in starts:
            inside = [m for place, m in known if start <= place < start + stretch]
            if len(inside) < max(best + 1, PARAPHRASE * size):
                continue
            found = common(inside, size)
            if found > best:
                best = found
                answer = common([m >> (size - tail) for m in inside if m >> (size - tail)], tail) >= ANSWER * tail
        return best / size, answer


def common(masks: list[int], size: int) -> int:
    """Length of the longest common subsequence; each mask has the places of a word in a text of ``size`` words."""
    full = (1 << size) - 1
    open_ = full
    for mask in masks:
        met = open_ & mask
        open_ = ((open_ + met) | (open_ - met)) & full
    return size - open_.bit_count()


def search(rows: DataFrame, blocks: list[Items]) -> DataFrame:
    """Rows of documents that hold an item of one of the blocks, in one pass."""
    shared = rows.sparkSession.sparkContext.broadcast(blocks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _slices(batches):
            keys = part.column(0).to_pylist()
            hashes, text = words_of(part.column(1))
            out = []
            for items in shared.value:
                found = leaks(hashes, text, len(keys), items)
                out += [(keys[doc], items.ids[i], *values) for (doc, i), values in found.items()]
                out += [(keys[doc], item, 1.0, 1.0, True) for doc, item in verbatim(hashes, text, items)]
            if out:
                names = ["doc_id", "item", "cosine", "overlap", "answer"]
                kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
        release()

    return rows.mapInArrow(run, FOUND)


def verbatim(hashes: np.ndarray, text: np.ndarray, items: Items) -> set[tuple[int, int]]:
    """Texts and the short items whose words stand in them one after the other."""
    found = set()
    for size, asked in items.short.items():
        rolled = hashes
        for k in range(1, size):
            rolled = wordhash.mix(rolled[:-1] * wordhash.BASE + hashes[k:]) if len(rolled) > 1 else rolled[:0]
        if not len(rolled):
            continue
        keys = []
        for words in asked:
            key = np.array(words[:1], np.uint64)
            for word in words[1:]:
                key = wordhash.mix(key * wordhash.BASE + np.uint64(word))
            keys.append(key)
        for at in np.flatnonzero(np.isin(rolled, np.concatenate(keys))).tolist():
            if text[at] == text[at + size - 1]:
                found.update((int(text[at]), item) for item in asked.get(tuple(hashes[at : at + size].tolist()), ()))
    return found


def candidates(hashes: np.ndarray, text: np.ndarray, items: Items) -> Iterator[tuple[int, int, int, int, float]]:
    """Document, item, first and last word of a window, and cosine, wherever it reaches ``COSINE``."""
    if not len(hashes) or not items.by_span:
        return
    term, start = terms_of(hashes), _groups(text, BLOCK)
    doc, edge = text[start], np.append(start, len(term))
    first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    size = np.diff(np.append(first, len(doc)))
    place, end = np.arange(len(doc)) - np.repeat(first, size), np.repeat(first + size, size)
    most = max(items.by_span)
    step = max(BLOCKS, 8 * most)
    for a in range(0, len(start), step):
        b = min(a + step, len(start))
        last = min(b + most, len(start))
        size = np.diff(edge[a : last + 1])
        order = np.argsort(-size, kind="stable")  # blocks at the end of a text are shorter
        sums = np.zeros((last - a + 1, items.table.shape[1]))
        sums[1 + order] = _run_sums(items.table, term, edge[a:last][order], size[order])
        np.cumsum(sums, axis=0, out=sums)
        column = 1
        for span, numbers in items.by_span.items():
            begin = a + np.flatnonzero(place[a:b] % (span // 2) == 0)
            stop = np.minimum(begin + span, end[begin])
            mine = sums[:, column : column + len(numbers)]
            column += len(numbers)
            length = np.sqrt(np.maximum(sums[stop - a, 0] - sums[begin - a, 0], 1e-9))
            cosine = (mine[stop - a] - mine[begin - a]) / length[:, None]
            for w, i in np.argwhere(cosine >= COSINE).tolist():
                yield int(doc[begin[w]]), numbers[i], int(edge[begin[w]]), int(edge[stop[w]]), float(cosine[w, i])


def leaks(
    hashes: np.ndarray, text: np.ndarray, texts: int, items: Items
) -> dict[tuple[int, int], tuple[float, float, bool]]:
    """Text and number of an item that it holds: cosine, share of the item's words, answer found."""
    bounds = np.searchsorted(text, np.arange(texts + 1))
    found: dict[tuple[int, int], tuple[float, float, bool]] = {}
    seen, near = None, set()
    for doc, i, low, high, cosine in candidates(hashes, text, items):
        if (doc, i) in found and found[doc, i][1] == 1.0:
            continue
        most = items.reach[i]
        if seen != (low, high, most):  # the words that any item may find around the window
            seen, near = (low, high, most), set(hashes[max(low - most, bounds[doc]) : min(high + most, bounds[doc + 1])].tolist())
        if not items.shares(i, near):
            continue
        more = len(items.words[i])
        region = hashes[max(low - more, bounds[doc]) : min(high + more, bounds[doc + 1])].tolist()
        overlap, answer = items.judge(i, region)
        if (overlap >= COPY or (overlap >= PARAPHRASE and answer)) and overlap > found.get((doc, i), (0, 0))[1]:
            found[doc, i] = (cosine, overlap, answer)
    return found


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = 1
) -> DataFrame:
    """``doc_id, item_id, cosine, overlap, answer``: a row for each document that holds a benchmark item."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    asked = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), text_or_empty("text").alias("text"))
    asked = asked.withColumn("item", F.xxhash64("text"))
    distinct = asked.groupBy("item").agg(F.min("text").alias("text"))
    spark, n = docs.sparkSession, distinct.count()
    if not n:
        return spark.createDataFrame([], SCHEMA)
    blocks, made, found = -(-n // ITEMS), [], []
    with cleared(spark):  # of the passages, once all is fitted
        cut = passages(rows)
        idf = weights(cut)
        first = products(cut, idf, random_basis())
        for block in range(blocks):
            mine = distinct.where(F.pmod("item", F.lit(blocks)) == block).collect()  # some ITEMS texts
            texts = pa.array([r["text"] for r in mine], pa.string())
            hashes, number = words_of(texts)
            long = np.flatnonzero(np.bincount(number, minlength=len(mine)) >= least).tolist()
            texts = texts.take(pa.array(long, pa.int64()))
            made.append(Items([mine[k]["item"] for k in long], texts, idf, latent_basis(cut, texts, idf, first)))
            if len(made) == GROUP or block == blocks - 1:
                found.append(search(rows, made))
                made = []
    names = lookup_join(reduce(DataFrame.unionAll, found), asked.select("item", "item_id"), "item")
    return names.select(*(c.split()[0] for c in SCHEMA.split(", ")))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )
