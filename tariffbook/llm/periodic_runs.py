"""Runs of periodic words in documents, found as maximal pairs of a word suffix tree.

A run is a stretch of words with a smallest period, at least ``LENGTH`` words and
``TIMES`` periods long, that no neighbouring word extends. Words are numbered,
suffixes sorted by prefix doubling, and the tree of LCP intervals is walked from
the bottom up. Each interval holds the places of its suffixes in lists by the
word to their left. Where two children meet in an interval of common length
``m``, a place of each, with other words to their left, is a maximal pair: what
follows them is equal for ``m`` words and not a word longer on either side. A
pair at a distance of at most ``m / (TIMES - 1)`` is a run as it stands, from
the first place to the end of the second match, and needs no extension; a run
turns up once for each multiple of its period, and the least distance is it.

Only pairs with a common length of two thirds of ``LENGTH`` can be runs. So
texts in which no such stretch of words occurs twice, told by hashes of
stretches of words, need no suffixes, and shorter matches are not looked at.
Hashes only rule texts out; the words themselves are compared.

Documents are worked on some hundred at a time, each whole, with no shuffle;
memory is that of a few arrays as long as their words.

Defined cases: a null or empty text, or one of white space, has no words and no
runs, and collapses to the empty text; repeated rows come out equal; a null id
stays null; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffbook.llm.common import text_or_empty
from tariffbook.llm.wordhash import mix

LENGTH, TIMES = 24, 3
ROWS, WORDS = 512, 1 << 18  # rows and, but for a single longer text, words worked on at a time
FEW = 8  # up to so many lists are searched one by one
Run = tuple[int, int, int]  # start, length, period


def _least_match(length: int, times: int) -> int:
    """The shortest common length of a maximal pair that is a run."""
    return -(-length * (times - 1) // times)


def _repeating(texts: list[list[bytes]], stretch: int) -> list[int]:
    """Numbers of the texts in which a stretch of words may occur twice; ``stretch`` is a power of two."""
    lengths = np.array([len(words) for words in texts], np.int64)
    ends = np.cumsum(lengths)
    x = mix(np.concatenate([np.fromiter(map(hash, words), np.int64, len(words)) for words in texts]).view(np.uint64))
    width = 1
    while width < stretch:
        if len(x) <= width:
            return []
        x = mix(x[:-width] + x[width:] * np.uint64(0x9E3779B97F4A7C15))
        width *= 2
    text = np.repeat(np.arange(len(texts)), lengths)[: len(x)]
    inside = np.arange(len(x)) + width <= ends[text]
    x, text = (x ^ mix(text.astype(np.uint64) + np.uint64(1)))[inside], text[inside]
    order = np.argsort(x, kind="stable")
    again = np.flatnonzero(x[order][1:] == x[order][:-1])
    return np.unique(text[order[again]]).tolist()


def _suffixes(t: np.ndarray, stretch: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``t`` in order, and a number for each place that equal stretches there share.

    Only suffixes that are not yet told apart are sorted again, by twice as many
    words each time.
    """
    m = len(t)
    sa = np.argsort(t, kind="stable")
    key, slots, rank, stretches, width = t[sa], np.arange(m), np.empty(m, np.int64), None, 1
    while True:
        new = np.ones(len(key), bool)
        np.not_equal(key[1:], key[:-1], out=new[1:])
        rank[sa[slots]] = slots[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
        if width == stretch:
            stretches = rank.copy()
        single = new.copy()
        single[:-1] &= new[1:]
        slots = slots[~single]
        if not len(slots):
            return sa, rank if stretches is None else stretches
        places = sa[slots]
        key = rank[places] * m + rank[places + width]
        order = np.argsort(key, kind="stable")
        sa[slots], key = places[order], key[order]
        width *= 2


def _common(t: np.ndarray, i: int, j: int, known: int) -> int:
    """How many symbols from places ``i`` and ``j`` on are equal; ``known`` of them are."""
    step = 64
    while True:
        a, b = t[i + known : i + known + step], t[j + known : j + known + step]
        n = min(len(a), len(b))
        other = np.flatnonzero(a[:n] != b[:n])
        if len(other):
            return known + int(other[0])
        known, step = known + n, 2 * step


def _matches(t: np.ndarray, sa: np.ndarray, same: np.ndarray, stretch: int) -> np.ndarray:
    """Common lengths of suffixes that are neighbours in order, where ``same`` says that they share a stretch.

    Only pairs with other symbols to their left are compared; the pair one place
    further on has one symbol less in common, and so on.
    """
    out = np.zeros(len(sa), np.int64)
    slots = np.flatnonzero(same) + 1
    slots = slots[np.argsort(sa[slots])]
    place, before = sa[slots], sa[slots - 1]
    first = t[place - 1] != t[before - 1]
    known = np.zeros(len(slots), np.int64)
    for k in np.flatnonzero(first).tolist():
        known[k] = _common(t, int(place[k]), int(before[k]), stretch)
    last = np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))
    out[slots] = known[last] - (place - place[last])
    return out


def _pairs(places: list[int], matches: list[int], left: list[int], length: int, times: int, found: dict) -> None:
    """Runs from the interval tree over suffixes at ``places``, ``matches[k]`` common to those at k - 1 and k.

    ``found`` gets the least distance by start and end. A node holds all its
    places in order, and lists of them by the symbol to their left.
    """

    def leaf(place: int) -> tuple[list[int], dict[int, list[int]]]:
        return [place], {left[place]: [place]}

    def pair(x: int, y: int, match: int) -> None:
        distance = abs(x - y)
        if match + distance >= length:
            run = (min(x, y), max(x, y) + match)
            if found.get(run, distance) >= distance:
                found[run] = distance

    def join(a: tuple, b: tuple, match: int) -> tuple:
        if len(a[0]) < len(b[0]):
            a, b = b, a
        places, lists = a
        reach = match // (times - 1)
        for symbol, smaller in b[1].items():
            for x in () if len(lists) == 1 and symbol in lists else smaller:
                at = bisect_left(places, x - reach)
                if at == len(places) or places[at] > x + reach:
                    continue
                if len(lists) <= FEW:
                    for other, mine in lists.items():
                        if other != symbol:
                            for k in range(bisect_left(mine, x - reach), len(mine)):
                                if mine[k] > x + reach:
                                    break
                                pair(x, mine[k], match)
                else:
                    for k in range(at, len(places)):
                        if places[k] > x + reach:
                            break
                        if left[places[k]] != symbol:
                            pair(x, places[k], match)
        for symbol, smaller in b[1].items():
            mine = lists.setdefault(symbol, [])
            for x in smaller:
                insort(places, x)
                insort(mine, x)
        return a

    stack, node = [], leaf(places[0])
    for place, match in zip(places[1:], matches[1:]):
        while stack and stack[-1][0] > match:
            above, first = stack.pop()
            node = join(first, node, above)
        if stack and stack[-1][0] == match:
            stack[-1][1] = join(stack[-1][1], node, match)
        else:
            stack.append([match, node])
        node = leaf(place)
    while stack:
        above, first = stack.pop()
        node = join(first, node, above)


def find_runs(texts: list[list[bytes]], length: int = LENGTH, times: int = TIMES) -> list[list[Run]]:
    """The runs of each text, given as its words, by start and period."""
    out: list[list[Run]] = [[] for _ in texts]
    least = _least_match(length, times)
    stretch = 1 << (least.bit_length() - 1)
    numbers = _repeating(texts, stretch) if any(texts) else []
    if not numbers:
        return out
    # The texts one after the other, each with symbols of its own, a symbol that occurs nowhere else before and after it.
    symbols, starts, size = [np.zeros(1, np.int64)], [], len(numbers) + 1
    for count, number in enumerate(numbers):
        known: dict[bytes, int] = {}
        ids = np.fromiter((known.setdefault(w, len(known)) for w in texts[number]), np.int64, len(texts[number]))
        symbols += [ids + size, np.array([count + 1])]
        size += len(known)
        starts.append(sum(map(len, symbols[:1])) if count == 0 else starts[-1] + len(texts[numbers[count - 1]]) + 1)
    t = np.concatenate(symbols)
    sa, stretches = _suffixes(t, stretch)
    matches = _matches(t, sa, stretches[sa[1:]] == stretches[sa[:-1]], stretch)
    long = np.append(matches >= least, False)
    begins = np.flatnonzero(~long[:-1] & long[1:])
    ends = np.flatnonzero(long[:-1] & ~long[1:])
    left = np.concatenate([t[:1], t[:-1]]).tolist()
    found: dict[tuple[int, int], int] = {}
    for a, b in zip(begins.tolist(), ends.tolist()):
        _pairs(sa[a : b + 1].tolist(), matches[a : b + 1].tolist(), left, length, times, found)
    at = np.searchsorted(starts, [start for start, _ in found], "right") - 1
    for (start, end), period, k in zip(found, found.values(), at.tolist()):
        out[numbers[k]].append((start - starts[k], end - start, period))
    for runs in out:
        runs.sort(key=lambda run: (run[0], run[2]))
    return out


def collapse(words: list[bytes], runs: list[Run]) -> bytes:
    """The words in no run, or in the first period of each run that holds them, with single spaces."""
    if not runs:
        return b" ".join(words)
    kept = bytearray(b"\x01") * len(words)
    for start, length, period in runs:
        kept[start + period : start + length] = bytes(length - period)
    return b" ".join(compress(words, kept))


RUNS_SCHEMA = (
    "doc_id bigint, n_words bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string"
)
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _portions(batch: pa.RecordBatch, edit: Callable | None) -> Iterator[tuple[int, list[list[bytes]]]]:
    """Rows of a batch as words, with the number of the first of them, a bounded number of words at a time."""
    for first in range(0, len(batch), ROWS):
        part = batch.slice(first, ROWS)
        texts, held, start = [], 0, first
        for key, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist()):
            words = text.split()  # of bytes: at ASCII white space
            words = words if edit is None else edit(key, words)
            if texts and held + len(words) > WORDS:
                yield start, texts
                texts, held, start = [], 0, start + len(texts)
            texts.append(words)
            held += len(words)
        yield start, texts


def periodic_runs(
    docs: DataFrame, length: int = LENGTH, times: int = TIMES,
    edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` of every row; ``edit`` may change a row's words beforehand.

    ``runs`` are (start, length, period) in words, by start and period.
    """
    if length < 2 or times < 2:
        raise ValueError("a run is at least two words and two periods long")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_words", "runs", "collapsed"]
        for batch in batches:
            for first, texts in _portions(batch, edit):
                found = find_runs(texts, length, times)
                rows = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs in found]
                short = pa.array([collapse(w, r) for w, r in zip(texts, found)], pa.binary()).cast(pa.string())
                counts = pa.array([len(w) for w in texts], pa.int64())
                ids = batch.column(0).slice(first, len(texts))
                yield pa.RecordBatch.from_arrays([ids, counts, pa.array(rows, _RUNS), short], names)

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(scan, RUNS_SCHEMA)


def repeat_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a tenth of all documents, by a hash of the id, with a part repeated up to the end."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a : a + p]
    return words[:a] + (part * -(-(n - a) // p))[: n - a]


def _greatest(runs: Column) -> Column:
    """The run of the greatest exponent, the first of equals in order; null without runs."""
    nothing = F.lit(None).cast("struct<start: bigint, length: bigint, period: bigint>")
    more = lambda best, run: run["length"] * best["period"] > best["length"] * run["period"]
    return F.reduce(runs, nothing, lambda best, run: F.when(best.isNull() | more(best, run), run).otherwise(best))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, a tenth of them with a repeated tail; runs and collapsed text as sha256."""
    found = periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), edit=repeat_tail)
    line = lambda r: F.concat_ws("", r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    best = found.withColumn("best", _greatest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        sha(F.array_join(F.transform("runs", line), "")).alias("runs_sha256"), sha(F.col("collapsed")).alias("collapsed_sha256"),
    )


# All equal words of a document at each distance, as stretches; crc32 bit by bit.
OP13_SQL = r"""
WITH split AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
        flatten([[ord(c), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]) AS steps
    FROM documents),
hashed AS (
    SELECT doc_id, words, CAST(len(words) AS BIGINT) AS n,
        xor(list_reduce(list_concat([4294967295], steps), lambda c, x:
            CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295) AS h
    FROM split),
parts AS (SELECT *, (h // 10) % n AS a, 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) AS p FROM hashed),
edited AS (
    SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
        THEN [words[1 + CASE WHEN i >= a THEN a + (i - a) % p ELSE i END] FOR i IN range(n)] ELSE words END AS words
    FROM parts),
placed AS (SELECT doc_id, n, unnest(range(n)) AS i, unnest(words) AS word FROM edited),
equal_words AS (
    SELECT x.doc_id, x.i, y.i - x.i AS p FROM placed x JOIN placed y
    ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
stretches AS (
    SELECT doc_id, p, min(i) AS start, count(*) AS matched
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, p ORDER BY i) AS island FROM equal_words)
    GROUP BY doc_id, p, island HAVING count(*) >= 2 * p AND count(*) + p >= 24),
runs AS (SELECT doc_id, start, matched + p AS length, min(p) AS period FROM stretches GROUP BY ALL),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS collapsed FROM placed w
    WHERE NOT EXISTS (SELECT 1 FROM runs r WHERE r.doc_id = w.doc_id AND i >= start + period AND i < start + length)
    GROUP BY doc_id),
listed AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS said
    FROM runs GROUP BY doc_id),
best AS (
    SELECT * FROM runs QUALIFY row_number() OVER (
        PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / period DESC, start, period) = 1)
SELECT d.doc_id, CAST(coalesce(n_runs, 0) AS BIGINT) AS n_runs, CAST(start AS BIGINT) AS start,
    CAST(length AS BIGINT) AS length, CAST(period AS BIGINT) AS period,
    CAST((1000 * length) // period AS BIGINT) AS exponent_milli,
    sha256(coalesce(said, '')) AS runs_sha256, sha256(coalesce(collapsed, '')) AS collapsed_sha256
FROM documents d LEFT JOIN kept USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id)"""
