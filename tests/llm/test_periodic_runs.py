"""Runs against a search of all periods at all places."""

import hashlib
import random
import zlib
from collections import Counter

import compare
import pytest

from tariffbook.llm import periodic_runs as periodic
from tariffbook.llm import queries

SF = "/root/testdata/sf0.001"


def brute_runs(words, length=24, times=3):
    """Stretches that are as long as can be for each period, the least period of each."""
    n, found = len(words), {}
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            start = i
            while i + p < n and words[i] == words[i + p]:
                i += 1
            end = i + p
            if end - start >= max(length, times * p):
                found.setdefault((start, end), p)
    return sorted(((s, e - s, p) for (s, e), p in found.items()), key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    kept = [w for i, w in enumerate(words) if not any(s + p <= i < s + m for s, m, p in runs)]
    said = "".join(f"{s},{m},{p}\n" for s, m, p in runs)
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        hashlib.sha256(said.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest(),
    )


def made_texts(seed, count):
    """Texts of few words, with repeated parts of many shapes, runs within runs and runs side by side."""
    pick = random.Random(seed)

    def some(n, of):
        return [b"w%d" % pick.randrange(of) for _ in range(n)]

    for _ in range(count):
        words = []
        while len(words) < pick.choice([5, 60, 200]):
            kind, of = pick.randrange(4), pick.choice([1, 2, 3, 50])
            if kind == 0:
                words += some(pick.randrange(30), of)
            elif kind == 1:
                part = some(pick.randrange(1, 9), of)
                words += (part * 40)[: pick.randrange(10, 60)]
            elif kind == 2:
                inner = some(pick.randrange(1, 4), of)
                part = (inner * 30)[: pick.randrange(24, 40)] + some(pick.randrange(4), of)
                words += part * pick.randrange(2, 5)
            else:
                words += words[-pick.randrange(1, 20) :] * pick.randrange(1, 5)
        yield words


@pytest.mark.parametrize(("length", "times"), [(24, 3), (6, 2), (9, 3), (2, 2), (30, 5)])
def test_all_runs_are_found(length, times):
    texts = list(made_texts(length + times, 300))
    found = periodic.find_runs(texts, length, times)
    assert found == [brute_runs(words, length, times) for words in texts]
    assert sum(map(bool, found)) > 30


def test_small_alphabets_exhaustively():
    texts = [[b"ab"[int(c) : int(c) + 1] for c in f"{x:011b}"] for x in range(1 << 11)]
    assert periodic.find_runs(texts, 4, 2) == [brute_runs(words, 4, 2) for words in texts]


def test_long_texts():
    """One word over and over, a long period, many starts of one line: no pair of places each."""
    same = [b"x"] * 50_000
    period = [b"%d" % i for i in range(9_000)]
    line = [b"l%d" % i for i in range(20)]
    lines = [w for i in range(3_000) for w in [b"n%d" % i, *line]]
    islands = [w for i in range(1_500) for w in [b"n%d" % i, *[b"a"] * (24 + i % 7)]]
    found = periodic.find_runs([same, period * 4 + period[:5], lines, islands])
    assert found[0] == [(0, 50_000, 1)]
    assert found[1] == [(0, 36_005, 9_000)]
    assert found[2] == []
    assert [(m, p) for _, m, p in found[3]] == [(24 + i % 7, 1) for i in range(1_500)]


def test_rows(spark, docs, empty):
    pick = random.Random(3)
    odd = ["a " * 24, "a " * 23, "\ta\n" * 30, "x\x0by\x0cz " * 12, "\xa0 \x1c " * 30, "ab c " * 40 + "q " + "ab c " * 40]
    odd += [" ".join(pick.choice("abcdef") for _ in range(400)) for _ in range(40)]
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd)] + [(None, odd[0])], "doc_id long, text string")
    rows = docs.where("length(text) < 20000 OR text IS NULL").select("doc_id", "text").unionAll(more)
    expected = Counter(brute_row(r["doc_id"], r["text"]) for r in rows.collect())
    assert sum(n for row, n in expected.items() if row[1]) > 6
    found = periodic.periodic_runs(rows, edit=periodic.repeat_tail)
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert by_id[8]["collapsed"] == " ".join(by_id[8]["collapsed"].split())
    assert periodic.periodic_runs(empty).count() == 0

    class Reader:
        class read:  # noqa: N801
            parquet = staticmethod(lambda path: rows)

    assert Counter(tuple(r) for r in periodic.op13_periodic_runs(Reader, "").collect()) == expected


def test_portions_do_not_change_rows(spark, docs, monkeypatch):
    whole = Counter(map(str, periodic.periodic_runs(docs, edit=periodic.repeat_tail).collect()))
    texts = [(t or "").encode().split() for t in (r["text"] for r in docs.collect())]
    one_by_one = [periodic.find_runs([words])[0] for words in texts]
    assert periodic.find_runs(texts) == one_by_one
    assert sum(whole.values()) == len(texts)


def test_query_equals_its_sql(spark):
    name = "op13_periodic_runs"
    with compare.duck(SF) as connection:
        assert compare.differences(queries.QUERIES[name](spark, SF), connection, queries.SQL[name]) == []
