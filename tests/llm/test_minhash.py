"""Links and components against all pairs of full sets."""

import random
from collections import Counter

import compare
import numpy as np
import pyarrow as pa
import pytest

from tariffbook.llm import minhash, queries

SF = "/root/testdata/sf0.001"
UPPER = {c: c + 32 for c in range(65, 91)}


def shingles(text, n=5):
    words = (text or "").translate(UPPER)
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if len(words) < n:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def brute(rows, percent=85):
    found = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def head(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(found):
        for j in range(i):
            both = len(a & found[j])
            if a and 100 * both >= percent * (len(a) + len(found[j]) - both):
                group[head(i)] = head(j)
    names = {}
    for i, (key, _) in enumerate(rows):
        if key is not None and found[i]:
            names[head(i)] = min(key, names.get(head(i), key))
    out = Counter()
    for i, (key, _) in enumerate(rows):
        name = names.get(head(i)) if found[i] else key
        out[key, len(found[i]), name, key == name] += 1
    return out


def family(pick, words, changes, count):
    """Copies of one text, each with some words changed; some are near the first one, some only near each other."""
    base = [f"v{pick.randrange(10**6)}" for _ in range(words)]
    for _ in range(count):
        one = list(base)
        for _ in range(pick.randrange(changes + 1)):
            one[pick.randrange(words)] = f"c{pick.randrange(30)}"
        base = one if pick.random() < 0.3 else base
        yield " ".join(one)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_rows(spark, docs, empty):
    pick = random.Random(7)
    made = [t for words, changes in ((30, 2), (60, 2), (150, 5), (700, 16)) for t in family(pick, words, changes, 25)]
    made += ["one two three four", "One TWO\tthree\x0bfour", "one two three four five", "É a b c d e", "é a b c d e", "  "]
    made += [f"same {i % 7} " + "word " * 40 for i in range(30)]
    pick.shuffle(made)
    more = [(1000 + i, t) for i, t in enumerate(made)] + [(None, made[3]), (None, "no id at all here"), (1003, made[4])]
    rows = docs.select("doc_id", "text").unionAll(spark.createDataFrame(more, "doc_id long, text string"))
    found = Counter(tuple(r) for r in minhash.near_duplicates(rows).collect())
    assert found == brute(pairs(rows))
    assert len({name for _, _, name, _ in found}) < len(found) - 60
    assert minhash.near_duplicates(docs).columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert minhash.near_duplicates(empty).count() == 0


def test_a_bucket_with_a_lonely_centre(spark, monkeypatch):
    """The centre of all buckets is linked with nobody; the others, more than a cell holds, are linked in groups."""
    monkeypatch.setattr(minhash, "PART", 16)
    monkeypatch.setattr(minhash, "bands", lambda values: np.zeros(1, np.int64))
    pick = random.Random(2)
    texts = [" ".join(f"x{i}" for i in range(100))] + [t for _ in range(3) for t in family(pick, 120, 4, 40)]
    rows = list(enumerate(texts))
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(tuple(r) for r in found) == brute(rows)


def test_a_hot_group_makes_few_pairs(spark):
    """A third of the rows are copies, another third near copies: a star of each bucket, not all pairs."""
    pick = random.Random(3)
    base = [f"w{i}" for i in range(200)]
    near = []
    for i in range(400):
        one = list(base)
        one[pick.randrange(200)] = f"n{i}"
        near.append(" ".join(one))
    texts = [" ".join(base)] * 400 + near + [" ".join(f"o{i}-{k}" for k in range(50)) for i in range(400)]
    rows = [(i, t, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string").repartition(8)
    stars = minhash.shared_buckets(classes(docs))
    pairs_made = stars.where("node <> centre").select("centre", "node").distinct().count()
    assert pairs_made < 2500
    found = minhash.near_duplicates(docs).collect()
    assert Counter(r["component_id"] for r in found)[0] == 800
    assert sum(r["kept"] for r in found) == 401


def classes(docs):
    from pyspark.sql import functions as F

    rows = minhash.prints(docs).where("node IS NOT NULL").groupBy("node")
    return rows.agg(F.min("doc_id").alias("first"), F.first("n").alias("n"), F.first("bands").alias("bands"))


def test_likeness_by_bins():
    """Bins, once filled, agree about as often as sets are alike; alike sets share a bucket, and bounded bins differ."""
    rng = np.random.default_rng(1)
    for size in (7, 20, 100, 500, 3000):
        agree, met = [], 0
        for _ in range(60):
            pool = np.unique(rng.integers(0, 1 << 63, 4 * size).astype(np.uint64))
            both = int(size * 0.9)
            own = size - both
            a, b = np.sort(pool[: both + own]), np.sort(np.concatenate([pool[:both], pool[-own:]] if own else [pool[:both]]))
            rows = [minhash.densified(*minhash._bins(x, minhash.BINS)) for x in (a, b)]
            agree.append((rows[0] == rows[1]).mean())
            met += bool(set(minhash.bands(a)) & set(minhash.bands(b)))
            differ = np.frombuffer(minhash.sketch(a), np.uint8) != np.frombuffer(minhash.sketch(b), np.uint8)
            assert differ.sum() <= len(np.setxor1d(a, b))
        share = both / (both + 2 * own)
        assert abs(np.mean(agree) - share) < 0.06
        if share >= 0.8:
            assert met == 60


@pytest.mark.parametrize("n", [1, 3, 5])
def test_sets_hold_distinct_shingles(n):
    texts = ["", "a", "a b c d e f", "A b  c\nd e f", "x " * 90, "a b c d", " ".join(map(str, range(3000)))]
    made = list(minhash.sets(pa.array(texts), n))
    assert [len(v) for _, v in made] == [len(shingles(t, n)) for t in texts]
    assert made[2][0] == made[3][0]
    assert made[0][0] is None


def test_query_equals_its_sql(spark):
    name = "op11_minhash_dedup"
    with compare.duck(SF) as connection:
        assert compare.differences(queries.QUERIES[name](spark, SF), connection, queries.SQL[name]) == []


def test_likely_keeps_all_that_are_asked_for(spark):
    from tariffbook.llm.common import likely

    rows = spark.range(-50_000, 50_000).selectExpr("id", "cast(id AS string) AS `odd name`")
    keys = spark.range(-50_000, 50_000, 37).selectExpr("id AS k").unionAll(spark.createDataFrame([(10**12,)], "k long"))
    kept = likely(rows, "id", keys)
    assert kept.columns == rows.columns
    asked = kept.where("(id + 50000) % 37 = 0").count()
    assert asked == keys.count() - 1
    assert kept.count() < asked * 1.2
    assert likely(rows, "id", keys.limit(0)).count() == 0
