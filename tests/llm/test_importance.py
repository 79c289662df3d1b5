"""Ratios, levels and top-k of the quality classifier in plain Python, and in any order of rows."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tariffbook.llm import importance


def spark_hash(doc_id, word):
    first = xxhash.xxh64_intdigest(int(doc_id).to_bytes(8, "little", signed=True), 42)
    return xxhash.xxh64_intdigest(word.encode(), first)


def brute(rows, good):
    """Rows (doc_id, text), ids of good ones; log ratio, worst passage and whether it stays, of every row."""
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    order = {i: signed(spark_hash(i, "sample")) for i in good if any(i == d for d, _ in rows)}
    fit, held = ({i for i in order if order[i] % 2 == odd} for odd in (0, 1))
    raw, target = [Counter(), Counter()], [Counter(), Counter()]
    parts = []
    for doc, text in rows:
        bucket, _, word, _ = importance.features(pa.array([text]))
        parts.append((bucket.tolist(), word.tolist()))
        for kind, found in enumerate((bucket.tolist(), sorted(set(word.tolist())))):
            raw[kind].update(found)
            if doc in fit:
                target[kind].update(found)

    def ratio(kind, x):
        prior = (importance.PRIOR, importance.WORD_PRIOR)[kind]
        expected = raw[kind][x] * (target[kind].total() / max(raw[kind].total(), 1))
        return math.log((target[kind][x] + prior) / (expected + prior))

    out = []
    for (doc, _), (bucket, word) in zip(rows, parts):
        runs = [word[i : i + importance.PASSAGE] for i in range(0, len(word), importance.PASSAGE)]
        worst = min((sum(ratio(1, w) for w in run) for run in runs), default=0.0)
        out.append([doc, sum(ratio(0, b) for b in bucket), worst])
    least = {i: [min(r[k] for r in out if r[0] == i) for k in (1, 2)] for i in held}
    at = lambda values, share: sorted(values)[int(share * (len(values) - 1))]
    level = at([v[0] for v in least.values()], importance.LOSS)
    lowest = at({round(v[1], 9) for v in least.values()}, importance.PASSAGE_LOSS)
    keys = []
    for doc, ratio_of, worst in out:
        uniform = ((spark_hash(doc, "gumbel") >> 11) + 0.5) / (1 << 53)
        keys.append((min(ratio_of - level, worst - lowest), min(ratio_of - level, worst - lowest) - math.log(-math.log(uniform))))
    k = sum(above >= -1e-9 for above, _ in keys)
    cut = sorted((key for _, key in keys), reverse=True)[k - 1]
    return [(doc, ratio_of, worst, key >= cut - 1e-9) for (doc, ratio_of, worst), (_, key) in zip(out, keys)]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(6)
    out = []
    for i in range(160):
        size, low = int(rng.integers(0, 90)), 0 if i < 110 else 60
        words = [f"w{int(w)}" for w in rng.integers(low, low + 90, size)]
        if i % 17 == 0:
            words[3:3] = ["vile", "swine"]
        out.append((i % 140, " ".join(words)))
    return [*out, out[5], (7, out[8][1])]


def test_whole_rows(spark, rows):
    good = [i for i in range(110) if i % 17]
    labels = spark.createDataFrame([(i, 1, 0) for i in good] + [(i, 0, 1) for i in range(0, 110, 17)], "doc_id long, quality int, toxic int")
    expected = sorted(brute(rows, good))
    for seed in (1, 2):
        mixed = [rows[k] for k in np.random.default_rng(seed).permutation(len(rows))]
        judged = importance.resample(spark.createDataFrame(mixed, "doc_id long, text string").repartition(2 + seed), labels)
        found = sorted((r["doc_id"], r["log_ratio"], r["worst"], r["keep"]) for r in judged.collect())
        assert [(d, k) for d, _, _, k in found] == [(d, k) for d, _, _, k in expected]
        assert np.allclose([r[1:3] for r in found], [r[1:3] for r in expected])
    assert 20 < sum(k for *_, k in expected) < len(rows)


def test_level_does_not_depend_on_rows_of_one_id(spark, rows, monkeypatch):
    """Many rows of held-out ids, in two orders: the same rows stay."""
    monkeypatch.setattr(importance, "LABELLED", 10)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    many = [(i % 20, f"{t} {i}") for i, (_, t) in enumerate(rows * 3)]
    kept = []
    for step in (1, -1):
        docs = spark.createDataFrame(many[::step], "doc_id long, text string").repartition(3)
        kept.append(sorted((r["doc_id"], round(r["log_ratio"], 6)) for r in importance.resample(docs, labels).where("keep").collect()))
    assert kept[0] == kept[1]
