"""Rotated documents against plain concatenation, and their exact restoration."""

import hashlib
import random
import re
from collections import Counter

import compare
from pyspark.sql import functions as F

from tariffbook.llm import fill_in_middle as fim
from tariffbook.llm import queries

SF = "/root/testdata/sf0.001"


def brute(doc_id, text, percent=100):
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= percent:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
    form = "spm" if h[3] % 100 < 50 else "psm"
    made = f"<P>{prefix}<S>{suffix}<M>{middle}" if form == "psm" else f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, form, len(prefix), len(middle), made


def test_rotation_exchanges_blocks(monkeypatch):
    monkeypatch.setattr(fim, "SWAP", 3)
    pick = random.Random(1)
    for _ in range(300):
        raw = bytes(pick.randrange(256) for _ in range(pick.randrange(40)))
        a, b, c = sorted(pick.randrange(len(raw) + 1) for _ in range(3))
        data = bytearray(raw)
        fim.rotate(data, a, b, c)
        assert bytes(data) == raw[:a] + raw[b:c] + raw[a:b] + raw[c:]
        fim.rotate(data, a, a + c - b, c)
        assert bytes(data) == raw


def test_every_row_and_its_restoration(spark, docs, empty):
    odd = ["\n", "\n\nü\n", "a<P>b\nc", "<M>", "x\r\ny\x0bz w", "é\n" * 5000, "last line\nwithout end"]
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd)] + [(-5, "a\nb\nc"), (None, "a\nb\n")] * 2, "doc_id long, text string")
    rows = docs.select("doc_id", "text", F.col("keep").alias("output")).unionByName(more, allowMissingColumns=True)
    texts = Counter((r["doc_id"], r["text"] or "") for r in rows.collect())
    for percent in (100, 40):
        made = fim.restore(fim.fill_in_middle(rows, fim_percent=percent)).collect()
        assert Counter(tuple(r)[:6] for r in made) == Counter({brute(*k, percent): n for k, n in texts.items()})
        assert Counter((r["doc_id"], r["restored"]) for r in made) == texts
    forms = {r["form"] for r in made}
    assert forms == {"plain", "psm", "spm"}
    assert fim.restore(fim.fill_in_middle(empty)).count() == 0


def test_query_equals_its_sql(spark):
    name = "op12_fill_in_middle"
    with compare.duck(SF) as connection:
        assert compare.differences(queries.QUERIES[name](spark, SF), connection, queries.SQL[name]) == []
