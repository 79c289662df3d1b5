import random

import pytest
from pyspark.sql import Row

WORDS = [a + b for a in ("ka", "lo", "mi", "ter", "von", "sha", "él") for b in ("ra", "sen", "ti", "down", "ü", "ly")]


def prose(seed, n):
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + pick.choice(["", "", "", ",", ".\n"]) for _ in range(n)).replace("\n ", "\n")


@pytest.fixture(scope="session")
def texts():
    """Null, empty, odd, long, equal and nearly equal texts."""
    base = prose(1, 300)
    odd = ["", None, "one", "two  spaces\n\nand\tmore ", "</s> <|endoftext|> [INST]", " ", "Der " * 400, "日本語 ünd\x1cso"]
    return [*odd, base, base, base + " end", prose(2, 9000), *(prose(i, 40 + i) for i in range(3, 23))]


@pytest.fixture(scope="session")
def docs(spark, texts):
    """Documents with names that operators use themselves, a repeated row and a null id."""
    rows = [Row(doc_id=i, text=t, keep="k", fp="f", ids="i", shard="s", source="src") for i, t in enumerate(texts)]
    rows += [rows[9], Row(doc_id=None, text=prose(99, 30), keep="k", fp="f", ids="i", shard="s", source="src")]
    schema = "doc_id bigint, text string, keep string, fp string, ids string, shard string, source string"
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
