"""Encoding by tables of words gives the ids of the library, from one entry for each word."""

import random
import tracemalloc
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tariffbook.llm import packing, tokenizing
from tariffbook.llm.tokenizing import KEPT, JsonEncoder, json_encoder

FILES = {"byte": "byte_bpe_50k.json", "word": "word_bpe_49k.json"}
WORDS = ["tariff", "Tariff", "ÉTÉ", "été", "naïve", "x", "ÿ", "µ", "ª", "ß", "don't", "a1", "3,5", "--", "日本", "I", "İ", "ſ", "é"]
MARKS = ["", "", "", ",", ".", "...", "!?", ")", "'s", "'"]


def text(seed):
    pick = random.Random(seed)
    made = ("".join(pick.choice("aeiourstlnéèÀÖß") for _ in range(pick.randint(1, 14))) for _ in range(60))
    words = [pick.choice([word, word.capitalize(), pick.choice(WORDS)]) + pick.choice(MARKS) for word in made]
    return "".join(word + pick.choice([" ", " ", " ", "\n"]) for word in words)[:-1]


@pytest.mark.parametrize("kind", FILES)
def test_ids_are_those_of_the_library(kind):
    path = public_tokenizers.path(FILES[kind])
    whole, encoder = Tokenizer.from_file(path), JsonEncoder(path, kind, "<u2")
    for seed in range(400):
        expected = whole.encode(text(seed), add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text(seed)), "<u2").tolist() == expected, text(seed)


@pytest.mark.parametrize("limit", [1 << 24, 60])
def test_many_texts_at_once_have_the_ids_of_the_library(monkeypatch, limit):
    """Texts that are cut together, those that are encoded on their own, and both in one go, in the given order."""
    monkeypatch.setattr(tokenizing, "LONG", limit)
    path = public_tokenizers.path(FILES["byte"])
    whole, encoder = Tokenizer.from_file(path), JsonEncoder(path, "byte", "<u2")
    odd = ["", " ", "\n", "\n\n", "a  b", "a\n b", " a", "a ", "\na", "a\n", "\x02", "a \x02b", "\x03", "a \x03 b\x02", "a\x85\x85b", "a\u2003\xa0b"]
    odd += ["<|endoftext|>", "a <|endoftext|> b", "a\tb", "a\x0bb", "a\x1c\x1fb", "don't, don't", "日本 日本", "x" * 70, "%", "été\nété, ÉTÉ"]
    texts = [t for seed in range(60) for t in (text(seed), odd[seed % len(odd)])]
    expected = [[*whole.encode(t, add_special_tokens=False).ids, 7] for t in texts]
    for given in (pa.array(texts), pa.array(["first", *texts, "last"])[1:-1], pa.array(texts[::2]), pa.array(odd)):
        found = encoder.encode_all(given, b"\7\0").to_pylist()
        assert [np.frombuffer(ids, "<u2").tolist() for ids in found] == [expected[texts.index(t)] for t in given.to_pylist()]
    assert encoder.encode_all(pa.array([], pa.string())).to_pylist() == []


def test_many_texts_at_once_look_up_each_word_once():
    encoder = JsonEncoder(public_tokenizers.path(FILES["byte"]), "byte", "<u2")
    looked_up = []
    encoder.spaced = type("Table", (), {"__getitem__": lambda _, word: looked_up.append(word) or b""})()
    encoder.encode_all(pa.array(["a tariff, a book", "a tariff, a table"] * 50))
    assert sorted(looked_up) == ["\x02a", "a", "book", "table", "tariff,"]


def test_a_word_has_one_entry_with_marks_and_without():
    encoder = JsonEncoder(public_tokenizers.path(FILES["byte"]), "byte", "<u2")
    encoder.encode("the tariff, the Tariff.\nÉté, book")
    made = []
    encoder.model = type("Model", (), {"tokenize": lambda _, word: made.append(word) or []})()
    encoder.encode("the tariff the Tariff! the tariff...\nÉté! book? book")
    assert made == []
    assert {"tariff", "tariff,", "Tariff"} <= encoder.spaced.keys() and "Été" in encoder.bare


def test_trimmed_tables_give_the_same_ids():
    encoder = JsonEncoder(public_tokenizers.path(FILES["word"]), "word")
    texts = [f"word{k} Some-Thing{k % 7} älter{k}." for k in range(300)]
    before = [encoder.encode(t) for t in texts]
    first = next(iter(encoder.words))
    assert len(encoder.words) > 300
    encoder.trim(100)
    assert len(encoder.words) == 100 and next(iter(encoder.words)) == first
    assert [encoder.encode(t) for t in texts] == before


def test_packing_holds_few_texts_and_gives_its_words_back(spark, monkeypatch):
    """A worker lives on, and an executor's memory is for all stages."""
    path, docs = public_tokenizers.path(FILES["word"]), spark.createDataFrame([], "doc_id bigint, text string")
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, run, schema: run)
    monkeypatch.setattr(packing, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    run, encoder = packing.pack(docs, path), json_encoder(path, "word")
    words = " ".join(f"w{k}" for k in range(KEPT + 1000))
    long = " ".join(["ab" * 500] * 10)
    many = pa.RecordBatch.from_pydict({"doc_id": range(4000), "text": [long] * 4000})  # 40 MB
    sum(len(out) for out in run(iter([many.slice(0, 1)])))
    tracemalloc.start()
    assert sum(sum(out["length"].to_pylist()) for out in run(iter([many]))) == 4000 * len(encoder.encode(long) + b"1234") // 4
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6
    list(run(iter([pa.RecordBatch.from_pydict({"doc_id": [1], "text": [words]})])))
    assert 0 < len(encoder.words) <= KEPT
