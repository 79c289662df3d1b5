"""Public tokenizers behind caches of pre-tokens, with the results of encoding whole texts.

A text is cut only where the tokenizer never joins two sides, so that the ids of
the parts, put together, are the ids of the whole. A worker keeps the ids of the
parts it has met in a bounded table. Texts for which the cuts are not certain
(runs of white space, special strings, odd separators) are encoded whole.
"""

from __future__ import annotations

import re
from array import array
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

LIMIT = 500_000  # entries of a cache, some 90 MB; when it is full, the first met quarter stays, which has the common ones
KEPT = 50_000  # entries that stay between tasks, where a task gives the others back
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
PLAIN = re.compile(f"([{LETTERS}]+)([!-&(-/:-@[-`{{-~]*)")
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
ODD_SEPARATORS = re.compile("[\x1c-\x1f]")
BEGIN, END = "\x02", "\x03"  # stand before the first word and after the last where many texts are encoded at once
DOUBLE_SPACE = re.compile(r"\s\s")
ODD = rf"[\s\x0b\x1c-\x1f\x{{85}}\pZ]{{2}}|[{BEGIN}{END}]"  # DOUBLE_SPACE for Arrow, and the signs above
LONG = 1 << 24  # bytes; a longer text is encoded on its own, and no more than these are cut at a time


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies write bytes: printable ones as themselves, the others from 256 on, in order."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


BYTE_LETTERS = _byte_letters()
SHOWN_SPACE = BYTE_LETTERS[ord(" ")]


def _shown(text: str) -> str:
    return text.encode().decode("latin-1").translate(BYTE_LETTERS)


class _Table(dict):
    """Results by pre-token; what is missing is made by ``make`` and kept while there is room."""

    def __init__(self, make, known=(), limit: int = LIMIT):
        super().__init__(known)
        self.make, self.limit, self.kept = make, len(self) + limit, len(self) + limit // 4

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.trim(self.kept)
        value = self[key] = self.make(key)
        return value

    def trim(self, kept: int) -> None:
        """Keeps the first met entries, in a table of their size."""
        if len(self) > kept:
            first = dict(islice(self.items(), kept))
            self.clear()
            self.update(first)


class JsonEncoder:
    """A tokenizers file. ``kind``: ``word`` (white space dropped), ``byte`` (byte-level, white space kept) or ``whole``.

    ``encode`` gives the ids as little-endian unsigned integers of ``dtype``, ``<u2`` or ``<u4``.
    """

    def __init__(self, path: str, kind: str, dtype: str = "<u4"):
        from tokenizers import Tokenizer

        self.tokenizer, self.kind, self.dtype = Tokenizer.from_file(path), kind, dtype
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.size = self.tokenizer.get_vocab_size()
        if self.size > np.iinfo(dtype).max + 1:
            raise ValueError(f"{self.size} ids do not fit {dtype}")
        self.code = {"<u2": "H", "<u4": "I"}[dtype]
        self.model = self.tokenizer.model
        # The letters of a word with marks are looked up as a word of their own, so a table holds both.
        self.words = _Table(self._word, limit=LIMIT * 3 // 2)
        self.spaced = _Table(self._spaced, limit=LIMIT * 3 // 2)
        self.bare = _Table(lambda word: self._part("", word, self.bare))
        self.newline = self.whole("\n") if kind == "byte" else b""

    def pack(self, ids) -> bytes:
        return array(self.code, ids).tobytes()

    def whole(self, text: str) -> bytes:
        return self.pack(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _letters(self, shown: str) -> bytes:
        """Ids of one pre-token, written as byte-level vocabularies do."""
        return array(self.code, [t.id for t in self.model.tokenize(shown)]).tobytes()

    def _word(self, chunk: str) -> bytes:
        if chunk.isascii() and chunk.isalpha() and chunk.islower():
            return self._letters(chunk)
        plain = PLAIN.fullmatch(chunk)
        if not plain:
            return self.whole(chunk)
        letters, marks = plain.groups()
        lower = letters.lower()
        if lower != chunk:
            return self.words[lower] + (self.words[marks] if marks else b"")
        return self._letters(_shown(chunk))

    def _spaced(self, chunk: str) -> bytes:
        """Ids of a word after a space, or of what ``encode_all`` cuts at the begin of a text or line."""
        letters = chunk.rstrip(MARKS)
        if letters.isalpha() and letters.isascii():  # bytes that are written as themselves
            if len(letters) < len(chunk):
                return self.spaced[letters] + self.bare[chunk[len(letters) :]]
            return self._letters(SHOWN_SPACE + chunk)
        first = chunk[:1]
        if first == "\n" or first == BEGIN:
            return (self.newline if first == "\n" else b"") + self.bare[chunk[1:]]
        return self._part(" ", chunk, self.spaced)

    def _part(self, space: str, chunk: str, table: _Table) -> bytes:
        if chunk.isascii() and chunk.isalpha():
            return self._letters(SHOWN_SPACE + chunk if space else chunk)
        plain = PLAIN.fullmatch(chunk)
        if not plain:
            return self.whole(space + chunk)
        letters, marks = plain.groups()
        return table[letters] + self.bare[marks] if marks else self._letters(_shown(space + chunk))

    def trim(self, kept: int = KEPT) -> None:
        """Gives the memory of most entries back: a worker lives on, and other stages need it."""
        for table in (self.words, self.spaced, self.bare):
            table.trim(kept)

    def encode_all(self, texts: pa.Array, end: bytes = b"") -> pa.Array:
        """``encode`` of each text, with ``end`` after it: Arrow cuts the words and puts the ids together, each different word is looked up once."""
        if self.kind != "byte":
            return pa.array([self.encode(t) + end for t in texts.to_pylist()], pa.binary())
        size = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        odd = [pc.match_substring_regex(texts, ODD), *(pc.match_substring(texts, s) for s in self.special)]
        alone = np.logical_or.reduce([size > LONG, *(o.to_numpy(zero_copy_only=False) for o in odd)])
        if alone.any():
            order = np.argsort(np.argsort(alone, kind="stable"))
            others = [self.encode(t) + end for t in texts.filter(pa.array(alone)).to_pylist()]
            together = self.encode_all(texts.filter(pa.array(~alone)), end)
            return pa.concat_arrays([together, pa.array(others, pa.binary())]).take(pa.array(order))
        if len(texts) > 1 and size.sum() > LONG:
            half = len(texts) // 2
            return pa.concat_arrays([self.encode_all(texts[:half], end), self.encode_all(texts[half:], end)])
        lines = pc.replace_substring(texts, "\n", " \n")
        cut = pc.split_pattern(pc.binary_join_element_wise(BEGIN, lines, f" {END}", ""), " ")
        words = cut.values.dictionary_encode()
        ids = [self.spaced[word] if word != END else end for word in words.dictionary.to_numpy(zero_copy_only=False)]
        # The ids of all words side by side: those of a text lie from where its first word begins to where its last ends.
        joined = pa.array(ids, pa.binary()).take(words.indices)
        at = np.append(0, np.cumsum(pc.binary_length(joined).to_numpy())).astype(np.int32)
        bounds = at[cut.offsets.to_numpy()]
        return pa.Array.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(bounds), joined.buffers()[2]])

    def encode(self, text: str) -> bytes:
        if self.kind == "word" and not ODD_SEPARATORS.search(text):
            return b"".join(map(self.words.__getitem__, text.split()))
        if self.kind == "byte" and not DOUBLE_SPACE.search(text) and not any(s in text for s in (BEGIN, *self.special)):
            parts = []
            for line in text.split("\n"):
                words = line.split(" ")
                parts.append(self.bare[words[0]])
                parts.extend(map(self.spaced.__getitem__, words[1:]))
                parts.append(self.newline)
            return b"".join(parts[:-1])
        return self.whole(text)


class PieceCounter:
    """Token counts of a sentencepiece model; ``known`` are lengths of common words made beforehand.

    Pieces hold the space mark only at their begin, but for runs of it, and no
    line end, so lines and words count on their own. ``self.spaced`` counts a
    word after a space, ``self.bare`` a word at the begin of a later line.
    """

    def __init__(self, path: str, known: dict[str, int] | None = None):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.separable = not any("\n" in p or ("▁" in p[1:] and p.strip("▁")) for p in pieces)
        self.spaced = _Table(self.whole, known or ())
        self.bare = _Table(lambda word: self.whole("\n" + word) - 2)

    def whole(self, text: str) -> int:
        return len(self.model.encode(text))

    def count(self, text: str) -> int:
        odd = "  " in text or "▁" in text or text.startswith(" ") or " \n" in text or "\n " in text
        if odd or not self.separable or text.endswith(" ") or text.startswith("\n") or not text:
            return self.whole(text)
        first, *lines = text.split("\n")
        total = sum(map(self.spaced.__getitem__, first.split(" "))) + len(lines)
        for line in lines:
            if line:
                words = line.split(" ")
                total += self.bare[words[0]] + sum(map(self.spaced.__getitem__, words[1:]))
        return total


@lru_cache(maxsize=4)
def json_encoder(path: str, kind: str, dtype: str = "<u4") -> JsonEncoder:
    """One encoder per worker process, with its cache."""
    return JsonEncoder(path, kind, dtype)
