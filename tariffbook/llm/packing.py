"""Sum-of-squares online packing of token ids into windows of fixed capacity.

A document longer than a window is cut into full windows; what is left of it,
and every shorter document, is placed online: of all fill levels it fits on, it
goes to the one that leaves the least sum over the levels of the squared number
of windows partially filled to it. The counts are kept in an array by level.
Each input partition packs for itself, without a shuffle, and closes by cutting
the pieces of its emptiest open windows to fill the others, so that at most one
window of a partition is padded. Open windows held at a time are bounded: beyond
``MAX_OPEN`` they are closed in the same way.

The result depends on how the input is split and ordered, as a file scan gives
it; a repeated task gets the same rows and so gives the same windows.

Defined cases: a null or empty text holds the end id alone; repeated rows are
packed one by one; a null id is kept; an empty table gives an empty result;
other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffbook.llm.common import release, text_or_empty
from tariffbook.llm.tokenizing import json_encoder

CAPACITY, MAX_OPEN, ID_BYTES = 2048, 4096, 4
SLICE, GIVEN = 256, 256  # documents worked on, and windows given, at a time
SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"
ARROW = pa.schema(
    [(name, pa.binary() if name == "ids" else pa.int64()) for name in (c.split()[0] for c in SCHEMA.split(", "))]
)


@dataclass
class Piece:
    doc_id: int | None
    start: int
    ids: bytes
    doc_tokens: int

    def __len__(self) -> int:
        return len(self.ids) // ID_BYTES

    def cut(self, n: int) -> tuple[Piece, Piece]:
        at = n * ID_BYTES
        head = Piece(self.doc_id, self.start, self.ids[:at], self.doc_tokens)
        return head, Piece(self.doc_id, self.start + n, self.ids[at:], self.doc_tokens)


class Packer:
    """Windows of one partition. ``add`` and ``close`` return the windows that became full, as lists of pieces."""

    def __init__(self, capacity: int = CAPACITY):
        self.capacity, self.n_open = capacity, 0
        self.by_level: list[list[list[Piece]]] = [[] for _ in range(capacity)]
        self.count = np.zeros(capacity + 1, np.int64)
        self.leave = np.full(capacity + 1, np.iinfo(np.int64).max // 4)  # change of the sum when a window leaves a level
        self.leave[0] = 0  # a new window
        self.enter = np.ones(capacity + 1, np.int64)  # change of the sum when one comes to a level
        self.enter[capacity] = 0  # full windows do not count

    def _set(self, level: int, change: int) -> None:
        if 0 < level < self.capacity:
            n = self.count[level] = self.count[level] + change
            self.leave[level] = 1 - 2 * n if n else np.iinfo(np.int64).max // 4
            self.enter[level] = 2 * n + 1
            self.n_open += change

    def add(self, piece: Piece) -> list[list[Piece]]:
        done = []
        while len(piece) >= self.capacity:
            head, piece = piece.cut(self.capacity)
            done.append([head])
        if n := len(piece):
            costs = self.leave[: self.capacity - n + 1] + self.enter[n:]
            level = int(len(costs) - 1 - np.argmin(costs[::-1]))  # of equal levels the fullest
            window = self.by_level[level].pop() if level else []
            window.append(piece)
            self._set(level, -1)
            self._set(level + n, 1)
            if level + n == self.capacity:
                done.append(window)
            else:
                self.by_level[level + n].append(window)
        return done + self.close() if self.n_open > MAX_OPEN else done

    def close(self) -> list[list[Piece]]:
        """Ends all open windows; all but one of those returned are full."""
        rows = [(level, w) for level in range(self.capacity - 1, 0, -1) for w in self.by_level[level]]
        hosts = sum(level for level, _ in rows) // self.capacity
        given = [piece for _, window in rows[hosts:] for piece in window][::-1]
        windows = []
        for level, window in [*rows[:hosts], (0, [])]:  # the last one takes what is left, less than a window
            while given and level < self.capacity:
                piece = given.pop()
                if len(piece) > self.capacity - level:
                    piece, rest = piece.cut(self.capacity - level)
                    given.append(rest)
                window.append(piece)
                level += len(piece)
            if window:
                windows.append(window)
        self.__init__(self.capacity)
        return windows


def pack(
    docs: DataFrame, path: str, end_id: int = 1, kind: str = "word", capacity: int = CAPACITY,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per piece; ``ids`` are the token ids as little-endian unsigned 32-bit integers."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = json_encoder(path, kind), Packer(capacity)
        first = TaskContext.get().partitionId() << 32
        made = 0

        def table(windows: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal made
            rows = []
            for window in windows:
                offset = 0
                for p in window:
                    rows.append((p.doc_id, p.start, len(p), p.ids, p.doc_tokens, first + made, offset))
                    offset += len(p)
                made += 1
            columns = zip(*rows) if rows else [()] * len(ARROW)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW)], schema=ARROW)

        full = []
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                part = batch.slice(at, SLICE)
                for key, value in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = encoder.encode(value) + end
                    full += packer.add(Piece(key, 0, ids, len(ids) // ID_BYTES))
                    if len(full) >= GIVEN:
                        yield table(full)
                        full = []
        yield table(full + packer.close())
        encoder.trim()
        release()

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, SCHEMA)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digest(pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")))


def pack_documents(docs: DataFrame) -> DataFrame:
    """With the parameters used in production."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def packed_digest(pieces: DataFrame) -> DataFrame:
    """Pieces with the checksum of their ids in place of the ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
