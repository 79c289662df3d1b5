"""Fill-in-the-middle documents by rotating blocks of a byte array in place.

A text is cut into units (lines), two cuts drawn from a hash of the document's
id part it into prefix, middle and suffix. Marks are inserted before the three
parts in a byte array; then parts change places by rotations, each of them three
reversals, worked off in swaps of bounded size. ``restore`` finds the marks,
turns the rotations back and takes the marks out, which gives the text exactly.

- ``psm``: ``<P>`` prefix ``<S>`` suffix ``<M>`` middle;
- ``spm``: ``<S>`` suffix ``<P>`` prefix ``<M>`` middle;
- ``plain``: the text, where it is empty, holds a mark, or is drawn to stay.

One pass over the rows, no shuffle; a row's memory is a few copies of its text.

Defined cases: a null text counts as empty; a null id draws as an empty id; rows
of equal id and text come out equal; a text without line ends is one unit; an
empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tariffbook.llm.common import text_or_empty

PREFIX, SUFFIX, MIDDLE = MARKS = (b"<P>", b"<S>", b"<M>")
SEED, FIM_PERCENT, SPM_PERCENT = 7, 100, 50
SWAP = 1 << 16  # bytes that a reversal moves at a time
ROWS = 512


def reverse(data: bytearray, start: int, end: int) -> None:
    """Reverses ``data[start:end]`` where it lies."""
    while end - start > 1:
        step = min(SWAP, (end - start) // 2)
        data[start : start + step], data[end - step : end] = data[end - step : end][::-1], data[start : start + step][::-1]
        start, end = start + step, end - step


def rotate(data: bytearray, start: int, cut: int, end: int) -> None:
    """Exchanges ``data[start:cut]`` and ``data[cut:end]`` by three reversals."""
    reverse(data, start, cut)
    reverse(data, cut, end)
    reverse(data, start, end)


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits from the id."""
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    return struct.unpack(">4I", hashlib.sha256(key.encode()).digest()[:16])


def line_ends(text: bytes) -> np.ndarray:
    """Where the lines of a text end; the last one may lack its line end."""
    ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    return np.append(ends, len(text)) if text and text[-1] != 10 else ends


def transform(
    text: bytes, doc_id: int | None, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT
) -> tuple[int, str, int | None, int | None, bytes]:
    """Number of units, form, bytes of prefix and of middle, output."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    ends = line_ends(text)
    n = len(ends)
    if not text or any(mark in text for mark in MARKS) or h3 % 100 >= fim_percent:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    first, second = (int(ends[k - 1]) if k else 0 for k in (low, high))
    data = bytearray(text)
    data[second:second] = SUFFIX
    data[first:first] = MIDDLE
    data[0:0] = PREFIX
    middle = first + len(PREFIX)
    suffix = second + len(PREFIX) + len(MIDDLE)
    form = "spm" if h4 % 100 < spm_percent else "psm"
    rotate(data, middle if form == "psm" else 0, suffix, len(data))
    return n, form, first, second - first, bytes(data)


def restore_bytes(output: bytes, form: str) -> bytes:
    """The text that an output of ``transform`` was made from."""
    if form == "plain":
        return output
    data = bytearray(output)
    if form == "psm":
        suffix, middle = data.index(SUFFIX), data.index(MIDDLE)
        rotate(data, suffix, middle, len(data))
    else:
        rotate(data, 0, data.index(PREFIX), len(data))
    suffix, middle = data.index(SUFFIX), data.index(MIDDLE)
    for at in (suffix, middle, 0):  # from the back, so that places in front stay
        del data[at : at + 3]
    return bytes(data)


FIM_SCHEMA = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, len(batch), ROWS):
            yield batch.slice(at, ROWS)


def fill_in_middle(
    docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every row; lengths in code points, null if plain."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            made = []
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                n, form, first, second, output = transform(raw, key, seed, fim_percent, spm_percent)
                if first is not None:
                    first, second = len(raw[:first].decode()), len(raw[first : first + second].decode())
                made.append((n, form, first, second, output))
            columns = list(zip(*made)) or [()] * 5
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            arrays[-1] = arrays[-1].cast(pa.string())
            names = [c.split()[0] for c in FIM_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names)

    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), text_or_empty(text).alias("text"))
    return rows.mapInArrow(run, FIM_SCHEMA)


def restore(made: DataFrame) -> DataFrame:
    """``made`` with a column ``restored``, from ``output`` and ``form`` alone."""
    names = made.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, how = names.index("output"), names.index("form")
        for batch in _slices(batches):
            pairs = zip(batch.column(at).cast(pa.binary()).to_pylist(), batch.column(how).to_pylist())
            texts = pa.array([restore_bytes(o, f) for o, f in pairs], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*names, "restored"])

    return made.mapInArrow(run, StructType([*made.schema.fields, StructField("restored", StringType())]))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document transformed and restored; texts as sha256."""
    made = restore(fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    sha = [F.sha2(F.col(c).cast("binary"), 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *sha)


OP12_SQL = r"""
WITH parts AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || doc_id) AS h,
        regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units
    FROM documents),
drawn AS (
    SELECT *, len(units) AS n, [CAST('0x' || h[8 * i + 1 : 8 * i + 8] AS BIGINT) FOR i IN range(4)] AS r FROM parts),
cut AS (
    SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
        CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
            WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn),
pieces AS (
    SELECT *, coalesce(array_to_string(units[1 : a], ''), '') AS prefix,
        coalesce(array_to_string(units[a + 1 : b], ''), '') AS middle,
        coalesce(array_to_string(units[b + 1 : n], ''), '') AS suffix
    FROM cut)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
    CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(text) AS restored_sha256
FROM pieces"""
