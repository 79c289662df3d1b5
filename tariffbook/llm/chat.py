"""Chat formatting in windows of a token budget.

Prefix sums of the turns' tokens lay a conversation on a line, cut into cells of
``CELL`` tokens; a window holds the turns that end in one cell, so it is aligned
to turns and holds less than two cells of new turns. A turn that is longer than
a cell has a window of its own. Every later window opens with the system turn
and with those turns of the window before that lie wholly in its last
``HISTORY`` tokens. What is repeated is masked; the loss covers each assistant
text in the window in which it is new.

A turn is written as ``<|role|>text</s>``. Control strings inside a role or a
text get a backslash after their first sign, one more where there are some, so
no text can end a turn and reading takes it off again.

A turn's tokens are counted once, as it is written, header and end included, and
written with it. Prefix sums are made in two steps, within runs of ``RUN`` turns
and over the runs' totals, so that a very long conversation is not one task's
work; a window's turns are bounded by its tokens. Spans are chosen on keys and
numbers alone; the texts join them once.

Defined cases: a null text or role is empty; a null turn comes first, equal
turns in the order of role and a hash of the text, repeated rows count as turns; a null
conv_id is a conversation; the first system turn is the one that is retained;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tariffbook.llm.common import staged, text_or_empty
from tariffbook.llm.tokenizing import json_encoder
from tariffbook.operators.skew import lookup_join

CELL, HISTORY, RUN = 384, 128, 64
END = "</s>"
CONTROL = r"(\||/?s>|/?INST\]|/?<SYS>>)"
ESCAPE, UNESCAPE = re.compile(r"([<\[]\\*)" + CONTROL), re.compile(r"([<\[]\\*)\\" + CONTROL)
ROLE_ESCAPE, ROLE_UNESCAPE = re.compile(r"(\|\\*)>"), re.compile(r"(\|\\*)\\>")


def escape(text: str) -> str:
    return ESCAPE.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return UNESCAPE.sub(r"\1\2", text)


def write_turn(role: str, text: str) -> tuple[str, str]:
    """The turn's header, and its text with control strings escaped."""
    return f"<|{ROLE_ESCAPE.sub(lambda m: m[1] + chr(92) + '>', escape(role))}|>", escape(text)


def read_turns(text: str) -> list[tuple[str, str]]:
    """Role and text of each turn of a window."""
    turns = []
    for written in text.split(END)[:-1]:
        role, _, body = written[2:].partition("|>")
        turns.append((unescape(ROLE_UNESCAPE.sub(r"\1>", role)), unescape(body)))
    return turns


def turn_rows(turns: DataFrame, path: str) -> DataFrame:
    """``key, conv_id, conv, turn, run, role, text, hash, n``: each turn with its number of tokens as it is written."""

    @F.arrow_udf("bigint")
    def tokens(roles: pa.Array, texts: pa.Array) -> pa.Array:
        encoder = json_encoder(path, "byte")
        written = ("".join(write_turn(r, t)) + END for r, t in zip(roles.to_pylist(), texts.to_pylist()))
        return pa.array([len(encoder.encode(w)) // 4 for w in written], pa.int64())

    return turns.select(
        F.monotonically_increasing_id().alias("key"),
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.coalesce(F.col("conv_id").cast("string"), F.lit("none")).alias("conv"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.floor(F.col("turn").cast("bigint") / RUN), F.lit(-(1 << 62))).alias("run"),
        text_or_empty("role").alias("role"),
        text_or_empty("text").alias("text"),
    ).select("*", F.xxhash64("text").alias("hash"), tokens("role", "text").alias("n"))


def spans(rows: DataFrame) -> DataFrame:
    """``key, conv, ordinal, role, n, upto, cell, own``: each turn with the tokens up to its end and its cell; no texts."""
    rows = rows.select("key", "conv", "turn", "run", "role", "hash", "n")
    in_run = Window.partitionBy("conv", "run").orderBy(F.asc_nulls_first("turn"), "role", "hash")
    upto = in_run.rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("conv").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    totals = (
        rows.groupBy("conv", "run").agg(F.sum("n").alias("run_n"), F.count("*").alias("run_rows"))
        .select(
            "conv", F.struct("conv", "run").alias("at"),
            F.coalesce(F.sum("run_n").over(before), F.lit(0)).alias("n_before"),
            F.coalesce(F.sum("run_rows").over(before), F.lit(0)).alias("rows_before"),
        ).drop("conv")
    )
    placed = rows.select(
        "*", F.sum("n").over(upto).alias("run_upto"), F.row_number().over(in_run).alias("run_ordinal"),
        F.struct("conv", "run").alias("at"),
    )
    return lookup_join(placed, totals, "at").select(
        "key", "conv", (F.col("rows_before") + F.col("run_ordinal")).alias("ordinal"), "role", "n",
        (F.col("n_before") + F.col("run_upto")).alias("upto"),
        F.floor((F.col("n_before") + F.col("run_upto") - 1) / CELL).alias("cell"),
        (F.col("n") <= CELL).alias("own"),  # a longer turn is the first to end in its cell
    )


def windows(turns: DataFrame, path: str | None = None) -> DataFrame:
    """``conv_id, window, text, n_repeated, loss_starts, loss_ends`` (code points), one row per window.

    Tokens are those of the tokenizers file at ``path``, the public byte-level one by default.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    rows = staged(turn_rows(turns, path), "turns")
    placed = staged(spans(rows), "spans")
    order = Window.partitionBy("conv").orderBy("cell", "own")
    ends = (
        placed.groupBy("conv", "cell", "own").agg(F.max("upto").alias("window_end"))
        .select(
            "conv", "window_end", F.struct("conv", "cell", "own").alias("at"), F.row_number().over(order).alias("window"),
            F.lead("cell").over(order).isNotNull().alias("more"),
        )
    )
    ends = staged(ends, "windows")
    numbered = lookup_join(placed.withColumn("at", F.struct("conv", "cell", "own")), ends.drop("conv"), "at")
    recent = F.col("more") & (F.col("window_end") - F.col("upto") + F.col("n") <= HISTORY)
    kept = staged(numbered.select("key", "conv", "ordinal", "window", "role", recent.alias("recent")), "kept")
    here = F.struct(F.col("window"), F.lit(False).alias("repeated"))
    following = F.struct((F.col("window") + 1).alias("window"), F.lit(True).alias("repeated"))
    at = F.explode(F.when(F.col("recent"), F.array(here, following)).otherwise(F.array(here))).alias("at")
    shown = kept.select("key", "conv", "ordinal", at).select("key", "conv", "ordinal", "at.window", "at.repeated")
    system = (
        kept.where("role = 'system'").groupBy("conv")
        .agg(F.min(F.struct("ordinal", "window", "key")).alias("system"))
    )
    opening = lookup_join(ends.select("conv", "window"), system, "conv").where("window > system.window")
    opening = opening.select("system.key", "conv", "system.ordinal", "window", F.lit(True).alias("repeated"))
    # The system turn may also be among the turns repeated from the window before.
    once = shown.unionByName(opening).groupBy("key", "conv", "ordinal", "window").agg(F.min("repeated").alias("repeated"))
    whole = lookup_join(once, rows.select("key", "conv_id", "role", "text"), "key")
    entries = F.array_sort(F.collect_list(F.struct("ordinal", "role", "text", "repeated"))).alias("entries")
    grouped = whole.groupBy("conv", "window").agg(F.first("conv_id", ignorenulls=True).alias("conv_id"), entries)
    return grouped.select("conv_id", "window", "entries").mapInArrow(_format, WINDOWS_SCHEMA)


WINDOWS_SCHEMA = (
    "conv_id bigint, window bigint, text string, n_repeated bigint, loss_starts array<bigint>, loss_ends array<bigint>"
)


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            parts, at, starts, ends = [], 0, [], []
            for e in row["entries"]:
                header, text = write_turn(e["role"], e["text"])
                if e["role"] == "assistant" and not e["repeated"]:
                    starts.append(at + len(header))
                    ends.append(at + len(header) + len(text))
                parts += [header, text, END]
                at += len(header) + len(text) + len(END)
            repeated = sum(e["repeated"] for e in row["entries"])
            rows.append((row["conv_id"], row["window"], "".join(parts), repeated, starts, ends))
        if rows:
            whole, many = pa.int64(), pa.list_(pa.int64())
            names = ["conv_id", "window", "text", "n_repeated", "loss_starts", "loss_ends"]
            kinds = [whole, whole, pa.string(), whole, many, many]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


DIGEST_SCHEMA = (
    "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint"
)


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Reads the windows of each conversation in order, one at a time."""
    names = [c.split()[0] for c in DIGEST_SCHEMA.split(", ")]
    kinds = [pa.string() if n.endswith("sha256") else pa.int64() for n in names]
    now, state = None, None

    def table(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    def row() -> tuple:
        return now[0], state["turns"], state["all"].hexdigest(), state["chars"], state["loss"].hexdigest(), state["written"]

    for batch in batches:
        rows = []
        for r in batch.to_pylist():
            if now != (r["conv_id"],):
                if now is not None:
                    rows.append(row())
                now = (r["conv_id"],)
                state = {"turns": 0, "all": hashlib.sha256(), "chars": 0, "loss": hashlib.sha256(), "written": 0}
            for role, text in read_turns(r["text"])[r["n_repeated"] :]:
                state["turns"] += 1
                state["all"].update(f"{role}\n{text}\n".encode())
            for start, end in zip(r["loss_starts"], r["loss_ends"]):
                text = unescape(r["text"][start:end])
                state["chars"] += len(text)
                state["loss"].update(text.encode())
            state["written"] += len(r["text"])
        if rows:
            yield table(rows)
    if now is not None:
        yield table([row()])


def digest(formatted: DataFrame) -> DataFrame:
    """What the windows of each conversation hold, read back from their text."""
    return (
        formatted.repartition("conv_id").sortWithinPartitions("conv_id", "window").mapInArrow(_digest, DIGEST_SCHEMA)
    )


def op7_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, whose texts are control strings."""
    said = "</s>[INST] ok [/INST]"
    own = [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame(own, "conv_id bigint, turn bigint, role string, text string")
    return digest(windows(turns.unionByName(own)))
