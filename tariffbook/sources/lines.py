"""Many delimited files as lines: what each one holds, its header, and its records by name.

All files are read in one scan of lines, whatever their number. Line ends are
LF, CR LF or CR; a record is one line, as quotes do not span lines here.
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: What a line is.
RECORD, HEADER, BLANK = "record", "header", "blank"
FEW_FIELDS, MANY_FIELDS, OPEN_QUOTE = "too_few_fields", "too_many_fields", "open_quote"
BOM = "\ufeff"
#: A quoted part; lines in which each field that begins with a quote ends with one too. Escapes are backslashes.
QUOTED = r'(?s)"(?:[^"\\]++|\\.)*+"'
_FIELD = r'(?:"(?:[^"\\]++|\\.|"(?!,|\z))*+"|[^",][^,]*+|)'
CLOSED = rf"(?s)\A{_FIELD}(?:,{_FIELD})*+\z"


def read_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``path, block, seq, value``: lines with the start of the part of the file they were read in.

    ``seq`` rises without gaps within a part; where it starts differs from scan to scan.
    """
    where = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block")
    return spark.read.text(list(paths)).select(*where, F.monotonically_increasing_id().alias("seq"), "value")


def _half(md5: Column, start: int) -> Column:
    """Sixty bits of a md5, so that sums of products with line numbers fit a decimal."""
    return F.conv(F.substring(md5, start, 15), 16, 10).cast("decimal(19,0)")


def _number(seq: Column) -> Column:
    """The place of a line among those of its task: the lower 33 bits."""
    return seq.bitwiseAND(F.lit((1 << 33) - 1)).cast("decimal(10,0)")


def _parts(lines: DataFrame) -> DataFrame:
    """Per file and part: number of lines, sums of their hashes plain and by place in the part, first line that is not blank."""
    md5 = F.md5(F.col("value").cast("binary"))
    hashed = lines.select("path", "block", "seq", "value", _number(F.col("seq")).alias("k"), _half(md5, 1).alias("a"), _half(md5, 17).alias("b"))
    sums = hashed.groupBy("path", "block").agg(
        F.count(F.lit(1)).alias("lines"),
        F.min("k").alias("low"),
        F.sum("a").alias("a"), F.sum(F.col("a") * F.col("k")).alias("ak"),
        F.sum("b").alias("b"), F.sum(F.col("b") * F.col("k")).alias("bk"),
        F.min_by("value", F.when(F.trim("value") != "", F.col("seq"))).alias("first"),
    )
    wide = "decimal(38,0)"
    shifted = [(F.col(f"{x}k") - (F.col(x) * F.col("low")).cast(wide)).cast(wide).alias(f"{x}k") for x in "ab"]
    return sums.select("path", "block", F.col("lines").cast(wide).alias("lines"), F.col("a").cast(wide).alias("a"),
                       F.col("b").cast(wide).alias("b"), *shifted, "first")


def file_contents(lines: DataFrame, lengths: DataFrame) -> DataFrame:
    """``path, content_md5, lines, header`` of every file of ``lengths`` (``path, length``).

    A file's digest is made of its length and of two sums over its lines, of
    their hashes and of their hashes times their line numbers. Both sums of two
    parts of a file give those of the whole, so parts are added up in any grouping
    as long as they stay in order, and the digest does not depend on how a file
    was cut into parts. Other lines, other order or a line more is another digest.
    """
    wide = "decimal(38,0)"
    part = F.struct("block", "lines", "a", "ak", "b", "bk", "first")
    # A row per part of a file: tens of bytes for each of its megabytes.
    gathered = _parts(lines).groupBy("path").agg(F.array_sort(F.collect_list(part)).alias("parts"))
    nothing = F.struct(*(F.lit(0).cast(wide).alias(n) for n in ("lines", "a", "ak", "b", "bk")))

    def add(whole: Column, part: Column) -> Column:
        """A line's number in the whole is its number in its part and the lines before that."""
        moved = [(whole[f"{x}k"] + part[f"{x}k"] + (whole["lines"] * part[x]).cast(wide)).cast(wide).alias(f"{x}k") for x in "ab"]
        plain = [(whole[x] + part[x]).cast(wide).alias(x) for x in ("lines", "a", "b")]
        return F.struct(plain[0], plain[1], moved[0], plain[2], moved[1])

    whole = gathered.select(
        "path", F.reduce("parts", nothing, add).alias("sums"),
        F.get(F.filter("parts", lambda p: p["block"] == 0), F.lit(0))["first"].alias("header"),
    )
    known = lengths.join(whole, "path", "left")
    sums = [F.coalesce(F.col(f"sums.{n}"), F.lit(0)).cast("string") for n in ("lines", "a", "ak", "b", "bk")]
    digest = F.md5(F.concat_ws("|", F.col("length").cast("string"), *sums).cast("binary"))
    lines_read = F.coalesce(F.col("sums.lines"), F.lit(0)).cast("bigint")
    return known.select("path", digest.alias("content_md5"), lines_read.alias("lines"), F.ltrim("header", F.lit(BOM)).alias("header"))


def header_fields(header: str | None) -> list[str]:
    """Names in a header line."""
    return next(csv.reader([header]), []) if header and header.strip() else []


def places(header: str | None, names: Sequence[str]) -> list[int] | None:
    """Where the names stand in a header, in any case of letters; None if one is missing or there twice."""
    found = [field.strip().lower() for field in header_fields(header)]
    if any(found.count(name.lower()) != 1 for name in names):
        return None
    return [found.index(name.lower()) for name in names]


def records(lines: DataFrame, header: str, schema: StructType) -> DataFrame:
    """``lines`` of files with that header, with ``kind``, ``raw`` and the schema's columns as text in place of ``value``.

    A record has as many fields as the header and closes its quotes; ``raw`` is
    the line where it is no record. A line that repeats the header is one.
    """
    fields, where = header_fields(header), places(header, schema.names)
    if where is None:
        raise ValueError(f"no column for each of {schema.names} in {header!r}")
    value = F.col("value")
    layout = ", ".join([*(f"c{k} string" for k in range(len(fields))), "odd string"])
    outside_quotes = F.regexp_replace(value, QUOTED, "")
    kind = (
        F.when(F.trim(value) == "", BLANK)
        .when(F.ltrim(value, F.lit(BOM)) == header, HEADER)
        .when(~value.rlike(CLOSED), OPEN_QUOTE)
        .when(F.col("_row.odd").isNull(), RECORD)
        .when(F.regexp_count(outside_quotes, F.lit(",")) >= len(fields), MANY_FIELDS)
        .otherwise(FEW_FIELDS)
    )
    row = F.from_csv(value, layout, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "odd"})
    told = lines.withColumn("_row", row).withColumn("_kind", kind)
    good = F.col("_kind") == RECORD
    columns = [F.when(good, F.col(f"_row.c{k}")).alias(name) for k, name in zip(where, schema.names)]
    others = [c for c in lines.columns if c != "value"]
    return told.select(*others, F.col("_kind").alias("kind"), F.when(~good, value).alias("raw"), *columns)


def numbered(some: DataFrame, lines: DataFrame, file: str) -> DataFrame:
    """``some`` of the ``lines`` with ``line``, their number in the ``file`` from one on, in place of ``block`` and ``seq``.

    ``lines`` has all lines of the files, as one scan read them; a row for each part of a file moves.
    """
    parts = lines.groupBy(file, "block").agg(F.min("seq").alias("low"), F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy(file).orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.select(file, "block", (F.coalesce(before, F.lit(0)) - F.col("low") + 1).alias("offset"))
    placed = some.join(starts, [file, "block"]).withColumn("line", F.col("seq") + F.col("offset"))
    return placed.drop("block", "seq", "offset")
