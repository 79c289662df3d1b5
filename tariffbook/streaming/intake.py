"""Take in deliveries: each as a whole, each content once, the ledger says what is current.

A delivery is a folder with files. What is new is decided by a listing against
the ledger (path, length, time of change), never by age; deliveries are numbered,
the oldest first. All files that wait are read together, in one scan of their
lines that gives each one's header and digest and in another for the contents
that are new, so the number of jobs does not grow with that of files. Lines land
by the content of their file, so a content that was taken in before, in any
delivery, is not landed again but entered in the ledger as known; the ledger
leads from a delivery to its lines. Lines that are no records land too, with what
is wrong with them. The ledger rows of one intake are one file, written last.

Current are all files of the newest delivery that has a file of each table and
none that could not be read: as the last intake that saw its whole folder found
them, with the files that came in one by one since.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tariffbook.operators.profiling import row_md5
from tariffbook.sources.lines import (
    BLANK,
    HEADER,
    RECORD,
    file_contents,
    numbered,
    places,
    read_lines,
    records,
)
from tariffbook.sources.manifest import listing

#: ``rows`` counts a file's records, ``bad`` its lines that are none; ``tables`` names all that a delivery must hold;
#: ``whole`` says that the intake saw all files of the delivery's folder.
LEDGER = (
    "delivery string, table string, path string, length bigint, modified bigint, "
    "content_md5 string, rows bigint, bad bigint, state string, tables string, whole boolean, number bigint"
)
# Of one job that lands lines: a name of each file is broadcast, and each header is a scan of its own.
FILES, HEADERS = 10_000, 16


def _half(md5: Column, start: int) -> Column:
    return F.conv(F.substring(md5, start, 16), 16, 10).cast("decimal(20,0)")


def file_digests(rows: DataFrame) -> DataFrame:
    """``path, content_md5, rows`` for rows that carry their ``path``.

    The digest adds up the md5 of every row, so a file of any size is hashed in
    parallel by its splits; the order of rows within a file does not count.
    """
    content = rows.drop("path")
    hashed = rows.select("path", row_md5(content).alias("row_md5"))
    sums = hashed.groupBy("path").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(_half(F.col("row_md5"), 1)).alias("high"),
        F.sum(_half(F.col("row_md5"), 17)).alias("low"),
    )
    digest = F.md5(F.concat_ws("|", "rows", "high", "low").cast("binary"))
    return sums.select("path", digest.alias("content_md5"), "rows")


def ledger_entries(digests: DataFrame, landed: DataFrame) -> DataFrame:
    """Digests with ``state``: ``landed`` for a content that is new, ``known`` for one landed before or under a smaller path."""
    known = landed.select("content_md5").distinct().withColumn("_known", F.lit(True))
    first = digests.groupBy("content_md5").agg(F.min("path").alias("_first_path"))
    new = F.col("_known").isNull() & (F.col("path") == F.col("_first_path"))
    return (
        digests.join(first, "content_md5")
        .join(known, "content_md5", "left")
        .select("path", "content_md5", "rows", F.when(new, "landed").otherwise("known").alias("state"))
    )


def read_ledger(spark: SparkSession, landing_dir: str) -> DataFrame:
    empty = spark.createDataFrame([], LEDGER)
    try:
        return spark.read.schema(LEDGER).parquet(f"{landing_dir}/ledger").select(*empty.columns)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty  # nothing was taken in yet


def file_pattern(tables: Mapping[str, StructType]) -> str:
    return "{" + ",".join(f"{table}*.csv" for table in tables) + "}"


def not_in_ledger(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files of a listing with ``delivery`` and ``modified`` that the ledger does not have as they are."""
    named = files.select(
        F.regexp_replace("path", "/[^/]*$", "").alias("delivery"), "file_name", "path", "length",
        F.unix_micros("modification_time").alias("modified"), "scan_path",
    )
    return named.join(ledger.select("path", "length", "modified"), ["path", "length", "modified"], "left_anti")


def by_delivery(files: list) -> list[list]:
    """Files of each delivery, the delivery changed longest ago first."""
    found: dict[str, list] = {}
    for file in files:
        found.setdefault(file["delivery"], []).append(file)
    return [found[d] for d in sorted(found, key=lambda d: (max(f["modified"] for f in found[d]), d))]


def pending(spark: SparkSession, source_dir: str, landing_dir: str, tables: Mapping[str, StructType]) -> list[list]:
    """Files of each delivery that holds one the ledger lacks, the delivery changed longest ago first.

    A table's files are ``<table>*.csv``. One row per listed file reaches the driver.
    """
    files, ledger = listing(spark, source_dir, file_pattern(tables)), read_ledger(spark, landing_dir)
    new = not_in_ledger(files, ledger).select("delivery").distinct()
    return by_delivery(not_in_ledger(files, ledger.limit(0)).join(new, "delivery").collect())


def _table_of(file_name: str, tables: Mapping[str, StructType]) -> str:
    return max((t for t in tables if file_name.startswith(t)), key=len)


def take_in(spark: SparkSession, files: list, landing_dir: str, tables: Mapping[str, StructType], number: int) -> None:
    """Takes in one delivery; repeated after a failure it ends the same."""
    take_in_all(spark, [files], landing_dir, tables, number)


def take_in_all(
    spark: SparkSession, deliveries: list[list], landing_dir: str, tables: Mapping[str, StructType], number: int,
    whole: bool = True,
) -> None:
    """Lands the new contents of deliveries and then writes their ledger rows, numbered from ``number`` on.

    Repeated after a failure it ends the same: contents overwrite themselves,
    and until the ledger has the rows nothing reads them.
    """
    ledger = read_ledger(spark, landing_dir).filter(F.col("number") < number)
    files = [(n, f, _table_of(f["file_name"], tables)) for n, own in enumerate(deliveries, number) for f in own]
    lengths = spark.createDataFrame([(f["scan_path"], f["length"]) for _, f, _ in files], "path string, length bigint")
    lines = read_lines(spark, [f["path"] for _, f, _ in files])
    contents = {c["path"]: c for c in file_contents(lines, lengths.distinct()).collect()}  # one row per file

    readable = [(n, f, t) for n, f, t in files if places(contents[f["scan_path"]]["header"], tables[t].names) is not None]
    asked = spark.createDataFrame(
        sorted({(t, contents[f["scan_path"]]["content_md5"]) for _, f, t in readable}), "table string, content_md5 string"
    )
    landed = ledger.filter("state = 'landed'").join(asked, ["table", "content_md5"])
    counts = {(r["table"], r["content_md5"]): (r["rows"], r["bad"]) for r in landed.collect()}
    fresh: dict[str, dict[str, tuple]] = {table: {} for table in tables}
    states = {}
    for n, f, t in sorted(readable, key=lambda x: (x[0], x[1]["path"])):
        content = contents[f["scan_path"]]
        known = (t, content["content_md5"]) in counts or content["content_md5"] in fresh[t]
        states[n, f["path"]] = "known" if known else "landed"
        if not known:
            fresh[t][content["content_md5"]] = (content["header"], f["path"], f["scan_path"])
    for table, new in fresh.items():
        for some in _batches(new):
            _land(spark, some, f"{landing_dir}/{table}", tables[table])
        counts |= {(table, content): n for content, n in _counted(spark, f"{landing_dir}/{table}", list(new)).items()}

    def entry(n: int, f, t: str) -> tuple:
        content = contents[f["scan_path"]]["content_md5"]
        state = states.get((n, f["path"]), "unreadable")
        rows, bad = counts[t, content] if state != "unreadable" else (None, None)
        if rows == 0 and bad == 0:
            state, content = "empty", None
        elif state == "unreadable":
            content = None
        return (f["delivery"], t, f["path"], f["length"], f["modified"], content, rows, bad, state, ",".join(sorted(tables)), whole, n)

    entries = spark.createDataFrame([entry(*x) for x in files], LEDGER)
    entries.coalesce(1).write.mode("overwrite").parquet(f"{landing_dir}/ledger/commit={number}")


def _batches(new: dict[str, tuple]) -> Iterator[dict[str, tuple]]:
    """New contents in the order of their headers, for one job each."""
    some: dict[str, tuple] = {}
    for content, file in sorted(new.items(), key=lambda x: (x[1][0], x[0])):
        headers = {header for header, *_ in some.values()} | {file[0]}
        if len(some) == FILES or len(headers) > HEADERS:
            yield some
            some = {}
        some[content] = file
    if some:
        yield some


def _land(spark: SparkSession, new: dict[str, tuple], path: str, schema: StructType) -> None:
    """Writes all lines of files, by content; a scan for each header."""
    by_header: dict[str, list] = {}
    for content, (header, file, scan_path) in new.items():
        by_header.setdefault(header, []).append((file, scan_path, content))
    parts = []
    for header, files in by_header.items():
        names = F.broadcast(spark.createDataFrame([f[1:] for f in files], "path string, content string"))
        told = records(read_lines(spark, [f[0] for f in files]), header, schema)
        parts.append(told.join(names, "path").drop("path"))
    (
        reduce(DataFrame.unionAll, parts).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("content").parquet(path)
    )


def _landed(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    columns = ", ".join(f"`{name}` string" for name in (schema.names if schema else ()))
    layout = "block bigint, seq bigint, kind string, raw string" + (f", {columns}" if columns else "") + ", content string"
    return spark.read.schema(layout).parquet(path)


def _counted(spark: SparkSession, path: str, contents: list[str]) -> dict[str, tuple[int, int]]:
    """Records and bad lines of each content."""
    if not contents:
        return {}
    records = F.count_if(F.col("kind") == RECORD)
    bad = F.count_if(~F.col("kind").isin(RECORD, HEADER, BLANK))
    counted = _landed(spark, path).filter(F.col("content").isin(contents)).groupBy("content").agg(records, bad)
    return {content: (n, m) for content, n, m in counted.collect()}


def ingest(spark: SparkSession, source_dir: str, landing_dir: str, tables: Mapping[str, StructType]) -> None:
    """Takes in every pending delivery. One that lacks a table fails, before anything of any delivery is taken in."""
    waiting = pending(spark, source_dir, landing_dir, tables)
    for files in waiting:
        there = {_table_of(f["file_name"], tables) for f in files}
        if absent := sorted(f"{t}.csv" for t in tables if t not in there):
            raise FileNotFoundError(f"not found in {files[0]['delivery']}: {', '.join(absent)}")
    if not waiting and read_ledger(spark, landing_dir).isEmpty():
        raise FileNotFoundError(f"not found in {source_dir}: {', '.join(f'{t}.csv' for t in sorted(tables))}")
    if waiting:
        last = read_ledger(spark, landing_dir).agg(F.max("number")).first()[0]
        take_in_all(spark, waiting, landing_dir, tables, 0 if last is None else last + 1)


def current_files(spark: SparkSession, landing_dir: str) -> DataFrame:
    """``table, path, content_md5`` of the newest delivery that could be read as a whole."""
    ledger = read_ledger(spark, landing_dir)
    bases = ledger.groupBy("delivery").agg(F.max(F.when(F.col("whole"), F.col("number"))).alias("base"))
    since = ledger.join(bases, "delivery").filter("base IS NULL OR number >= base")
    entry = F.struct("table", "content_md5", "state", "tables", "number")
    files = since.groupBy("delivery", "path").agg(F.max_by(entry, "number").alias("f")).select("delivery", "path", "f.*")
    missing = F.size(F.array_except(F.split(F.max_by("tables", "number"), ","), F.collect_set("table")))
    judged = files.groupBy("delivery").agg(
        F.max("number").alias("newest"), F.max((F.col("state") == "unreadable").cast("int")).alias("bad"), missing.alias("missing")
    )
    chosen = judged.filter("bad = 0 AND missing = 0").agg(F.max_by("delivery", "newest")).first()[0]
    return files.filter(F.col("delivery") == chosen).select("table", "path", "content_md5")


def current(spark: SparkSession, landing_dir: str, table: str, schema: StructType) -> DataFrame:
    """All rows of ``table`` in the newest delivery that could be read as a whole."""
    files = current_files(spark, landing_dir).filter((F.col("table") == table) & F.col("content_md5").isNotNull())
    contents = sorted({f["content_md5"] for f in files.select("content_md5").collect()})
    if not contents:
        return spark.createDataFrame([], schema)
    landed = _landed(spark, f"{landing_dir}/{table}", schema)
    return landed.filter(F.col("content").isin(contents) & (F.col("kind") == RECORD)).select(*schema.names)


def bad_lines(spark: SparkSession, landing_dir: str, table: str, files: DataFrame | None = None) -> DataFrame:
    """``path, line, reason, raw``: lines of the files of ``table`` that are no records; of all files ever, or of ``files``."""
    files = read_ledger(spark, landing_dir) if files is None else files
    mine = files.filter((F.col("table") == table) & F.col("content_md5").isNotNull())
    mine = mine.select("path", F.col("content_md5").alias("content")).distinct()
    if mine.isEmpty():
        return spark.createDataFrame([], "path string, line bigint, reason string, raw string")
    lines = _landed(spark, f"{landing_dir}/{table}")
    bad = lines.filter(~F.col("kind").isin(RECORD, HEADER, BLANK))
    placed = numbered(bad, lines.join(bad.select("content").distinct(), "content", "left_semi"), "content")
    return placed.join(mine, "content").select("path", "line", F.col("kind").alias("reason"), "raw")
