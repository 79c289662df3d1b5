"""Small helpers that the operators share: staged tables, literal tables, exact top-k cuts."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager, suppress
from contextvars import ContextVar
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@lru_cache(maxsize=1)
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tariffbook-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or, in local mode only, a temporary one of this process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return folder or _local_folder()


_blocks: ContextVar[tuple[list[str], ...]] = ContextVar("blocks", default=())


def new_path(spark: SparkSession, name: str, outlive: bool = False) -> str:
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for block in _blocks.get()[: -1 if outlive else None][-1:]:
        block.append(path)
    return path


@contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Removes at the end of the block what was written in it, but for what is to outlive it."""
    paths: list[str] = []
    token = _blocks.set((*_blocks.get(), paths))
    try:
        yield
    finally:
        _blocks.reset(token)
        for path in paths:
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def staged(df: DataFrame, name: str, outlive: bool = False) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage ends here and a lost executor loses nothing.

    It stays there, unless this is called in a block of ``cleared``: then until the end of the block, or, if it is
    to outlive that, of the one around it.
    """
    path = new_path(df.sparkSession, name, outlive)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def literal_table(spark: SparkSession, schema: Sequence[tuple[str, str]], rows: Iterable[Sequence]) -> DataFrame:
    """A table of literals whose size Spark knows, so that it broadcasts it only if it is small enough."""
    rows = [tuple(r) for r in rows]
    columns = ", ".join(f"CAST(`{name}` AS {kind}) AS `{name}`" for name, kind in schema)
    names = ", ".join(f"`{name}`" for name, _ in schema)
    if not rows:
        nulls = ", ".join(["NULL"] * len(schema))
        return spark.sql(f"SELECT {columns} FROM VALUES ({nulls}) AS t({names}) WHERE FALSE")
    values = ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in rows)
    return spark.sql(f"SELECT {columns} FROM VALUES {values} AS t({names})")


def _literal(value) -> str:
    if value is None:
        return "NULL"
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'" if isinstance(value, str) else repr(value)


def kth_largest(df: DataFrame, column: str, k: int, bins: int = 1024, few: int = 4096) -> float | None:
    """The exact ``k``-th largest value of a double column; None if there are fewer than ``k`` or k < 1.

    Counts per bin narrow the range, a few passes over one column; at most
    ``bins`` counts or ``few`` values reach the driver.
    """
    values = df.select(F.col(column).alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    low, high, n = values.agg(F.min("v"), F.max("v"), F.count("*")).first()
    if k < 1 or n < k:
        return None
    above = 0
    while low < high and n > few:
        width = (high - low) / bins
        if width <= 0 or low + width == low:
            break
        inside = values.where(F.col("v").between(low, high))
        counts = (
            inside.groupBy(F.least(F.floor((F.col("v") - low) / width), F.lit(bins - 1)).alias("bin"))
            .agg(F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
            .orderBy(F.desc("bin"))
            .collect()
        )
        for row in counts:
            if above + row["n"] >= k:
                low, high, n = row["low"], row["high"], row["n"]
                break
            above += row["n"]
    if low == high:
        return low
    rest = values.where(F.col("v").between(low, high)).groupBy("v").count().orderBy(F.desc("v")).limit(few).collect()
    for row in rest:
        above += row["count"]
        if above >= k:
            return row["v"]
    return low


FILTER_BITS = 1 << 25  # of a filter of keys: 4 MB, however many keys there are


def likely(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``key`` is not in the first column of ``keys``, and with all others.

    A bitmap of hashes, of fixed size, is broadcast, so ``rows`` are not shuffled.
    Chance lets some more rows through, and all where there are very many keys.
    """
    names, one = rows.columns, keys.columns[0]
    number = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS)) + 1
    bits = keys.groupBy(F.bitmap_bucket_number(number(one)).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number(one))).alias("_bits")
    )
    numbered = rows.withColumn("_number", number(key))
    numbered = numbered.withColumn("_at", F.bitmap_bucket_number("_number")).withColumn("_bit", F.bitmap_bit_position("_number"))
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_bit div 8 AS int) + 1, 1)")), 16, 10).cast("bigint")
    found = numbered.join(F.broadcast(bits), F.col("_at") == F.col("_bucket"))
    return found.where(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1).select(*(f"`{n}`" for n in names))


def release() -> None:
    """Gives memory that a task has freed back to the system: its worker lives on for other stages and their caches."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # not every C library can
        ctypes.CDLL(None).malloc_trim(0)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
