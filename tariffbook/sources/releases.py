"""Results published as a whole: each run writes a folder of its own, and a mark is committed last.

Readers follow the newest mark. A run that fails leaves a folder without a mark,
which nobody reads and ``tidy`` removes, and the run before stays as it was.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARK = "number bigint, folder string, table string, rows bigint"


def _marks(spark: SparkSession, root: str) -> DataFrame:
    try:
        return spark.read.schema(MARK).parquet(f"{root}/published").select("number", "folder", "table", "rows")
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MARK)


def _folders(spark: SparkSession, root: str) -> dict[int, str]:
    """Folders of runs, published or not."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/runs")
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return {}
    names = [status.getPath().getName() for status in system.listStatus(path)]
    return {int(name.removeprefix("run=")): f"{root}/runs/{name}" for name in names if name.startswith("run=")}


def new_run(spark: SparkSession, root: str) -> tuple[int, str]:
    """Number and folder of a run, beyond those of all runs so far, failed ones included."""
    number = 1 + max(_folders(spark, root), default=0)
    folder = f"{root}/runs/run={number}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path):
        raise OSError(f"cannot make {folder}")
    return number, folder


def publish(spark: SparkSession, root: str, number: int, rows: Mapping[str, int]) -> None:
    """Marks a run as the current one. The mark is one file, which is there or not."""
    marks = [(number, f"runs/run={number}", table, n) for table, n in rows.items()]
    spark.createDataFrame(marks, MARK).coalesce(1).write.mode("overwrite").parquet(f"{root}/published/mark={number}")


def published(spark: SparkSession, root: str) -> tuple[int, str] | None:
    """Number and folder of the current run; None before the first one."""
    row = _marks(spark, root).agg(F.max(F.struct("number", "folder")).alias("last")).first()["last"]
    return None if row is None else (row["number"], f"{root}/{row['folder']}")


def published_rows(spark: SparkSession, root: str) -> dict[str, int]:
    """Rows of each table of the current run, as counted when they were written."""
    now = published(spark, root)
    marks = _marks(spark, root).filter(F.col("number") == (now[0] if now else -1))
    return {r["table"]: r["rows"] for r in marks.collect()}


def tidy(spark: SparkSession, root: str, keep: int = 2) -> list[int]:
    """Removes folders of runs but for the last ``keep`` published ones and those begun after them; their numbers."""
    numbers = sorted(r["number"] for r in _marks(spark, root).select("number").distinct().collect())
    kept, current = set(numbers[-keep:] if keep else ()), max(numbers, default=0)
    gone = []
    for number, folder in sorted(_folders(spark, root).items()):
        if number < current and number not in kept:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
            gone.append(number)
    return gone
