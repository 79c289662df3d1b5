"""Are the expected input files there?"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tariffbook.schemas import RAW_FILES


def listing(spark: SparkSession, source_dir: str, pattern: str = "*") -> DataFrame:
    """``file_name, path, length, modification_time`` of the files below a folder whose name fits; contents are not read.

    ``scan_path`` is the path as scans of lines give it.
    """
    options = {"recursiveFileLookup": True, "pathGlobFilter": pattern}
    return file_entries(spark.read.format("binaryFile").options(**options).load(source_dir))


def file_entries(files: DataFrame) -> DataFrame:
    """The columns of ``listing`` from a scan, or stream, of whole files."""
    return files.select(
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        "path",
        "length",
        F.col("modificationTime").alias("modification_time"),
        F.col("_metadata.file_path").alias("scan_path"),
    )


def expected_files(spark: SparkSession, names: Iterable[str] = RAW_FILES) -> DataFrame:
    return spark.createDataFrame([(name,) for name in names], "file_name string")


def missing_inputs(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Expected names for which no file is present."""
    return expected.join(present.select("file_name"), "file_name", "left_anti")


def require_inputs(spark: SparkSession, source_dir: str, names: Iterable[str] = RAW_FILES) -> None:
    """Fail with all missing names at once. An action, over the few expected names only."""
    wanted = list(names)
    missing = missing_inputs(expected_files(spark, wanted), listing(spark, source_dir, "{" + ",".join(wanted) + "}"))
    absent = sorted(row.file_name for row in missing.collect())
    if absent:
        raise FileNotFoundError(f"not found in {source_dir}: {', '.join(absent)}")
