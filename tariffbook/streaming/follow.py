"""Intake as a stream: files are found by a checkpointed file source and taken in batch by batch.

The stream tells which files are new; the ledger tells what was taken in. A
batch that was cut off comes again with the same files: those that the ledger
has are left out, the others get the same numbers as before, so ledger and rows
end the same. Neither the age of a file nor the size of a batch loses anything: a
delivery that is spread over several batches becomes current with its last file.

The stream knows a file by its path. One that is replaced under its path is
seen by ``intake.ingest``, which lists the folder, and not by the stream.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tariffbook.sources.manifest import file_entries
from tariffbook.streaming import intake

_FILE = "path string, modificationTime timestamp, length bigint, content binary"
# No file is too old: the source would otherwise skip files a week older than the newest.
_AGE = "365000d"


def arrivals(
    spark: SparkSession, source_dir: str, tables: Mapping[str, StructType], files_per_batch: int | None = None,
    archive_dir: str | None = None,
) -> DataFrame:
    """A stream of the entries of new files; contents are not read.

    With ``archive_dir``, files move there after a later batch has been committed.
    """
    options = {"pathGlobFilter": intake.file_pattern(tables), "recursiveFileLookup": True, "maxFileAge": _AGE}
    if files_per_batch is not None:
        options["maxFilesPerTrigger"] = files_per_batch
    if archive_dir is not None:
        options |= {"cleanSource": "archive", "sourceArchiveDir": archive_dir}
    return file_entries(spark.readStream.format("binaryFile").schema(_FILE).options(**options).load(source_dir))


def take_in_batch(files: DataFrame, landing_dir: str, tables: Mapping[str, StructType]) -> None:
    """Takes in those files of a batch that the ledger does not have."""
    spark = files.sparkSession
    ledger = intake.read_ledger(spark, landing_dir)
    new = intake.by_delivery(intake.not_in_ledger(files, ledger).collect())  # one row per file of the batch
    if new:
        last = ledger.agg(F.max("number")).first()[0]
        intake.take_in_all(spark, new, landing_dir, tables, 0 if last is None else last + 1, whole=False)


def follow(
    spark: SparkSession, source_dir: str, landing_dir: str, tables: Mapping[str, StructType], checkpoint_dir: str,
    files_per_batch: int | None = None, archive_dir: str | None = None, once: bool = True,
) -> StreamingQuery:
    """Starts the stream: up to what is there now (``once``), or on and on."""
    found = arrivals(spark, source_dir, tables, files_per_batch, archive_dir)
    trigger = {"availableNow": True} if once else {"processingTime": "1 minute"}
    return (
        found.writeStream.foreachBatch(lambda files, _: take_in_batch(files, landing_dir, tables))
        .option("checkpointLocation", checkpoint_dir)
        .trigger(**trigger)
        .start()
    )
