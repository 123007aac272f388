"""A stored ledger of files that were read, so that the next run reads only new and changed ones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.operators.relational import join_reduced
from adlake.sources.readers import plain_path
from adlake.sources.writers import stage

COLUMNS = "file_path STRING, length BIGINT, modified_at TIMESTAMP"


def listed(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """The files below a folder as ``file_path``, ``length`` and ``modified_at``; none is opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return files.select(plain_path(F.col("path")).alias("file_path"), "length", F.col("modificationTime").alias("modified_at"))


def ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger's entries; one is created if there is none."""
    spark.createDataFrame([], COLUMNS).write.mode("append").parquet(path)
    return spark.read.schema(COLUMNS).parquet(path)


def unread(files: DataFrame, known: DataFrame) -> DataFrame:
    """Files whose path, length and time the ledger does not have: new ones, and old ones that changed."""
    entry = F.struct("file_path", "length", "modified_at")
    seen = known.select(entry.alias("__entry")).distinct()
    return join_reduced(files.withColumn("__file", entry), seen, {"__file": "__entry"}, "left_anti").drop("__file")


class NewFiles:
    """The files of a folder that a ledger lacks, fixed when this is made, and entered when they are done.

        new = NewFiles(spark, folder, "/shared/ledger", "*.csv")
        if new.paths:
            rows, rejected = read_reports(spark, manifest, new.paths, schema)
            ...write them...
            new.done()

    The list is staged, so files that land meanwhile wait for the next run. A run that breaks off
    before ``done`` enters nothing and is repeated: its sink must take rows twice, as
    merges and partition overwrites do. ``paths`` are held by the driver, as Spark's own file list is.
    """

    def __init__(self, spark: SparkSession, folder: str, ledger_path: str, pattern: str = "*") -> None:
        self.ledger_path = ledger_path
        self.files = stage(unread(listed(spark, folder, pattern), ledger(spark, ledger_path)), "new-files")
        self.paths = [r.file_path for r in self.files.select("file_path").collect()]

    def done(self) -> None:
        self.files.write.mode("append").parquet(self.ledger_path)
