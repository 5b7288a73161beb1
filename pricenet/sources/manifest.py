"""Ingest manifest (S4): download / conversion status files.

The manifest is a CSV whose header is the union of two layouts: download
rows fill Month_Year, Status, Timestamp, Filepath; conversion / listing rows
fill Status, Timestamp, Month, Data_Type, Filename, URL, File_Size_MB.
Files of either layout (or both) are read with an explicit schema and
combined by name; the roll-up counts rows and sums sizes per status.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The manifest header, in file order.
MANIFEST_COLUMNS = ["Month_Year", "Status", "Timestamp", "Filepath", "Error", "Month",
                    "Data_Type", "Filename", "URL", "File_Size_MB"]

MANIFEST_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType() if c == "File_Size_MB" else T.StringType()) for c in MANIFEST_COLUMNS])


def read_manifest(spark: SparkSession, paths: Iterable[str]) -> DataFrame:
    """Read manifest files and combine them by column name.

    A file may carry only its own layout's columns; missing ones are null.
    Header lines are read in one job, and files with the same header are one
    read, however many there are.  ``Timestamp`` becomes a timestamp
    (``yyyy-MM-dd HH:mm:ss``).
    """
    paths = list(paths)
    layouts: dict[str, list[str]] = {}
    if paths:
        # The first line of each file: its row with the smallest place.
        lines = spark.read.text(paths).select(
            F.col("_metadata.file_path").alias("path"), "value",
            F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"))
        for r in lines.groupBy("path").agg(F.min_by("value", "place").alias("header")).collect():
            layouts.setdefault(r.header, []).append(r.path)
    out = spark.createDataFrame([], MANIFEST_SCHEMA)
    for header in sorted(layouts):
        df = spark.read.option("header", "true").option("inferSchema", "false").csv(sorted(layouts[header]))
        out = out.unionByName(df.select(*[F.col(c).cast(MANIFEST_SCHEMA[c].dataType).alias(c)
                                          for c in df.columns if c in MANIFEST_COLUMNS]), allowMissingColumns=True)
    return out.withColumn("Timestamp", F.to_timestamp("Timestamp", "yyyy-MM-dd HH:mm:ss"))


def status_rollup(manifest: DataFrame) -> DataFrame:
    """Rows and total megabytes per status."""
    return manifest.groupBy("Status").agg(
        F.count("*").alias("files"), F.sum("File_Size_MB").alias("total_mb"))
