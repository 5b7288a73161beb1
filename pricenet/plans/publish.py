"""Results that appear as a whole: staged run folders and markers.

A run writes its tables and report to a folder of its own,
``<output>/runs/<run>``.  Only when all of it is there, an empty marker file
``<output>/published/<run>`` is created, which every file system and object
store does in one step.  Readers follow the newest marker.  A run that dies
before its marker leaves the earlier result whole and unread files behind,
which the next published run clears away.

Run names start with the UTC time, so their order is the order of publishing
by drivers with a common clock.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from pricenet.plans.report import save_report, save_results

RUNS, MARKERS = "runs", "published"


def _path(spark: SparkSession, *parts: str):
    """(file system, path) of a folder or file below the output."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join(p.rstrip("/") for p in parts))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _names(spark: SparkSession, *parts: str) -> list[str]:
    fs, path = _path(spark, *parts)
    return sorted(s.getPath().getName() for s in fs.listStatus(path)) if fs.exists(path) else []


def published_folder(spark: SparkSession, output_dir: str) -> str | None:
    """Folder of the newest published run, None before the first one."""
    markers = _names(spark, output_dir, MARKERS)
    return "/".join([output_dir.rstrip("/"), RUNS, markers[-1]]) if markers else None


def read_published(spark: SparkSession, output_dir: str, table: str, fmt: str = "parquet") -> DataFrame:
    """One table of the newest published run."""
    folder = published_folder(spark, output_dir)
    if folder is None:
        raise FileNotFoundError(f"nothing is published under {output_dir}")
    reader = spark.read.option("header", "true") if fmt == "csv" else spark.read
    return reader.format(fmt).load(f"{folder}/{table}")


def publish_results(results: Mapping[str, DataFrame | None], report: str | None, spark: SparkSession,
                    output_dir: str, fmt: str = "parquet", keep: int = 2) -> str:
    """Write all tables and the report to a new run folder, then publish it; returns the folder.

    The newest ``keep`` published runs stay, so that a reader of the run just
    replaced can end its work; older ones and unpublished folders that are
    older than them are deleted (a run still being written is newer).
    """
    if keep < 1:
        raise ValueError("at least the published run has to stay")
    run = f"{_dt.datetime.now(_dt.timezone.utc):%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:8]}"
    folder = "/".join([output_dir.rstrip("/"), RUNS, run])
    save_results(results, folder, fmt)
    if report is not None:
        save_report(spark, report, folder)
    fs, marker = _path(spark, output_dir, MARKERS, run)
    fs.create(marker, False).close()
    _clear(spark, output_dir, keep)
    return folder


def _clear(spark: SparkSession, output_dir: str, keep: int) -> None:
    """Drop the markers beyond ``keep``, then the run folders older than the oldest marker left."""
    markers = _names(spark, output_dir, MARKERS)
    for name in markers[:-keep]:
        fs, path = _path(spark, output_dir, MARKERS, name)
        fs.delete(path, False)
    oldest = markers[-keep:][0]
    for name in _names(spark, output_dir, RUNS):
        if name < oldest:
            fs, path = _path(spark, output_dir, RUNS, name)
            fs.delete(path, True)
