"""Session construction and lineage-cutting helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Groups of the key (year, category) always travel together.
GROUP = ["year", "category"]


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "pricenet") -> SparkSession:
    """Session for local runs and tests.

    On a cluster, use the session that ``spark-submit`` provides; the
    library only reads settings from it (see :func:`ensure_checkpoint_dir`).
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PRICENET_DRIVER_MEMORY", "16g"))
    )
    if master:
        builder = builder.master(master)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Local-mode fallback folders of sessions without a SparkContext handle.
_LOCAL_DIRS: dict[int, str] = {}


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only if none is named.

    The cluster names a shared folder in ``spark.checkpoint.dir`` (a static
    setting, read here, never written); that value wins, then a folder
    already set on the context.  Only a local-mode session without any
    setting (tests, laptops) gets a private temporary folder — a
    machine-local folder is useless on a cluster, so there we refuse
    instead of guessing.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a local SparkContext
        sc = None
    if conf_dir:
        if sc is not None and not sc.getCheckpointDir():
            sc.setCheckpointDir(conf_dir)
        return conf_dir
    if sc is not None:
        current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
        if current:
            return current
        master = sc.master
    else:
        if id(spark) in _LOCAL_DIRS:
            return _LOCAL_DIRS[id(spark)]
        master = spark.conf.get("spark.master", "")
    if not master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative graph steps need a "
            "shared checkpoint folder on a cluster")
    local_dir = tempfile.mkdtemp(prefix="pricenet-ckpt-")
    if sc is not None:
        sc.setCheckpointDir(local_dir)
        return sc.getCheckpointDir() or local_dir
    _LOCAL_DIRS[id(spark)] = local_dir
    return local_dir


def run_folder(spark: SparkSession) -> str:
    """Sub-folder for this application's intermediate tables.

    All tables one application writes share ``pricenet-tables/<app id>``
    under the checkpoint folder, so one delete removes a finished run.
    """
    try:
        return spark.sparkContext.applicationId
    except Exception:  # sessions without a local SparkContext
        return spark.conf.get("spark.app.id", "run")


# Sub-folders of open :func:`scratch` blocks, innermost last.
_SCRATCH: list[str] = []


def _tables_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/pricenet-tables/{run_folder(spark)}"


def cut_lineage(df: DataFrame, keep: bool = False) -> DataFrame:
    """Write ``df`` as a parquet table in the checkpoint folder and read it back.

    Later plans start from a compact file scan instead of re-planning (and,
    after an executor loss, re-running) the whole lineage.  Unlike an RDD
    checkpoint, the file scan carries size statistics, so the planner can
    broadcast a small result behind its size threshold and prune columns.
    With ``keep`` the table outlives a :func:`scratch` block.
    """
    return cut_lineage_counted(df, count=False, keep=keep)[0]


def cut_lineage_counted(df: DataFrame, count: bool = True, keep: bool = False) -> tuple[DataFrame, int | None]:
    """:func:`cut_lineage` that also returns the number of rows written.

    The count is read from the footers of the written files.
    """
    spark = df.sparkSession
    folder = [_tables_folder(spark), *([] if keep else _SCRATCH)]
    path = "/".join([*folder, uuid.uuid4().hex])
    df.write.mode("overwrite").parquet(path)
    written = spark.read.schema(df.schema).parquet(path)
    return written, written.count() if count else None


def _delete_folder(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables cut within the block are deleted at its end, but those with ``keep``."""
    _SCRATCH.append(f"scratch-{uuid.uuid4().hex}")
    try:
        yield
    finally:
        folder = "/".join([_tables_folder(spark), *_SCRATCH])
        _SCRATCH.pop()
        _delete_folder(spark, folder)


def drop_run_tables(spark: SparkSession) -> None:
    """Delete the tables that :func:`cut_lineage` wrote for this application.

    For the end of a job: DataFrames built on those tables cannot be read
    afterwards.
    """
    _delete_folder(spark, _tables_folder(spark))
