"""Incremental refresh on newly arriving price files.

A Structured Streaming file source picks up new monthly files; each micro
batch is handled in ``foreachBatch``:

1. the batch is written to the price history, partitioned by category and
   batch id, so a replayed batch overwrites its own partitions — idempotent;
2. the moments of every (category, item) — count, mean, squared deviations —
   are kept as state: the batch's own moments are merged into the state that
   earlier batches left, and written as that of this batch.  Only the batch
   is read for it;
3. z-scores depend on the whole history of a category, so the categories
   present in the batch are scored again over all their years, from the new
   state; the history scan is pruned to their partitions;
4. network, score and evolution tables are replaced for those categories
   only (partitioned by category);
5. the yearly roll-up is replaced for every year those categories have data
   in, also where their networks lost all edges.

A replaced partition without new rows (a category or year whose last edge is
gone) is removed.  Categories absent from the batch keep their files
untouched.  Where a price is revised, the first value in the order of batches
and files stays, as in one read of all files.  CSV and JSON files are bound by
their column names; their bad rows go to ``rejected``, one folder a batch.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pricenet.functions.moments import STATE, merged, moments, zscored
from pricenet.operators import scoring as W
from pricenet.plans.analysis import Analysis
from pricenet.session import cut_lineage
from pricenet.sources.files import PLACE, accepted, read_by_name

PRICE_SCHEMA = T.StructType([
    T.StructField("city", T.StringType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("category", T.StringType()),
    T.StructField("month_year", T.StringType()),
    T.StructField("item_description", T.StringType()),
    T.StructField("price", T.DoubleType()),
])

PRICE_TYPES = {f.name: f.dataType.simpleString() for f in PRICE_SCHEMA.fields}

# The price history also keeps where each row came from.
HISTORY_SCHEMA = T.StructType([*PRICE_SCHEMA.fields, T.StructField("place", T.StructType([
    T.StructField("path", T.StringType()), T.StructField("start", T.LongType()), T.StructField("row", T.LongType())])),
    T.StructField("batch_id", T.LongType())])

ITEM = ["category", "item_description"]
MOMENTS_SCHEMA = T.StructType([
    T.StructField("category", T.StringType()), T.StructField("item_description", T.StringType()),
    T.StructField("n", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in STATE[1:]],
    T.StructField("batch_id", T.LongType())])
# What the binary file source tells about new files; their content is not read.
_FILES = "path string, modificationTime timestamp, length long, content binary"


def _read_or_none(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The table at ``path``, or None where nothing has been written; other errors are raised."""
    try:
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def _place(batch: DataFrame) -> Column:
    """Where a row stands in its batch: file and split, if the stream told them, and row within the split."""
    if PLACE in batch.columns:
        return F.col(PLACE)
    told = "_path" in batch.columns
    return F.struct((F.col("_path") if told else F.lit("")).alias("path"),
                    (F.col("_start") if told else F.lit(0).cast("long")).alias("start"),
                    F.monotonically_increasing_id().alias("row"))


def _of(categories: Sequence[str | None]) -> Column:
    """Rows of some categories, as a filter that prunes partitions."""
    named = F.col("category").isin([c for c in categories if c is not None])
    return named | F.col("category").isNull() if None in categories else named


class Refresher:
    """State and sinks of one refresh pipeline rooted at ``output_dir``."""

    def __init__(self, cities: Sequence[str], tau: float, output_dir: str,
                 category_weights: Mapping[str, float] | None = None):
        self.cities = list(cities)
        self.tau = tau
        self.out = output_dir.rstrip("/")
        self.category_weights = dict(category_weights or {})

    def history_path(self) -> str:
        return f"{self.out}/history"

    def history(self, spark: SparkSession, categories: Sequence[str | None]) -> DataFrame:
        """All prices of some categories; other categories' partitions are not read."""
        return spark.read.schema(HISTORY_SCHEMA).parquet(self.history_path()).where(_of(categories))

    def _delete(self, spark: SparkSession, name: str, **partition: str | int | None) -> None:
        jvm, path = spark.sparkContext._jvm, f"{self.out}/{name}"
        for col, value in partition.items():
            path += f"/{col}=" + ("__HIVE_DEFAULT_PARTITION__" if value is None else
                                  jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(str(value)))
        stale = jvm.org.apache.hadoop.fs.Path(path)
        stale.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(stale, True)

    def _replace(self, df: DataFrame, name: str, col: str, touched: DataFrame) -> None:
        """Replace the partitions ``col`` in ``touched`` of a table by the rows of ``df``.

        Partitions with rows are overwritten; a touched one without rows is
        deleted (its name is one value of the batch's categories or years).
        """
        df = cut_lineage(df)
        self._overwrite(df, name, col)
        emptied = touched.select(col).distinct().join(df.select(col).distinct(), col, "left_anti")
        for row in emptied.toLocalIterator():
            self._delete(df.sparkSession, name, **{col: row[0]})

    def _overwrite(self, df: DataFrame, name: str, *cols: str) -> None:
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*cols)
         .parquet(f"{self.out}/{name}"))

    def merge_moments(self, spark: SparkSession, batch_id: int, categories: Sequence[str | None]) -> DataFrame:
        """State of the batch's categories after it: that of the latest earlier batch and the batch's own moments.

        Reads the batch and its categories' states alone.  A state is kept until
        the second batch after it, so a replayed batch finds what it had found.
        """
        own = moments(self.history(spark, categories).where(F.col("batch_id") == batch_id), ITEM, "price")
        stored = _read_or_none(spark, f"{self.out}/moments", MOMENTS_SCHEMA)
        if stored is None:
            state, versions = own, []
        else:
            earlier = stored.where(_of(categories) & (F.col("batch_id") < batch_id))
            versions = [(r.category, r.batch_id) for r in earlier.select("category", "batch_id").distinct().collect()]
            latest = {c: max(k for x, k in versions if x == c) for c, _ in versions}
            last = F.lit(False)
            for category, k in latest.items():
                last = last | (F.col("category").eqNullSafe(F.lit(category)) & (F.col("batch_id") == k))
            state = merged(earlier.where(last).drop("batch_id"), own, ITEM)
            versions = [(c, k) for c, k in versions if k < latest[c]]
        state = cut_lineage(state)
        self._overwrite(state.withColumn("batch_id", F.lit(batch_id).cast("long")), "moments", "category", "batch_id")
        for category, k in versions:
            self._delete(spark, "moments", category=category, batch_id=k)
        return state

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        self._overwrite(batch.select(*PRICE_SCHEMA.fieldNames(), _place(batch).alias("place"),
                                     F.lit(batch_id).cast("long").alias("batch_id")), "history", "category", "batch_id")
        written = _read_or_none(spark, self.history_path(), HISTORY_SCHEMA)
        categories = [] if written is None else [
            r.category for r in written.where(F.col("batch_id") == batch_id).select("category").distinct().collect()]
        if not categories:
            return
        touched = spark.createDataFrame([(c,) for c in categories], "category string")
        state = self.merge_moments(spark, batch_id, categories)
        obs = (zscored(self.history(spark, categories), state, ITEM, "price", "normalized_price")
               .select("city", "year", "category", "month_year", "item_description", "normalized_price",
                       F.struct("batch_id", "place").alias("ordinal")))
        a = Analysis(obs, self.cities, tau=self.tau, category_weights=self.category_weights)
        metadata = cut_lineage(a.metadata)
        self._replace(metadata, "network_metadata", "category", touched)
        self._replace(a.scores, "weighted_scores", "category", touched)
        self._replace(a.evolution, "network_evolution", "category", touched)
        # New history changes the z-scores of a touched category in every year
        # it has data in: each of these years gets a new roll-up over all
        # categories, touched or not.
        years = metadata.select("year").distinct()
        scores = self.current_scores(spark)
        if scores is None:
            scores = a.scores
        yearly = W.scores_by_year(scores.join(years, "year", "left_semi"), sort=False)
        self._replace(yearly, "final_rankings", "year", years)

    def process_files(self, fmt: str):
        """A batch of new text files: bound by name, bad rows set apart, the rest processed."""
        def run(files: DataFrame, batch_id: int) -> None:
            spark = files.sparkSession
            paths = [r.path for r in files.select("path").collect()]
            if paths:
                rows = read_by_name(spark, paths, fmt, PRICE_TYPES)
                self.process(accepted(rows, f"{self.out}/rejected/batch_id={batch_id}", "overwrite"), batch_id)
        return run

    def current_scores(self, spark: SparkSession) -> DataFrame | None:
        """Scores of all networks that currently have edges; None before there is any."""
        return _read_or_none(spark, f"{self.out}/weighted_scores")

    def start(self, spark: SparkSession, source_dir: str, checkpoint_location: str,
              available_now: bool = True, fmt: str = "parquet", files_per_batch: int = 1000) -> StreamingQuery:
        """The refresh of a folder.  A batch holds at most ``files_per_batch`` files (the driver lists them)."""
        stream = spark.readStream.option("maxFilesPerTrigger", str(files_per_batch))
        if fmt == "parquet":
            src = stream.schema(PRICE_SCHEMA).format(fmt).load(source_dir).select(
                "*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"))
            run = self.process
        else:
            # The stream tells which files are new; each is read by its own header.
            src, run = stream.schema(_FILES).format("binaryFile").load(source_dir).select("path"), self.process_files(fmt)
        writer = src.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint_location)
        writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 hour")
        return writer.start()
