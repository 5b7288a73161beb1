"""Text files (CSV, JSON lines) read by column name, with bad rows set apart.

A CSV file's columns are bound by its own header, whatever their order; other
columns are left out and a missing one is an error that names it.  Files with
the same header are one read, however many there are.  Every value is read as
text and converted under control: a row that is malformed, or whose number is
none, keeps its record and gets a reason instead of silent nulls.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricenet.functions.validation import require_names
from pricenet.session import cut_lineage

# What the reader adds to the asked columns.
REASON, RECORD, PLACE = "reject_reason", "record", "place"
_CORRUPT = "_corrupt_record"

# Row numbers within a partition sit in the low bits of a monotonically increasing id.
_ROW_BITS = (1 << 33) - 1


def file_order() -> Column:
    """Order of a row in a file source: file path, start of its split, row within the split.

    Spark deals splits to tasks by size, so a row id alone does not follow the
    files; within one split it does.
    """
    return F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
                    F.monotonically_increasing_id().bitwiseAND(F.lit(_ROW_BITS)).alias("row"))


def header_layouts(spark: SparkSession, paths: Sequence[str], **options) -> list[list[str]]:
    """The files of each distinct header line; empty files are left out.

    One job reads the lines; the driver gets one line and path a file.
    """
    lines = spark.read.text(list(paths), lineSep=options.get("lineSep")).select(
        F.col("_metadata.file_path").alias("path"), "value",
        F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("place"))
    layouts: dict[str, list[str]] = {}
    for r in lines.where(F.trim("value") != "").groupBy("path").agg(F.min_by("value", "place").alias("header")).collect():
        layouts.setdefault(r.header, []).append(r.path)
    return [sorted(layouts[header]) for header in sorted(layouts)]


def _named(name: str, columns: Iterable[str]) -> str:
    return next(c for c in columns if c.lower() == name.lower())


def _converted(text: Column, kind: str) -> tuple[Column, Column]:
    """A text as its type, and whether it is no such value; blank and NaN count as missing."""
    if kind == "string":
        return text, F.lit(False)
    trimmed = F.trim(text)
    if kind == "double":
        value = trimmed.try_cast("double")
        missing = text.isNull() | (trimmed == "") | F.coalesce(F.isnan(value), F.lit(False))
        bad = ~missing & (value.isNull() | F.abs(value).isin(float("inf")))
        return F.when(~missing & ~bad, value), bad
    value = trimmed.try_cast(kind)
    missing = text.isNull() | (trimmed == "")
    return F.when(~missing, value), ~missing & value.isNull()


def _typed(texts: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Text columns with the broken record beside them -> typed columns, place, record and reason."""
    typed, reasons = [], [F.when(F.col(_CORRUPT).isNotNull(), F.lit("malformed record"))]
    own = texts.columns
    for name, kind in columns.items():
        text = F.col(f"`{_named(name, own)}`")
        value, bad = _converted(text, kind)
        typed.append(value.alias(name))
        reasons.append(F.when(bad, F.concat(F.lit(f"{name} is no {kind}: "), text)))
    # Whole rows are kept as they were read, the broken ones as their line.
    kept = F.to_json(F.struct(*[F.col(f"`{c}`") for c in own if c != _CORRUPT]))
    return texts.select(*typed, file_order().alias(PLACE), F.coalesce(*reasons).alias(REASON),
                        F.coalesce(_CORRUPT, kept).alias(RECORD))


def _csv(spark: SparkSession, paths: Sequence[str], columns: Mapping[str, str], options: Mapping) -> list[DataFrame]:
    parts = []
    for files in header_layouts(spark, paths, **options):
        reader = spark.read.options(**options).option("header", "true")
        names = reader.option("inferSchema", "false").csv(files[0]).columns
        require_names(names, columns)
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, _CORRUPT]])
        # Without pruning, so that a row with too many or too few fields is seen whichever columns are asked.
        parts.append(_typed(reader.schema(schema).option("mode", "PERMISSIVE").option("columnPruning", "false")
                            .option("columnNameOfCorruptRecord", _CORRUPT).csv(files), columns))
    return parts


def _json(spark: SparkSession, paths: Sequence[str], columns: Mapping[str, str], options: Mapping) -> list[DataFrame]:
    # JSON names its fields in every row: a column is missing when no row has it.
    keys = spark.read.text(list(paths)).select(F.explode(F.json_object_keys("value")).alias("key")).distinct()
    wanted = {c.lower() for c in columns}
    names = sorted(r.key for r in keys.where(F.lower("key").isin(sorted(wanted))).collect())
    if not names and not spark.read.text(list(paths)).where(F.trim("value") != "").head(1):
        return []
    require_names(names, columns)
    schema = T.StructType([T.StructField(_named(c, names), T.StringType()) for c in columns] + [T.StructField(_CORRUPT, T.StringType())])
    return [_typed(spark.read.options(**options).schema(schema).option("mode", "PERMISSIVE")
                   .option("columnNameOfCorruptRecord", _CORRUPT).json(list(paths)), columns)]


def read_by_name(spark: SparkSession, paths: Sequence[str], fmt: str, columns: Mapping[str, str], **options) -> DataFrame:
    """``columns`` (name -> type) of CSV or JSON-lines files, and place, record and reject_reason of every row.

    Names are compared without case.  Extra columns are left out.  A required
    column that a CSV header (or every JSON row) lacks raises a ValueError.
    Blank values and NaN are null; other values that do not convert, infinite
    numbers and malformed records get a reason.  Empty files give no rows.
    """
    parts = {"csv": _csv, "json": _json}[fmt](spark, paths, columns, options)
    if not parts:
        place = "struct<path: string, start: bigint, row: bigint>"
        ddl = ", ".join(f"{n} {k}" for n, k in columns.items())
        return spark.createDataFrame([], f"{ddl}, {PLACE} {place}, {REASON} string, {RECORD} string")
    return reduce(DataFrame.unionByName, parts)


def accepted(rows: DataFrame, rejects: str | None, mode: str = "append") -> DataFrame:
    """The good rows of :func:`read_by_name`; the others are written to the parquet table ``rejects``.

    Without ``rejects`` the first bad row that is read fails the job with its
    reason.  With it the rows are parsed once, into a written table.
    """
    if rejects is None:
        checked = F.when(F.col(REASON).isNull(), F.lit(True)).otherwise(
            F.raise_error(F.concat(F.lit("bad row: "), REASON)).cast("boolean"))
        return rows.where(checked).drop(REASON, RECORD)
    rows = cut_lineage(rows)
    (rows.where(F.col(REASON).isNotNull()).select(F.col(f"{PLACE}.path").alias("path"), REASON, RECORD)
     .write.mode(mode).parquet(rejects))
    return rows.where(F.col(REASON).isNull()).drop(REASON, RECORD)
