"""Column helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Text handled at a time inside a task, in characters.
PIECE_CHARS = 2_000_000


def id_and_text(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator reads, renamed, a null text as the empty one.

    Other columns are pruned here, so their names cannot clash with results.
    """
    return df.select(F.col(id_col).cast("long").alias("id"),
                     F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def runs_of(texts: list[str], limit: int = PIECE_CHARS) -> Iterator[tuple[int, int]]:
    """Consecutive index ranges of ``texts`` of about ``limit`` characters each."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= limit:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(texts):
        yield start, len(texts)
