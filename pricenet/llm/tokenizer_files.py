"""Tokenizer files: read once on the driver, broadcast, parsed once per Python worker.

A file is a parameter (a path the driver can read).  Its content is a
vocabulary of fixed size (about 1.6 MB for the ones used here), which bounds
the broadcast whatever the corpus.
"""

from __future__ import annotations

import json
import os

from pyspark import Broadcast
from pyspark.sql import SparkSession

MAX_BYTES = 64_000_000
_PARSED: dict[int, object] = {}


def broadcast_file(spark: SparkSession, path: str) -> Broadcast:
    if os.path.getsize(path) > MAX_BYTES:
        raise ValueError(f"{path}: a vocabulary file of over {MAX_BYTES} bytes is not broadcast")
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def per_worker(kind, shared: Broadcast):
    """``kind(content)`` of the broadcast file, built once in each Python worker."""
    content = shared.value
    key = hash((kind.__qualname__, content))
    if key not in _PARSED:
        _PARSED[key] = kind(content)
    return _PARSED[key]


def special_tokens(content: str) -> dict[str, int]:
    return {t["content"]: t["id"] for t in json.loads(content)["added_tokens"]}
