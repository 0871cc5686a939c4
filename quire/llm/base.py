"""Shared pieces of the training-data operators: table access, checkpoints and Arrow batch helpers."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quire.session import cut, shared_dir, table

__all__ = ["table", "cut", "shared_dir", "lean", "by_chars"]


def lean(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that extra columns with clashing names never reach an operator."""
    return df.select(*[F.col(c) for c in columns])


def by_chars(texts: list, limit: int) -> Iterator[tuple[int, int]]:
    """Ranges of a batch that hold at most ``limit`` characters each (or one text that alone is longer)."""
    start = size = 0
    for i, text in enumerate(texts):
        n = len(text) if text else 0
        if size and size + n > limit:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(texts):
        yield start, len(texts)
