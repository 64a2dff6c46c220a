"""Names that a table's own columns and an operator's results do not share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def own_names(docs: DataFrame, *needed: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """The table with other names for all columns but those needed, and the way back to its own."""
    names = [c if c in needed else f"own_{i}" for i, c in enumerate(docs.columns)]
    own = list(docs.columns)
    return docs.toDF(*names), lambda df: df.select(*(F.col(a).alias(b) for a, b in zip(names, own, strict=True)))
