"""Texts with a label, for operators that learn."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000  # ids and labels, some 16 bytes each: up to here they go to the texts


def with_labels(docs: DataFrame, labels: DataFrame, key: str, label_key: str, label: str) -> DataFrame:
    """Rows of `docs` that have a label, with `_label`; a key that is labelled twice counts once, with the lower label.

    The labels' number is checked: few are broadcast, many meet the texts in a shuffle.
    """
    told = labels.filter(F.col(label).isNotNull() & F.col(label_key).isNotNull()).groupBy(
        F.col(label_key).alias("_label_key")).agg(F.min(label).alias("_label"))
    if labels.count() <= BROADCAST_ROWS:
        told = F.broadcast(told)
    return docs.join(told, F.col(key) == F.col("_label_key")).drop("_label_key")
