"""What the two document classifiers share: held-out rows, the bounded training sample, measures."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(modulus: int, remainder: int, id_column: str = "doc_id") -> Column:
    """True where crc32 of the id as text leaves ``remainder``; false for a null id."""
    key = F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary"))
    return F.col(id_column).isNotNull() & (key % modulus == remainder)


def training_ids(labels: DataFrame, label: str, modulus: int, remainder: int, per_class: int, id_column: str = "doc_id") -> DataFrame:
    """id and y (0 or 1) of at most ``per_class`` labelled, not held-out rows of each class, chosen by a hash of the id.

    Null or other labels are left out; of an id's repeated labels the largest counts.
    """
    rows = labels.where(F.col(id_column).isNotNull() & F.col(label).isin(0, 1) & ~held_out(modulus, remainder, id_column))
    rows = rows.groupBy(F.col(id_column).cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("y"))
    order = F.xxhash64("doc_id"), F.col("doc_id")
    return rows.where("y = 1").orderBy(*order).limit(per_class).union(rows.where("y = 0").orderBy(*order).limit(per_class))


def share_of_ones(labels: DataFrame, label: str, modulus: int, remainder: int, id_column: str = "doc_id") -> float:
    """Share of label 1 among all labelled rows that are not held out; a half where there are none."""
    rows = labels.where(F.col(id_column).isNotNull() & F.col(label).isin(0, 1) & ~held_out(modulus, remainder, id_column))
    found = rows.agg(F.avg(label)).first()[0]
    return 0.5 if found is None else float(found)


def auc(score: np.ndarray, y: np.ndarray) -> float:
    """Chance that a row of label 1 scores higher than one of label 0; ties count half."""
    values, inverse, count = np.unique(score, return_inverse=True, return_counts=True)
    rank = (np.cumsum(count) - (count - 1) / 2)[inverse]
    n = int(y.sum())
    return float((rank[y == 1].sum() - n * (n + 1) / 2) / max(1, n * (len(y) - n)))
