"""What the vector operators share: which vectors count, packing, components in numpy."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def finite(vector: str) -> Column:
    """True where a vector is not null, not empty, not all zero and all its components are finite."""
    x = F.col(vector).cast("array<double>")
    inf = F.lit(float("inf"))
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (v < inf) & (v > -inf))
    return F.coalesce((F.size(x) > 0) & good & F.exists(x, lambda v: v != 0), F.lit(False))


def valid_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, vector array<double>, dim)`` of the rows whose vectors count."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector")).filter(F.col("id").isNotNull())
    return rows.filter(finite("vector")).withColumn("dim", F.size("vector"))


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node of each node's component, for edges a-b among nodes 0 to n - 1."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new
