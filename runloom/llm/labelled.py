"""Bounded labelled samples for the classifiers, and fitting on them in one task."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from runloom.llm.common import arrow_map
from runloom.session import written

#: Bytes of text that a sample holds for each class at most.
TOTAL_BYTES = 1 << 24


def fold(id_col: str, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % folds


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, keep: Column, per_class: int, max_bytes: int,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = None, total_bytes: int = TOTAL_BYTES,
) -> tuple[DataFrame, dict[int, int]]:
    """Up to ``per_class`` labelled rows of each class with their whole texts, and the classes' sizes.

    ``keep`` filters the labels (it may use the id only). Rows are taken in
    order of a hash of their id until the class holds ``total_bytes`` of text, so
    the sample is the same in every run. Texts of over ``max_bytes`` are not
    sampled. Labels that are null or not 0 or 1 are not used; an id labelled twice
    counts with its larger label, a document that repeats with its least text.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(id_col).isNotNull() & keep).groupBy(id_col).agg(F.max(label).alias("y"))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), (F.col(lang_col) if lang_col else F.lit(None)).cast("string").alias("lang"))
    sizes = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    order = F.xxhash64(F.col("id"), F.lit(5))
    parts = [known.filter(F.col("y") == y).orderBy(F.xxhash64(F.col(id_col), F.lit(5)), id_col).limit(per_class) for y in (0, 1)]
    chosen = parts[0].unionAll(parts[1]).withColumnRenamed(id_col, "id")  # 2 * per_class rows at most
    rows = texts.filter(F.octet_length("text") <= max_bytes).join(F.broadcast(chosen), "id")
    rows = written(rows.groupBy("id", "y").agg(F.min(F.struct("text", "lang")).alias("t")).select("id", "t.text", "t.lang", "y"))
    places = rows.select("y", order.alias("at"), F.octet_length("text").alias("bytes")).toArrow()  # 2 * per_class rows at most
    y, at, size = (places.column(c).to_numpy() for c in ("y", "at", "bytes"))
    by = np.lexsort((at, y))
    inside = F.lit(False)
    for label_ in np.unique(y).tolist():
        own = by[y[by] == label_]
        fits = own[np.cumsum(size[own]) <= total_bytes]
        if len(fits):
            inside |= (F.col("y") == int(label_)) & (order <= int(at[fits[-1]]))
    return rows.filter(inside), sizes


def fitted(sample: DataFrame, fit: Callable[[pd.DataFrame], object]):
    """What ``fit`` makes of the sample, a pandas frame in order of id; it runs in one task, so the driver holds the result only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        frame = pa.Table.from_batches(held).to_pandas() if held else empty
        yield pa.record_batch([pa.array([pickle.dumps(fit(frame.sort_values("id").reset_index(drop=True)), protocol=5)], pa.binary())], names=["model"])

    empty = pd.DataFrame({c: [] for c in sample.columns})
    model = arrow_map(sample.coalesce(1), run, "model binary").first()
    return pickle.loads(model["model"]) if model else fit(empty)  # Spark leaves out a task that reads no rows
