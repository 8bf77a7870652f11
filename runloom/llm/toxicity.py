"""Convolutional toxicity classifier over hashed word embeddings.

Words are lower-cased runs of letters. A word's embedding is that of its hash
bucket; only buckets that enough training texts hold are stored, all others are
zero, so a word never seen cannot look like one that was. Filters of several
widths slide over the embeddings, each gives its maximum over the text, and a
logistic layer weighs the maxima (Kim, 2014). Embeddings start from smoothed log
odds along one direction and are trained with the filters by Adagrad, in numpy.
Scores are those of the text alone; thresholds for a decision are calibrated for
each language on training rows that the weights were not fitted to.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from runloom.llm.common import arrow_batches, arrow_map, require
from runloom.llm.labelled import fitted, fold, labelled_sample

WIDTHS, FILTERS, DIM = (1, 2, 3), 8, 16
BUCKETS = 1 << 24
#: Labelled rows of each class that a model is fitted on at most, and bytes of the longest text among them.
PER_CLASS, MAX_BYTES = 6000, 1 << 17
#: Training texts that must hold a word.
MIN_TEXTS = 2
#: For each so many toxic texts, a text at the classes' shares that a word is taken to have been in already; 20 at most.
SHRINK = 80
EPOCHS, BATCH, RATE = 4, 64, 0.05
CACHE = 200_000
#: Words that are scored at once.
CHUNK = 1 << 16

_SPACES = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def words_of(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_SPACES).split()


class Rows(dict):
    """Embedding row of each word; words not met yet are hashed."""

    def __init__(self, rows: dict[int, int]) -> None:
        super().__init__()
        self.rows = rows

    def __missing__(self, word: bytes) -> int:
        row = self.rows.get(zlib.crc32(word) % BUCKETS, 0)
        if len(self) < CACHE:
            self[word] = row
        return row


@dataclass
class Model:
    buckets: np.ndarray  # of rows 1, 2, ...
    embeddings: np.ndarray  # row 0 is zero
    filters: dict[int, np.ndarray]  # width: (width, DIM, FILTERS)
    biases: dict[int, np.ndarray]
    out: np.ndarray
    bias: float
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = 0.5

    def rows(self) -> Rows:
        return Rows({b: i + 1 for i, b in enumerate(self.buckets.tolist())})

    def _tables(self) -> dict[int, list[np.ndarray]]:
        return {w: [np.ascontiguousarray(self.embeddings @ f[k]) for k in range(w)] for w, f in self.filters.items()}

    def pooled(self, ids: list[np.ndarray], tables: dict[int, list[np.ndarray]]) -> np.ndarray:
        """Maxima of each text; texts of any length, a chunk of words at a time."""
        out = np.zeros((len(ids), len(WIDTHS) * FILTERS), np.float32)
        best = np.full((len(WIDTHS), len(ids), FILTERS), -np.inf, np.float32)
        for who, flat, starts, sizes, last in _chunks(ids):
            for j, w in enumerate(WIDTHS):
                conv = tables[w][0][flat[: len(flat) - w + 1]]
                for k in range(1, w):
                    conv += tables[w][k][flat[k : len(flat) - w + 1 + k]]
                # A text's windows end with the zeros behind it, a part's where the next part begins.
                stops = starts + np.where(last, sizes + max(WIDTHS) + 1 - w, sizes)
                pairs = np.minimum(np.stack([starts, stops], axis=1).ravel(), len(conv) - 1)
                best[j][who] = np.maximum(best[j][who], np.maximum.reduceat(conv, pairs, axis=0)[::2])
        for j, w in enumerate(WIDTHS):
            out[:, j * FILTERS : (j + 1) * FILTERS] = np.maximum(best[j] + self.biases[w], 0)
        return out

    def score(self, ids: list[np.ndarray], tables: dict[int, list[np.ndarray]] | None = None) -> np.ndarray:
        z = self.pooled(ids, tables or self._tables()) @ self.out + self.bias
        return 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -40, 40)))


def _chunks(ids: list[np.ndarray]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(texts, ids with zeros after each, starts, sizes, whether it is a text's last part) of about CHUNK words."""
    lap = max(WIDTHS) - 1
    have, size = [], 0
    for k, x in enumerate(ids):
        for s in range(0, max(len(x), 1), CHUNK):
            last = s + CHUNK >= len(x)
            if have and (size + CHUNK > 2 * CHUNK or have[-1][0] == k):
                yield _joined(have)
                have, size = [], 0
            have.append((k, x[s:] if last else x[s : s + CHUNK + lap], last))
            size += len(have[-1][1])
    if have:
        yield _joined(have)


def _joined(have: list[tuple[int, np.ndarray, bool]]) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    zeros = np.zeros(max(WIDTHS), np.int64)
    flat = np.concatenate([y for _, x, _ in have for y in (x, zeros)] + [zeros])
    full = np.array([len(x) + len(zeros) for _, x, _ in have])
    sizes = np.array([len(x) if last else CHUNK for _, x, last in have])
    return [k for k, _, _ in have], flat, np.concatenate([[0], np.cumsum(full)[:-1]]), sizes, np.array([last for _, _, last in have])


def fit(texts: list[str], labels: np.ndarray, langs: list[str | None], class_sizes: dict[int, int] | None = None, seed: int = 3) -> Model:
    """A model of the rows; every fifth is kept for the thresholds."""
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, np.int64)
    n = len(texts)
    hold = np.zeros(n, bool)
    hold[rng.permutation(n)[: n // 5]] = True
    hashed = [np.fromiter((zlib.crc32(w) % BUCKETS for w in words_of(t)), np.int32) for t in texts]
    train = np.flatnonzero(~hold)
    own = [np.unique(hashed[k]) for k in train.tolist()]
    none = np.empty(0, np.int32)
    seen, texts_with = np.unique(np.concatenate([none, *own]), return_counts=True)
    common = texts_with >= MIN_TEXTS
    buckets = seen[common].astype(np.int64)
    bad, bad_texts = np.unique(np.concatenate([none, *(x for k, x in zip(train.tolist(), own, strict=True) if labels[k])]), return_counts=True)
    del own
    prior = float(np.clip(labels[train].mean() if len(train) else 0.5, 0.02, 0.98))
    pos = np.zeros(len(buckets))
    there = np.isin(bad, buckets, assume_unique=True)
    pos[np.searchsorted(buckets, bad[there])] = bad_texts[there]
    neg = texts_with[common] - pos
    shrink = float(np.clip(labels[train].sum() / SHRINK, 1, 20))
    odds = np.log((pos + shrink * prior) / (neg + shrink * (1 - prior))) - np.log(prior / (1 - prior))
    axis = rng.normal(size=DIM)
    axis /= np.linalg.norm(axis)
    emb = np.zeros((len(buckets) + 1, DIM), np.float32)
    emb[1:] = 0.5 * odds[:, None] * axis + rng.normal(scale=0.02, size=(len(buckets), DIM))
    filters = {w: (rng.normal(scale=0.1, size=(w, DIM, FILTERS)) + axis[None, :, None] / w).astype(np.float32) for w in WIDTHS}
    model = Model(buckets, emb, filters, {w: np.full(FILTERS, -1.0, np.float32) for w in WIDTHS}, np.full(len(WIDTHS) * FILTERS, 1.5 / (len(WIDTHS) * FILTERS), np.float32), -1.0)
    # Weights bring the sample back to the share that each class has among the labels.
    share = {y: class_sizes.get(y, 0) / max((labels == y).sum(), 1) for y in (0, 1)} if class_sizes else {0: 1.0, 1: 1.0}
    top = max(share.values()) or 1.0
    weight = np.array([max(share[int(y)] / top, 0.2) for y in labels], np.float32)
    ids = []
    for k, h in enumerate(hashed):
        at = np.minimum(np.searchsorted(buckets, h), max(len(buckets) - 1, 0))
        ids.append((np.where(buckets[at] == h, at + 1, 0) if len(buckets) else np.zeros(len(h))).astype(np.int32))
        hashed[k] = none
    _train(model, ids, labels, weight, train, rng)
    _calibrate(model, model.score([ids[k] for k in np.flatnonzero(hold)]), labels[hold], weight[hold], [langs[k] for k in np.flatnonzero(hold)])
    return model


def _train(model: Model, ids: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, train: np.ndarray, rng: np.random.Generator) -> None:
    grads = {"e": np.full(len(model.embeddings), 1e-4, np.float32), "o": np.full(len(model.out), 1e-4, np.float32), "b": 1e-4}
    grads |= {w: np.full(f.shape, 1e-4, np.float32) for w, f in model.filters.items()}
    edge = np.zeros(max(WIDTHS) - 1, np.int64)
    for _ in range(EPOCHS):
        order = rng.permutation(train)
        for s in range(0, len(order), BATCH):
            batch = order[s : s + BATCH].tolist()
            pooled, places = np.zeros((len(batch), len(model.out)), np.float32), []
            tokens = [np.concatenate([ids[k], edge, edge[:1]]) for k in batch]
            x = model.embeddings[np.concatenate(tokens)]
            ends = np.cumsum([len(t) for t in tokens])
            starts = ends - [len(t) for t in tokens]
            for j, w in enumerate(WIDTHS):
                conv = sum(x[k : len(x) - w + 1 + k] @ model.filters[w][k] for k in range(w))
                at = np.stack([a + conv[a : b - w + 1].argmax(axis=0) for a, b in zip(starts, ends, strict=True)])
                places.append(at)
                pooled[:, j * FILTERS : (j + 1) * FILTERS] = np.maximum(np.take_along_axis(conv, at, axis=0) + model.biases[w], 0)
            z = pooled @ model.out + model.bias
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[batch]) * weight[batch] / len(batch)
            back = err[:, None] * model.out[None, :] * (pooled > 0)
            g = pooled.T @ err
            grads["o"] += g * g
            model.out -= RATE * g / np.sqrt(grads["o"])
            grads["b"] += float(err.sum()) ** 2
            model.bias -= RATE * float(err.sum()) / np.sqrt(grads["b"])
            flat = np.concatenate(tokens)
            touched, pushed = [], []
            for j, w in enumerate(WIDTHS):
                d = back[:, j * FILTERS : (j + 1) * FILTERS]
                model.biases[w] -= RATE * d.sum(axis=0)
                for k in range(w):
                    hit = places[j] + k  # (batch, filters)
                    own = x[hit]  # (batch, filters, DIM)
                    g = np.einsum("bf,bfd->df", d, own)
                    touched.append(flat[hit].ravel())
                    pushed.append((d[:, :, None] * model.filters[w][k].T[None]).reshape(-1, DIM))
                    grads[w][k] += g * g
                    model.filters[w][k] -= RATE * g / np.sqrt(grads[w][k])
            rows, inverse = np.unique(np.concatenate(touched), return_inverse=True)
            g = np.zeros((len(rows), DIM), np.float32)
            np.add.at(g, inverse, np.concatenate(pushed))
            g[rows == 0] = 0
            grads["e"][rows] += (g * g).sum(axis=1)
            model.embeddings[rows] -= RATE * g / np.sqrt(grads["e"][rows])[:, None]


def _calibrate(model: Model, scores: np.ndarray, labels: np.ndarray, weight: np.ndarray, langs: list[str | None]) -> None:
    """Thresholds of best F1, in the middle of the gap; a language with few rows of a class takes the common one."""

    def best(s: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
        order = np.argsort(-s, kind="stable")
        s, y, w = s[order], y[order], w[order]
        tp, fp = np.cumsum(y * w), np.cumsum((1 - y) * w)
        f1 = 2 * tp / np.maximum(tp + fp + (y * w).sum(), 1e-9)
        last = np.append(s[1:] != s[:-1], True)
        k = int(np.argmax(np.where(last, f1, -1)))
        return float((s[k] + (s[k + 1] if k + 1 < len(s) else 0.0)) / 2)

    if labels.sum() and (1 - labels).sum():
        model.threshold = best(scores, labels, weight)
    for lang in sorted({x for x in langs if x is not None}):
        own = np.array([x == lang for x in langs])
        if labels[own].sum() >= 20 and (1 - labels[own]).sum() >= 20:
            model.thresholds[lang] = best(scores[own], labels[own], weight[own])


def _scored(shared) -> object:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        rows, tables = model.rows(), model._tables()
        for batch in batches:
            for part in (batch.slice(k, 250) for k in range(0, len(batch), 250)):
                ids = [np.array(list(map(rows.__getitem__, words_of(t or ""))), np.int64) for t in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array(model.score(ids, tables)), part.column(2)], names=["id", "score", "lang"])

    return run


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = None) -> DataFrame:
    """``(id_col, score, flagged)``, one row for each input row.

    The score is of the text alone; ``flagged`` compares it with the threshold
    of the row's language, or the common one. Null text counts as empty and has
    a score like any other; other columns are not read. An empty table gives an
    empty result.
    """
    require(docs, id_col, text_col)
    spark: SparkSession = docs.sparkSession
    arrow_batches(spark)
    lang = F.col(lang_col) if lang_col else F.lit(None).cast("string")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), lang.cast("string").alias("lang"))
    kind = docs.schema[id_col].dataType.simpleString()
    scored = rows.transform(arrow_map, _scored(spark.sparkContext.broadcast(model)), f"id {kind}, score double, lang string")
    limit = F.lit(model.threshold)
    for name, t in model.thresholds.items():
        limit = F.when(F.col("lang") == name, t).otherwise(limit)
    return scored.select(F.col("id").alias(id_col), "score", (F.col("score") >= limit).alias("flagged"))


def fit_documents(docs: DataFrame, labels: DataFrame, keep, id_col: str = "doc_id", text_col: str = "text", lang_col: str | None = "lang", per_class: int = PER_CLASS, max_bytes: int = MAX_BYTES) -> Model:
    """A model of a bounded sample of the labelled rows that ``keep`` admits; language is used for thresholds only."""
    sample, sizes = labelled_sample(docs, labels, "toxic", keep, per_class, max_bytes, id_col, text_col, lang_col)
    return fitted(sample, lambda rows: fit(rows["text"].tolist(), rows["y"].to_numpy(), rows["lang"].tolist(), sizes))


def reject_toxic(docs: DataFrame, model: Model, text_col: str = "text", lang_col: str | None = "lang") -> DataFrame:
    """The rows that the model does not flag at their language's threshold, with all their columns.

    A null or empty text has a score like any other; a null language, or one
    without a threshold of its own, takes the common one. Null ids and repeated
    rows are judged like any other; an empty table gives an empty result.
    """
    require(docs, text_col)
    arrow_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    # Whole rows pass through the workers, so that these tidy up after each partition; a last column names the language.
    rows = docs.withColumn("__lang", F.col(lang_col).cast("string") if lang_col else F.lit(None).cast("string"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: Model = shared.value
        words, tables = own.rows(), own._tables()
        for batch in batches:
            text = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            ids = [np.array(list(map(words.__getitem__, words_of(t or ""))), np.int64) for t in text]
            limit = np.array([own.thresholds.get(x, own.threshold) for x in batch.column(batch.num_columns - 1).to_pylist()], np.float64)
            kept = batch.filter(pa.array(own.score(ids, tables) < limit))
            yield kept.select(list(range(batch.num_columns - 1)))

    return rows.transform(arrow_map, run, docs.schema)


def op3_toxicity(spark, sf_dir):
    """Toxicity score of every document; fitted on labelled rows outside fold 2 of 4."""
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_documents(docs, labels, fold("doc_id", 4) != 2)
    scored = score_documents(docs, model, lang_col="lang")
    return scored.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"), "flagged")
