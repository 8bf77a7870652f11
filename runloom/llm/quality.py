"""Supervised subword embeddings for text quality.

As in fastText (Joulin et al., 2016): hashed vectors of words, word bigrams and character
n-grams inside words with their boundaries, averaged over the text, and a softmax
layer, trained by stochastic gradient descent in numpy. All features of a text
come from one pass of prefix hashes over its bytes. As the layer is linear in the
average, scoring folds vectors and layer into one number a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from runloom.llm.common import RollingHash, arrow_batches, arrow_map, mix64, require
from runloom.llm.labelled import fitted, fold, labelled_sample

BITS, DIM, GRAMS = 18, 8, (3, 4)
PER_CLASS, MAX_BYTES = 3000, 1 << 17
EPOCHS, RATE = 4, 0.5
#: Bytes of text that are hashed at once; a longer text comes in parts, each led by the word before it. A single word
#: of more bytes than this is cut, and its parts count as words.
CHUNK = 1 << 18

_BLANKS = bytes([9, 10, 11, 12, 13, 32])
_SPACE = np.zeros(256, bool)
_SPACE[[*_BLANKS]] = True


@lru_cache(maxsize=1)
def _hasher() -> RollingHash:
    return RollingHash(101, CHUNK * 2 + 64)


def features(data: np.ndarray, fresh: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, number of the text) of all features of texts that lie in ``data`` with white space around each; those that begin before ``fresh`` were counted with the part before."""
    h = _hasher()
    p = h.prefix(data)
    space = _SPACE[data]
    # Words: from a non-space after a space to the next space.
    first = np.flatnonzero(~space[1:] & space[:-1]) + 1
    last = np.flatnonzero(~space[:-1] & space[1:]) + 1
    owner = np.searchsorted(ends, first, side="right")
    words = h.slices(p, first, last)
    new = first >= fresh[owner]
    yield (words[new] >> np.uint64(64 - BITS)).astype(np.int64), owner[new]
    # Word bigrams by the difference of their hashes: a word that follows itself is the same bigram whatever the word.
    same = owner[1:] == owner[:-1]
    pairs = mix64((words[1:] - words[:-1])[same] + np.uint64(1))
    yield (pairs >> np.uint64(64 - BITS)).astype(np.int64), owner[1:][same]
    before = np.concatenate([[0], np.cumsum(space)])
    for n in GRAMS:
        codes = h.grams(p, n)
        at = np.arange(len(codes))
        ok = before[at + n - 1] == before[at + 1]  # white space at the ends only, as a word's boundary
        at = at[ok]
        owner = np.searchsorted(ends, at + 1, side="right")  # the second letter's text, as the first may be the space before
        inside = owner < len(ends)
        at, owner = at[inside], owner[inside]
        new = at + 1 >= fresh[owner]
        at, owner = at[new], owner[new]
        yield ((codes[at] ^ np.uint64(n * 0x9E3779B97F4A7C15 % 2**64)) >> np.uint64(64 - BITS)).astype(np.int64), owner


def _parts(text: bytes) -> Iterator[tuple[bytes, int]]:
    """(part, bytes at its start that the part before held): the text in parts of CHUNK bytes, cut at white space, each led by the last word before it."""
    s, word = 0, b""
    while True:
        e = len(text)
        if e - s > CHUNK:
            e = max(text.rfind(bytes([c]), s + 1, s + CHUNK) for c in _BLANKS)
            e = s + CHUNK if e <= s else e
        part = text[s:e]
        yield word + part, len(word)
        if e == len(text):
            return
        if text[e] not in _BLANKS:
            word = b""  # inside a word of over CHUNK bytes
        elif words := (word + part).rstrip(_BLANKS):
            word = words[max(words.rfind(bytes([c])) for c in _BLANKS) + 1 :]
            word = word if len(word) <= CHUNK // 2 else b""
        s = e


def _laid_out(texts: list[bytes]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """(numbers of the texts, bytes, where each one's new bytes start, ends) a chunk at a time."""
    who, parts, laps, size = [], [], [], 0
    for k, t in enumerate(texts):
        for part, lap in _parts(t):
            if size and size + len(part) > CHUNK:
                yield _lay(who, parts, laps)
                who, parts, laps, size = [], [], [], 0
            who.append(k)
            parts.append(part)
            laps.append(lap)
            size += len(part) + 1
    if who:
        yield _lay(who, parts, laps)


def _lay(who: list[int], parts: list[bytes], laps: list[int]) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray]:
    data = np.frombuffer(b" " + b" ".join(parts) + b" ", np.uint8)
    sizes = np.array([len(p) + 1 for p in parts])
    ends = np.cumsum(sizes) + 1
    return who, data, ends - sizes + np.array(laps), ends


@dataclass
class Model:
    vectors: np.ndarray  # (buckets, DIM)
    layer: np.ndarray  # (2, DIM)
    bias: np.ndarray  # (2,)

    def folded(self) -> np.ndarray:
        return (self.vectors @ (self.layer[1] - self.layer[0])).astype(np.float32)

    def score(self, texts: list[bytes], folded: np.ndarray | None = None) -> np.ndarray:
        table = self.folded() if folded is None else folded
        total, count = np.zeros(len(texts)), np.zeros(len(texts))
        for who, data, fresh, ends in _laid_out(texts):
            numbers = np.array(who)
            for bucket, owner in features(data, fresh, ends):
                total += np.bincount(numbers[owner], table[bucket], len(texts))
                count += np.bincount(numbers[owner], minlength=len(texts))
        z = total / np.maximum(count, 1) + self.bias[1] - self.bias[0]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit(texts: list[bytes], labels: np.ndarray, class_sizes: dict[int, int] | None = None, seed: int = 5) -> Model:
    """A model of the rows, one step of gradient descent a text, at a rate that falls to zero."""
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, np.int64)
    model = Model(rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32), np.zeros((2, DIM), np.float32), np.zeros(2))
    bags: list[tuple[np.ndarray, np.ndarray]] = []
    for t in texts:
        found = [b for _, data, fresh, ends in _laid_out([t]) for b, _ in features(data, fresh, ends)]
        ids, counts = np.unique(np.concatenate(found), return_counts=True)
        bags.append((ids.astype(np.int32), (counts / max(counts.sum(), 1)).astype(np.float32)))
    share = {y: class_sizes.get(y, 0) / max((labels == y).sum(), 1) for y in (0, 1)} if class_sizes else {0: 1.0, 1: 1.0}
    top = max(share.values()) or 1.0
    weight = {y: max(v / top, 0.1) for y, v in share.items()}
    steps = EPOCHS * len(texts)
    done = 0
    for _ in range(EPOCHS):
        for k in rng.permutation(len(texts)).tolist():
            rate = RATE * (1 - done / steps)
            done += 1
            ids, c = bags[k]
            h = c @ model.vectors[ids] if len(ids) else np.zeros(DIM, np.float32)
            z = model.layer @ h + model.bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[labels[k]] -= 1
            p *= weight[int(labels[k])]
            back = (p @ model.layer).astype(np.float32)
            model.layer -= (rate * np.outer(p, h)).astype(np.float32)
            model.bias -= rate * p
            if len(ids):
                # fastText adds the text's gradient to each of its vectors, once for each occurrence.
                model.vectors[ids] -= rate * np.minimum(c * len(ids), 4)[:, None] * back
    return model


def _scored(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model = shared.value
        folded = model.folded()
        for batch in batches:
            for part in (batch.slice(k, 250) for k in range(0, len(batch), 250)):
                texts = [(t or "").encode("utf-8", "replace") for t in part.column(1).to_pylist()]
                yield pa.record_batch([part.column(0), pa.array(model.score(texts, folded))], names=["id", "score"])

    return run


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, score)``, one row for each input row: the probability of quality 1.

    Null text counts as empty; a text without a word has the score of the bias.
    Other columns are not read. An empty table gives an empty result.
    """
    require(docs, id_col, text_col)
    spark = docs.sparkSession
    arrow_batches(spark)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.transform(arrow_map, _scored(spark.sparkContext.broadcast(model)), f"id {kind}, score double").withColumnRenamed("id", id_col)


def fit_documents(docs: DataFrame, labels: DataFrame, keep, id_col: str = "doc_id", text_col: str = "text", per_class: int = PER_CLASS, max_bytes: int = MAX_BYTES) -> Model:
    """A model of a bounded sample of the labelled rows that ``keep`` admits."""
    sample, sizes = labelled_sample(docs, labels, "quality", keep, per_class, max_bytes, id_col, text_col)
    return fitted(sample, lambda rows: fit([t.encode("utf-8", "replace") for t in rows["text"]], rows["y"].to_numpy(), sizes))


def op8_quality(spark, sf_dir):
    """Quality score of every document; fitted on labelled rows outside fold 0 of 5."""
    docs, labels = spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_documents(docs, fit_documents(docs, labels, fold("doc_id", 5) != 0))
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
