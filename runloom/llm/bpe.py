"""Byte-level BPE in padded numpy matrices.

A text is split by the pattern; each distinct piece is merged once. Pieces are
bucketed by length into matrices with one row a piece, padded with -1. In each
round every row merges its leftmost pair of least rank: pairs are looked up in
an open-addressing hash table, the rows' minima are taken, and the merged column
is squeezed out; rows without a pair leave the matrix. Pieces longer than
``LONG`` bytes merge by the same rule with a heap, in n log n.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from runloom.llm.common import arrow_batches, arrow_map, require, utf8

LONG = 256
#: Pieces that a worker remembers, and characters of one that is worth remembering.
CACHE, SHORT = 300_000, 64
_NONE = np.int64(2**62)


class PairTable:
    """Open-addressing hash table from pairs of ids to the merged id, with vectorised lookup."""

    def __init__(self, pairs: dict[tuple[int, int], int]) -> None:
        keys = np.array([(a << 32) | b for a, b in pairs], np.int64)
        values = np.fromiter(pairs.values(), np.int64, len(pairs))
        self.bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 4))))
        size = 1 << self.bits
        self.keys, self.values = np.full(size, -1, np.int64), np.full(size, _NONE, np.int64)
        left, step = np.arange(len(keys)), 0
        slots = self._slot(keys)
        while len(left):
            at = (slots[left] + step) & (size - 1)
            free = self.keys[at] < 0
            first = np.unique(at[free], return_index=True)[1]
            won = left[free][first]
            self.keys[at[free][first]] = keys[won]
            self.values[at[free][first]] = values[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            step += 1
        self.probes = max(step, 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged id of each pair, or a number above all ids."""
        keys = (left.astype(np.int64) << 32) | right
        out = np.full(len(keys), _NONE, np.int64)
        if not len(keys):
            return out
        at = self._slot(keys)
        todo = np.arange(len(keys))
        for _ in range(self.probes):
            got = self.keys[at]
            same = got == keys[todo]
            out[todo[same]] = self.values[at[same]]
            go = ~same & (got >= 0)
            if not go.any():
                break
            todo, at = todo[go], (at[go] + 1) & (len(self.keys) - 1)
        return out


class Codec:
    """Encoder and decoder for a rank table: bytes of each token to its rank."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    pairs[a, b] = rank
        self.pairs, self.table = pairs, PairTable(pairs)
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.cache: dict[str, bytes] = {}
        self.back: dict[bytes, bytes] = {}

    @classmethod
    def load(cls, data: bytes, pattern: str) -> Codec:
        """From the content of a rank file: base64 token and rank in each line."""
        return cls({base64.b64decode(a): int(b) for a, b in (line.split() for line in data.splitlines() if line.strip())}, pattern)

    def merge_matrix(self, rows: list[bytes]) -> list[np.ndarray]:
        """Ids of pieces of similar length."""
        n = len(rows)
        width = max(map(len, rows))
        m = np.full((n, width), -1, np.int64)
        sizes = np.array([len(r) for r in rows])
        m[np.arange(width) < sizes[:, None]] = self.bytes[np.frombuffer(b"".join(rows), np.uint8)]
        out: list[np.ndarray] = [np.empty(0, np.int64)] * n
        who = np.arange(n)
        pair = np.full((n, max(width - 1, 0)), _NONE, np.int64)
        if width > 1:
            good = m[:, 1:] >= 0
            pair[good] = self.table.find(m[:, :-1][good], m[:, 1:][good])
        while len(who):
            if pair.shape[1]:
                col = pair.argmin(axis=1)
                best = pair[np.arange(len(who)), col]
                done = best >= _NONE
            else:
                done = np.ones(len(who), bool)
            for k in np.flatnonzero(done).tolist():
                out[who[k]] = m[k][m[k] >= 0]
            if done.all():
                break
            keep = ~done
            m, pair, who, col, best = m[keep], pair[keep], who[keep], col[keep], best[keep]
            rows_at = np.arange(len(who))
            # Squeeze the right half of the merged pair out of both matrices.
            cols = np.arange(m.shape[1] - 1)
            shift = cols[None, :] > col[:, None]
            m = np.where(shift, m[:, 1:], m[:, :-1])
            m[rows_at, col] = best
            if pair.shape[1] > 1:
                cols = np.arange(pair.shape[1] - 1)
                pair = np.where(cols[None, :] >= col[:, None], pair[:, 1:], pair[:, :-1])
                for side in (-1, 0):  # only the pairs next to the merged id change
                    at = col + side
                    ok = (at >= 0) & (at < pair.shape[1])
                    r, c = rows_at[ok], at[ok]
                    left, right = m[r, c], m[r, c + 1]
                    got = np.full(len(r), _NONE, np.int64)
                    real = (left >= 0) & (right >= 0)
                    got[real] = self.table.find(left[real], right[real])
                    pair[r, c] = got
            else:
                pair = np.full((len(who), 0), _NONE, np.int64)
        return out

    def merge_long(self, piece: bytes) -> np.ndarray:
        """Ids of one long piece, by a heap of (rank, place) over a linked list."""
        ids = self.bytes[np.frombuffer(piece, np.uint8)].tolist()
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i) for i in range(n - 1) if (r := self.pairs.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = after[i] if ids[i] >= 0 else -1
            if j < 0 or self.pairs.get((ids[i], ids[j])) != r:
                continue
            ids[i], ids[j] = r, -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for a in (before[i], i):
                if a >= 0 and after[a] >= 0 and (x := self.pairs.get((ids[a], ids[after[a]]))) is not None:
                    heapq.heappush(heap, (x, a))
        return np.array([x for x in ids if x >= 0], np.int64)

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Ids of each piece as little-endian unsigned 32-bit integers."""
        out: list[bytes] = [b""] * len(pieces)
        rest: dict[int, list[tuple[int, bytes]]] = {}
        for k, p in enumerate(pieces):
            raw = p.encode("utf-8", "surrogatepass")
            if (whole := self.ranks.get(raw)) is not None:
                out[k] = whole.to_bytes(4, "little")
            elif len(raw) > LONG:
                out[k] = self.merge_long(raw).astype("<u4").tobytes()
            else:
                n = len(raw)
                rest.setdefault(n if n <= 16 else -(-n // 8) * 8 if n <= 64 else -(-n // 64) * 64, []).append((k, raw))
        for group in rest.values():
            for s in range(0, len(group), 8192):
                part = group[s : s + 8192]
                for (k, _), ids in zip(part, self.merge_matrix([r for _, r in part]), strict=True):
                    out[k] = ids.astype("<u4").tobytes()
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, without special tokens."""
        split = [self.pattern.findall(t) for t in texts]
        if len(self.cache) > CACHE:
            self.cache.clear()
        cache = self.cache
        new = list({p for s in split for p in s if p not in cache})
        cache.update(zip(new, self.encode_pieces(new), strict=True))
        out = [b"".join([cache[p] for p in s]) for s in split]
        for p in new:
            if len(p) > SHORT:
                del cache[p]
        return out

    def decode(self, ids: bytes) -> bytes:
        """Bytes of little-endian 32-bit ids; unknown ids raise."""
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def codec_of(path: str, pattern: str) -> Codec:
    """The codec of a rank file; a worker builds its tables once, not once a task."""
    with open(path, "rb") as f:
        return Codec.load(f.read(), pattern)


#: Texts that are encoded at once.
PART = 200


def _encode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path, pattern)
        for batch in batches:
            for part in (batch.slice(k, PART) for k in range(0, len(batch), PART)):
                ids = codec.encode([t or "" for t in part.column(1).to_pylist()])
                yield pa.record_batch([part.column(0), pa.array(ids, pa.binary())], names=["id", "ids"])

    return run


def encode_texts(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, ids binary)``: ids as little-endian unsigned 32-bit integers, one row for each input row.

    ``path`` names a rank file that every machine has. Null text counts as
    empty and gives no ids; texts of any length are encoded whole; null ids and
    repeated rows stay. Other columns are not read.
    """
    require(docs, id_col, text_col)
    arrow_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col)).transform(arrow_map, _encode(path, pattern), "id long, ids binary").withColumnRenamed("id", id_col)


def _decode(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(path, pattern)
        for batch in batches:
            at = batch.schema.get_field_index("ids")
            out = [codec.decode(x or b"") for x in batch.column(at).to_pylist()]
            yield pa.record_batch([batch.column(1 - at), batch.column(at), pa.array(out, pa.binary())], names=["id", "ids", "decoded"])

    return run


def decode_ids(encoded: DataFrame, path: str, pattern: str, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, ids, decoded binary)`` from rows of ``(id_col, ids)``; null ids count as none."""
    require(encoded, id_col, "ids")
    return encoded.select(F.col(id_col).alias("id"), "ids").transform(arrow_map, _decode(path, pattern), "id long, ids binary, decoded binary").withColumnRenamed("id", id_col)


def _both(path: str, pattern: str):
    encode, decode = _encode(path, pattern), _decode(path, pattern)
    return lambda batches: decode(encode(batches))


def round_trip(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode_ids`` of ``encode_texts`` in one pass of the workers."""
    require(docs, id_col, text_col)
    arrow_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col))
    return rows.transform(arrow_map, _both(path, pattern), "id long, ids binary, decoded binary").withColumnRenamed("id", id_col)


def op9_bpe(spark, sf_dir):
    """Ids of every document by the multilingual rank file, and their decoded bytes, as digests."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    both = round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), path, pattern)
    return both.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
