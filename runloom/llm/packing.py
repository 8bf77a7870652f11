"""Packing of documents into token windows by Karmarkar-Karp multiway differencing.

Each partition is one stream of blocks. A document's whole windows are full
sequences at once; the rests of a block's documents, cut to a quarter of a window
at most and gathered to bundles of an eighth, are dealt to m windows,
m = ceil(tokens / capacity), by multiway differencing: two partial partitions
are merged by adding the fullest window of one to the emptiest of the other,
largest difference first, until one partition is left. If its fullest window
exceeds the capacity, m rises by one and the block is dealt again. Two bundles
that follow each other hold over an eighth of a window, so a block has sixteen for
each window at most, however short its documents are. No shuffle is needed, a
block's size bounds the memory, and a lost task is redone alike.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zlib
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from runloom.llm.common import arrow_batches, arrow_map, require

CAPACITY = 2048
#: Windows that one block fills, and pieces of a window that a document's rest is cut to: differencing needs
#: several items a window to come out near-equal (0.4 % padding in place of 3 % with uncut rests).
BLOCK_WINDOWS, CUTS = 384, 4
#: Pieces of a block at most; documents of a few tokens reach it before the windows are full.
BLOCK_PIECES = 1 << 18


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Ids of one text as the tokenizer file gives them, no special tokens added.

    A plain byte-level BPE file whose ids follow its merges is run by its
    ranks; any other file, and any text that the ranks' library refuses (a run of
    about a million spaces), by the tokenizers library itself.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, added = spec["model"], spec.get("added_tokens") or []
    pre = json.dumps(spec.get("pre_tokenizer") or {})
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model.get("merges", [])]
    vocab = model.get("vocab", {})
    plain = (
        model.get("type", "BPE") == "BPE" and '"ByteLevel"' in pre and "Split" not in pre and '"add_prefix_space": true' not in pre and not spec.get("normalizer")
        and not model.get("dropout") and not model.get("ignore_merges") and not model.get("continuing_subword_prefix") and not model.get("end_of_word_suffix")
        and not model.get("byte_fallback") and '"use_regex": false' not in pre
        and len(vocab.keys() - {t["content"] for t in added}) == 256 + len(merges) and all(vocab.get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
        and all(not (t.get("normalized") or t.get("lstrip") or t.get("rstrip") or t.get("single_word")) for t in added)
    )

    @cache
    def library():
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        return t

    def slow(text: str) -> np.ndarray:
        return np.array(library().encode(text, add_special_tokens=False).ids, np.uint32)

    if not plain:
        return slow
    import public_tokenizers
    import tiktoken

    special = {t["content"]: t["id"] for t in added}
    letters = byte_letters()
    ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if token not in special}
    run = tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

    def fast(text: str) -> np.ndarray:
        try:
            return run.encode_to_numpy(text, allowed_special="all")
        except ValueError:  # the pattern's backtracking has a bound
            return slow(text)

    return fast


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in byte-level vocabularies, by its published rule."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def differencing(sizes: list[int], m: int) -> np.ndarray:
    """Window of each item, by Karmarkar-Karp differencing into ``m`` windows; ties by order."""
    n = len(sizes)
    if m <= 1 or n == 0:
        return np.zeros(n, np.int64)
    # A node holds its windows' sums in descending order, less the least.
    merges: list[tuple[int, int, np.ndarray]] = []
    heap = []
    sums: dict[int, np.ndarray] = {}
    for i, s in enumerate(sizes):
        v = np.zeros(m, np.int64)
        v[0] = s
        sums[i] = v
        heap.append((-s, i))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        both = sums.pop(a) + sums.pop(b)[::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        both -= both[-1]
        node = n + len(merges)
        merges.append((a, b, order))
        sums[node] = both
        heapq.heappush(heap, (-int(both[0]), node))
    out = np.empty(n, np.int64)
    # Window of each slot, handed down from the last node.
    slots = {heap[0][1]: np.arange(m)}
    for k in range(len(merges) - 1, -1, -1):
        a, b, order = merges[k]
        own = slots.pop(n + k)
        back = np.empty(m, np.int64)
        back[order] = own
        slots[a], slots[b] = back, back[::-1]
    for i in range(n):
        out[i] = slots[i][0]
    return out


def pack(sizes: list[int], capacity: int) -> tuple[np.ndarray, int]:
    """(window of each item, windows); every window holds ``capacity`` at most."""
    if not sizes:
        return np.zeros(0, np.int64), 0
    m = max(1, -(-sum(sizes) // capacity))
    while True:
        where = differencing(sizes, m)
        if np.bincount(where, sizes, m).max() <= capacity:
            return where, m
        m += 1


class Rests:
    """Rests of a block's documents in columns, and the bundles that they are gathered to."""

    def __init__(self, capacity: int) -> None:
        self.most, self.bundle = max(1, capacity // CUTS), max(1, capacity // (2 * CUTS))
        self.ids: list[int | None] = []
        self.columns = tuple(array("q") for _ in range(4))  # start, length, crc, doc_tokens
        self.bundles: list[int] = []  # tokens
        self.first = array("q")  # first piece of each bundle
        self.held = 0

    def add(self, i: int | None, start: int, piece: np.ndarray, tokens: int) -> None:
        n = len(piece)
        if not self.bundles or self.bundles[-1] + n > self.bundle:
            self.first.append(len(self.ids))
            self.bundles.append(0)
        self.bundles[-1] += n
        self.ids.append(i)
        for column, x in zip(self.columns, (start, n, zlib.crc32(piece.tobytes()), tokens), strict=True):
            column.append(x)
        self.held += n

    def settle(self, capacity: int, serial: int) -> tuple[pa.RecordBatch, int]:
        """Rows of all pieces, in sequences from ``serial`` on, and how many sequences these are."""
        where, m = pack(self.bundles, capacity)
        filled, starts = np.zeros(max(m, 1), np.int64), np.zeros(len(where), np.int64)
        for k, (w, size) in enumerate(zip(where.tolist(), self.bundles, strict=True)):
            starts[k] = filled[w]
            filled[w] += size
        first = np.array(self.first, np.int64)
        start, length, crc, tokens = (np.array(c, np.int64) for c in self.columns)
        bundle = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(length))))
        before = np.cumsum(length) - length
        offset = starts[bundle] + before - before[first[bundle]]
        columns = (start, length, crc, tokens, serial + where[bundle], offset)
        return pa.record_batch([pa.array(self.ids, pa.int64()), *map(pa.array, columns)], names=_NAMES), m


_PIECES = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_NAMES = [x.split()[0] for x in _PIECES.split(", ")]


def _packed(path: str, capacity: int, end_id: int, block_windows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        task = TaskContext.get()
        serial = (task.partitionId() if task else 0) << 40
        rests = Rests(capacity)
        for batch in batches:
            out: list[tuple] = []
            for i, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.append(encode(text or ""), end_id).astype("<u4")
                n = len(ids)
                for s in range(0, n - n % capacity, capacity):
                    out.append((i, s, capacity, zlib.crc32(ids[s : s + capacity].tobytes()), n, serial, 0))
                    serial += 1
                for s in range(n - n % capacity, n, rests.most):
                    rests.add(i, s, ids[s : s + rests.most], n)
                if rests.held >= capacity * block_windows or len(rests.ids) >= BLOCK_PIECES:
                    rows, m = rests.settle(capacity, serial)
                    yield rows
                    serial += m
                    rests = Rests(capacity)
            columns = list(zip(*out, strict=True)) or [()] * len(_NAMES)
            yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=_NAMES)
        if rests.ids:
            yield rests.settle(capacity, serial)[0]

    return run


def pack_documents(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = 1, block_windows: int = BLOCK_WINDOWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row a piece: ``(id_col, start, length, ids_crc32, doc_tokens, sequence_id, offset)``.

    A document is its ids and then ``end_id``; null text counts as empty, so
    each document has a piece. Long documents are cut at multiples of the
    capacity. Null ids and repeated rows are packed like any other; other columns
    are not read. An empty table gives an empty result.
    """
    require(docs, id_col, text_col)
    arrow_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col)).transform(arrow_map, _packed(path, capacity, end_id, block_windows), _PIECES).withColumnRenamed("id", id_col)


def op4_packing(spark, sf_dir):
    """Pieces of every document in sequences of 2,048 tokens."""
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
