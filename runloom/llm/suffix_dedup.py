"""Repeated-substring removal by blockwise suffix sorting with a difference cover.

A window is a string of ``length`` bytes. A byte goes if some window over it
also starts anywhere else, in this document or another.

1. *Buckets.* Each window is keyed by its anchor, the leftmost k-gram of
   smallest hash inside it, and by the anchor's offset in the window. Equal
   windows have equal keys, so suffixes need sorting only inside a bucket, and a
   bucket whose anchor occurs once in the corpus is done. Windows that follow
   each other and share an anchor form a context of a few hundred bytes; equal
   contexts are counted before the shuffle, which settles whole copies.
2. *Blockwise suffix sort.* The contexts that stay open are sorted one block of
   buckets at a time. In a block the contexts are laid out with their anchors at
   multiples of v; a difference cover modulo v gives the sample positions, whose
   ranks come from prefix doubling. A suffix is then ordered by its bucket, its
   first bytes and, for ties, the rank of its next sample. Equal windows are
   neighbours in that order and are compared byte by byte.
3. *Hot buckets.* A bucket with more than ``hot`` open contexts (a passage that
   a third of all documents hold) is narrowed until each window is a bucket of
   its own; those are counted by a partial aggregate, exactly and in any number.
4. Covered ranges meet their document, are merged and cut out.

Two lengths can be judged in one pass: buckets and contexts are those of the
shorter windows, contexts carry the bytes that the longer windows need, and one
suffix order tells which of either are repeated.

Keys are 64-bit hashes of anchors with 64-bit hashes of contexts; the sort
itself compares bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from runloom.llm.common import RollingHash, arrow_batches, arrow_map, mix64, require, utf8
from runloom.session import written

#: Bytes that a repeated string has at least to be cut, and those that every passage of over 50 words reaches.
LENGTH, PASSAGE = 400, 240
#: Bytes of the anchor k-gram, and the window starts that are handled at once.
GRAM, PIECE = 60, 1 << 18
#: Modulus of the difference cover. Contexts of a block, in bytes.
COVER, BLOCK = 31, 1 << 19
#: Bytes of contexts that are sent to the sort at once.
CUT = 1 << 22
#: Open contexts of a bucket from which on its windows are counted one by one.
HOT = 4096


def difference_cover(v: int) -> np.ndarray:
    """The first smallest set of residues whose differences are all residues modulo v."""

    def grow(have: list[int], size: int) -> list[int] | None:
        seen = {(a - b) % v for a in have for b in have}
        if len(seen) == v:
            return have
        if len(have) == size or len(seen) + (size - len(have)) * 2 * len(have) + (size - len(have)) * (size - len(have) - 1) < v:
            return None
        for x in range(have[-1] + 1, v):
            if found := grow([*have, x], size):
                return found
        return None

    size = 2
    while not (found := grow([0, 1], size)):
        size += 1
    return np.array(found)


@lru_cache(maxsize=2)
def _hashers(size: int) -> tuple[RollingHash, RollingHash]:
    return RollingHash(11, size), RollingHash(23, size)


def _windows_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` neighbours."""
    out, span = values, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    return np.minimum(out[: len(out) - (width - span)], out[width - span :]) if width > span else out


def _contexts(data: np.ndarray, ends: np.ndarray, limits: np.ndarray, length: int, longest: int) -> tuple[np.ndarray, ...]:
    """Contexts of the texts that lie end to end in ``data``: text number, first window, last window, anchor (positions in data), bytes behind the last window that longer ones need, anchor hash, context hash.

    ``ends`` are the texts' ends, ``limits`` where their windows must end.
    """
    gram = min(GRAM, length)
    one, two = _hashers(PIECE * 2 + 2 * longest)
    p1 = one.prefix(data)
    h = one.grams(p1, gram)
    bits = np.uint64((1 << 21) - 1)
    packed = (h & ~bits) | np.arange(len(h), dtype=np.uint64)
    least = _windows_min(packed, length - gram + 1)
    n = len(least)
    starts = np.arange(n)
    text = np.searchsorted(ends, starts, side="right")
    good = starts + length <= limits[text]
    at = (least & bits).astype(np.int64)
    new = np.ones(n, bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1]) | ~good[:-1]
    first = np.flatnonzero(new & good)
    stop = np.ones(n, bool)
    stop[:-1] = new[1:] | ~good[1:]
    last = np.flatnonzero(stop & good)
    anchor = at[first]
    room = np.minimum(longest - length, ends[text[first]] - last - length)
    p2 = two.prefix(data)
    ctx = two.slices(p2, first, last + length + room)
    shape = ((anchor - first) << 32) | ((last - first) << 16) | room
    ctx = mix64(ctx ^ (shape.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
    return text[first], first, last, anchor, room, h[anchor].view(np.int64), ctx.view(np.int64)


def _pieces(offsets: np.ndarray, length: int) -> Iterator[list[tuple[int, int, int]]]:
    """Lists of (row, first byte, end) of up to PIECE window starts; longer texts come in overlapping pieces."""
    have, size = [], 0
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        if b - a < length:
            continue
        for s in range(a, b - length + 1, PIECE):
            e = min(b, s + PIECE + length - 1)
            if size + e - s > PIECE + length:
                if have:
                    yield have
                have, size = [], 0
            have.append((row, s, e))
            size += e - s
    if have:
        yield have


_ANCHORS = "id long, dk long, pos int, lo short, hi short, room short, ah long, ch long"


def _anchors(lengths: tuple[int, ...]):
    length, longest = lengths[0], lengths[-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8(batch.column(2))
            for piece in _pieces(offsets, length):
                far = [min(int(offsets[r + 1]), e + longest - length) for r, _, e in piece]
                data = np.concatenate([raw[s:f] for (_, s, _), f in zip(piece, far, strict=True)])
                ends = np.cumsum([f - s for (_, s, _), f in zip(piece, far, strict=True)])
                limits = ends - np.array([f - e for (_, _, e), f in zip(piece, far, strict=True)])
                text, lo, hi, at, room, ah, ch = _contexts(data, ends, limits, length, longest)
                row = np.array([r for r, _, _ in piece])[text]
                shift = np.array([s - offsets[r] for r, s, _ in piece])[text] - np.concatenate([[0], ends[:-1]])[text]
                yield pa.record_batch(
                    [batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array((at + shift).astype(np.int32)), *(pa.array(x.astype(np.int16)) for x in (at - lo, hi - at, room)), pa.array(ah), pa.array(ch)],
                    names=["id", "dk", "pos", "lo", "hi", "room", "ah", "ch"],
                )

    return run


def _cut_contexts(length: int):
    """Rows of (z, contexts wanted of it) to rows of (ah, ch, lo, hi, text of the context), CUT bytes of texts at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            lists = batch.column(1)
            wanted = lists.flatten()
            ah, ch, pos, lo, hi, room = (wanted.field(wanted.type.get_field_index(c)) for c in ("ah", "ch", "pos", "lo", "hi", "room"))
            first = pos.to_numpy().astype(np.int64) - lo.to_numpy()
            last = pos.to_numpy().astype(np.int64) + hi.to_numpy() + length + room.to_numpy()
            done = at = 0
            texts: list[bytes] = []
            size = 0

            def rows() -> pa.RecordBatch:
                columns = [x.slice(done, len(texts)) for x in (ah, ch, lo, hi)]
                return pa.record_batch([*columns, pa.array(texts, pa.binary())], names=["ah", "ch", "lo", "hi", "ctx"])

            for z, n in zip(batch.column(0), lists.value_lengths().to_pylist(), strict=True):
                raw = unpack.decompress(z.as_py())
                for s, e in zip(first[at : at + n].tolist(), last[at : at + n].tolist(), strict=True):
                    texts.append(raw[s:e])
                    size += e - s
                    if size >= CUT:
                        yield rows()
                        done, texts, size = done + len(texts), [], 0
                at += n
            yield rows()

    return run


def block_repeats(ctxs: list[bytes], lo: np.ndarray, hi: np.ndarray, bucket: np.ndarray, lengths: tuple[int, ...]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each of the ascending ``lengths``: windows (context number, start relative to the anchor) of a block that equal another window of their bucket.

    The suffix order is built as in the blockwise scheme of Kärkkäinen (2007):
    cover samples first, then the suffixes by first bytes and sample rank.
    """
    v, longest = COVER, lengths[-1]
    cover = difference_cover(v)
    sizes = np.array([len(c) for c in ctxs])
    lead = (-lo) % v  # so that anchors stand at multiples of v
    room = -(-(sizes + lead + 1) // v) * v
    base = np.concatenate([[0], np.cumsum(room)[:-1]]) + lead
    total = int(room.sum())
    text = np.zeros(total + longest + 64, np.uint8)
    for c, b in zip(ctxs, base.tolist(), strict=True):
        text[b : b + len(c)] = np.frombuffer(c, np.uint8)
    word = text[: total + longest + 56].astype(np.uint64)
    for k in range(1, 8):
        word = (word << np.uint64(8)) | text[k : k + len(word)]
    # Ranks of the samples: first by v bytes, then by doubling along positions p, p + span.
    sample = (np.arange(0, total, v)[:, None] + cover[None, :]).ravel()
    sample = sample[sample < total]
    keys = [word[sample + k] for k in (0, 8, 16)] + [word[sample + 24] >> np.uint64(8)]
    order = np.lexsort(keys[::-1])
    rank = np.zeros(total + 2 * longest + 4 * v, np.int64)

    def name(order: np.ndarray, keys: list[np.ndarray]) -> bool:
        differ = np.zeros(len(order), bool)
        for k in keys:
            differ[1:] |= k[order[1:]] != k[order[:-1]]
        names = np.cumsum(differ) + 1
        rank[sample[order]] = names
        return len(names) == 0 or names[-1] == len(names)

    done = name(order, keys)
    span = v
    while not done and span < longest:
        far = np.minimum(sample + span, len(rank) - 1)
        keys = [rank[sample], rank[far]]
        order = np.lexsort(keys[::-1])
        done = name(order, keys)
        span *= 2
    # The suffixes of the block: one for each window; a bucket is (anchor, offset).
    counts = (lo + hi + 1).astype(np.int64)
    who = np.repeat(np.arange(len(ctxs)), counts)
    nth = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    at = base[who] + nth
    offset = nth - lo[who]
    to_sample = np.array([min((c - r) % v for c in cover.tolist()) for r in range(v)])[at % v]
    keys = [rank[at + to_sample], word[at + 8], word[at], offset, bucket[who]]
    wide = to_sample > 16  # bytes beyond 16 matter where the next sample is farther than that
    if wide.any():
        keys[1:1] = [np.where(wide, word[at + 24], 0), np.where(wide, word[at + 16], 0)]
    order = np.lexsort(keys)
    a, b = order[:-1], order[1:]
    near = np.flatnonzero((bucket[who[a]] == bucket[who[b]]) & (offset[a] == offset[b]))
    out = []
    for length in lengths:
        near = _equal(text, word, at, a, b, near, length)
        fits = nth + length <= sizes[who]
        hit = np.zeros(len(at), bool)
        if fits.all():
            hit[a[near]] = True
            hit[b[near]] = True
        elif len(near):
            # Windows that a text's end cuts off are none; the rest of a run of equal ones may be.
            differ = np.ones(len(order), bool)
            differ[near + 1] = False
            run = np.cumsum(differ) - 1
            hit[order] = np.bincount(run, fits[order])[run] > 1
            hit &= fits
        out.append((who[hit], offset[hit]))
    return out


def _equal(text: np.ndarray, word: np.ndarray, at: np.ndarray, a: np.ndarray, b: np.ndarray, near: np.ndarray, length: int) -> np.ndarray:
    """The numbers in ``near`` whose windows a and b hold the same ``length`` bytes."""
    if length < 8:
        return np.array([i for i in near.tolist() if (text[at[a[i]] : at[a[i]] + length] == text[at[b[i]] : at[b[i]] + length]).all()], np.int64)
    for k in [*range(0, length - 7, 8), length - 8]:
        near = near[word[at[a[near]] + k] == word[at[b[near]] + k]]
    return near


def sort_block(ctxs: list[bytes], lo: np.ndarray, hi: np.ndarray, bucket: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """``block_repeats`` for one length."""
    return block_repeats(ctxs, lo, hi, bucket, (length,))[0]


def _runs(who: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((offset, who))
    who, offset = who[order], offset[order]
    new = np.ones(len(who), bool)
    new[1:] = (who[1:] != who[:-1]) | (offset[1:] != offset[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:] - 1, [len(who) - 1]]) if len(first) else first
    return who[first], offset[first], offset[last]


_KINDS = (("ah", pa.int64()), ("ch", pa.int64()), ("a", pa.int32()), ("b", pa.int32()), ("k", pa.int32()))


def _sorted_runs(lengths: tuple[int, ...]):
    """Contexts in order of their anchor hash, one block of whole buckets at a time; k is the number of the length."""

    def solve(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        ah, ch = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
        lo, hi = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
        bucket = np.unique(ah, return_inverse=True)[1]
        for k, found in enumerate(block_repeats([r[4] for r in rows], lo, hi, bucket, lengths)):
            who, a, b = _runs(*found)
            columns = (ah[who], ch[who], a, b, np.full(len(who), k))
            yield pa.record_batch([pa.array(x, t) for x, (_, t) in zip(columns, _KINDS, strict=True)], names=[n for n, _ in _KINDS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if size >= BLOCK and row[0] != have[-1][0]:
                    yield from solve(have)
                    have, size = [], 0
                have.append(row)
                size += len(row[4])
        if have:
            yield from solve(have)

    return run


def _single_windows(lengths: tuple[int, ...]):
    """Contexts of hot buckets to one row a window: (ah, ch, at, k, w1, w2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, two = RollingHash(37, 4 * lengths[-1]), RollingHash(41, 4 * lengths[-1])
        for batch in batches:
            for ah, ch, lo, hi, ctx in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = np.frombuffer(ctx, np.uint8)
                for k, length in enumerate(lengths):
                    n = min(lo + hi + 1, len(ctx) - length + 1)
                    if n > 0:
                        yield pa.record_batch(
                            [pa.array(np.full(n, ah)), pa.array(np.full(n, ch)), pa.array(np.arange(n, dtype=np.int32) - lo), pa.array(np.full(n, k, np.int32))]
                            + [pa.array(r.grams(r.prefix(data), length)[:n].view(np.int64)) for r in (one, two)],
                            names=["ah", "ch", "at", "k", "w1", "w2"],
                        )

    return run


def _merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs that the spans cover, in order."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order]) if len(end) else end
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    first = np.flatnonzero(new)
    return start[first], end[np.append(first[1:] - 1, len(end) - 1)[: len(first)]]


_KEPT = (("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary()), ("n_passage", pa.int64()), ("dk", pa.int64()))


def _strip(last: int):
    """(id, z, spans, dk) to (id, n_bytes, n_removed, n_spans, kept bytes, n_passage, dk), CUT bytes at a time; spans of the length numbered ``last`` are cut, n_passage counts those of the first."""

    def record(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(_KEPT)
        return pa.record_batch([pa.array(c, t) for c, (_, t) in zip(columns, _KEPT, strict=True)], names=[n for n, _ in _KEPT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            spans = batch.column(2).flatten()
            start, end, kind = (spans.field(spans.type.get_field_index(c)).to_numpy().astype(np.int64) for c in ("s", "e", "k"))
            sizes = batch.column(2).value_lengths().fill_null(0).to_pylist()
            out, size, at = [], 0, 0
            for i, z, n, dk in zip(batch.column(0).to_pylist(), batch.column(1), sizes, batch.column(3).to_pylist(), strict=True):
                raw = unpack.decompress(z.as_py())
                s, e, k = start[at : at + n], end[at : at + n], kind[at : at + n]
                at += n
                gone, gone_to = _merged(s[k == last], e[k == last])
                short, short_to = _merged(s[k == 0], e[k == 0]) if last else (gone, gone_to)
                kept = b"".join(raw[a:b] for a, b in zip([0, *gone_to.tolist()], [*gone.tolist(), len(raw)], strict=True))
                out.append((i, len(raw), len(raw) - len(kept), len(gone), kept, int((short_to - short).sum()), dk))
                size += len(kept)
                if size >= CUT:
                    yield record(out)
                    out, size = [], 0
            yield record(out)

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        raw, offsets = utf8(batch.column(2))
        whole = raw.tobytes()
        z = [pack.compress(whole[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        yield pa.record_batch([batch.column(0), batch.column(1), pa.array(z, pa.binary())], names=["id", "dk", "z"])


def repeated_spans(docs: DataFrame, id_col: str, text_col: str, lengths: tuple[int, ...], hot: int = HOT) -> tuple[DataFrame, DataFrame]:
    """``(keyed, spans)``: documents as (id, dk, z) and repeated byte ranges of each of the ascending lengths as (id, dk, spans)."""
    arrow_batches(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text_col).alias("dk"), F.col(text_col).alias("text"))
    found = written(base.filter(F.octet_length("text") >= lengths[0]).transform(arrow_map, _anchors(lengths), _ANCHORS))
    # Written, so that the joins below are between plain exchanges, whose hot partitions Spark splits.
    again = written(found.groupBy("ah").agg(F.count("*").alias("n")).filter("n > 1").select("ah"))
    open_ = written(found.join(again, "ah"))
    contexts = open_.groupBy("ah", "ch").agg(F.count("*").alias("n"), F.min(F.struct("id", "dk", "pos", "lo", "hi", "room")).alias("rep"))
    contexts = written(contexts)
    state = written(contexts.groupBy("ah").agg(F.count("*").alias("kinds"), F.max(F.col("n") == 1).alias("left")).filter("kinds > 1 and left"))
    todo = written(contexts.join(state, "ah").select("ah", "ch", "n", "rep.*", (F.col("kinds") > hot).alias("hot")))
    keyed = base.transform(arrow_map, _pack, "id long, dk long, z binary")
    asked = todo.groupBy("id", "dk").agg(F.collect_list(F.struct("ah", "ch", "pos", "lo", "hi", "room", "hot")).alias("wanted"))
    # A null id is a key like any other.
    k, w = keyed.alias("k"), asked.alias("w")
    texts = k.join(w, F.col("k.id").eqNullSafe(F.col("w.id")) & (F.col("k.dk") == F.col("w.dk"))).select("k.z", "w.wanted")
    plain = texts.transform(arrow_map, _cut_contexts(lengths[0]), "ah long, ch long, lo short, hi short, ctx binary")
    plain = written(plain.join(todo.filter("hot").select("ah").distinct().withColumn("hot", F.lit(True)), "ah", "left"))
    cold = plain.filter("hot is null").select("ah", "ch", "lo", "hi", "ctx")
    runs = cold.repartition("ah").sortWithinPartitions("ah", "ch", "lo", "hi").transform(arrow_map, _sorted_runs(lengths), "ah long, ch long, a int, b int, k int")
    single = plain.filter("hot").select("ah", "ch", "lo", "hi", "ctx").transform(arrow_map, _single_windows(lengths), "ah long, ch long, at int, k int, w1 long, w2 long")
    # Repeated rows send a context twice; the least and greatest context tell whether two differ.
    window = ["ah", "at", "k", "w1", "w2"]
    twice = single.groupBy(*window).agg(F.min("ch").alias("x"), F.max("ch").alias("y")).filter("x <> y").select(*window)
    narrow = single.join(twice, window).select("ah", "ch", F.col("at").alias("a"), F.col("at").alias("b"), "k")
    part = runs.unionAll(narrow).groupBy("ah", "ch").agg(F.collect_set(F.struct("a", "b", "k")).alias("runs"))
    whole = contexts.filter("n > 1").select("ah", "ch", F.lit(True).alias("whole"))
    verdict = written(whole.join(part, ["ah", "ch"], "full"))
    hits = open_.join(verdict, ["ah", "ch"])
    first, last = -F.col("lo").cast("int"), F.col("hi").cast("int")
    full = [F.struct(first.alias("a"), F.least(last, last + F.col("room") - (n - lengths[0])).alias("b"), F.lit(i).alias("k")) for i, n in enumerate(lengths)]
    ranges = F.when(F.col("whole"), F.filter(F.array(*full), lambda r: r["a"] <= r["b"])).otherwise(F.col("runs"))
    hits = hits.select("id", "dk", "pos", F.explode(ranges).alias("r"))
    length = F.element_at(F.array(*map(F.lit, lengths)), F.col("r.k") + 1)
    spans = hits.groupBy("id", "dk").agg(F.collect_set(F.struct((F.col("pos") + F.col("r.a")).alias("s"), (F.col("pos") + F.col("r.b") + length).alias("e"), F.col("r.k").alias("k"))).alias("spans"))
    return keyed, spans


def _kept(docs: DataFrame, id_col: str, text_col: str, lengths: tuple[int, ...], hot: int) -> DataFrame:
    require(docs, id_col, text_col)
    keyed, spans = repeated_spans(docs, id_col, text_col, lengths, hot)
    k, s = keyed.alias("k"), spans.alias("s")
    both = k.join(s, F.col("k.id").eqNullSafe(F.col("s.id")) & (F.col("k.dk") == F.col("s.dk")), "left").select("k.id", "k.z", "s.spans", "k.dk")
    return both.transform(arrow_map, _strip(len(lengths) - 1), "id long, n_bytes long, n_removed long, n_spans long, kept binary, n_passage long, dk long")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, passage: int | None = None, hot: int = HOT) -> DataFrame:
    """Cut every byte that a repeated ``length``-byte string covers.

    Returns ``(id_col, n_bytes, n_removed, n_spans, kept binary)``, one row for
    each input row; with ``passage``, a shorter length, also ``n_passage``: the
    bytes that repeated strings of that length cover, which are only counted.
    Null text counts as empty; texts shorter than a length hold no string of it;
    a repeated row is a repetition of its own text; null ids are kept; other
    columns of the input are not read, whatever their names. An empty table
    gives an empty result. ``hot`` is the number of different contexts of an
    anchor from which on its windows are counted instead of sorted.
    """
    if passage is not None and not 0 < passage <= length:
        raise ValueError("passage must be at most length")
    lengths = (length,) if passage in (None, length) else (passage, length)
    kept = _kept(docs, id_col, text_col, lengths, hot).drop("dk").withColumnRenamed("id", id_col)
    return kept.drop("n_passage") if passage is None else kept


def remove_repeats_from(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """The documents with repeated strings cut out of their text; broken UTF-8 at a cut is dropped. Other columns stay."""
    kept = _kept(docs, id_col, text_col, (length,), hot).filter("n_removed > 0")
    text = F.try_validate_utf8(F.col("kept").cast("string"))

    @F.pandas_udf("string")
    def repaired(raw):
        return raw.map(lambda b: bytes(b).decode("utf-8", "ignore"))

    cut = kept.select("id", "dk", F.coalesce(text, repaired("kept")).alias("cut")).dropDuplicates(["id", "dk"])
    d = docs.withColumn("__dk", F.xxhash64(text_col)).alias("d")
    joined = d.join(cut.alias("c"), F.col(f"d.{id_col}").cast("long").eqNullSafe(F.col("c.id")) & (F.col("d.__dk") == F.col("c.dk")), "left")
    return joined.select(*[F.coalesce(F.col("c.cut"), F.col(f"d.`{c}`")).alias(c) if c == text_col else F.col(f"d.`{c}`") for c in docs.columns])


def digests(kept: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Columns of ``remove_repeats`` with a digest in place of the kept bytes."""
    more = [c for c in ("n_passage",) if c in kept.columns]
    return kept.select(id_col, "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), *more)


def op1_suffix_dedup(spark, sf_dir):
    """Removed and kept bytes of every document at 400 bytes; kept_sha256 is of the kept bytes.

    n_passage counts the bytes of repeated strings of 240 bytes or more: a
    passage of over 50 words that other documents hold too, most of which are
    shorter than what is removed.
    """
    return digests(remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"), passage=PASSAGE))


def brute_force(texts: list[bytes], length: int) -> list[bytes]:
    """What each text keeps, by counting every window; for tests."""
    seen: dict[bytes, int] = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\x01" * length
        out.append(bytes(b for b, g in zip(t, gone, strict=True) if not g))
    return out
