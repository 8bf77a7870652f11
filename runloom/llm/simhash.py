"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprints are 64 majority bits over XXH64 of word shingles. To link all
fingerprints that differ in at most ``radius`` bits, the 64 bits are split into
partitions and each gets a threshold of its own with thresholds summing to
radius - partitions + 1 (Qin et al., "GPH", ICDE 2018): two linked fingerprints
must then agree within its threshold on some partition.

- Bits that are correlated over all fingerprints go to the same partition.
- Thresholds come from dynamic programming over estimated candidate counts: the
  measured sizes of each partition's value groups over all fingerprints, carried
  to larger thresholds by the bits' measured agreement.
- Each fingerprint probes the values within the threshold; candidates that meet
  in a bucket are verified by XOR and bit count, and a bucket gives a spanning
  forest instead of all its pairs.
- A bucket of more than ``HOT`` fingerprints goes another exact way: all values
  within one bit of each of its fingerprints; two fingerprints within two bits
  share such a value, and 65 distinct fingerprints at most do.

Equal fingerprints are one node from the start, so copies cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from runloom.llm.common import arrow_batches, arrow_map, require, utf8
from runloom.operators.graph import connected_components
from runloom.session import checkpointed, written

SHINGLE, SEED, RADIUS, PARTITIONS = 3, 42, 2, 3
HOT = 1024
#: Hashes of a long text that are counted at once.
CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of one UTF-8 text; no word gives zero."""
    words = text.lower().split()  # bytes: A-Z only, and x20, x09 to x0D
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), seed)
    digest = xxhash.xxh64_intdigest
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])[: len(words) - shingle + 1].tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    ones = np.zeros(64, np.int64)
    n = len(starts)
    for k in range(0, n, CHUNK):
        h = np.array([digest(line[a:b], seed) for a, b in zip(starts[k : k + CHUNK], stops[k : k + CHUNK], strict=True)], dtype=">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def _fingerprints(shingle: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = utf8(batch.column(1))
            whole, offs = raw.tobytes(), offsets.tolist()
            fps = np.array([fingerprint(whole[a:b], shingle, seed) for a, b in zip(offs[:-1], offs[1:], strict=True)], dtype=np.uint64)
            yield pa.record_batch([batch.column(0), pa.array(fps.view(np.int64))], names=["id", "fp"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``(id, fp)`` with fp as a signed 64-bit integer."""
    arrow_batches(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).transform(arrow_map, _fingerprints(shingle, seed), "id long, fp long")


def _bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ones of each bit and of each pair of bits over a partition's fingerprints."""
    both, n = np.zeros((64, 64)), 0
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
        bits = ((fps[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.float32)
        both += bits.T @ bits
        n += len(fps)
    yield pa.record_batch([pa.array([n]), pa.array([both.ravel().astype(np.int64).tolist()])], names=["n", "both"])


def group_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Partitions of the bits, each grown from the bit left by the most correlated ones."""
    p = np.diag(both) / max(n, 1)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs((both / max(n, 1) - np.outer(p, p)) / np.outer(spread, spread))
    np.fill_diagonal(corr, 0)
    left, out = list(range(64)), []
    for k in range(parts):
        size = -(-len(left) // (parts - k))
        group = [left.pop(int(np.argmax(corr[np.ix_(left, left)].sum(1))))]
        while len(group) < size:
            group.append(left.pop(int(np.argmax(corr[np.ix_(left, group)].sum(1)))))
        out.append(sorted(group))
    return out


def allocate(cost: list[dict[int, float]], total: int) -> list[int]:
    """Thresholds, one a partition and -1 for none, that sum to ``total`` at least cost; by dynamic programming."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for table in cost:
        nxt: dict[int, tuple[float, list[int]]] = {}
        for have, (c, taken) in best.items():
            for t, more in table.items():
                if have + t not in nxt or c + more < nxt[have + t][0]:
                    nxt[have + t] = (c + more, [*taken, t])
        best = nxt
    return best[total][1]


def plan(nodes: DataFrame, radius: int, parts: int) -> list[tuple[list[int], int]]:
    """(bits, threshold) of each partition, from statistics of all fingerprints."""
    rows = nodes.select("fp").transform(arrow_map, _bits, "n long, both array<long>")
    total = rows.select("n", F.posexplode("both").alias("k", "c")).groupBy("k").agg(F.sum("c").alias("c"), F.sum("n").alias("n")).collect()  # 4,096 rows
    n = max((r["n"] for r in total), default=0)
    both = np.zeros(64 * 64)
    for r in total:
        both[r["k"]] = r["c"]
    groups = group_bits(n, both.reshape(64, 64), parts)
    values = nodes.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), (F.col("fp").bitwiseAND(_mask(g))).alias("value")) for i, g in enumerate(groups)])).alias("x")).select("x.*")
    met = values.groupBy("i", "value").count().groupBy("i").agg(F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("pairs")).collect()
    pairs = {r["i"]: r["pairs"] for r in met}
    p = np.diag(both.reshape(64, 64)) / max(n, 1)
    agree = np.clip(p * p + (1 - p) * (1 - p), 0.5, 1 - 1e-6)
    cost = []
    for i, g in enumerate(groups):
        odds = (1 - agree[g]) / agree[g]
        grow = [1.0, 1 + odds.sum(), 1 + odds.sum() + (odds.sum() ** 2 - (odds**2).sum()) / 2]
        probes = [1, 1 + len(g), 1 + len(g) + len(g) * (len(g) - 1) / 2]
        table = {-1: 0.0}
        for t in range(radius + 1):
            table[t] = (pairs.get(i, 0.0) + 1) * grow[min(t, 2)] + n * probes[min(t, 2)]
        cost.append(table)
    return list(zip(groups, allocate(cost, radius - parts + 1), strict=True))


def _mask(bits: list[int]) -> int:
    m = sum(1 << b for b in bits)
    return m - 2**64 if m >= 2**63 else m


def _flips(bits: list[int], most: int) -> list[int]:
    return [_mask(list(c)) for t in range(most + 1) for c in combinations(bits, t)]


def _forest(radius: int):
    """Rows (i, value, visit, fp) in order of bucket: edges (a, b) that span what is linked within a bucket."""

    def solve(fps: np.ndarray, visit: np.ndarray) -> list[tuple[int, int]]:
        homes = np.unique(fps[~visit])
        nodes = np.unique(fps)
        root = np.arange(len(nodes))

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        where = np.searchsorted(nodes, homes)
        edges = []
        for k in range(0, len(homes), 256):
            near = np.bitwise_count(homes[k : k + 256, None] ^ nodes[None, :]) <= radius
            for a, b in zip(*(x.tolist() for x in np.nonzero(near)), strict=True):
                ra, rb = find(int(where[k + a])), find(b)
                if ra != rb:
                    root[max(ra, rb)] = min(ra, rb)
                    edges.append((int(nodes[where[k + a]].view(np.int64)), int(nodes[b].view(np.int64))))
        return edges

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, fps, visits = None, [], []
        for batch in batches:
            out: list[tuple[int, int]] = []
            for i, value, visit, fp in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (i, value) != key:
                    if len(fps) > 1:
                        out += solve(np.array(fps, np.int64).view(np.uint64), np.array(visits))
                    key, fps, visits = (i, value), [], []
                fps.append(fp)
                visits.append(visit)
            yield _edges(out)
        if len(fps) > 1:
            yield _edges(solve(np.array(fps, np.int64).view(np.uint64), np.array(visits)))

    def _edges(out: list[tuple[int, int]]) -> pa.RecordBatch:
        a, b = zip(*out, strict=True) if out else ((), ())
        return pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return run


def links(nodes: DataFrame, radius: int = RADIUS, parts: int = PARTITIONS, hot: int = HOT) -> DataFrame:
    """``(a, b)``: fingerprints of ``nodes(fp)``, all distinct, linked so that they span every group within ``radius`` bits."""
    probes = []
    for i, (bits, t) in enumerate(plan(nodes, radius, parts)):
        if t < 0:
            continue
        value = F.col("fp").bitwiseAND(_mask(bits))
        for k, flip in enumerate(_flips(bits, t)):
            probes.append(F.struct(F.lit(i).alias("i"), value.bitwiseXOR(flip).alias("value"), F.lit(k > 0).alias("visit")))
    rows = nodes.select("fp", F.explode(F.array(*probes)).alias("x")).select("x.*", "fp")
    sizes = rows.groupBy("i", "value").agg(F.count("*").alias("n"), F.min("visit").alias("alone")).filter("n > 1 and not alone")
    met = written(rows.join(sizes.select("i", "value", (F.col("n") > hot).alias("hot")), ["i", "value"]))
    calm = met.filter("not hot").select("i", "value", "visit", "fp").repartition("i", "value").sortWithinPartitions("i", "value").transform(arrow_map, _forest(radius), "a long, b long")
    if radius > 2:
        raise ValueError("buckets over the bound are exact for a radius of 2 at most")
    crowd = met.filter("hot").select("fp").distinct()
    variants = crowd.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(m) for m in [0, *(_mask([b]) for b in range(64))]])).alias("v"))
    if radius == 2:
        least = variants.groupBy("v").agg(F.min("fp").alias("b"), F.count("*").alias("n")).filter("n > 1").select("v", "b")
        dense = variants.join(least, "v").filter("fp <> b").select(F.col("fp").alias("a"), "b").distinct()
    else:
        own = crowd.withColumnRenamed("fp", "b")
        dense = variants.filter("fp <> v").join(own, F.col("v") == F.col("b")).select(F.col("fp").alias("a"), "b")
    return calm.unionAll(dense)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS, hot: int = HOT) -> DataFrame:
    """``(id_col, fingerprint, component_id)``, one row for each input row.

    Null and empty texts, and those of white space only, have fingerprint zero
    and are linked like any other; fewer words than a shingle give one shingle.
    Repeated rows stay repeated; ids that repeat or are null are grouped by
    fingerprint all the same, and component_id is the smallest id that is not
    null (null if there is none). Other columns are not read. An empty table
    gives an empty result.
    """
    require(docs, id_col, text_col)
    prints = written(fingerprints(docs, id_col, text_col, shingle))
    nodes = written(prints.groupBy("fp").agg(F.min("id").alias("least")))
    groups = connected_components(links(nodes.select("fp"), radius, hot=hot))
    named = nodes.join(groups, nodes.fp == groups.node, "left").select("fp", "least", F.coalesce("component", "fp").alias("component"))
    named = checkpointed(named)
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    found = named.join(smallest, "component").select("fp", "component_id")
    return prints.join(found, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of ``docs`` of each group in ``groups(id_col, text_hash, group)``: the one of least id, nulls last, then of least text hash.

    Ids may repeat or be null; a row is known by its id and its text. Rows of
    equal id and equal text are one document. Other columns stay.
    """
    least = F.min(F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col("text_hash").alias("text_hash")))
    kept = written(groups.groupBy("group").agg(least.alias("x")).select(F.col("x.id").alias("__id"), F.col("x.text_hash").alias("__hash")))
    named = docs.withColumn("__own", F.xxhash64(F.coalesce(text_col, F.lit(""))))
    chosen = named.join(kept, named[id_col].cast("long").eqNullSafe(kept["__id"]) & (named["__own"] == kept["__hash"]), "left_semi")
    return chosen.dropDuplicates([id_col, "__own"]).select(*docs.columns)


def op10_simhash(spark, sf_dir):
    """Fingerprint and near-duplicate group of every document, by three-word shingles within two bits."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
