import random
from itertools import combinations

import numpy as np
import xxhash

from runloom.llm import simhash as H, similar_documents as D
from runloom.llm.simhash import fingerprint


def model_print(text, n=3):
    w = (text or "").encode().lower().split()
    runs = [b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def groups(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_fingerprints():
    for t in ["", "  \t\n", "One", "one TWO", "a b c", "Ä ä É é x", "a\x0bb\x0cc\xa0d e f", "w " * 500]:
        assert H.fingerprint(t.encode()) == model_print(t), t


def test_groups_of_texts(spark):
    rng = np.random.default_rng(2)
    words = [f"w{i}" for i in range(300)]
    base = [list(rng.choice(words, 200)) for _ in range(4)]
    texts = [" ".join(b) for b in base]
    for b in base:
        for k in range(5):
            c = list(b)
            c[10 * k] = "changed"
            texts.append(" ".join(c))
    texts += ["", None, " ", texts[0], "short", "short"]
    docs = spark.createDataFrame([(i + 5, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, fp int")
    fps = {i + 5: model_print(t) for i, t in enumerate(texts)}
    want = groups(fps, [(a, b) for a, b in combinations(fps, 2) if (fps[a] ^ fps[b]).bit_count() <= 2])
    for hot in (1, 1024):
        got = {r["doc_id"]: r for r in H.near_duplicates(docs, hot=hot).collect()}
        assert {i: r["component_id"] for i, r in got.items()} == want
        assert all(got[i]["fingerprint"] == f"{f:016x}" for i, f in fps.items())


def test_links_of_random_neighbours(spark):
    rng = np.random.default_rng(3)
    fps = set()
    for _ in range(60):
        f = int(rng.integers(0, 2**63)) * 2 + 1
        fps.add(f)
        for _ in range(6):
            g = f
            for b in rng.choice(64, rng.integers(1, 4), replace=False):
                g ^= 1 << int(b)
            fps.add(g)
    fps = sorted(fps)
    signed = [f - 2**64 if f >= 2**63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = groups(signed, [(signed[i], signed[j]) for i, j in combinations(range(len(fps)), 2) if (fps[i] ^ fps[j]).bit_count() <= 2])
    for hot in (1, 4, 1024):
        edges = [(r["a"], r["b"]) for r in H.links(nodes, hot=hot).collect()]
        assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 2 for a, b in edges)
        assert groups(signed, edges) == want


def test_allocation_and_flips():
    assert H.allocate([{-1: 0, 0: 5, 1: 9}, {-1: 0, 0: 1, 1: 2}, {-1: 0, 0: 50, 1: 60}], 0) == [0, 1, -1]
    assert len(H._flips([0, 1, 63], 2)) == 1 + 3 + 3
    parts = H.group_bits(10, np.diag(np.full(64, 5.0)), 3)
    assert sorted(x for p in parts for x in p) == list(range(64))


def test_nulls_repeats_and_empty(spark):
    docs = spark.createDataFrame([(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (None, "alone at last")], "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in H.near_duplicates(docs).collect())
    assert got == [(0, 0), (0, 3), (3, 3), (3, 3)]
    assert H.near_duplicates(docs.limit(0)).count() == 0


def test_one_of_each(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (None, "alone at last with more words"), (4, long), (4, "quite another text under this id"), (2, long + " end"), (5, None), (6, "")]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id long, text string, text_hash int")
    kept = H.one_of_each(docs, D.similar_documents(docs, hashes=True))
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"] or 0), r["text"]) for r in kept.collect() if r["doc_id"] != 5) == [(0, rows[3][1]), (2, rows[6][1]), (3, "a b c d e f"), (4, rows[5][1])]
    assert kept.filter("doc_id = 5").count() == 1
    assert H.one_of_each(docs.limit(0), D.similar_documents(docs.limit(0), hashes=True)).count() == 0


def test_similar_documents(spark):
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(2000)]
    texts = []
    for _ in range(8):
        b = list(rng.choice(words, 300))
        texts.append(" ".join(b))
        for changes in (1, 4, 8, 40):
            c = list(b)
            for p in rng.choice(300, changes, replace=False):
                c[p] = "new"
            texts.append(" ".join(c))
    texts += ["", None, "one", "one"]
    sets = [D.shingle_set((t or "").encode(), 5) for t in texts]
    similar = [(i, j) for i, j in combinations(range(len(texts)), 2) if D.jaccard(sets[i].tobytes(), sets[j].tobytes()) >= 0.8]
    want = groups(range(len(texts)), similar)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in D.similar_documents(docs).collect()}
    # Fingerprints propose nearly all similar pairs; what they propose is judged exactly, so no group is too large.
    assert all(want[i] == want[g] for i, g in got.items())
    assert sum(got[i] == want[i] for i in want) >= 0.95 * len(want)
    # Every candidate within the radius that is similar is linked.
    prints = [fingerprint((t or "").encode(), D.PRINT_SHINGLE) for t in texts]
    assert all(got[i] == got[j] for i, j in similar if (prints[i] ^ prints[j]).bit_count() <= D.RADIUS)
    assert D.similar_documents(docs.limit(0)).count() == 0


def test_forest_spans_at_least_cost():
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 40, 200), rng.integers(0, 40, 200)
    d = rng.integers(0, 10, 200)
    keep = D.forest(40, a, b, d)
    root = list(range(40))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    best = 0
    for k in np.argsort(d, kind="stable"):
        x, y = find(a[k]), find(b[k])
        if x != y:
            root[x] = y
            best += d[k]
    assert d[keep].sum() == best


def block_edits(n=40):
    """Texts and copies with a new tail or one replaced block, at a similarity just over 0.8."""
    rng = random.Random(11)
    word = lambda: f"w{rng.randrange(10**6)}"
    out = []
    for k in range(n):
        words = [word() for _ in range(300)]
        tail, block = [word() for _ in range(70)], [word() for _ in range(28)]
        out += [words, [*words, *tail] if k % 2 else [*words[:150], *block, *words[178:]]]
    return [" ".join(w) for w in out]


def test_contiguous_edits_are_found(spark):
    texts = block_edits()
    sets = [D.shingle_set(t.encode(), 5) for t in texts]
    pairs = [(i, i + 1) for i in range(0, len(texts), 2)]
    assert all(0.8 <= D.overlap(sets[i], sets[j]) < 0.9 for i, j in pairs)
    prints = [fingerprint(t.encode(), D.PRINT_SHINGLE) for t in texts]
    assert any((prints[i] ^ prints[j]).bit_count() > D.RADIUS for i, j in pairs)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in D.similar_documents(docs).collect()}
    assert got == {i: i - i % 2 for i in range(len(texts))}


def test_equal_fingerprints_are_verified(spark):
    rng = random.Random(12)
    texts = [" ".join([f"w{rng.randrange(10**6)}" for _ in range(90)] + ["0"] * 120) for _ in range(4)]
    assert len({fingerprint(t.encode(), D.PRINT_SHINGLE) for t in texts}) == 1
    texts += [texts[2] + " end", texts[3]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in D.similar_documents(docs).collect()}
    assert got == {0: 0, 1: 1, 2: 2, 3: 3, 4: 2, 5: 3}


def test_last_round_with_an_unused_partition(spark):
    rng = random.Random(13)
    base = [rng.getrandbits(64) for _ in range(6)]
    # Near prints that agree on the low half, whose partition has no threshold.
    fps = sorted({b ^ (f << 32) for b in base for f in (0, 1 << 3, 1 << 9)})
    signed = [int(np.array(f, np.uint64).view(np.int64)) for f in fps]
    owner = {b ^ (f << 32): b for b in base for f in (0, 1 << 3, 1 << 9)}
    sets = {f: np.arange(20, dtype=np.uint64) + np.uint64(100 * base.index(owner[f])) for f in fps}
    rows = [(s, s, bytearray(sets[f].tobytes())) for s, f in zip(signed, fps)]
    few = spark.createDataFrame(rows, "fp long, comp long, shingles binary")
    plan = [(list(range(32)), -1), (list(range(32, 64)), 1)]
    links = D.dealt(few, plan, "shingles").transform(D.arrow_map, D._block_links(1, 0.8, plan), "a long, b long").collect()
    brute = [(a, b) for (a, x), (b, y) in combinations(zip(signed, fps), 2) if (x ^ y).bit_count() <= 1 and D.overlap(sets[x], sets[y]) >= 0.8]
    assert groups(signed, [tuple(r) for r in links]) == groups(signed, brute) and brute


def test_probes_are_rows_and_not_expressions(spark):
    plan = [(list(range(0, 12)), 2), (list(range(12, 40)), -1), (list(range(40, 64)), 1)]
    fps = [0, 5, -1, 1 << 41, -(2**63)]
    nodes = spark.createDataFrame([(f, f, [f]) for f in fps], "fp long, comp long, failed array<long>")
    out = D.dealt(nodes, plan, "failed")
    want = set()
    for i, (bits, t) in enumerate(plan):
        homes = {f & D._mask(bits) for f in fps} if t >= 0 else set()
        flips = D._flips(bits, t) if t >= 0 else []
        # Only buckets in which some fingerprint is at home are visited.
        want |= {(i, (f & D._mask(bits)) ^ x, k > 0, f) for f in fps for k, x in enumerate(flips) if (f & D._mask(bits)) ^ x in homes}
    rows = out.collect()
    assert {(r["i"], r["value"], r["visit"], r["fp"]) for r in rows} == want and len(rows) == len(want)
    assert all(r["block"] == 0 and r["comp"] == r["fp"] and r["failed"] == [r["fp"]] for r in rows)
    # 79 + 25 flips; before, each was a struct in the plan of the driver.
    assert out._jdf.queryExecution().analyzed().toString().count("struct(") <= len(plan)
