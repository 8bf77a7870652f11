import numpy as np
import pytest

from runloom.llm import suffix_dedup as S


def kept(spark, texts, length, **more):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r["doc_id"]: r for r in S.remove_repeats(docs, length=length, **more).collect()}


@pytest.mark.parametrize("hot", [1, 4096])
@pytest.mark.parametrize("length", [5, 24, 60])
def test_against_counting(spark, length, hot):
    rng = np.random.default_rng(length)
    bits = ["".join(rng.choice(list("abé "), 40)) for _ in range(6)]
    texts = ["".join(rng.choice(bits, 5)) for _ in range(30)] + ["a" * 90, "ab" * 40, "", "abc", None, bits[0], bits[0]]
    got = kept(spark, texts, length, hot=hot)
    raw = [(t or "").encode() for t in texts]
    for i, want in enumerate(S.brute_force(raw, length)):
        assert bytes(got[i]["kept"]) == want, i
        assert got[i]["n_bytes"] == len(raw[i]) and got[i]["n_removed"] == len(raw[i]) - len(want)


def test_spans_are_maximal_runs(spark):
    a, b = "x1y2z3w4v5", "q6r7s8t9u0"
    got = kept(spark, [a + "----" + b, a + "++++" + b, "nothing of it at all"], 10)
    assert [got[i]["n_spans"] for i in range(3)] == [2, 2, 0]
    assert bytes(got[0]["kept"]) == b"----"


def test_pieces_of_a_long_text(spark, monkeypatch):
    text = "".join(np.random.default_rng(1).choice(list("abcdefgh"), 5000))
    data = np.frombuffer(text.encode(), np.uint8)
    whole = list(S._pieces(np.array([0, len(data)]), 50))
    monkeypatch.setattr(S, "PIECE", 700)
    parts = list(S._pieces(np.array([0, len(data)]), 50))
    assert len(whole) == 1 and len(parts) == 8
    starts = [s for p in parts for _, s, e in p for s in range(s, e - 49)]
    assert sorted(starts) == list(range(len(data) - 49))


def test_nulls_repeats_and_clashing_names(spark):
    t = "the same text of some length"
    rows = [(None, t, 1, "h"), (7, t, 2, "h"), (7, t, 2, "h"), (8, None, 3, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, dk int, spans string")
    got = S.remove_repeats(docs, length=12).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in got) == [(0, 28), (7, 28), (7, 28), (8, 0)]
    back = S.remove_repeats_from(docs, length=12)
    assert back.columns == docs.columns and back.count() == 4
    assert S.remove_repeats(docs.limit(0)).count() == 0


def test_cuts_inside_letters_are_dropped(spark):
    docs = spark.createDataFrame([(1, "éa" * 8 + "z"), (2, "xéa" + "éa" * 6)], "doc_id long, text string")
    for r in S.remove_repeats_from(docs, length=7).collect():
        r["text"].encode("utf-8")


def test_difference_cover():
    for v in (7, 13, 31):
        d = S.difference_cover(v)
        assert {(a - b) % v for a in d for b in d} == set(range(v))


def test_block_sort_finds_equal_windows():
    rng = np.random.default_rng(0)
    core = bytes(rng.integers(97, 100, 80, dtype=np.uint8))
    ctxs = [bytes(rng.integers(97, 100, 10, dtype=np.uint8)) + core + bytes(rng.integers(97, 100, 10, dtype=np.uint8)) for _ in range(6)]
    who, offset = S.sort_block(ctxs, np.full(6, 10), np.full(6, 20), np.zeros(6, np.int64), 70)
    windows = {}
    for i, c in enumerate(ctxs):
        for k in range(31):
            windows.setdefault((k, c[k : k + 70]), []).append((i, k - 10))
    assert sorted(zip(who.tolist(), offset.tolist(), strict=True)) == sorted(x for v in windows.values() if len(v) > 1 for x in v)


@pytest.mark.parametrize("hot", [1, 4096])
@pytest.mark.parametrize("lengths", [(12, 40), (5, 24), (30, 31)])
def test_two_lengths_against_counting(spark, lengths, hot):
    rng = np.random.default_rng(sum(lengths))
    bits = ["".join(rng.choice(list("abé "), n)) for n in (14, 20, 35, 44, 60, 90)]
    texts = ["".join(rng.choice(bits, 5)) + "".join(rng.choice(list("abé "), 7)) for _ in range(40)]
    texts += ["a" * 90, "ab" * 40, "", "abc", None, bits[3], bits[3], bits[5][:30], bits[5][-41:], texts[0][:-3]]
    got = kept(spark, texts, lengths[1], passage=lengths[0], hot=hot)
    raw = [(t or "").encode() for t in texts]
    short = S.brute_force(raw, lengths[0])
    for i, want in enumerate(S.brute_force(raw, lengths[1])):
        assert bytes(got[i]["kept"]) == want, i
        assert got[i]["n_passage"] == len(raw[i]) - len(short[i]), i


def test_two_lengths_in_a_very_long_text(spark, monkeypatch):
    rng = np.random.default_rng(2)
    part = "".join(rng.choice(list("abcdefgh"), 3000))
    text = "".join(rng.choice(list("abcdefgh"), S.PIECE + 5000)) + part + "xyz" + part[1000:2500]
    got = kept(spark, [text, part[200:500], None], 400, passage=240)
    assert got[0]["n_removed"] == 3000 and got[0]["n_passage"] == 3300 and got[0]["n_spans"] == 2
    assert got[1]["n_removed"] == 0 and got[1]["n_passage"] == 300
