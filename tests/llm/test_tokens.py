import base64
import json
import uuid
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from runloom.llm import bpe, packing, token_counts
from runloom.session import shared_dir

LIBRARY = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
MULTI, JSON = P.path("byte_bpe_multi_50k.tiktoken"), P.path("byte_bpe_50k.json")
ENCODE = packing.encoder(JSON)
TEXTS = ["", None, "plain words here", "éàü ß 日本語 🙂", "a" * 700, " " * 300 + "x", "12 345 6789!!??", "don't we'll\n\n\tit's", "<|endoftext|> inside <|endoftext|>", "\x00\x01", "word " * 3000]


@pytest.fixture(scope="module")
def codec():
    with open(MULTI, "rb") as f:
        return bpe.Codec.load(f.read(), P.PATTERN)


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(MULTI, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(max_size=300), st.text(alphabet="abcde é", max_size=700)))
def test_codec_against_library(codec, library, text):
    text = text.encode("utf-8", "ignore").decode()
    ids = codec.encode([text])[0]
    assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
    assert codec.decode(ids) == text.encode()


def test_long_pieces(codec):
    for t in (b"ab" * 300, b"abcde" * 100, "é".encode() * 200):
        assert codec.merge_long(t).tolist() == codec.merge_matrix([t])[0].tolist()


def test_round_trip_frame(spark, library):
    docs = spark.createDataFrame([(i if i != 3 else None, t, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string")
    rows = bpe.decode_ids(bpe.encode_texts(docs, MULTI, P.PATTERN), MULTI, P.PATTERN).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        t = TEXTS[3 if r["doc_id"] is None else r["doc_id"]] or ""
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(t) and bytes(r["decoded"]) == t.encode()
    assert sorted(map(str, bpe.round_trip(docs, MULTI, P.PATTERN).collect())) == sorted(map(str, rows))
    assert bpe.encode_texts(docs.limit(0), MULTI, P.PATTERN).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_and_cache(spark, name):
    path = P.path(name)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS + TEXTS[:4])], "doc_id long, text string")
    cache = f"{shared_dir(spark)}/cache-{uuid.uuid4().hex}"
    if name.endswith(".json"):
        want = [len(e) for e in Tokenizer.from_file(path).encode_batch([t or "" for t in TEXTS], add_special_tokens=False)]
    else:
        want = token_counts.counter(path)([t or "" for t in TEXTS])
    for _ in range(2):
        got = {r["doc_id"]: r for r in token_counts.count_tokens(docs, path, cache).collect()}
        assert [got[i]["n_tokens"] for i in range(len(TEXTS))] == want
        assert got[3]["n_bytes"] == len(TEXTS[3].encode())
    # The second run added nothing.
    assert token_counts.read_cache(spark, cache).count() == len({t or "" for t in TEXTS})
    assert token_counts.count_tokens(docs.limit(0), path, cache).count() == 0


def test_counts_take_only_misses(spark):
    cache = f"{shared_dir(spark)}/cache-{uuid.uuid4().hex}"
    docs = spark.createDataFrame([(1, "one two"), (2, "three")], "doc_id long, text string")
    token_counts.count_tokens(docs.filter("doc_id = 1"), JSON, cache).count()
    stored = token_counts.read_cache(spark, cache)
    spark.createDataFrame([(r["tokenizer"], r["digest"], 99) for r in stored.collect()], token_counts.CACHE_SCHEMA).write.mode("append").parquet(cache)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(docs, JSON, cache).collect()}
    assert got == {1: 99, 2: 1}


def test_encoder_is_the_library(tmp_path):
    t = Tokenizer.from_file(JSON)
    encode = packing.encoder(JSON)
    for x in TEXTS:
        assert encode(x or "").tolist() == t.encode(x or "", add_special_tokens=False).ids
    spec = json.load(open(JSON))
    spec["model"]["merges"] = spec["model"]["merges"][:1000]
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec))
    assert packing.encoder(str(other))("plain words here").tolist() == Tokenizer.from_file(str(other)).encode("plain words here").ids


@settings(max_examples=150, deadline=None)
@given(st.one_of(st.text(max_size=200), st.text(alphabet="ab<|endoftext>é 1'st\n", max_size=200)))
def test_encoder_on_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    assert ENCODE(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_encoder_on_a_million_spaces():
    text = "a" + " " * 1_200_000 + "b c"
    assert ENCODE(text).tolist() == LIBRARY.encode(text, add_special_tokens=False).ids


def test_packing(spark):
    t = Tokenizer.from_file(JSON)
    texts = TEXTS + [f"text number {i} " * (i % 90) for i in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = packing.pack_documents(docs, JSON, capacity=256, block_windows=8).collect()
    ids = {i: np.array([*t.encode(x or "", add_special_tokens=False).ids, 1], "<u4") for i, x in enumerate(texts)}
    pieces, sequences = {}, {}
    for r in rows:
        own = ids[r["doc_id"]]
        assert r["ids_crc32"] == zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes()) and r["doc_tokens"] == len(own)
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans, size in [(p, len(ids[i])) for i, p in pieces.items()] + [(s, None) for s in sequences.values()]:
        at = 0
        for start, length in sorted(spans):
            assert start == at and length > 0
            at += length
        assert at == size if size else at <= 256
    assert set(pieces) == set(ids)
    assert sum(map(len, ids.values())) / (256 * len(sequences)) > 0.9
    assert packing.pack_documents(docs.limit(0), JSON).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_pack_fits(sizes):
    where, m = packing.pack(sizes, 100)
    assert len(where) == len(sizes)
    if sizes:
        assert np.bincount(where, sizes, m).max() <= 100 and m >= -(-sum(sizes) // 100)


def test_differencing_balances():
    assert sorted(np.bincount(packing.differencing([8, 7, 6, 5, 4], 2), [8, 7, 6, 5, 4]).tolist()) == [14, 16]


def test_many_short_texts_take_little_memory():
    """A million empty texts; a vector of windows for each text would take gigabytes."""
    import resource

    rests = packing.Rests(2048)
    one = np.array([1], "<u4")
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    sizes = []
    for i in range(1_000_000):
        rests.add(i, 0, one, 1)
        if len(rests.ids) >= packing.BLOCK_PIECES:
            sizes.append(rests.settle(2048, 0)[1])
            rests = packing.Rests(2048)
    rests.settle(2048, 0)
    assert sizes == [128, 128, 128]
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 400_000  # KB


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=200))
def test_bundles_hold_every_piece_once(sizes):
    rests = packing.Rests(64)
    for i, n in enumerate(sizes):
        for s in range(0, n, rests.most):
            rests.add(i, s, np.arange(s, min(n, s + rests.most), dtype="<u4"), n)
    if not rests.ids:
        return
    rows, m = rests.settle(64, 10)
    got = rows.to_pydict()
    assert set(got["sequence_id"]) <= set(range(10, 10 + m))
    spans = {}
    for q, o, n in zip(got["sequence_id"], got["offset"], got["length"]):
        spans.setdefault(q, []).append((o, n))
    for own in spans.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= 64
    assert sum(got["length"]) == sum(sizes)


def test_repeated_rows_are_encoded_once(spark):
    cache = f"{shared_dir(spark)}/cache-{uuid.uuid4().hex}"
    docs = spark.createDataFrame([(1, "the same text")] * 50 + [(2, "the same text")] * 50 + [(None, None)] * 3, "doc_id long, text string").repartition(4)
    assert token_counts.count_tokens(docs, JSON, cache).count() == 103
    assert spark.read.parquet(cache).count() == 2


def test_key_names_what_counts(monkeypatch):
    key = token_counts.tokenizer_version(JSON)
    monkeypatch.setattr(P, "PATTERN", P.PATTERN + "|x")
    assert token_counts.tokenizer_version(JSON) != key
