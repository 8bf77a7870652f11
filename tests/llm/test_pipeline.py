"""The pipeline stage by stage against plain versions, each on what the stage before it kept."""

import zlib

import numpy as np
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
from runloom.llm import similar_documents as D
from runloom.llm.suffix_dedup import PASSAGE, brute_force
from runloom.session import written

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in C.STAGES:
        docs = written(stage(spark, docs, DATA))
        out.append((name, docs))
    return {name: df.collect() for name, df in out}, {name: df.columns for name, df in out}


def texts(rows):
    return {r["doc_id"]: r["text"] for r in rows}


def test_stage_names_and_columns(stages):
    assert [n for n, _ in C.STAGES] == ["toxicity", "line_dedup", "simhash", "suffix_dedup", "packing"]
    for name in ("toxicity", "line_dedup", "simhash", "suffix_dedup"):
        assert stages[1][name] == stages[1]["documents"]
    assert all(r["n_chars"] == len(r["text"]) for r in stages[0]["suffix_dedup"])


def test_toxicity_only_drops(stages):
    before, after = texts(stages[0]["documents"]), texts(stages[0]["toxicity"])
    assert all(before[i] == t for i, t in after.items()) and 0 < len(after) <= len(before)


def test_line_dedup_is_the_loop(stages):
    before, after = texts(stages[0]["toxicity"]), texts(stages[0]["line_dedup"])
    seen = set()
    for i in sorted(before):
        lines = before[i].split("\n")
        gone = set()
        for k in range(len(lines) - 2):
            w = tuple(lines[k : k + 3])
            if w in seen:
                gone |= {k, k + 1, k + 2}
            seen.add(w)
        assert after[i] == "\n".join(x for k, x in enumerate(lines) if k not in gone)


def test_one_of_each_group(stages):
    before, after = texts(stages[0]["line_dedup"]), texts(stages[0]["simhash"])
    sets = {i: D.shingle_set(t.encode(), 5) for i, t in before.items()}
    ids = sorted(before)
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if D.overlap(sets[i], sets[j]) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    want = {i for i in ids if find(i) == i}
    assert all(before[i] == t for i, t in after.items())
    assert want == set(after)


def test_suffix_dedup_is_the_count(stages):
    before, after = texts(stages[0]["simhash"]), texts(stages[0]["suffix_dedup"])
    ids = sorted(before)
    for i, kept in zip(ids, brute_force([before[i].encode() for i in ids], PASSAGE), strict=True):
        assert after[i] == kept.decode("utf-8", "ignore")


def test_packing_holds_all_ids(stages):
    docs, rows = texts(stages[0]["suffix_dedup"]), stages[0]["packing"]
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    spans = {}
    for r in rows:
        ids = np.array([*t.encode(docs[r["doc_id"]], add_special_tokens=False).ids, 1], "<u4")
        assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
        spans.setdefault(r["doc_id"], []).append((r["start"], r["length"], len(ids)))
    assert set(spans) == set(docs)
    for own in spans.values():
        assert sum(n for _, n, _ in own) == own[0][2]


def test_run_is_the_stages(spark, stages):
    got = sorted(tuple(r) for r in C.run(spark, DATA).drop("sequence_id", "offset").collect())
    assert got == sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in stages[0]["packing"])


LONG = " ".join(f"word{i} of{i % 7}" for i in range(80))
ODD = [
    (None, None, None, None, None, "x", None), (None, "", "en", "a", 0, "x", 1), (7, LONG, "en", "a", 1, "y", 2), (7, LONG, "en", "a", 1, "y", 2), (7, LONG + " more", None, None, None, None, None),
    (8, "other " * 40 + LONG, "de", "b", 5, "z", 3), (9, "l1\nl2\nl3\nl4", "fr", "c", 5, "z", 4), (10, "l1\nl2\nl3\nl5", "fr", "c", 5, "z", 4), (11, "\n\n\n", "fr", "c", 5, "z", 4), (12, " " * 5000, "fr", "c", 5, "z", 4), (13, "x" * 300_000, None, "c", 5, "z", 4),
]


@pytest.mark.parametrize("name,stage", C.STAGES)
def test_stages_on_odd_rows(spark, name, stage):
    docs = spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long, id string, fp int")
    rows = stage(spark, docs, DATA)
    if name == "packing":
        tokens = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
        assert sum(r["length"] for r in rows.collect()) == sum(len(tokens.encode(t[1] or "", add_special_tokens=False).ids) + 1 for t in ODD)
        return
    assert rows.columns == list(C.COLUMNS)
    got = [(r["doc_id"], r["text"]) for r in rows.collect()]
    want = [(r[0], r[1]) for r in ODD]
    if name == "line_dedup":
        want[want.index((10, "l1\nl2\nl3\nl5"))] = (10, "l5")
        want[want.index((11, "\n\n\n"))] = (11, "")
    if name == "simhash":  # the least id of similar texts, of those without a word too
        assert sorted(i for i, _ in got) == [7, 9, 10, 11, 13]
        return
    if name == "suffix_dedup":
        want = [(i, t.replace(LONG, "") if t and len(t) > 290 and LONG in t else t) for i, t in want]
        want[-1] = (13, "")
        want[-2] = (12, "")
    key = lambda x: (x[0] is None, x[0] or 0, x[1] is None, x[1] or "")
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("name,stage", C.STAGES)
def test_stages_on_an_empty_table(spark, name, stage):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    assert stage(spark, docs, DATA).count() == 0
