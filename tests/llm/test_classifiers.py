import numpy as np
import pytest
from pyspark.sql import functions as F

from runloom.llm import quality as Q, toxicity as X
from runloom.llm.common import mix64
from runloom.llm.labelled import fold, labelled_sample

BAD = ["blorx", "grumph", "zzikt"]


def corpus(n, seed, bad):
    rng = np.random.default_rng(seed)
    words = [f"{a}{b}" for a in ("ka", "mo", "ti", "re", "su") for b in ("la", "no", "pi", "ru", "da", "ve")]
    texts, labels = [], []
    for i in range(n):
        w = list(rng.choice(words, rng.integers(30, 80)))
        y = int(i % 3 == 0)
        if y == bad:
            w[rng.integers(0, len(w))] = BAD[i % 3]
        texts.append(" ".join(w))
        labels.append(y)
    return texts, np.array(labels)


def test_toxicity_learns_and_calibrates():
    texts, y = corpus(600, 1, 1)
    model = X.fit(texts, y, ["en" if i % 2 else "fr" for i in range(600)])
    held, hy = corpus(300, 2, 1)
    rows = model.rows()
    s = model.score([np.array([rows[w] for w in X.words_of(t)], np.int64) for t in held])
    assert ((s >= 0.3) == hy).mean() > 0.95
    assert set(model.thresholds) == {"en", "fr"}
    assert 0 <= model.score([np.empty(0, np.int64)])[0] <= 1


def test_toxicity_chunks_change_nothing(monkeypatch):
    texts, y = corpus(200, 3, 1)
    model = X.fit(texts, y, [None] * 200)
    rows = model.rows()
    ids = [np.array([rows[w] for w in X.words_of(t * 5)], np.int64) for t in texts] + [np.empty(0, np.int64)]
    whole = model.score(ids)
    monkeypatch.setattr(X, "CHUNK", 50)
    assert np.allclose(whole, model.score(ids))


def test_toxicity_frame(spark):
    texts, y = corpus(300, 4, 1)
    docs = spark.createDataFrame([(i, t, "en", 0.5) for i, t in enumerate(texts)] + [(None, None, None, 1.0), (999, "", "en", 1.0)], "doc_id long, text string, lang string, score double")
    labels = spark.createDataFrame([(i, int(v), int(v)) for i, v in enumerate(y)] + [(5, None, None), (6, 7, 7)], "doc_id long, toxic int, quality int")
    model = X.fit_documents(docs, labels, fold("doc_id", 4) != 2)
    got = X.score_documents(docs, model, lang_col="lang").collect()
    assert len(got) == 302 and all(0 <= r["score"] <= 1 for r in got)
    left = X.reject_toxic(docs, model)
    assert left.columns == docs.columns
    gone = {r["doc_id"] for r in docs.join(left.select("doc_id"), "doc_id", "left_anti").collect()} - {None}
    assert len(gone ^ {i for i, v in enumerate(y) if v}) < 15
    assert X.score_documents(docs.limit(0), model).count() == 0


def test_no_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string, lang string" if False else "doc_id long, text string").withColumn("lang", F.lit("en"))
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    assert X.score_documents(docs, X.fit_documents(docs, labels, F.lit(True))).count() == 1
    assert Q.score_documents(docs, Q.fit_documents(docs, labels, F.lit(True))).count() == 1


def test_sample_is_bounded_and_stable(spark):
    docs = spark.createDataFrame([(i, "x" * i) for i in range(100)] + [(3, "again")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)] + [(3, 0)], "doc_id long, toxic int")
    a, sizes = labelled_sample(docs, labels, "toxic", F.lit(True), 10, 60)
    b, _ = labelled_sample(docs.repartition(5), labels, "toxic", F.lit(True), 10, 60)
    a, b = a.orderBy("id").toPandas(), b.orderBy("id").toPandas()
    assert a["id"].tolist() == b["id"].tolist() and len(a) <= 20 and a["text"].str.len().max() <= 60 and sizes == {0: 50, 1: 50}


def test_quality_learns_junk(spark):
    good, _ = corpus(300, 5, 9)
    junk = [t.upper() for t in good[:60]] + [" ".join(w + "%%%" for w in t.split()) for t in good[60:120]] + [" ".join([w] * 20) for w in (t.split()[0] for t in good[120:180])]
    texts = [t.encode() for t in good[180:] + junk]
    y = np.array([1] * 120 + [0] * 180)
    model = Q.fit(texts, y)
    more, _ = corpus(100, 6, 9)
    bad = [t.upper() for t in more[:30]] + [" ".join([w] * 15) for w in (t.split()[1] for t in more[30:60])]
    assert (model.score([t.encode() for t in more]) >= 0.3).mean() > 0.95
    assert (model.score([t.encode() for t in bad]) < 0.3).mean() > 0.9
    docs = spark.createDataFrame([(1, more[0], 2.0), (2, None, 1.0), (None, "", 0.0)], "doc_id long, text string, score double")
    got = Q.score_documents(docs, model).collect()
    assert len(got) == 3 and all(0 <= r["score"] <= 1 for r in got)


def plain_quality(model, text):
    """The score by loops over words and letters."""
    h, folded = Q._hasher(), model.folded()
    code = lambda x: int(mix64(np.array([sum(int(h.table[c]) * int(h.powers[i]) for i, c in enumerate(x)) % 2**64], np.uint64))[0])
    words = text.split()
    buckets = [code(w) >> 64 - Q.BITS for w in words]
    for a, b in zip(words, words[1:]):
        buckets.append(int(mix64(np.array([(code(b) - code(a) + 1) % 2**64], np.uint64))[0]) >> 64 - Q.BITS)
    spaced = b" " + text + b" "
    for n in Q.GRAMS:
        for i in range(len(spaced) - n + 1):
            if not any(c in Q._BLANKS for c in spaced[i + 1 : i + n - 1]):
                buckets.append((code(spaced[i : i + n]) ^ n * 0x9E3779B97F4A7C15 % 2**64) >> 64 - Q.BITS)
    z = float(np.mean(folded[buckets])) if buckets else 0.0
    return 1 / (1 + np.exp(-(z + model.bias[1] - model.bias[0])))


def test_quality_scores_are_the_loops(monkeypatch):
    texts, y = corpus(60, 7, 0)
    model = Q.fit([t.encode() for t in texts], y)
    some = [t.encode() for t in texts[:6]] + [b"", b" ", b"a", b"ab  c\n\nd", b"x" * 30, " é ß".encode(), " ".join(texts[:4]).encode()]
    want = [plain_quality(model, t) for t in some]
    assert np.allclose(model.score(some), want, atol=1e-6)
    for size in (64, 100, 177):
        monkeypatch.setattr(Q, "CHUNK", size)
        assert np.allclose(model.score(some), want, atol=1e-6), size


def test_quality_parts_hold_all_bytes(monkeypatch):
    monkeypatch.setattr(Q, "CHUNK", 40)
    for text in (b"", b" " * 200, b"w" * 130, b"some words here and there " * 9, b"a" + b" " * 100 + b"b" * 90 + b"\tc"):
        assert b"".join(p[lap:] for p, lap in Q._parts(text)) == text


def plain_toxicity(model, text):
    """The score by loops over words, widths and filters."""
    rows = model.rows()
    x = [model.embeddings[rows[w]] for w in X.words_of(text)] + [np.zeros(X.DIM)] * max(X.WIDTHS)
    pooled = []
    for w in X.WIDTHS:
        conv = np.array([sum(x[i + k] @ model.filters[w][k] for k in range(w)) for i in range(len(x) - w + 1)])
        pooled.append(np.maximum(conv.max(axis=0) + model.biases[w], 0))
    return 1 / (1 + np.exp(-(np.concatenate(pooled) @ model.out + model.bias)))


def test_toxicity_scores_are_the_loops():
    texts, y = corpus(80, 3, 20)
    model = X.fit(texts, np.array(y), ["x"] * len(texts))
    rows = model.rows()
    some = [*texts[:20], "", "one", "12 !?", " ".join(texts)]
    got = model.score([np.array(list(map(rows.__getitem__, X.words_of(t))), np.int64) for t in some])
    assert np.allclose(got, [plain_toxicity(model, t) for t in some], atol=1e-4)


@pytest.mark.parametrize("op,column", [(X, "toxic"), (Q, "quality")])
def test_held_out_accuracy(spark, op, column):
    """On the whole sf0.1 table, which the model sees through its training folds only."""
    run = X.op3_toxicity if op is X else Q.op8_quality
    data = "/root/testdata/sf0.1"
    rows = run(spark, data).join(spark.read.parquet(f"{data}/labels.parquet"), "doc_id").filter("held_out").select("predicted", column, "score").collect()
    right = sum(r["predicted"] == r[column] for r in rows) / len(rows)
    assert right > 0.93, right


def test_sample_is_bounded_in_bytes(spark):
    docs = spark.createDataFrame([(i, "x" * 40) for i in range(100)], "doc_id long, text string").unionAll(spark.createDataFrame([(7, "y" * 40)] * 50, "doc_id long, text string"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, toxic int")
    frame, _ = labelled_sample(docs, labels, "toxic", F.lit(True), 50, 60, total_bytes=400)
    frame = frame.toPandas()
    assert frame["y"].value_counts().to_dict() == {0: 10, 1: 10} and frame["id"].is_unique
