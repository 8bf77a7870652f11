import duckdb
import pytest

from runloom.llm import line_dedup as L

DATA = "/root/testdata/sf0.001"


def model(texts, width=3):
    seen, out = set(), []
    for t in texts:
        lines = (t or "").split("\n")
        gone = set()
        for i in range(len(lines) - width + 1):
            w = tuple(lines[i : i + width])
            if w in seen:
                gone |= set(range(i, i + width))
            seen.add(w)
        out.append((len(lines), len(gone), "\n".join(x for k, x in enumerate(lines) if k not in gone)))
    return out


TEXTS = ["a\nb\nc\nd", "x\na\nb\nc\ny", "a\nb\nc\nd", "q\nq\nq\nq\nq", "", None, "a\nb", "\n\n\n\n", "b\nc\nd\na\nb\nc"]


def test_against_a_loop(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_lines"], r["n_removed"], r["kept"]) for r in L.remove_repeated_lines(docs).collect()}
    assert [got[i] for i in range(len(TEXTS))] == model(TEXTS)
    back = {r["doc_id"]: r["text"] for r in L.remove_repeated_lines_from(docs).collect()}
    assert all((back[i] or "") == got[i][2] for i in got)


def test_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{DATA}/documents.parquet'")
    assert {tuple(r) for r in L.op2_line_dedup(spark, DATA).collect()} == set(con.execute(L.OP2_SQL).fetchall())


def test_edges(spark):
    docs = spark.createDataFrame([(None, "a\nb\nc", 1), (5, "a\nb\nc", 2), (5, "a\nb\nc", 2)], "doc_id long, text string, starts int")
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in L.remove_repeated_lines(docs).collect())
    assert got == [(0, 0), (5, 3), (5, 3)]
    assert L.remove_repeated_lines_from(docs).columns == docs.columns
    assert L.remove_repeated_lines(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        L.remove_repeated_lines(docs, text_col="nope")
