import difflib
import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from runloom.functions import text as T
from runloom.operators import evaluation as E, governance as G, graph, ranking, selection as S, structure as X


def test_personal_data(spark):
    cases = {
        "mail me at a.b@c.example": ["email"], "call (555) 123-4567 now": ["phone"], "at 12 Long Winding Road": ["postal_address"], "account #AB-1234": ["customer_id"], "Dr. Ada Lovelace": ["person_name"],
        "host 10.0.0.255": ["ip_address"], "host 10.0.0.256": [], "host 10.0.0.01": [], "[REDACTED] <redacted:email>": [], "": [], "ACME Corp says": ["organization_entity"],
    }
    df = spark.createDataFrame([(k,) for k in cases], "t string").select("t", T.personal_data(F.col("t"), ("acme corp",)).alias("k"))
    assert {r["t"]: r["k"] for r in df.collect()} == cases


SECRETS = {
    "api_key=abc123, next": "api_key=[REDACTED], next", 'password: "two words" x': 'password: "[REDACTED]" x', "run --auth-token xyz now": "run --auth-token [REDACTED] now", "token_count=5": None,
    "secret=[REDACTED]": None, "name=bob": None, "private_key='k'": "private_key='[REDACTED]'", "Authorization: Basic abc def==\nsafe: yes": "Authorization: [REDACTED]\nsafe: yes",
    "password=several words here; mode=x": "password=[REDACTED]; mode=x", "cookie=c other=d": "cookie=[REDACTED] other=d", "token: a --flag": "token: [REDACTED] --flag", "run --token --verbose": None, "run --secret -v": None,
    "x=password=p": "x=password=[REDACTED]", "session_id=5 user_hash=6": None, "auth_id=5": "auth_id=[REDACTED]", "bearer: t": "bearer: [REDACTED]", "token=<redacted:env>": None, "token=[REDACTED] tail": "token=[REDACTED]",
    "accessToken=q": "accessToken=[REDACTED]", "authTokens=3": "authTokens=[REDACTED]", "clientSecretName=3": None, 'password="open\nnext': 'password="[REDACTED]\nnext', "password=\nnext": None, 'k "token": "a\\"b" z': 'k "token": "[REDACTED]" z',
    "--client-secret a\\ b c": "--client-secret [REDACTED] c", "the token and the password": None, "a.password:b": "a.password:[REDACTED]", "tokenizer=3 monkey=4 passWord=5": None, "APIKey=v, myAPIKEY=w": "APIKey=[REDACTED], myAPIKEY=[REDACTED]",
}


def test_redaction_and_secrets(spark):
    df = spark.createDataFrame([(k,) for k in SECRETS], "t string").select("t", T.redacted(F.col("t")).alias("r"), T.has_secret(F.col("t")).alias("s"))
    for r in df.collect():
        want = SECRETS[r["t"]]
        assert (r["r"], r["s"]) == (want or r["t"], want is not None), r["t"]
        assert T.redact(r["t"]) == r["r"] and T.redact(r["r"]) == r["r"]
    assert T.redact("a\nsecret one", ("secret.one",)) == "a\n[REDACTED]"


def test_credential_literals(spark):
    mark = "abcdefghij0123456789"
    found = [f"sk-{mark}", f"sk-proj-{mark}", f"ghp_{mark}", f"github_pat_{mark}", f"xoxb-{mark}", f"xapp-{mark}", f"xwfp-{mark}"]
    clean = ["sk-short", f"task-{mark}", f"ghq_{mark}", "xapp-1", f"xsk-{mark}"]
    df = spark.createDataFrame([(x,) for x in found + clean], "t string")
    assert {r["t"] for r in df.filter(T.has_secret(F.concat(F.lit("see "), F.col("t"), F.lit(" here")))).collect()} == set(found)


def parts_of(name):
    """Parts of a name by a loop over its letters."""
    out, part = [], ""
    for i, c in enumerate(name):
        if not (c.isascii() and c.isalnum()):
            out, part = [*out, part], ""
            continue
        up_low = i + 1 < len(name) and "a" <= name[i + 1] <= "z"
        if part and "A" <= c <= "Z" and (not "A" <= part[-1] <= "Z" or up_low):
            out, part = [*out, part], ""
        part += c
    return [p.lower() for p in [*out, part] if p]


def test_secret_names_against_a_loop(spark):
    rng = random.Random(5)
    bits = [*T.SECRET_WORDS, *T.KEY_QUALIFIERS, *T.SAFE_LAST, "key", "api", "apikey", "id", "x", "9"]
    names = []
    for _ in range(3000):
        some = [rng.choice([str.lower, str.capitalize, str.upper])(rng.choice(bits)) for _ in range(rng.randrange(1, 4))]
        names.append(rng.choice(["", "_", "-", ".", " "]).join(some))
    got = {r["n"]: r["s"] for r in spark.createDataFrame([(n,) for n in set(names)], "n string").select("n", T.secret_key(F.col("n")).alias("s")).collect()}
    for n in names:
        p = parts_of(n)
        want = (bool(set(p) & set(T.SECRET_WORDS)) or "apikey" in "".join(p) or ("key" in p and bool(set(p) & set(T.KEY_QUALIFIERS)))) and not (len(p) > 1 and p[-1] in T.SAFE_LAST)
        assert got[n] == want == T.is_secret_key(n), n


def test_sanitised_json():
    assert T.sanitise({"password": "x", "n": [1, "token=abc"], "auth": {"a": 1}, "secret": "", "bearer": "[REDACTED]"}) == {"password": "[REDACTED]", "n": [1, "token=[REDACTED]"], "auth": "[REDACTED]", "secret": "", "bearer": "[REDACTED]"}
    held = {"credentials": {"user": "u", "list": ["a", {"b": 2}], "token_count": 3, "api_key_env": "E", "password": {"p": "q"}}}
    assert T.sanitise(held) == {"credentials": {"user": "[REDACTED]", "list": ["[REDACTED]", {"b": "[REDACTED]"}], "token_count": 3, "api_key_env": "E", "password": "[REDACTED]"}}


def test_normal_form(spark):
    df = spark.createDataFrame([("Straße ﬁn, 12!",), ("",)], "t string").select(T.normalise(F.col("t")).alias("n"))
    assert [r["n"] for r in df.collect()] == ["strasse fin 12", ""]


def test_jaccard_against_all_pairs(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.sample([f"w{k}" for k in range(25)], rng.randrange(1, 12))) for _ in range(60)] + ["", "w1 w1"]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    sets = [set(t.split()) for t in texts]
    for t in (0.3, 0.5, 0.8, 1.0):
        want = {(a, b) for a, b in combinations(range(len(texts)), 2) if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= t}
        assert {(r["a"], r["b"]) for r in G.jaccard_pairs(G.token_rows(rows, "id", "text"), None, "id", t).collect()} == want


def test_clusters_join_empty_texts(spark):
    rows = spark.createDataFrame([(1, ""), (2, "!!"), (3, "a b c d"), (4, "A, b c d"), (5, "a b c d e"), (6, "z")], "id int, text string")
    got = {r["id"]: r["cluster"] for r in G.near_duplicate_clusters(rows, "id", "text", 0.7).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3, 5: 3, 6: 6}


@pytest.mark.parametrize("tile", [4, 1024])
def test_clusters_by_jaccard_or_ratio(spark, monkeypatch, tile):
    monkeypatch.setattr(G, "TILE", tile)
    rng = random.Random(8)
    texts = ["", "a"]
    for _ in range(25):
        base = " ".join("".join(rng.choices("abcdefgh", k=rng.randrange(3, 9))) for _ in range(rng.randrange(1, 8)))
        texts += [base, base + rng.choice(["s", "ing", " 12"]), "".join(c if rng.random() > 0.08 else "z" for c in base)]
    rng.shuffle(texts)
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    for t in (0.6, 0.8):
        root = list(range(len(texts)))
        by_ratio = 0
        for a, b in combinations(range(len(texts)), 2):
            x, y = texts[a], texts[b]
            p, q = set(x.split()), set(y.split())
            jaccard = len(p & q) / len(p | q) if p | q else 0.0
            ratio = difflib.SequenceMatcher(None, x, y, autojunk=False).ratio() if x and y else 0.0
            if x == y or max(jaccard, ratio) >= t:
                by_ratio += jaccard < t <= ratio
                low, high = sorted((root[a], root[b]))
                root = [low if r == high else r for r in root]
        assert by_ratio
        assert {r["id"]: r["cluster"] for r in G.near_duplicate_clusters(rows, "id", "text", t).collect()} == dict(enumerate(root))


def test_curation_against_a_loop(spark):
    rng = random.Random(5)
    rows = [(i, float(rng.randrange(4)), rng.choice("abc"), rng.choice(["x", "y"])) for i in range(80)]
    df = spark.createDataFrame(rows, "row_id int, quality_score double, source_id string, training_role string")
    for per, most in ((3, 5), (30, 20), (2, 100)):
        want, taken, chosen = {}, {}, 0
        for i, q, s, r in sorted(rows, key=lambda x: (-x[1], T.digest(f"curation-v1:{x[0]}"), x[0])):
            if q < 1:
                want[i] = "minimum_quality"
            elif r != "x":
                want[i] = "role_not_allowed"
            elif taken.get(s, 0) >= per:
                want[i] = "source_cap"
            elif chosen >= most:
                want[i] = "row_cap"
            else:
                want[i] = "selected"
                taken[s] = taken.get(s, 0) + 1
                chosen += 1
        assert {r["row_id"]: r["reason"] for r in G.curate(df, 1, ["x"], per, most).collect()} == want


def test_closure_with_a_cycle(spark):
    v = spark.createDataFrame([(1, True), (2, False), (3, False), (4, False)], "version int, direct boolean")
    e = spark.createDataFrame([(1, 2), (2, 3), (3, 1)], "parent int, child int")
    assert {(r["version"], r["distance"]) for r in G.deletion_closure(v, e).collect()} == {(1, 0), (2, 1), (3, 2)}


def test_components_of_random_graphs(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(100 + i, 101 + i) for i in range(40)] + [(5, 5)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    df = spark.createDataFrame([*edges, (None, 3)], "a long, b long")
    assert {r["node"]: r["component"] for r in graph.connected_components(df).collect()} == {x: find(x) for x in root}
    assert graph.connected_components(df.limit(0)).count() == 0


def test_global_rank(spark):
    df = spark.range(500).select(((F.col("id") * 37) % 11).alias("k"), "id").repartition(7)
    got = [(r["k"], r["id"]) for r in ranking.global_rank(df, "n", F.desc("k"), F.col("id")).orderBy("n").collect()]
    assert got == sorted(got, key=lambda x: (-x[0], x[1])) and len(got) == 500


def test_bootstrap_repeats_and_covers(spark):
    rows = spark.createDataFrame([(i, float(i % 5) - 1, i % 2) for i in range(40)], "cluster int, mean_delta double, domain int")
    a, b = E.bootstrap(rows, "cluster").first(), E.bootstrap(rows.repartition(3), "cluster").first()
    assert a == b and a["lower"] <= a["mean"] <= a["upper"] and abs(a["mean"] - 1.0) < 1e-12
    s = E.bootstrap(rows, "cluster", strata="domain").first()
    assert s["n"] == 40 and s["lower"] <= s["mean"] <= s["upper"]


def test_balance_invariants(spark):
    rows = spark.createDataFrame([(0, "big" if i < 15 else "small", f"f{i % 4}", 1, i) for i in range(20)], "pool int, domain string, family string, weight int, key int")
    kept = {r["key"] for r in S.balance(rows, "pool", "domain", "family", "weight", "key").collect()}
    big = {k for k in kept if k < 15}
    assert len(big) / len(kept) <= 0.5 and {k % 4 for k in big} == {0, 1, 2, 3} and set(range(15, 20)) <= kept


def test_schema_subset():
    schema = {"type": "object", "required": ["a"], "properties": {"a": {"$ref": "#/defs/n"}, "b": {"type": "array", "items": {"enum": [1, "x"]}, "uniqueItems": True}, "c": {"oneOf": [{"type": "string"}, {"type": "null"}]}}, "additionalProperties": False, "defs": {"n": {"type": "integer", "minimum": 1}}}
    assert X.schema_errors({"a": 2, "b": [1, "x"], "c": None}, schema) == []
    bad = X.schema_errors({"a": True, "b": [True, 1, 1], "d": 0}, schema)
    assert len(bad) == 4 and any("$.a" in e for e in bad) and any("$.b[0]" in e for e in bad)
    assert not X.same(True, 1) and X.same({"a": [1, 2.0]}, {"a": [1.0, 2]})


def test_diff_of_kinds(spark):
    df = spark.createDataFrame([(1, '{"a": {"b": 1}, "l": [1, 2]}', '{"a": {"b": "1"}, "l": [1, 2, 3]}'), (2, "{}", "{}"), (3, None, "{}"), (4, "{", "{}")], "k int, x string, y string")
    got = {(r["path"], r["change"]) for r in X.state_diff(df.filter("k = 1"), "k", "x", "y").collect()}
    assert got == {("$.a.b", "changed"), ("$.l[2]", "added")}
    assert {r["k"]: r["status"] for r in X.diff_status(df, "k", "x", "y").collect()} == {1: "changed", 2: "unchanged", 3: "unknown", 4: "unknown"}


@pytest.mark.parametrize("parts", [1, 6])
def test_checksum_ignores_order(spark, parts):
    df = spark.range(200).select((F.col("id") % 3).alias("g"), "id")
    want = X.checksum(df, "g", ["id"]).orderBy("g").collect()
    assert X.checksum(df.orderBy(F.desc("id")).repartition(parts), "g", ["id"]).orderBy("g").collect() == want
    assert X.checksum(df.filter("id <> 7"), "g", ["id"]).orderBy("g").collect() != want


def test_lineage_levels(spark):
    versions = spark.createDataFrame([(i,) for i in range(1, 6)], "version long")
    edges = [(1, 2), (2, 3), (1, 3), (3, 4), (9, 5), (1, 2)]
    levels = G.lineage_levels(versions, spark.createDataFrame(edges, "parent long, child long"))
    assert sorted(map(tuple, levels.select("version", "level").collect())) == [(1, 0), (2, 1), (3, 2), (4, 3), (5, 0)]
    for cycle in ((4, 2), (5, 5)):
        with pytest.raises(ValueError, match="cycle"):
            G.lineage_levels(versions, spark.createDataFrame([*edges, cycle], "parent long, child long")).collect()
    assert G.lineage_levels(versions.limit(0), spark.createDataFrame([], "parent long, child long")).collect() == []


def test_assigned_paths(spark):
    cases = [('{"k":1}', '{"k":1,"a":{"b":7}}'), ('{"a":{"c":2}}', '{"a":{"c":2,"b":7}}'), ('{"a":3,"z":4}', '{"z":4,"a":{"b":7}}'), ("[1]", '{"a":{"b":7}}'), ("", '{"a":{"b":7}}'), (None, '{"a":{"b":7}}')]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(cases)], "i int, t string")
    got = df.select("i", X.assign_path(F.col("t"), ("a", "b"), F.lit("7")).alias("o")).collect()
    assert {r["i"]: r["o"] for r in got} == {i: o for i, (_, o) in enumerate(cases)}


def test_contamination_report_against_all_pairs(spark):
    rows = [(1, "the cat sat on the mat today", "train"), (2, "The cat sat on the mat today!", "test"), (3, "a quite different line of text", "train"), (4, "a quite different line of texts", "train"), (5, "alone", None), (6, "", "test"), (7, None, None), (8, "the cat sat on the mat today", None)]

    def similarity(a, b):
        x, y = T_plain(a), T_plain(b)
        s, t = set(x.split()), set(y.split())
        return 0.0 if not s or not t else max(len(s & t) / len(s | t), difflib.SequenceMatcher(None, x, y, autojunk=False).ratio())

    def T_plain(t):
        return norm[t]

    texts = spark.createDataFrame([(i, t) for i, t, _ in rows], "i long, t string")
    said = {r["i"]: r["n"] for r in texts.select("i", T.normalise(F.coalesce("t", F.lit(""))).alias("n")).collect()}
    norm = {t: said[i] for i, t, _ in rows}
    cluster = {i: i for i, _, _ in rows}
    for _ in rows:
        for (i, a, _), (j, b, _) in combinations(rows, 2):
            if norm[a] == norm[b] or similarity(a, b) >= 0.9:
                cluster[i] = cluster[j] = min(cluster[i], cluster[j])
    df = spark.createDataFrame(rows, "k long, t string, split string")
    got = {r["cluster"]: (r["rows"], r["texts"], r["splits"], r["exact_duplicate"], r["cross_split"]) for r in G.contamination_report(df, "k", "t", "split").collect()}
    want = {}
    for c in set(cluster.values()):
        own = [r for r in rows if cluster[r[0]] == c]
        n, splits = len({norm[t] for _, t, _ in own}), len({s for _, _, s in own if s})
        want[c] = (len(own), n, splits, n == 1 and len(own) > 1, splits > 1)
    assert got == want


def test_ratio_links_match_only_what_bounds_allow(monkeypatch):
    import pyarrow as pa

    rng = random.Random(5)
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti", "to", "it"]
    texts = [" ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(30)) for _ in range(100)]
    texts += [t[:k] + "x" + t[k + 5 :] for t in texts[:20] for k in (10, 70)]
    want = {(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts)) if difflib.SequenceMatcher(None, texts[a], texts[b], autojunk=False).ratio() >= 0.9}
    calls = []
    real = difflib.SequenceMatcher
    monkeypatch.setattr(G.difflib, "SequenceMatcher", lambda *x, **k: calls.append(x) or real(*x, **k))
    rows = [(0, 0, 0, home, 0, k, k, t) for k, t in enumerate(texts) for home in (True, False)]
    links = G._ratio_links(0.9)(pa.table([pa.array(c) for c in zip(*rows, strict=True)], names=["band", "i", "j", "home", "own", "key", "comp", "n"])).to_pylist()
    assert {(x["a"], x["b"]) for x in links} <= want
    # Every original is joined with its two changed copies.
    assert len(links) == 40
    assert len(calls) <= 2 * len(want)
