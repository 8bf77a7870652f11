"""Data quality and governance: duplicates, contamination, splits, receipts, curation, deletion."""

from __future__ import annotations

import difflib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from runloom.functions import text as T
from runloom.operators.graph import connected_components
from runloom.session import checkpointed


def exact_duplicates(rows: DataFrame, key: str, text: str) -> DataFrame:
    """Each row's representative: the smallest key of the rows with equal normal forms.

    A hash of the normal form is counted with a partial aggregate and joined
    back, so that a text that very many rows share is one aggregate row.
    """
    hashed = rows.select(key, F.sha2(T.normalise(F.coalesce(text, F.lit(""))), 256).alias("content"))
    # A checkpoint, so that the join is between plain exchanges, whose hot partitions Spark splits.
    least = checkpointed(hashed.groupBy("content").agg(F.min(key).alias("representative"), F.count("*").alias("copies")))
    return hashed.join(least, "content").select(key, "representative", "copies")


def token_rows(rows: DataFrame, key: str, text: str) -> DataFrame:
    """``(key, token, size)``: hashes of the distinct tokens of each row and how many it has."""
    hashes = F.transform(F.array_distinct(T.tokens(F.col(text))), lambda t: F.xxhash64(t))
    sets = rows.select(key, hashes.alias("t")).filter(F.size("t") > 0)
    return sets.select(key, F.size("t").alias("size"), F.explode("t").alias("token"))


def jaccard_pairs(left: DataFrame, right: DataFrame | None, key: str, threshold: float, right_key: str | None = None) -> DataFrame:
    """All pairs of ``token_rows`` whose token sets have a Jaccard similarity of ``threshold`` at least.

    Prefix and positional filtering (Chaudhuri et al., 2006; Xiao et al., 2008):
    with tokens in order of rarity, two such sets share one of their first
    size - ceil(t * size) + 1 tokens, their sizes are within t of each other, and
    what follows their first shared token must hold the rest of the overlap.
    Candidates meet on those rare tokens as pairs of keys only; each set then
    joins its candidates once and the overlap is counted inside the row. With
    ``right`` None the pairs are of one table, smaller key first.
    """
    other = left if right is None else right
    right_key = right_key or key
    freq = (left if right is None else left.select("token").unionAll(right.select("token"))).groupBy("token").agg(F.count("*").alias("df"))

    def sets(rows: DataFrame, k: str) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct("df", "token")))
        return checkpointed(rows.join(freq, "token").groupBy(k, "size").agg(F.transform(ordered, lambda x: x["token"]).alias("tokens")))

    def prefix(rows: DataFrame, k: str, names: list[str]) -> DataFrame:
        first = F.slice("tokens", F.lit(1), (F.col("size") - F.ceil(F.lit(threshold) * F.col("size") - 1e-9) + 1).cast("int"))
        return rows.select(k, F.posexplode(first), "size").toDF(*names)

    x = sets(left, key)
    y = x if right is None else sets(other, right_key)
    a, b = prefix(x, key, ["a", "i", "token", "sa"]), prefix(y, right_key, ["b", "j", "token", "sb"])
    both = F.ceil(F.lit(threshold / (1 + threshold)) * (F.col("sa") + F.col("sb")) - 1e-9)
    fits = (F.least("sa", "sb") >= F.ceil(F.lit(threshold) * F.greatest("sa", "sb") - 1e-9)) & (F.least(F.col("sa") - F.col("i"), F.col("sb") - F.col("j")) >= both)
    if right is None:
        fits = fits & (F.col("a") < F.col("b"))
    candidates = a.join(b, "token").filter(fits).select("a", "b").distinct()
    met = candidates.join(x.select(F.col(key).alias("a"), F.col("tokens").alias("ta")), "a").join(y.select(F.col(right_key).alias("b"), F.col("tokens").alias("tb")), "b")
    shared = met.select("a", "b", F.size(F.array_intersect("ta", "tb")).alias("both"), (F.size("ta") + F.size("tb")).alias("sum"))
    similarity = F.col("both") / (F.col("sum") - F.col("both"))
    return shared.filter(similarity >= threshold - 1e-12).select("a", "b", F.round(similarity, 6).alias("similarity"))


#: Texts of one side of a tile that compares texts of like lengths.
TILE = 512
#: Partitions that tiles are dealt to.
TILE_PARTITIONS = 64
#: Lengths of the runs of characters that are counted for a pair's bound, and classes that each length's runs are counted in.
RUNS = ((3, 4096), (4, 8192))


def _runs(codes: list[np.ndarray], q: int, classes: int) -> np.ndarray:
    """(classes, texts): how many runs of ``q`` characters of each text fall in each class."""
    out = np.zeros((classes, len(codes)), np.int32)
    for k, c in enumerate(codes):
        if len(c) >= q:
            h = np.zeros(len(c) - q + 1, np.uint64)
            for s in range(q):
                h = h * np.uint64(0x9E3779B97F4A7C15) + c[s : len(c) - q + 1 + s]
            out[:, k] = np.bincount((h >> np.uint64(40)).astype(np.int64) % classes, minlength=classes)
    return out


def common_subsequences(codes: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the longest common subsequences of the texts numbered ``a`` and ``b``, pair by pair.

    A row of each pair's table is bits of 64-bit words (Hyyrö, 2004); all pairs take a step together.
    """
    order = np.argsort([-len(codes[k]) for k in b], kind="stable")
    a, b = a[order], b[order]
    own, place = np.unique(a, return_inverse=True)
    letters = np.unique(np.concatenate([codes[k] for k in own]))
    words = -(-max(len(codes[k]) for k in own) // 64)
    # The last letter is one that no own text holds.
    masks = np.zeros((words, len(own), len(letters) + 1), np.uint64)
    for n, k in enumerate(own):
        at = np.arange(len(codes[k]))
        np.bitwise_or.at(masks, (at // 64, n, np.searchsorted(letters, codes[k])), np.uint64(1) << (at % 64).astype(np.uint64))
    masks = masks.reshape(words, -1)
    met, spot = np.unique(b, return_inverse=True)
    steps = np.full((max(len(codes[k]) for k in met), len(met)), len(letters), np.int32)
    for n, k in enumerate(met):
        c = np.minimum(np.searchsorted(letters, codes[k]), len(letters) - 1)
        steps[: len(c), n] = np.where(letters[c] == codes[k], c, len(letters))
    sizes = np.array([len(codes[k]) for k in b])
    base = place * (len(letters) + 1)
    rows = np.full((words, len(a)), np.iinfo(np.uint64).max)
    for step in range(len(steps)):
        n = int(np.searchsorted(-sizes, -step))  # texts that are longer than step
        at = base[:n] + steps[step, spot[:n]]
        carry = np.zeros(n, np.uint64)
        for w in range(words):
            row = rows[w, :n]
            u = row & masks[w].take(at)
            one = row + u
            both = one + carry
            carry = ((one < u) | (both < one)).astype(np.uint64)
            np.bitwise_or(both, row ^ u, out=row)
    out = np.empty(len(a), np.int64)
    out[order] = 64 * words - np.bitwise_count(rows).sum(axis=0, dtype=np.int64)
    return out


#: Pairs of a tile whose common subsequences are found together.
TOGETHER = 8192


def _ratio_links(threshold: float):
    """A tile (home, band, own, key, comp, n) to links (a, b) of texts whose matching-blocks ratio is ``threshold`` at least, as they join its components.

    Only pairs that upper bounds allow are matched. With s characters in both
    texts, m = t * s / 2 of each match or more, so the counts of characters and the
    longest common subsequence reach m. Between two blocks lies a character that
    does not match, so there are (1 - t) * s + 1 blocks at most, each of which
    shares all its runs of q characters but q - 1.
    """

    def run(table: pa.Table) -> pa.Table:
        home, band, own, key, comp, text = (table.column(c).to_pylist() for c in ("home", "band", "own", "key", "comp", "n"))
        codes = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in text]
        size = np.array([len(t) for t in text])
        # Classes of characters and of their runs: the sum of the lesser counts bounds what can match.
        counts = np.array([np.bincount(c % 64, minlength=64) for c in codes], np.int32)
        runs = [(q, _runs([c.astype(np.uint64) for c in codes], q, classes)) for q, classes in RUNS]
        order, group = (np.unique(np.array(x), return_inverse=True)[1] for x in (key, comp))
        left, right = (np.flatnonzero(np.array(home) == side) for side in (True, False))
        # Pairs of one band are met once, from the smaller key.
        late = np.array(own)[right] != np.array(band)[right]
        root: dict = {}

        def find(x):
            while root.get(x, x) != x:
                x = root[x]
            return x

        links = []

        def match(i: np.ndarray, j: np.ndarray) -> None:
            apart = np.array([find(comp[x]) != find(comp[y]) for x, y in zip(i.tolist(), j.tolist(), strict=True)], bool)
            i, j = i[apart], j[apart]
            if len(i):
                near = 2 * common_subsequences(codes, i, j) >= threshold * (size[i] + size[j]) - 1e-9
                i, j = i[near], j[near]
            for x, y in zip(i.tolist(), j.tolist(), strict=True):
                p, q = find(comp[x]), find(comp[y])
                if p == q:
                    continue
                a, b = (x, y) if key[x] < key[y] else (y, x)
                if difflib.SequenceMatcher(None, text[a], text[b], autojunk=False).ratio() >= threshold:
                    root[q] = p
                    links.append((key[a], key[b]))

        held, n = [], 0
        for i in left.tolist():
            both = size[i] + size[right]
            fits = (2 * np.minimum(size[i], size[right]) >= threshold * both - 1e-9) & (late | (order[right] > order[i])) & (group[right] != group[i])
            near, both = right[fits], both[fits]
            fits = 2 * np.minimum(counts[i], counts[near]).sum(axis=1) >= threshold * both - 1e-9
            near, both = near[fits], both[fits]
            for q, of in runs:
                least = threshold * both / 2 - (q - 1) * ((1 - threshold) * both + 1)
                mine = np.flatnonzero(of[:, i])
                fits = np.minimum(of[mine[:, None], near], of[mine, i][:, None]).sum(axis=0) >= least - 1e-9
                near, both = near[fits], both[fits]
            held.append((np.full(len(near), i), near))
            n += len(near)
            if n >= TOGETHER:
                match(*(np.concatenate(x) for x in zip(*held, strict=True)))
                held, n = [], 0
        if n:
            match(*(np.concatenate(x) for x in zip(*held, strict=True)))
        return pa.table([pa.array([x[k] for x in links], table.schema.field("key").type) for k in (0, 1)], names=["a", "b"])

    return run


def ratio_links(texts: DataFrame, threshold: float) -> DataFrame:
    """``(a, b)``: links of ``texts(key, comp, n)`` by matching-blocks ratio, the smaller key first, that span what it joins.

    A ratio of t needs lengths within t / (2 - t) of each other. Lengths are
    dealt to bands of that width, so such texts are in one band or in
    neighbours; bands are compared in tiles, and only pairs of different
    components whose characters, runs of characters and common subsequence allow
    the ratio are matched.
    """
    narrow = threshold / (2 - threshold)
    if narrow <= 0:
        band = F.lit(0)
    elif narrow >= 1:
        band = F.length("n")
    else:
        band = F.floor(F.log(F.length("n")) / F.lit(-math.log(narrow) * (1 + 1e-9)))
    rows = checkpointed(texts.filter(F.length("n") > 0).withColumn("own", band.cast("long")))
    other = rows.withColumn("band", F.explode(F.array(F.col("own"), F.col("own") - 1)))
    tiles = other.groupBy("band").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles"))

    def placed(side: DataFrame, home: bool) -> DataFrame:
        mine, every = F.pmod(F.xxhash64("key"), F.col("tiles").cast("long")).cast("int"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
        side = side.join(tiles, "band").withColumn("mine", mine).withColumn("every", every)
        i, j = ("mine", "every") if home else ("every", "mine")
        return side.select("band", F.col(i).alias("i"), F.col(j).alias("j"), F.lit(home).alias("home"), "own", "key", "comp", "n")

    met = placed(rows.withColumn("band", F.col("own")), True).unionAll(placed(other, False))
    kind = texts.schema["key"].dataType.simpleString()
    # A tile is few bytes and much work: the number of partitions is given, so that Spark does not merge them by size.
    met = met.repartition(TILE_PARTITIONS, "band", "i", "j")
    return met.groupBy("band", "i", "j").applyInArrow(_ratio_links(threshold), f"a {kind}, b {kind}")


def near_duplicate_clusters(rows: DataFrame, key: str, text: str, threshold: float, ratio: bool = True) -> DataFrame:
    """``(key, cluster)`` of every row: the smallest key that chains of similar rows reach.

    Two rows are similar if the Jaccard similarity of their tokens or the
    matching-blocks ratio of their normal forms is ``threshold`` or more, rows in
    order of key; without ``ratio`` tokens alone count. Rows of equal normal form
    are one node, so pairs are sought between different texts only; rows without
    a token are equal to each other.
    """
    same = exact_duplicates(rows, key, text).select(key, "representative")
    reps = rows.join(same.filter(F.col(key) == F.col("representative")).select(key), key, "left_semi")
    pairs = jaccard_pairs(token_rows(reps, key, text), None, key, threshold).select("a", "b")
    groups = connected_components(pairs)
    if ratio:
        normal = reps.select(F.col(key).alias("key"), T.normalise(F.coalesce(text, F.lit(""))).alias("n"))
        texts = normal.join(groups, normal["key"] == groups["node"], "left").select("key", F.coalesce("component", "key").alias("comp"), "n")
        joins = groups.select(F.col("node").alias("a"), F.col("component").alias("b"))
        groups = connected_components(joins.unionAll(ratio_links(texts, threshold)))
    return same.join(groups, same["representative"] == groups["node"], "left").select(key, F.coalesce("component", "representative").alias("cluster"))


def clustered_split(clusters: DataFrame, key: str, validation: float = 0.1, test: float = 0.1, seed: str = "cluster-v1") -> DataFrame:
    """Split of each row by a hash of its cluster, so that a cluster never straddles splits."""
    u = T.unit_interval(F.concat(F.lit(seed + ":"), F.col("cluster").cast("string")))
    return clusters.select(key, "cluster", F.when(u < test, "test").when(u < test + validation, "validation").otherwise("train").alias("split"))


def shingles(rows: DataFrame, key: str, text: str, n: int = 5) -> DataFrame:
    """``(key, tokens)``: hashes of the distinct runs of ``n`` tokens; shorter texts have none."""
    hashes = F.transform(T.tokens(F.col(text)), lambda t: F.xxhash64(t))
    over = lambda h: F.transform(F.sequence(F.lit(0), F.size(h) - n), lambda i: F.xxhash64(*[h[i + k] for k in range(n)]))
    # The array of hashes is bound once, by a transform over one element.
    runs = F.transform(F.array(hashes), lambda h: F.when(F.size(h) >= n, over(h)).otherwise(F.array().cast("array<bigint>")))[0]
    return rows.select(key, F.array_distinct(runs).alias("tokens")).filter(F.size("tokens") > 0)


#: Rows of protected shingles up to which they go to every task.
BROADCAST_ROWS = 2_000_000


def max_shingle_overlap(rows: DataFrame, protected: DataFrame, key: str, protected_key: str, text: str) -> DataFrame:
    """For each row that shares a 5-token shingle with a protected text: the most similar one, ties to the smaller key.

    Only shingles that a protected text holds are shuffled: the others fall out in
    a broadcast join while the protected ones are few, else in a join of hashes.
    """
    own = checkpointed(shingles(protected, protected_key, text).select(F.col(protected_key).alias("b"), F.size("tokens").alias("sb"), F.explode("tokens").alias("token")))
    a = shingles(rows, key, text).select(F.col(key).alias("a"), F.size("tokens").alias("sa"), F.explode("tokens").alias("token"))
    both = a.join(F.broadcast(own) if own.count() <= BROADCAST_ROWS else own, "token").groupBy("a", "b", "sa", "sb").agg(F.count("*").alias("n"))
    scored = both.withColumn("similarity", F.round(F.col("n") / (F.col("sa") + F.col("sb") - F.col("n")), 6))
    best = F.max_by("b", F.struct("similarity", -F.col("b")))
    return scored.groupBy(F.col("a").alias(key)).agg(F.max("similarity").alias("similarity"), best.alias("matched"))


def governance_reasons(rows: DataFrame, purpose: str, now: Column, text: str) -> DataFrame:
    """``rows`` with the sorted reasons why each may not be used for a purpose; none means authorised."""
    empty = lambda c: F.coalesce(F.trim(c) == "", F.lit(True))
    missing = empty(F.col("owner")) | empty(F.col("legal_basis")) | empty(F.col("license")) | F.col("retention_expires_at").isNull() | (F.coalesce(F.size("allowed_purposes"), F.lit(0)) == 0)
    reasons = F.array(
        F.when(missing, "missing_governance_metadata"),
        F.when(~F.coalesce(F.array_contains("allowed_purposes", purpose), F.lit(False)), "purpose_not_authorized"),
        F.when((F.lower(F.trim("legal_basis")) == "consent") & empty(F.col("consent_id")), "consent_identifier_missing"),
        F.when(F.lower(F.trim(F.coalesce("license", F.lit("")))).isin("", "unknown", "none", "unlicensed"), "license_not_approved"),
        F.when(F.col("retention_expires_at").isNull(), "retention_invalid").when(F.col("retention_expires_at") <= now, "retention_expired"),
        F.when(F.size(T.personal_data(F.col(text))) > 0, "unredacted_personal_data"),
    )
    return rows.withColumn("reasons", F.array_sort(F.array_compact(reasons))).withColumn("authorized", F.size("reasons") == 0)


def curate(rows: DataFrame, minimum: float, roles: list[str], per_source: int, most: int, seed: str = "curation-v1", key: str = "row_id") -> DataFrame:
    """Selection by quality, hash and id under caps, with the reason of every row.

    The caps are the recipe's: per source by a window, over all by a distributed
    rank. Once the row cap is reached no source fills up any more, so a row behind
    it is ``source_cap`` only if its source has its share among the selected.
    """
    order = [F.desc("quality_score"), F.sha2(F.concat(F.lit(seed + ":"), F.col(key).cast("string")), 256), F.col(key)]
    base = F.when(F.col("quality_score") < minimum, "minimum_quality").when(~F.col("training_role").isin(*roles), "role_not_allowed")
    marked = rows.withColumn("reason", base)
    fit = marked.filter("reason is null").withColumn("nth", F.row_number().over(Window.partitionBy("source_id").orderBy(*order)))
    from runloom.operators.ranking import global_rank

    inside = global_rank(fit.filter(F.col("nth") <= per_source), "place", *order)
    chosen = inside.groupBy("source_id").agg(F.count_if(F.col("place") <= most).alias("taken"))
    inside = inside.withColumn("reason", F.when(F.col("place") <= most, "selected").otherwise("row_cap")).select(*rows.columns, "reason")
    over = fit.filter(F.col("nth") > per_source).join(chosen, "source_id", "left")
    over = over.withColumn("reason", F.when(F.coalesce("taken", F.lit(0)) >= per_source, "source_cap").otherwise("row_cap")).select(*rows.columns, "reason")
    return marked.filter("reason is not null").select(*rows.columns, "reason").unionByName(inside).unionByName(over)


def deletion_closure(versions: DataFrame, edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``(version, distance)``: versions affected directly (0) and all that derive from them, by fewest steps.

    ``versions`` has (version, direct); ``edges`` has (parent, child). Rounds of
    joins follow the frontier only; visited versions are left out, so cycles end.
    """
    seen = checkpointed(versions.filter("direct").select("version", F.lit(0).alias("distance")).distinct())
    frontier = seen
    for step in range(1, max_rounds):
        nxt = frontier.join(edges, frontier["version"] == edges["parent"]).select(F.col("child").alias("version")).distinct().join(seen.select("version"), "version", "left_anti")
        frontier = checkpointed(nxt.withColumn("distance", F.lit(step)))
        if frontier.isEmpty():
            return seen
        seen = checkpointed(seen.unionAll(frontier))
    raise RuntimeError("lineage is deeper than max_rounds")


def deletion_plan(rows: DataFrame, closure: DataFrame, subjects: list[str]) -> DataFrame:
    """Rows to delete: those of a subject, and all rows of versions that derive from an affected one."""
    hit = F.arrays_overlap("deletion_subject_ids", F.array(*[F.lit(s) for s in subjects]))
    both = rows.join(closure, "version", "left")
    reason = F.when(hit, "subject").when(F.col("distance") > 0, "derived")
    return both.select(*rows.columns, F.coalesce("distance", F.lit(-1)).alias("distance"), reason.alias("deletion_reason")).filter("deletion_reason is not null")


def source_partition(families: DataFrame, group: str, family: str, size: str, target: int, seed: str = "partition-v1") -> DataFrame:
    """Families in hash order go to development until the target is met, but never all of a group."""
    order = [F.sha2(F.concat(F.lit(seed + ":"), F.col(family).cast("string")), 256), F.col(family)]
    w = Window.partitionBy(group)
    running = F.sum(size).over(w.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - F.col(size)
    last = F.row_number().over(w.orderBy(*order)) == F.count("*").over(w)
    return families.withColumn("partition", F.when((running < target) & ~last, "dev").otherwise("train"))


def contamination_report(rows: DataFrame, key: str, text: str, split: str, threshold: float = 0.9) -> DataFrame:
    """``(cluster, rows, texts, splits, exact_duplicate, cross_split)``: clusters of similar rows, and those that straddle splits."""
    clusters = near_duplicate_clusters(rows, key, text, threshold)
    named = rows.select(key, split, F.sha2(T.normalise(F.coalesce(text, F.lit(""))), 256).alias("__text")).join(clusters, key)
    filled = F.when(F.coalesce(F.col(split), F.lit("")) != "", F.col(split))
    sums = named.groupBy("cluster").agg(F.count("*").alias("rows"), F.count_distinct("__text").alias("texts"), F.count_distinct(filled).alias("splits"))
    return sums.select("cluster", "rows", "texts", "splits", ((F.col("texts") == 1) & (F.col("rows") > 1)).alias("exact_duplicate"), (F.col("splits") > 1).alias("cross_split"))


def quarantine(models: DataFrame, closure: DataFrame) -> DataFrame:
    """``(model, versions)``: models that were trained on an affected version, with how many; ``models`` is (model, version)."""
    return models.distinct().join(closure.select("version"), "version", "left_semi").groupBy("model").agg(F.count("*").alias("versions"))


def lineage_levels(versions: DataFrame, edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """``(version, level)``: the longest way from a version without parents; an order by (level, version) is topological.

    ``edges`` is (parent, child); parents that are no version are left out.
    Versions leave in rounds, once none of their parents is left; raises if some
    never do, as a lineage must have no cycle.
    """
    known = edges.join(versions.select(F.col("version").alias("parent")), "parent", "left_semi").join(versions.select(F.col("version").alias("child")), "child", "left_semi").distinct()
    left, known = checkpointed(versions.select("version").distinct()), checkpointed(known)
    out = None
    for level in range(max_rounds):
        if left.isEmpty():
            return out if out is not None else left.select("version", F.lit(0).alias("level"))
        ready = checkpointed(left.join(known.select(F.col("child").alias("version")), "version", "left_anti"))
        if ready.isEmpty():
            raise ValueError("the lineage has a cycle")
        named = ready.select("version", F.lit(level).alias("level"))
        out = checkpointed(named if out is None else out.unionAll(named))
        left = checkpointed(left.join(ready, "version", "left_anti"))
        known = checkpointed(known.join(ready.select(F.col("version").alias("parent")), "parent", "left_anti"))
    raise RuntimeError("lineage is deeper than max_rounds")
