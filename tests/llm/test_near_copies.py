"""Near copies of the pipeline against comparing all pairs."""

from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from riskspark.llm import near_copies

SCHEMA = "doc_id bigint, text string, lang string, n_chars bigint"


def jaccard(one, two, width=5):
    sets = []
    for text in (one, two):
        words = (text or "").encode().lower().split()
        sets.append({b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set())
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1]) if sets[0] | sets[1] else 1.0


def first_of_components(rows, share=0.8):
    above = list(range(len(rows)))

    def root(i):
        while above[i] != i:
            i = above[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if jaccard(rows[i][1], rows[j][1]) >= share:
            low, high = sorted((root(i), root(j)))
            above[high] = low
    return {rows[i][0] for i in range(len(rows)) if root(i) == i}


def edited(words, edits, rng):
    words = list(words)
    for at in rng.choice(len(words), edits, replace=False):
        words[at] = f"new{rng.integers(1 << 30)}"
    return " ".join(words)


def test_near_copies_equal_comparing_all_pairs(spark, small):
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(25):
        base = [f"w{n}" for n in rng.integers(0, 5000, 200)]
        rows += [" ".join(base).upper(), *(edited(base, edits, rng) for edits in (1, 2, 3, 4, 5, 6, 8, 12))]
    rows += ["", None, " \n", "one two", "ONE  two", "one two three"]
    rows = list(enumerate(rows))
    pairs = sum(0.8 <= jaccard(a, b) < 1 for (_, a), (_, b) in combinations(rows, 2))
    assert pairs > 100
    docs = spark.createDataFrame([(i, t, "en", 1) for i, t in rows], SCHEMA)
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, small)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(first_of_components(rows))
    again = docs.unionByName(docs).unionByName(docs.withColumn("doc_id", F.lit(None).cast("bigint")))
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, again, small).collect()) == sorted(first_of_components(rows))
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), small).count() == 0


def kept_and_compared(spark, rows, monkeypatch):
    compared = []
    judge = near_copies.similar

    def counted(pairs, texts, share):
        compared.append(pairs.count())
        return judge(pairs, texts, share)

    monkeypatch.setattr(near_copies, "similar", counted)
    docs = spark.createDataFrame([(i, t, "en", 1) for i, t in enumerate(rows)], SCHEMA)
    kept = sorted(r["doc_id"] for r in near_copies.one_per_group(docs).collect())
    monkeypatch.undo()
    return kept, sum(compared)


def test_texts_that_share_a_base_without_being_near_copies_are_not_all_compared(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base = [f"w{n}" for n in rng.integers(0, 5000, 200)]
    pairs = {}
    for size in (150, 300):
        rows = [edited(base, 9, rng) for _ in range(size)]
        kept, pairs[size] = kept_and_compared(spark, rows, monkeypatch)
        assert kept == list(range(size))
    assert pairs[300] <= 3 * max(pairs[150], 10)


def test_groups_with_and_without_their_base(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = []
    for base_kept in (True, False):
        base = [f"w{n}" for n in rng.integers(0, 5000, 150)]
        rows += [" ".join(base)] * base_kept
        rows += [edited(base, int(edits), rng) for edits in rng.integers(1, 9, 60)]
        rows += [" ".join(base[: int(cut)]) for cut in rng.integers(90, 150, 12)]
        rows += [edited(base[30:], 2, rng), edited(base + base[:40], 2, rng)]
    half = [f"h{n}" for n in rng.integers(0, 5000, 100)]
    rows += [" ".join(half + base[:60]), edited(half + base[:60], 1, rng), edited(half + base[:50], 2, rng)]
    rows = [rows[i] for i in rng.permutation(len(rows))]
    kept, compared = kept_and_compared(spark, rows, monkeypatch)
    assert kept == sorted(first_of_components(list(enumerate(rows))))
    assert compared < len(rows) ** 2 / 20


def test_very_long_texts_and_clashing_columns(spark):
    rng = np.random.default_rng(6)
    words = [f"w{n}" for n in rng.integers(0, 100_000, 60_000)]
    rows = [(1, " ".join(words)), (2, edited(words, 300, rng)), (3, edited(words, 6000, rng)), (4, "short"), (4, "short")]
    docs = spark.createDataFrame([(i, t, "r", "k", "x", 1, "b") for i, t in rows], "doc_id bigint, text string, root string, text_key string, row string, size int, bucket string")
    kept = near_copies.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["root"], r["size"]) for r in kept.collect()) == [(1, "r", 1), (3, "r", 1), (4, "r", 1)]


def printed(rng, count, share):
    """Fingerprints of `count` pairs that differ in about `share` of the bits, as an array of lanes by row; pairs are neighbours."""
    bits = rng.integers(0, 2, (count, 64 * near_copies.LANES))
    rows = np.stack([bits, bits ^ (rng.random(bits.shape) < share)], axis=1).reshape(2 * count, -1)
    return np.packbits(rows.astype(np.uint8), axis=1, bitorder="little").view(np.uint64)


def test_the_stage_gets_its_candidates_from_the_trie_of_simhash_fingerprints(spark, small, monkeypatch):
    words = [f"w{n}" for n in range(200)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:190])), (3, "another text")]
    docs = spark.createDataFrame([(i, t, "en", 1) for i, t in rows], SCHEMA)
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, small).collect()) == [1, 3]
    monkeypatch.setattr(near_copies, "links", lambda nodes: nodes.selectExpr("node AS a", "node AS b").limit(0))
    assert sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, small).collect()) == [1, 2, 3]


def test_trie_join_links_what_comparing_all_fingerprints_links(monkeypatch):
    monkeypatch.setattr(near_copies, "LEAF", 8)
    rng = np.random.default_rng(7)
    prints = printed(rng, 400, 0.15)
    pairs = {(2 * i, 2 * i + 1) for i in range(400)}
    for cut in (800, 500):
        side = rng.permutation(800)
        order = np.concatenate([part[np.argsort(prints[part, 0])] for part in (side[:cut], side[cut:])])
        member, least = near_copies.trie_links([np.ascontiguousarray(prints[order, lane]) for lane in range(near_copies.LANES)], cut)
        found = {tuple(sorted((int(order[a]), int(order[b])))) for a, b in zip(member, least, strict=True)}
        left = set(order[:cut].tolist())
        assert found == {p for p in pairs if cut == 800 or len(left & set(p)) == 1}


def test_every_two_sizes_near_enough_meet_in_one_cell(spark, monkeypatch):
    monkeypatch.setattr(near_copies, "PART", 3)
    sizes = [0, 0, 1, 4, 5, 6, *range(8, 40), 100, 125, 126, 80, 64, 1000] * 2
    nodes = spark.createDataFrame([(i, size, *[i] * near_copies.LANES) for i, size in enumerate(sizes)], ", ".join(f"{c} bigint" for c in ("node", "size", *near_copies.WORDS)))
    cells = {}
    for r in near_copies.dealt(nodes).collect():
        cells.setdefault((r["step"], r["above"], r["i"], r["j"]), []).append((r["node"], r["right"]))
    met = {}
    for (_, above, i, j), members in cells.items():
        for (a, one), (b, two) in combinations(members, 2):
            if one != two or not above and i == j:
                met[frozenset((a, b))] = met.get(frozenset((a, b)), 0) + 1
    assert set(met.values()) == {1} and any(i != j for _, _, i, j in cells)
    for a, b in combinations(range(len(sizes)), 2):
        low, high = sorted((sizes[a], sizes[b]))
        assert low < 0.8 * high or frozenset((a, b)) in met


def test_similar_sets_are_within_the_budget_of_every_depth():
    rng = np.random.default_rng(8)
    for size in (5, 9, 12, 40, 200, 2000):
        for _ in range(60):
            both = rng.integers(0, 1 << 63, size, np.uint64)
            more = np.append(both, rng.integers(0, 1 << 63, size // 4, np.uint64))
            one, two = (near_copies.fingerprint(np.unique(s)).view(np.uint64) for s in (both, more))
            ones = np.bitwise_count(one ^ two).astype(int)
            assert ones[:2].sum() <= near_copies.BUDGETS[128] and ones.sum() <= near_copies.BUDGETS[256]
