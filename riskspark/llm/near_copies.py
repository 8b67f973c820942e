"""Near copies: texts whose sets of word shingles have a Jaccard similarity of `share` or more, and all linked through such pairs.

Candidates come from SimHash fingerprints of LANES x 64 bits and their binary trie joined with itself. Texts whose distinct shingles
have Jaccard 0.8 differ in about 15 % of the bits, unrelated ones in half of them. The trie is walked in pairs of nodes; differing bits
add up, and a pair of nodes above the budget of its depth is dropped with all below it. Nodes of up to LEAF members are walked by
whole lanes, all their pairs at once. The budget of a depth is the least number of bits that a pair at 0.8 exceeds with chance
MISS at most; BORDER is the greatest share of bits that such a pair is expected to differ in (sets of 4 and 5 shingles; long
texts: 0.152). 64 bits would not do: 0.8 is up to about 14 of them on the given texts, and a budget that misses none lets over 5 % of
all pairs pass.
The trie is dealt out by sizes, since sizes of similar sets differ by a quarter at most, and a size by parts of PART members. Pairs
left out by sizes cost nothing, every other pair of distinct fingerprints a few nanoseconds in a task and no row. A task reports one
link per fingerprint and component it sees; the components are the buckets of candidates. Every pair is compared by its
shingles (64-bit hashes) before it counts, so nothing less similar is linked.

Buckets are compared in two passes, so no pass makes all pairs of a bucket.

1. Every member is compared with the star of its bucket, the member with the fewest shingles of its own (that no other text
   has). Texts with more than 1 - `share` of their shingles to themselves can have no partner and take no part at all.
2. Let x be a member that is not similar to its star s, sharing a shingles with it. A text y shares at most a shingles of s with
   x. So y is similar to x only if both share shingles that s lacks, or if y is small: |y| <= a (1 + share) / share - |x|. Members
   of one star are therefore joined on the shingles the star lacks (rarest first, as far as the rest of the list could still
   reach the wanted overlap) and on their size within that bound. Pairs whose ends are in one component are left out.

A large group of near copies costs one comparison a member, a group around one base that differs too much from it costs none.
What stays quadratic is a group in which all texts share shingles that its star lacks and yet stay just below `share`.
Only the shingles of texts that meet another one travel. Work is on distinct texts.

Nulls and ties: texts without words are near copies of each other; shorter texts than `width` words are one shingle.
Words are cut at ASCII white space, A-Z lower-cased. Repeated rows share a root. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.simhash import components, first_of_each, merge, root
from riskspark.llm.words import BASE, mixed, ragged, utf8
from riskspark.session import stored

SEED = 42
LANES = 4
LEAF = 512
PART = 65_536
BORDER, MISS = 0.1875, 1e-6
#: Sizes of one step differ by less than a quarter; the excess keeps rounding from parting neighbours by two steps.
STEP = math.log(1.25) + 1e-9


def budget(depth: int) -> int:
    """The least number of differing bits that a pair at the border exceeds with chance MISS at most, of `depth` bits."""
    chance, within = 1.0, -1
    while chance > MISS:
        within += 1
        chance -= math.comb(depth, within) * BORDER**within * (1 - BORDER) ** (depth - within)
    return within


BUDGETS = [budget(depth) for depth in range(64 * LANES + 1)]
#: Odd multipliers, one per lane.
FACTORS = np.array([pow(BASE, lane, 1 << 64) for lane in range(LANES)], np.uint64)
WORDS = [f"w{lane}" for lane in range(LANES)]


def shingles(text: bytes, width: int) -> np.ndarray:
    """Sorted distinct XXH64 values of the word shingles."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(joined, SEED)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)[: len(words) - width + 1]
    return np.unique(np.array([digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends[width - 1 :].tolist(), strict=True)], np.uint64))


def fingerprint(values: np.ndarray) -> np.ndarray:
    """SimHash of a set of 64-bit values, one number per lane: the bits set in over half of the values, mixed anew for each lane."""
    counts = np.zeros(64 * LANES, np.int64)
    for at in range(0, len(values), 255):  # counts of a byte
        lanes = mixed(values[at : at + 255, None] * FACTORS)
        counts += np.unpackbits(lanes.view(np.uint8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint8)
    return np.packbits(counts * 2 > len(values), bitorder="little").view(np.int64)


def sketches(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, text_key, size (number of shingles) and the lanes of the fingerprint of every row."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints = [], np.zeros((batch.num_rows, LANES), np.int64)
            for place, text in enumerate(utf8(batch.column("text"))):
                own = shingles(text, width)
                sizes.append(len(own))
                prints[place] = fingerprint(own)
            lanes = [pa.array(np.ascontiguousarray(prints[:, lane])) for lane in range(LANES)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), pa.array(sizes, pa.int64()), *lanes], names=["doc_id", "text_key", "size", *WORDS]
            )

    return with_keys(docs).mapInArrow(of, f"doc_id bigint, text_key bigint, size bigint, {', '.join(f'{w} bigint' for w in WORDS)}")


def dealt(nodes: DataFrame) -> DataFrame:
    """`nodes` (node, size, lanes) dealt to cells (step, above, i, j), and whether they are on the right side of their cell.

    A cell holds part i and part j of one step of sizes, or part i of a step and part j of the step above it. Every two nodes whose
    sizes can be those of similar sets meet in one cell, no cell has more than about twice PART nodes.
    """
    placed = nodes.withColumn("step", F.coalesce(F.floor(F.log(F.nullif("size", F.lit(0))) / F.lit(STEP)), F.lit(-1)).cast("int"))
    parts = placed.groupBy("step").agg(F.ceil(F.count("*") / F.lit(PART)).cast("int").alias("parts"))
    for shift, name in ((0, "parts"), (-1, "higher"), (1, "lower")):
        placed = placed.join(F.broadcast(parts.select((F.col("step") + shift).alias("step"), F.col("parts").alias(name))), "step", "left")
    placed = placed.withColumn("part", F.pmod(F.hash("node"), "parts"))

    def cells(count: str, of) -> Column:
        return F.transform(F.when(F.col(count) > 0, F.sequence(F.lit(0), F.col(count) - 1)).otherwise(F.array().cast("array<int>")), of)

    def cell(step: Column, above: bool, i: Column, j: Column, right: Column) -> Column:
        return F.struct(step.alias("step"), F.lit(above).alias("above"), i.alias("i"), j.alias("j"), right.alias("right"))

    step, part = F.col("step"), F.col("part")
    within = cells("parts", lambda q: cell(step, False, F.least(part, q), F.greatest(part, q), part > q))
    below = cells("higher", lambda q: cell(step, True, part, q, F.lit(False)))
    beyond = cells("lower", lambda q: cell(step - 1, True, q, part, F.lit(True)))
    return placed.select(F.explode(F.concat(within, below, beyond)).alias("cell"), "node", *WORDS).select("cell.*", "node", *WORDS)


def compare(parent: np.ndarray, lanes: list[np.ndarray], a: int, a_end: int, b: int, b_end: int) -> None:
    """Walks two small nodes by whole lanes and joins the components of their members within the last budget."""
    counts = [np.bitwise_count(lane[a:a_end, None] ^ lane[b:b_end]) for lane in lanes[:2]]
    one, two = np.nonzero(counts[0] + counts[1] <= BUDGETS[128])
    apart = root(parent, np.arange(a, a_end))[one] != root(parent, np.arange(b, b_end))[two]
    one, two = one[apart] + a, two[apart] + b
    total = sum(np.bitwise_count(lane[one] ^ lane[two]).astype(np.int64) for lane in lanes)
    near = total <= BUDGETS[-1]
    merge(parent, one[near], two[near])


def trie_links(lanes: list[np.ndarray], cut: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, least member) of components by place. Each of lanes[0][:cut] and lanes[0][cut:] is sorted; the two are joined, or the
    first with itself if there is no second. A node of the trie is a range of places."""
    size = len(lanes[0])
    parent = np.arange(size)
    ones: dict[int, np.ndarray] = {}

    def halved(depth: int, start: int, end: int) -> int:
        if depth not in ones:
            ones[depth] = np.append(0, np.cumsum((lanes[0] >> np.uint64(63 - depth)) & np.uint64(1), dtype=np.int64))
        return end - int(ones[depth][end] - ones[depth][start])

    stack = [(0, 0, cut, cut, size, 0) if cut < size else (0, 0, size, 0, size, 0)]
    while stack:
        depth, a, a_end, b, b_end, spent = stack.pop()
        if a == a_end or b == b_end or spent > BUDGETS[depth]:
            continue
        if depth == 64 or max(a_end - a, b_end - b) <= LEAF:
            for x in range(a, a_end, LEAF):
                for y in range(b, b_end, LEAF):
                    compare(parent, lanes, x, min(x + LEAF, a_end), y, min(y + LEAF, b_end))
            continue
        a_cut, b_cut = halved(depth, a, a_end), halved(depth, b, b_end)
        stack += [(depth + 1, a, a_cut, b, b_cut, spent), (depth + 1, a_cut, a_end, b_cut, b_end, spent), (depth + 1, a, a_cut, b_cut, b_end, spent + 1)]
        if a != b:
            stack.append((depth + 1, a_cut, a_end, b, b_cut, spent + 1))
    roots = root(parent, np.arange(size))
    linked = np.flatnonzero(roots != np.arange(size))
    return linked, roots[linked]


def links(nodes: DataFrame) -> DataFrame:
    """Links (a, b), a > b, that connect all nodes (node, size, lanes) within the budgets of the trie whose sizes are near enough."""

    def join(table: pa.Table) -> pa.Table:
        right = table.column("right").to_numpy()
        lanes = [table.column(word).to_numpy().view(np.uint64) for word in WORDS]
        order = np.lexsort((lanes[0], right))
        cut = len(right) - int(right.sum())
        names = table.column("node").to_numpy()[order]
        two_sides = table.column("above")[0].as_py() or table.column("i")[0].as_py() != table.column("j")[0].as_py()
        member, least = trie_links([lane[order] for lane in lanes], cut) if not two_sides or 0 < cut < len(right) else (order[:0], order[:0])
        return pa.table({"a": np.maximum(names[member], names[least]), "b": np.minimum(names[member], names[least])})

    return dealt(nodes).groupBy("step", "above", "i", "j").applyInArrow(join, "a bigint, b bigint").distinct()


def with_keys(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("bigint"), text.alias("text"), F.xxhash64(text).alias("text_key"))


def shingle_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """text_key and shingles of the texts in `wanted` (text_key, distinct)."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = ragged([shingles(text, width).view(np.int64) for text in utf8(batch.column("text"))], np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("text_key"), sets], names=["text_key", "shingles"])

    texts = with_keys(docs).select("text", "text_key").join(wanted, "text_key", "left_semi").dropDuplicates(["text_key"])
    return texts.mapInArrow(of, "text_key bigint, shingles array<bigint>")


def common_shingles(sets: DataFrame) -> DataFrame:
    """text_key, size (number of shingles) and tokens (those that another text has too, rarest first) of every text."""
    posts = sets.select("text_key", F.explode("shingles").alias("token"))
    often = posts.groupBy("token").agg(F.count("*").alias("n")).filter("n > 1")
    placed = posts.join(often, "token").groupBy("text_key").agg(F.sort_array(F.collect_list(F.struct("n", "token"))).alias("placed"))
    sized = sets.select("text_key", F.size("shingles").alias("size")).join(placed, "text_key", "left")
    return sized.select("text_key", "size", F.coalesce(F.col("placed.token"), F.array().cast("array<bigint>")).alias("tokens"))


def named(texts: DataFrame, key: str, size: str, tokens: str) -> DataFrame:
    return texts.select(F.col("text_key").alias(key), F.col("size").alias(size), F.col("tokens").alias(tokens))


def enough(common: Column, share: float, one: str, two: str) -> Column:
    """Whether sets of these sizes with so many common members have a Jaccard similarity of `share` or more."""
    return common >= F.lit(share / (1 + share)) * (F.col(one) + F.col(two)) - F.lit(1e-9)


def faced(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Each text x of `members` (bucket, text_key) beside the stars of its buckets: x, star, their sizes, n (common shingles)
    and rest (tokens of x that the star lacks)."""
    own = members.join(texts.select("text_key", (F.col("size") - F.size("tokens")).alias("own")), "text_key")
    first = own.groupBy("bucket").agg(F.min(F.struct("own", "text_key")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    ends = own.join(first.select("bucket", F.col("first.text_key").alias("star")), "bucket").filter("text_key <> star")
    ends = ends.select(F.col("text_key").alias("x"), "star").distinct()
    both = ends.join(named(texts, "x", "x_size", "x_tokens"), "x").join(named(texts, "star", "star_size", "star_tokens"), "star")
    n, rest = F.size(F.array_intersect("x_tokens", "star_tokens")), F.array_except("x_tokens", "star_tokens")
    return both.select("x", "star", "x_size", "star_size", n.alias("n"), rest.alias("rest"))


def beside_stars(stars: DataFrame, roots: DataFrame, share: float) -> DataFrame:
    """Pairs (a, b) of texts of one star in different components that can be similar although one is not similar to the star."""
    stars = stars.join(roots.select(F.col("node").alias("x"), "root"), "x", "left").withColumn("root", F.coalesce("root", "x"))
    apart = stars.filter(~enough(F.col("n"), share, "x_size", "star_size"))

    def side(rows: DataFrame, name: str, *more: Column) -> DataFrame:
        return rows.select("star", F.col("x").alias(name), F.col("x_size").alias(f"{name}_size"), F.col("n").alias(f"{name}_n"), F.col("root").alias(f"{name}_root"), *more)

    def posts(rows: DataFrame, name: str) -> DataFrame:
        left = side(rows, name, F.size("rest").alias("all"), F.posexplode("rest").alias("place", "token"))
        left = left.withColumn(f"{name}_left", F.col("all") - F.col("place")).drop("all", "place")
        # What is left no longer reaches the overlap with the smallest partner: `fits` and `reach` would fail.
        return left.filter(F.col(f"{name}_n") + F.col(f"{name}_left") >= F.lit(share) * F.col(f"{name}_size") - F.lit(1e-9))

    inside = F.least("x_n", "y_n")
    fits = (F.col("x_root") != F.col("y_root")) & (F.least("x_size", "y_size") >= F.lit(share) * F.greatest("x_size", "y_size") - F.lit(1e-9))
    reach = enough(inside + F.least("x_left", "y_left"), share, "x_size", "y_size")
    by_token = posts(apart, "x").join(posts(stars, "y"), ["star", "token"]).filter(fits & reach).select("x", "y")

    low = F.ceil(F.lit(share) * F.col("x_size") - F.lit(1e-9))
    high = F.floor(F.col("x_n") * F.lit((1 + share) / share) - F.col("x_size") + F.lit(1e-9))
    small = side(apart, "x").filter(low <= high).withColumn("size", F.explode(F.sequence(low, high)))
    others = side(stars, "y").withColumn("size", F.col("y_size").cast("bigint"))
    by_size = small.join(others, ["star", "size"]).filter(fits & enough(inside, share, "x_size", "y_size")).select("x", "y")
    return by_token.unionByName(by_size).select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct()


def similar(pairs: DataFrame, texts: DataFrame, share: float) -> DataFrame:
    """Those of `pairs` (a, b) whose sets of shingles are similar."""
    both = pairs.join(named(texts, "a", "a_size", "a_tokens"), "a").join(named(texts, "b", "b_size", "b_tokens"), "b")
    return both.filter(enough(F.size(F.array_intersect("a_tokens", "b_tokens")), share, "a_size", "b_size")).select("a", "b")


def near_copies(docs: DataFrame, width: int = 5, share: float = 0.8) -> DataFrame:
    """doc_id, text_key and root (a number that linked rows share) of every row."""
    rows = stored(sketches(docs, width))
    own = rows.dropDuplicates(["text_key"]).withColumn("node", F.xxhash64("size", *WORDS))
    nodes = stored(own.dropDuplicates(["node"]).select("node", "size", *WORDS))
    near = components(links(nodes)).withColumnRenamed("root", "bucket")
    placed = stored(own.select("text_key", "node").join(near, "node", "left").select("text_key", F.coalesce("bucket", "node").alias("bucket")))
    shared = placed.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket")
    members = stored(placed.join(shared, "bucket", "left_semi"))
    sets = stored(shingle_sets(docs, members.select("text_key").distinct(), width))
    texts = stored(common_shingles(sets).filter(F.size("tokens") >= F.lit(share) * F.col("size") - F.lit(1e-9)))

    stars = stored(faced(members, texts))
    edges = stars.filter(enough(F.col("n"), share, "x_size", "star_size"))
    edges = stored(edges.select(F.greatest("x", "star").alias("a"), F.least("x", "star").alias("b")).distinct())
    roots = components(edges)

    more = stored(similar(beside_stars(stars, roots, share), texts, share))
    if not more.isEmpty():
        roots = components(edges.unionByName(more))
    found = rows.join(roots, rows.text_key == roots.node, "left")
    return found.select("doc_id", "text_key", F.coalesce("root", "text_key").alias("root"))


def one_per_group(docs: DataFrame, width: int = 5, share: float = 0.8) -> DataFrame:
    """`docs`, all columns, with one row of each group: the one with the smallest doc_id, of equals the smallest text_key.

    A null doc_id is larger than any other.
    """
    return first_of_each(docs, near_copies(docs, width, share))
