"""SimHash near-duplicates: fingerprints, and their links from a binary trie joined with itself.

A fingerprint bit is 1 if it is set in over half of the XXH64 values of a text's word shingles. Fingerprints link at
`budget` or fewer differing bits. Work is on distinct fingerprints, so copies cost nothing after the first shuffle.

The trie is dealt out by blocks: 64 bits are cut into budget + 1 blocks, and two linked fingerprints agree in at least
one, so every fingerprint goes to one group per block. A group with more than `most` members is cut again by blocks
of the bits that are still free. Within a group the trie of the sorted fingerprints is traversed in
pairs of nodes, level by level: differing bits add up, and a pair above the budget is dropped with all below it. Each
task reports one link per fingerprint and component it sees, which keeps everything reachable. Components then join by
alternating large-star and small-star rounds in Spark.

Nulls and ties: null and empty texts have fingerprint zero. A null doc_id is a member but never names a component,
unless all its members have none (component_id is null then). Repeated rows are kept and share a component. Further
columns of the input are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.words import utf8
from riskspark.session import stored

SEED = 42
BITS = 64
#: Bit k of every byte value, for counting set bits by byte values.
BYTE_BITS = (np.arange(256)[:, None] >> np.arange(8)) & 1


def fingerprint(words: list[bytes], width: int) -> int:
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.append(0, ends[:-1] + 1)[: len(words) - width + 1]
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends[width - 1 :].tolist(), strict=True)]
    # Number of values by byte place and byte value, then of set bits by bit.
    as_bytes = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    counts = np.bincount((as_bytes + np.arange(8) * 256).ravel(), minlength=2048).reshape(8, 256)
    bits = (counts @ BYTE_BITS).ravel() * 2 > len(hashes)
    return int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little", signed=True)


def fingerprints(docs: DataFrame, width: int = 5) -> DataFrame:
    """doc_id, text_key (hash of the text) and fingerprint (bigint) of every row; words are cut at ASCII white space, A-Z lower-cased."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text.lower().split(), width) for text in utf8(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(found, pa.int64())], names=["doc_id", "text_key", "fingerprint"])

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), F.xxhash64(F.col("text").cast("string")).alias("text_key"))
    return texts.mapInArrow(of, "doc_id bigint, text_key bigint, fingerprint bigint")


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def finer(mask: int, budget: int) -> list[int]:
    """`mask` with each of budget + 1 blocks of its free bits added; at most as many as there are free bits."""
    free = [bit for bit in range(BITS) if not mask >> bit & 1]
    blocks = [part for part in np.array_split(free, budget + 1) if len(part)]
    return [mask | sum(1 << int(bit) for bit in part) for part in blocks]


def children(level: list[int], budget: int):
    """Column of the finer masks of column `mask`, whose values are those of `level`."""
    pairs = []
    for mask in level:
        pairs += [F.lit(signed(mask)), F.array(*[F.lit(signed(m)) for m in finer(mask, budget)])]
    return F.element_at(F.create_map(*pairs), F.col("mask"))


def groups(nodes: DataFrame, budget: int, most: int, levels: int = 3) -> DataFrame:
    """(mask, key, fingerprint): groups of fingerprints that agree in the bits of mask, cut until none has over `most` members.

    After `levels` cuts about half of the bits agree (31 of 64 for budget 4); such a group is left whole, 24 bytes a member.
    """
    level = [0]
    done, wide = None, nodes.select(F.lit(0).cast("bigint").alias("mask"), "fingerprint")
    for cut in range(levels):
        wide = wide.select(F.explode(children(level, budget)).alias("mask"), "fingerprint")
        level = sorted({m for parent in level for m in finer(parent, budget)})
        wide = wide.withColumn("key", F.col("fingerprint").bitwiseAND(F.col("mask")))
        large = None
        if cut < levels - 1:
            large = stored(wide.groupBy("mask", "key").count().filter(F.col("count") > most).select("mask", "key"))
        if large is None or large.isEmpty():
            return wide if done is None else done.unionByName(wide)
        small = wide.join(large, ["mask", "key"], "left_anti")
        done = small if done is None else done.unionByName(small)
        wide = wide.join(large, ["mask", "key"], "left_semi").select("mask", "fingerprint")


def trie_links(prints: np.ndarray, heads: np.ndarray, budget: int, frontier: int = 1 << 19) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups of sorted unsigned fingerprints; heads: start of each group, and the end.

    A node is a range of the sorted array. One link per member and component is returned, by array place: (member, least member).
    """
    parent = np.arange(len(prints))
    ones = {}

    def before(level: int) -> np.ndarray:
        if level not in ones:
            bits = (prints >> np.uint64(level)) & np.uint64(1)
            ones[level] = np.append(0, np.cumsum(bits.astype(np.int64)))
        return ones[level]

    start, end = heads[:-1], heads[1:]
    stack = [(BITS - 1, np.stack([start, end, start, end, np.zeros_like(start)]))]
    while stack:
        level, pairs = stack.pop()
        if pairs.shape[1] > frontier:
            half = pairs.shape[1] // 2
            stack += [(level, pairs[:, :half]), (level, pairs[:, half:])]
            continue
        a, a_end, b, b_end, _ = pairs
        size = (a_end - a) * (b_end - b)
        few = (size <= 16) | (level < 0)
        unite(parent, prints, pairs[:, few], budget)
        pairs = pairs[:, ~few]
        if not pairs.shape[1]:
            continue
        a, a_end, b, b_end, spent = pairs
        count = before(level)
        a_cut, b_cut = a_end - (count[a_end] - count[a]), b_end - (count[b_end] - count[b])
        same = a == b
        nodes = [
            np.stack([a, a_cut, b, b_cut, spent]),
            np.stack([a_cut, a_end, b_cut, b_end, spent]),
            np.stack([a, a_cut, b_cut, b_end, spent + 1]),
            np.stack([a_cut, a_end, b, b_cut, spent + 1])[:, ~same],
        ]
        nodes = np.concatenate(nodes, axis=1)
        alive = (nodes[0] < nodes[1]) & (nodes[2] < nodes[3]) & (nodes[4] <= budget)
        stack.append((level - 1, nodes[:, alive]))
    roots = root(parent, np.arange(len(prints)))
    linked = np.flatnonzero(roots != np.arange(len(prints)))
    return linked, roots[linked]


def root(parent: np.ndarray, places: np.ndarray) -> np.ndarray:
    while True:
        above = parent[places]
        if (above == places).all():
            return places
        places = above


def unite(parent: np.ndarray, prints: np.ndarray, pairs: np.ndarray, budget: int) -> None:
    """Compares all members of small node pairs and joins the components of those within budget."""
    a, a_end, b, b_end, _ = pairs
    wide = b_end - b
    total = (a_end - a) * wide
    if not total.sum():
        return
    pair = np.repeat(np.arange(len(total)), total)
    at = np.arange(len(pair)) - np.repeat(np.cumsum(total) - total, total)
    left, right = a[pair] + at // wide[pair], b[pair] + at % wide[pair]
    near = (left != right) & (np.bitwise_count(prints[left] ^ prints[right]) <= budget)
    merge(parent, left[near], right[near])


def merge(parent: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
    """Joins the components of the places left[i] and right[i]."""
    while len(left):
        left, right = root(parent, left), root(parent, right)
        apart = left != right
        left, right = left[apart], right[apart]
        low, high = np.minimum(left, right), np.maximum(left, right)
        np.minimum.at(parent, high, low)
        left, right = low, high


def links(nodes: DataFrame, budget: int = 4, most: int = 200_000) -> DataFrame:
    """Links (a, b), a > b as signed numbers, that connect what is within `budget` bits in `nodes` (fingerprint, distinct)."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        rows = 0

        def results(final: bool):
            nonlocal held, rows
            table = np.concatenate(held, axis=1)
            new = (np.diff(table[0], prepend=table[0][0]) != 0) | (np.diff(table[1], prepend=table[1][0]) != 0)
            heads = np.append(0, np.flatnonzero(new))
            cut = table.shape[1] if final else heads[-1]
            held = [table[:, cut:]]
            rows = table.shape[1] - cut
            order = np.lexsort((table[2][:cut].view(np.uint64), np.searchsorted(heads, np.arange(cut), "right")))
            prints = table[2][:cut][order]
            member, least = trie_links(prints.view(np.uint64), np.append(heads[heads < cut], cut), budget)
            one, two = prints[member], prints[least]
            return pa.RecordBatch.from_arrays([pa.array(np.maximum(one, two)), pa.array(np.minimum(one, two))], names=["a", "b"])

        for batch in batches:
            held.append(np.stack([batch.column(i).to_numpy() for i in range(3)]))
            rows += batch.num_rows
            if rows >= 100_000:
                yield results(False)
        if rows:
            yield results(True)

    dealt = groups(nodes, budget, most).select("mask", "key", "fingerprint").repartition("mask", "key").sortWithinPartitions("mask", "key")
    return dealt.mapInArrow(join, "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node reachable) of every node in `edges` (a, b); alternating large-star and small-star."""
    edges = stored(edges.filter("a <> b").select("a", "b"))
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("least")).withColumn("least", F.least("a", "least"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
        large = large.filter("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("least"))
        small = down.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("least").alias("b")), F.struct("a", F.col("least").alias("b")))).alias("e"))
        edges = stored(small.select("e.*").filter("a <> b").distinct())
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state


def near_duplicates(docs: DataFrame, width: int = 5, budget: int = 4, most: int = 200_000) -> DataFrame:
    """Per input row: doc_id, text_key, fingerprint (bigint), component_id (smallest doc_id reachable over links)."""
    prints = stored(fingerprints(docs, width))
    nodes = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least_id")))
    roots = components(links(nodes.select("fingerprint"), budget, most))
    named = nodes.join(roots, nodes.fingerprint == roots.node, "left").select("fingerprint", "least_id", F.coalesce("root", "fingerprint").alias("root"))
    names = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = named.join(names, "root").select("fingerprint", "root", "component_id")
    return prints.join(named, "fingerprint").select("doc_id", "text_key", "fingerprint", "root", "component_id")


def one_per_group(docs: DataFrame, width: int = 5, budget: int = 4, most: int = 200_000) -> DataFrame:
    """`docs`, all columns, with one row of each component: the one with the smallest doc_id, of equals the smallest text_key.

    A null doc_id is larger than any other.
    """
    return first_of_each(docs, near_duplicates(docs, width, budget, most))


def first_of_each(docs: DataFrame, grouped: DataFrame) -> DataFrame:
    """`docs` with the first row of each `root` of `grouped` (doc_id, text_key, root of every row)."""
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key")
    kept = grouped.groupBy("root").agg(F.min(place).alias("p")).select(F.col("p.doc_id").alias("kept_id"), F.col("p.text_key").alias("kept_key"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("row_id"), F.xxhash64(F.col("text").cast("string")).alias("row_key"))
    rows = rows.join(kept, (F.col("row_key") == F.col("kept_key")) & F.col("row_id").eqNullSafe(F.col("kept_id")), "left_semi")
    return rows.dropDuplicates(["row_id", "row_key"]).select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
