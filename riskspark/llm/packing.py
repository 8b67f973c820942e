"""Packs documents into sequences of at most `capacity` tokens with a grouping genetic algorithm.

Documents are tokenized once, where they lie. Only those longer than a sequence are cut; all their pieces but the first
are full and need no search. The rest are dealt into blocks of about `block_items` pieces. Several islands evolve
packings of each block: a child takes whole well-filled sequences of one parent, drops the sequences of the other that
hold the same pieces, and best-fits what that displaced. After each epoch an island also gets its neighbour's elite. The
best packing of all islands counts. Blocks grow in number with the input, not in size, so memory is bounded.

Nulls and ties: null text is an empty document, which has the end token only. Null doc_id and repeated rows are packed
like any other row. Further columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import json
import random
import re
import sys
import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.words import mixed, utf8
from riskspark.session import stored

SEGMENTS = 400_000


if array("I").itemsize != 4 or sys.byteorder != "little":
    raise ImportError("token ids are laid out as little-endian 32-bit numbers")


@cache
def encoding(path: str) -> tiktoken.Encoding:
    """Byte-level BPE of the rank file at `path`; its ids are those of the tokenizers file with the same vocabulary."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class Segments(dict):
    """Ids, as little-endian bytes, of a text segment with the space before it.

    The tokenizer never joins across a space that is followed by other than white space, so such segments are
    tokenized alone and remembered, in two generations of bounded size: what a generation used moves on to the next.
    None marks a segment that begins or ends with white space of its own. The strings of `added` tokens are cut out
    before anything else, as the tokenizers file says, and have their own ids.
    """

    def __init__(self, path: str, added: dict[str, int] | None = None):
        super().__init__()
        self.encode = encoding(path).encode_ordinary
        self.added = {text: array("I", [number]).tobytes() for text, number in (added or {}).items()}
        self.marks = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        self.older: dict[str, bytes | None] = {}

    def ids(self, text: str) -> bytes:
        return array("I", self.encode(text)).tobytes()

    def __missing__(self, segment: str) -> bytes | None:
        if len(self) >= SEGMENTS:
            self.older = dict(self)
            self.clear()
        if segment in self.older:
            value = self.older[segment]
        elif segment == "" or segment[0].isspace() or segment[-1].isspace():
            value = None
        else:
            value = self.ids(" " + segment)
        if len(segment) < 64:
            self[segment] = value
        return value

    def of(self, text: str) -> bytes:
        if self.marks is not None and self.marks.search(text):
            return b"".join(self.added[part] if part in self.added else self.plain(part) for part in self.marks.split(text) if part)
        return self.plain(text)

    def plain(self, text: str) -> bytes:
        segments = text.split(" ")
        parts = list(map(self.__getitem__, segments[1:]))
        if None in parts or segments[0] == "" or segments[0][-1:].isspace():
            return self.ids(text)
        return self.ids(segments[0]) + b"".join(parts)


@cache
def added_tokens(path: str) -> dict[str, int]:
    """The added tokens of a tokenizers file, which are found in plain text too. Files differ in how they trim around them."""
    with open(path, encoding="utf-8") as file:
        tokens = json.load(file)["added_tokens"]
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in tokens):
        raise ValueError(f"added tokens of {path} need more than to be cut out")
    return {t["content"]: t["id"] for t in tokens}


def pieces(docs: DataFrame, capacity: int = 1024, end_id: int = 2, ranks: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, and a salt that spreads the rows evenly.

    `ranks` and `vocabulary` are the rank file and the tokenizers file of one vocabulary.
    """
    path = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    added = added_tokens(vocabulary or public_tokenizers.path("byte_bpe_50k.json"))
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments = Segments(path, added)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text")), strict=True):
                ids = segments.of(text.decode()) + end if text else end
                total = len(ids) // 4
                at, piece = 0, 0
                while at < total:
                    to = at + capacity if at else (total - 1) % capacity + 1
                    rows.append((doc_id, piece, at, to - at, zlib.crc32(ids[4 * at : 4 * to])))
                    at, piece = to, piece + 1
            columns = list(zip(*rows, strict=True)) or [()] * 5
            crc = np.array(columns[4], np.uint64)
            salt = mixed(crc + np.arange(len(crc), dtype=np.uint64) * np.uint64(1 << 33)).view(np.int64)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(values, kind) for values, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(salt)], names=["doc_id", "piece", "start", "length", "ids_crc32", "salt"])

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return texts.mapInArrow(cut, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, salt bigint")


class Packing:
    """Bins of one packing; items are numbers into `lengths`."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.bins: list[list[int]] = []
        self.fill: list[int] = []
        self.by_room: dict[int, list[int]] = {}
        self.rooms = 0  # bit r: a bin with room r exists

    def open(self, items: list[int]) -> None:
        self.bins.append(items)
        self.fill.append(sum(map(self.lengths.__getitem__, items)))
        self._offer(len(self.bins) - 1)

    def _offer(self, at: int) -> None:
        room = self.capacity - self.fill[at]
        if room:
            self.by_room.setdefault(room, []).append(at)
            self.rooms |= 1 << room

    def best_fit(self, items: list[int]) -> None:
        """Longest first into the bin it fills best."""
        for item in sorted(items, key=self.lengths.__getitem__, reverse=True):
            length = self.lengths[item]
            fitting = self.rooms >> length
            if not fitting:
                self.open([item])
                continue
            room = length + (fitting & -fitting).bit_length() - 1
            at = self.by_room[room].pop()
            if not self.by_room[room]:
                self.rooms ^= 1 << room
            self.bins[at].append(item)
            self.fill[at] += length
            self._offer(at)

    def plan(self) -> list[int]:
        found = [0] * len(self.lengths)
        for number, items in enumerate(self.bins):
            for item in items:
                found[item] = number
        return found

    def fitness(self) -> float:
        """Fewer and fuller bins are better; one bin less always outweighs."""
        full = sum((f / self.capacity) ** 2 for f in self.fill)
        return -len(self.bins) + full / (len(self.bins) + 1)


def from_plan(plan: list[int], lengths: list[int], capacity: int) -> Packing:
    bins: dict[int, list[int]] = {}
    for item, number in enumerate(plan):
        bins.setdefault(number, []).append(item)
    packing = Packing(lengths, capacity)
    for items in bins.values():
        packing.open(items)
    return packing


def crossover(one: Packing, two: Packing, rng: random.Random) -> Packing:
    """Well-filled bins of `one`, the bins of `two` free of their items, and the displaced items best-fitted."""
    child = Packing(one.lengths, one.capacity)
    order = sorted(range(len(one.bins)), key=lambda at: -one.fill[at] + rng.random() * one.capacity / 16)
    taken: set[int] = set()
    for at in order[: len(order) // 2]:
        child.open(list(one.bins[at]))
        taken.update(one.bins[at])
    displaced: list[int] = []
    for items, fill in zip(two.bins, two.fill, strict=True):
        left = [i for i in items if i not in taken]
        # A bin that is poorly filled is opened again too, which is the mutation.
        if len(left) == len(items) and (fill == two.capacity or rng.random() < fill / two.capacity):
            child.open(left)
        else:
            displaced += left
    child.best_fit(displaced)
    return child


def evolve(lengths: list[int], plans: list[list[int]], capacity: int, seed: int, generations: int, population: int) -> Packing:
    """Best packing after some generations, starting from `plans` and shuffled best fits."""
    rng = random.Random(seed)
    least = -(-sum(lengths) // capacity)
    members = [from_plan(plan, lengths, capacity) for plan in plans]
    while len(members) < population:
        start = Packing(lengths, capacity)
        items = list(range(len(lengths)))
        rng.shuffle(items)  # breaks ties between equal lengths
        start.best_fit(items)
        members.append(start)
        if len(start.bins) == least:
            return start
    for _ in range(generations):
        members.sort(key=Packing.fitness, reverse=True)
        if len(members[0].bins) <= least:
            break
        one, two = rng.sample(members[: max(2, population // 2)], 2)
        members = [*members[: population - 2], crossover(one, two, rng), crossover(two, one, rng)]
    return max(members, key=Packing.fitness)


def _epoch(capacity: int, epoch: int, generations: int, population: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            plans, scores = [], []
            for row in batch.to_pylist():
                seed = (epoch << 48) ^ (row["block"] << 8) ^ row["island"]
                best = evolve(row["lengths"], [p for p in row["plans"] if p], capacity, seed, generations, population)
                plans.append(best.plan())
                scores.append(best.fitness())
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("island"), batch.column("lengths"), pa.array([[p] for p in plans], pa.list_(pa.list_(pa.int32()))), pa.array(scores, pa.float64())],
                names=["block", "island", "lengths", "plans", "score"],
            )

    return run


def pack(
    docs: DataFrame, capacity: int = 1024, end_id: int = 2, ranks: str | None = None, block_items: int = 4000,
    islands: int = 2, epochs: int = 2, generations: int = 4, population: int = 4,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    all_pieces = stored(pieces(docs, capacity, end_id, ranks))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    # Full pieces are sequences of their own, with negative numbers.
    full = all_pieces.filter(F.col("length") == capacity).select(
        *columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset")
    )
    short = all_pieces.filter(F.col("length") < capacity)
    blocks = -(-short.count() // block_items)
    dealt = short.withColumn("block", F.pmod("salt", F.lit(max(blocks, 1))))
    items = stored(dealt.groupBy("block").agg(F.collect_list(F.struct(*columns)).alias("items")))
    state = items.select(
        "block", F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"), F.col("items.length").cast("array<int>").alias("lengths"),
        F.array().cast("array<array<int>>").alias("plans"),
    )
    kinds = "block bigint, island int, lengths array<int>, plans array<array<int>>, score double"
    for epoch in range(epochs):
        if epoch:
            guests = state.select("block", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.col("plans").alias("guests"))
            state = state.join(guests, ["block", "island"]).withColumn("plans", F.concat("plans", "guests"))
        state = state.repartition(F.col("block"), F.col("island")).select("block", "island", "lengths", "plans")
        state = stored(state.mapInArrow(_epoch(capacity, epoch, generations, population), kinds))
    best = state.groupBy("block").agg(F.max_by(F.element_at("plans", 1), F.struct("score", "island")).alias("plan"))
    placed = items.join(best, "block").select("block", "plan", F.posexplode("items").alias("at", "item"))
    placed = placed.select("item.*", (F.shiftleft("block", 24) + F.get("plan", "at")).alias("sequence_id"), "at")
    offset = F.sum("length").over(Window.partitionBy("sequence_id").orderBy("at")) - F.col("length")
    return placed.withColumn("offset", offset).drop("at").unionByName(full)
