"""Nested address ranges flattened into disjoint pieces, so that an address is looked up by one equality join.

A sweep with a stack over the ranges in address order gives segments that do not overlap, each with the attributes of the most
specific range that holds it; addresses no range holds are segments without attributes. A segment is then cut into pieces that
are keyed by a network of 8, 16, 24, ... bits: what covers whole subnetworks of 8 more bits stays with the network, what begins
or ends inside a subnetwork goes one level down. Only the two ends of a segment can go down, so a range makes a few pieces, and
a key has at most 256 of them, whatever the table.

Every address of either family lies in exactly one piece. A lookup tries the keys of all levels that occur (three for IPv4,
up to fifteen for IPv6) in one join with the condition that the piece holds the address, and finds exactly one row; no
grouping picks the best one afterwards.

The sweep runs per network of 8 bits; a shorter range is handed to each of its networks. Equal ranges count once, the one with
the largest attributes. Addresses are texts of '4' or '6' and their bits, as `functions.ip.all_bits` gives them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = {"4": 32, "6": 128}
FIRST = 8
#: Key of rows without an address.
NOWHERE = "-"


def segments(ranges: list[tuple[int, int, int]], low: int, high: int) -> Iterator[tuple[int, int, int | None]]:
    """(first, last, number) of the pieces of [low, high] in order; `ranges` are (first, last, number), nested or apart."""
    open_ranges: list[tuple[int, int, int]] = []
    at = low

    def upto(last: int, number: int | None):
        nonlocal at
        if at <= last:
            yield at, last, number
            at = last + 1

    for first, last, number in sorted(ranges, key=lambda r: (r[0], -r[1])):
        while open_ranges and open_ranges[-1][1] < first:
            _, end, inner = open_ranges.pop()
            yield from upto(end, inner)
        yield from upto(first - 1, open_ranges[-1][2] if open_ranges else None)
        open_ranges.append((first, last, number))
    while open_ranges:
        _, end, inner = open_ranges.pop()
        yield from upto(end, inner)
    yield from upto(high, None)


def pieces(first: int, last: int, bits: int, level: int = FIRST) -> Iterator[tuple[int, int, int]]:
    """(level, first, last) of the parts of a segment that lies in one network of `level` bits."""
    shift = bits - level - 8
    if shift <= 0:
        yield level, first, last
        return
    size = 1 << shift
    inner_first = -(-first // size) * size
    inner_last = (last + 1) // size * size - 1
    if inner_first > inner_last:  # inside one subnetwork, or at the end of one and the beginning of the next
        border = inner_first
        if first < border <= last:
            yield from pieces(first, border - 1, bits, level + 8)
            yield from pieces(border, last, bits, level + 8)
        else:
            yield from pieces(first, last, bits, level + 8)
        return
    if first < inner_first:
        yield from pieces(first, inner_first - 1, bits, level + 8)
    yield level, inner_first, inner_last
    if inner_last < last:
        yield from pieces(inner_last + 1, last, bits, level + 8)


def flattened(ranges: DataFrame, attributes: list[str]) -> DataFrame:
    """key, level, low, high and `attributes` of all pieces; `ranges` has `_prefix` ('4' or '6' and bits), `_len` and `attributes`.

    One more row stands for rows without an address (key NOWHERE).
    """
    kinds = {name: ranges.schema[name].dataType for name in attributes}
    best = ranges.groupBy("_prefix", "_len").agg(F.max(F.struct(*attributes)).alias("a")).where(F.col("_prefix").isNotNull())
    spare = f"greatest(0, {FIRST} - _len)"
    nets_of = f"transform(sequence(0, shiftleft(1, {spare}) - 1), n -> substr(concat(_prefix, if(_len < {FIRST}, lpad(bin(n), {spare}, '0'), '')), 1, {FIRST + 1}))"
    placed = best.select(
        F.explode(F.expr(nets_of)).alias("_net"),
        "_prefix", "_len", *[F.col(f"a.{name}").alias(name) for name in attributes],
    )
    nets = ranges.sparkSession.range(1 << FIRST).select(
        F.explode(F.array(F.lit("4"), F.lit("6"))).alias("f"), F.lpad(F.bin("id"), FIRST, "0").alias("b")
    )
    seeds = nets.select(F.concat("f", "b").alias("_net"), F.lit("").alias("_prefix"), F.lit(-1).alias("_len"))
    rows = seeds.unionByName(placed, allowMissingColumns=True).select("_net", "_prefix", "_len", *attributes)

    def swept(net: str, own: list[tuple[str, int]]) -> Iterator[tuple[str, int, str, str, int | None]]:
        bits, start = BITS[net[0]], int(net[1:], 2)
        low, high = start << (bits - FIRST), ((start + 1) << (bits - FIRST)) - 1
        inside = []
        for number, (prefix, size) in enumerate(own):
            if size >= 0:
                first = int(prefix[1:] or "0", 2) << (bits - size)
                inside.append((max(first, low), min(first + (1 << (bits - size)) - 1, high), size, number))
        # Of ranges cut to the same network the longer prefix is the inner one.
        inside.sort(key=lambda r: (r[0], -r[1], r[2]))
        for first, last, number in segments([(a, b, n) for a, b, _, n in inside], low, high):
            for level, begin, end in pieces(first, last, bits):
                key = net[0] + format(begin >> (bits - level), f"0{level}b")
                yield key, level, net[0] + format(begin, f"0{bits}b"), net[0] + format(end, f"0{bits}b"), number

    names = ["key", "level", "low", "high", *attributes]
    schema = "key string, level int, low string, high string, " + ", ".join(f"`{n}` {k.simpleString()}" for n, k in kinds.items())

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def made(table: pa.Table) -> pa.RecordBatch:
            found, take = [], []
            columns = table.column("_net").to_pylist(), table.column("_prefix").to_pylist(), table.column("_len").to_pylist()
            at = 0
            while at < table.num_rows:
                end = at
                while end < table.num_rows and columns[0][end] == columns[0][at]:
                    end += 1
                for *piece, number in swept(columns[0][at], list(zip(columns[1][at:end], columns[2][at:end], strict=True))):
                    found.append(piece)
                    take.append(None if number is None else at + number)
                at = end
            places = pa.array(take, pa.int64())
            own = [pa.array(values, kind) for values, kind in zip(zip(*found, strict=True), (pa.string(), pa.int32(), pa.string(), pa.string()), strict=True)]
            return pa.RecordBatch.from_arrays([*own, *[table.column(n).combine_chunks().take(places) for n in attributes]], names=names)

        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            nets = rest.column("_net").to_pylist()
            if nets and nets[0] != nets[-1]:
                cut = nets.index(nets[-1])  # the last network may go on in the next batch
                yield made(rest.slice(0, cut))
                rest = rest.slice(cut)
        if rest is not None and rest.num_rows:
            yield made(rest)

    found = rows.repartition("_net").sortWithinPartitions("_net", "_len", "_prefix").mapInArrow(sweep, schema)
    nowhere = found.sparkSession.range(1).select(F.lit(NOWHERE).alias("key"), F.lit(0).alias("level"), F.lit("").alias("low"), F.lit("").alias("high"))
    return found.unionByName(nowhere, allowMissingColumns=True)


def lookup(rows: DataFrame, bits: str, table: DataFrame, attributes: list[str], levels: list[int]) -> DataFrame:
    """Adds `attributes` of the piece that holds the address in column `bits`; null for a null address.

    `levels` are those of `table`. Every row comes out once.
    """
    keys = [F.substr(bits, F.lit(1), F.lit(level + 1)) for level in levels if level]
    own = F.filter(F.array(*keys), lambda k: F.length(k) <= F.length(bits)) if keys else F.array().cast("array<string>")
    tried = rows.select("*", F.explode(F.when(F.col(bits).isNull(), F.array(F.lit(NOWHERE))).otherwise(F.array_distinct(own))).alias("_key"))
    address = F.coalesce(F.col(bits), F.lit(""))
    joined = tried.join(table, (F.col("_key") == F.col("key")) & (F.col("low") <= address) & (address <= F.col("high")))
    return joined.select(*rows.columns, *attributes)


def levels_of(table: DataFrame) -> list[int]:
    """The levels that occur, at most fifteen small numbers."""
    return sorted(r.level for r in table.select("level").distinct().collect())
