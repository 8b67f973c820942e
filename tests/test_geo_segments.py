"""Flattened ranges against trying every range."""

import ipaddress
import random

import pytest
from riskspark.operators.geo import GEO_COLUMNS, geo_enrich, geo_pieces
from riskspark.operators.geo_segments import pieces, segments
from riskspark.streaming.enrich import geo_by_subnet

RANGES = "network string, prefix_len int, country string, city string, network_class string, confidence double"


def nested(rng, family, count):
    bits = 32 if family == 4 else 128
    made = ipaddress.IPv4Network if family == 4 else ipaddress.IPv6Network
    networks = [made((rng.getrandbits(bits) >> (bits - 6) << (bits - 6), 6)) for _ in range(3)]
    if family == 4:
        networks.append(made((0, 0)))
    for _ in range(count):
        outer = rng.choice(networks)
        if outer.prefixlen < bits:
            size = min(bits, outer.prefixlen + rng.choice([1, 2, 8, 13, 30]))
            low = int(outer.network_address) + (rng.getrandbits(size - outer.prefixlen) << (bits - size))
            networks.append(made((low, size)))
    return networks


def best(networks, address):
    holding = [n for n in networks if n.version == address.version and address in n]
    if not holding:
        return None
    longest = max(n.prefixlen for n in holding)
    return next(n for n in holding if n.prefixlen == longest)


def asked(rng, networks, family):
    for network in networks:
        low, high = int(network.network_address), int(network.broadcast_address)
        for n in (low, high, low - 1, high + 1, rng.randint(low, high)):
            if 0 <= n < 1 << (32 if family == 4 else 128):
                yield (ipaddress.IPv4Address if family == 4 else ipaddress.IPv6Address)(n)


@pytest.mark.parametrize("bits", [16, 24, 32])
def test_segments_and_pieces_cover_every_address_once(bits):
    rng = random.Random(bits)
    low, high = 0, (1 << (bits - 8)) - 1
    for _ in range(40):
        ranges = [(low, high, 0)] if rng.random() < 0.5 else []
        for number in range(1, 12):
            size = rng.randrange(bits - 7)
            first = rng.getrandbits(bits - 8) >> size << size
            ranges.append((first, first + (1 << size) - 1, number))
        ranges = list({(a, b): (a, b, n) for a, b, n in ranges}.values())
        found = list(segments(ranges, low, high))
        assert [s[0] for s in found] == [low, *[s[1] + 1 for s in found[:-1]]] and found[-1][1] == high
        for first, last, number in found:
            for at in {first, last, rng.randint(first, last)}:
                holding = [r for r in ranges if r[0] <= at <= r[1]]
                assert number == (min(holding, key=lambda r: r[1] - r[0])[2] if holding else None)
            parts = list(pieces(first, last, bits))
            assert [p[1] for p in parts] == [first, *[p[2] + 1 for p in parts[:-1]]] and parts[-1][2] == last
            for level, begin, end in parts:
                assert begin >> (bits - level) == end >> (bits - level)


def test_lookup_equals_trying_every_range(spark):
    rng = random.Random(4)
    networks = {f: list(dict.fromkeys(nested(rng, f, 120))) for f in (4, 6)}
    rows = [(str(n.network_address), n.prefixlen, f"c{i}", str(n), None, None) for i, n in enumerate(networks[4] + networks[6])]
    rows.append(rows[5][:2] + ("A", "aaa", None, None))  # an equal range with smaller attributes
    ranges = spark.createDataFrame(rows, RANGES)
    addresses = [a for f in (4, 6) for a in asked(rng, networks[f], f)]
    wanted = {}
    for a in addresses:
        text = str(a)
        # '...0' stands for '...1' in IPv4, as in every lookup of a subnet
        host = ipaddress.ip_address(text[:-1] + "1") if a.version == 4 and text.endswith(".0") else a
        found = best(networks[a.version], host)
        wanted[text] = None if found is None else str(found)
    events = spark.createDataFrame([(t,) for t in wanted] + [(None,), ("x",), ("",)], "caller_ip_subnet string")
    for result in (geo_enrich(events, ranges), geo_by_subnet(events, ranges)):
        got = {r.caller_ip_subnet: r.geo_city for r in result.collect()}
        assert {k: v for k, v in got.items() if k in wanted} == wanted
        assert got[None] is None and got["x"] is None and got[""] is None and result.count() == events.count()


def test_keys_hold_few_pieces(spark):
    rng = random.Random(5)
    networks = list(dict.fromkeys(nested(rng, 6, 400)))
    ranges = spark.createDataFrame([(str(n.network_address), n.prefixlen, "c", str(n), None, None) for n in networks], RANGES)
    table = geo_pieces(ranges)
    assert table.groupBy("key").count().agg({"count": "max"}).first()[0] <= 256
    assert table.count() < 512 + 40 * len(networks)


def test_a_stream_looks_up_by_one_join(spark, folder):
    ranges = spark.createDataFrame([("10.0.0.0", n, "c", f"r{n}", None, None) for n in range(8, 33)], RANGES)
    spark.createDataFrame([("1", "10.0.0.0")], "id string, caller_ip_subnet string").write.parquet(f"{folder}/in")
    events = spark.readStream.schema("id string, caller_ip_subnet string").parquet(f"{folder}/in")
    placed = geo_by_subnet(events, ranges)
    assert placed._jdf.queryExecution().analyzed().toString().count("Join ") == 1
    assert placed.columns == ["id", "caller_ip_subnet", *GEO_COLUMNS]
