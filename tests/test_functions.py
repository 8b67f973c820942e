"""Column functions against Python's own ideas of cards, addresses and JSON."""

import ipaddress
import json

from pyspark.sql import functions as F

from riskspark.functions import cards, coerce, payload, pii
from riskspark.functions import ip as ipf


def column(spark, values, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_cards(spark):
    values = ["4532015112830366", "378282246310005", "4532-0151-1283-0366", "4532 0151 1283 0366", "4532015112830367",
              "45320151128303", "4532o15112830366", "", None]
    errors = column(spark, values, cards.card_error)
    assert errors == [None, None, None, None, "CHECK_DIGIT", "BAD_LENGTH", "NON_DIGIT", "NON_DIGIT", "MISSING"]
    assert column(spark, values[:2], cards.masked_card) == ["453201******0366", "378282*****0005"]
    assert column(spark, values[:1], cards.card_bin) == ["453201"] and column(spark, values[:1], cards.card_last4) == ["0366"]
    assert column(spark, ["1" * 14, "1" * 15, "1" * 19, "1" * 20], cards.looks_like_card) == [False, True, True, False]


ADDRESSES = [
    "203.0.113.77", "0.0.0.0", "255.255.255.255", "10.1.2.3", "224.0.0.1", "239.255.255.255", "256.1.1.1", "1.2.3", "1.2.3.4.5",
    "01.2.3.4", "", "abc", "2001:db8:85a3::8a2e:370:7334", "::", "::1", "fe80::1", "ff02::1", "1::", "1:2:3:4:5:6:7:8",
    "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8:9", "1::2::3", ":1:2:3:4:5:6:7", "1:2:3:4:5:6:7:", "12345::",
    "2001:0DB8:0000:0001::", "0:0:0:1:2:3:4:5", "1:0:0:0:5:6:7:8", "::ffff:1.2.3.4", "64:ff9b::1.2.3.4", "::1.2.3.400", "g::1",
    "1:2:3:4:5:6:1.2.3.4", ":::", "1:::2",
]


def _expected(text):
    try:
        address = ipaddress.ip_address(text)
    except ValueError:
        return None, "MALFORMED"
    if address.is_multicast:
        return None, "MULTICAST"
    prefix = 24 if address.version == 4 else 64
    return str(ipaddress.ip_network(f"{text}/{prefix}", strict=False).network_address), None


def test_addresses_like_python(spark):
    assert column(spark, ADDRESSES, ipf.truncate_ip) == [_expected(a)[0] for a in ADDRESSES]
    assert column(spark, ADDRESSES, ipf.ip_error) == [_expected(a)[1] for a in ADDRESSES]
    v4 = ["203.0.113.77", "10.1.200.3"]
    assert column(spark, v4, lambda c: ipf.truncate_ip(c, 20)) == ["203.0.112.0", "10.1.192.0"]
    assert column(spark, v4, ipf.v4_number) == [int(ipaddress.ip_address(a)) for a in v4]


def test_address_bits(spark):
    values = ["203.0.113.1", "2001:db8::1", "bad"]
    expected = ["4" + f"{int(ipaddress.ip_address(values[0])):032b}", "6" + f"{int(ipaddress.ip_address(values[1])):0128b}"[:64], None]
    assert column(spark, values, ipf.address_bits) == expected
    assert column(spark, ["203.0.113.0/24", "203.0.113.0", "203.0.113.9", "::"], ipf.representative_host) == [
        "203.0.113.1", "203.0.113.1", "203.0.113.9", "::",
    ]


def test_all_bits(spark):
    values = ["203.0.113.1", "2001:db8::1", "::ffff:203.0.113.7", "bad"]
    expected = ["4" + f"{int(ipaddress.ip_address(values[0])):032b}", *("6" + f"{int(ipaddress.ip_address(v)):0128b}" for v in values[1:3]), None]
    assert column(spark, values, ipf.all_bits) == expected


def test_text_patterns(spark):
    texts = ["card 4532-1234-5678-9012 here", "4532 1234 5678 9012", "45321234567890123", "none"]
    assert column(spark, texts, pii.has_pan) == [True, True, False, False]
    texts = ["at 203.0.113.42 now", "net 203.0.113.0/24 ok", "net 203.0.113.0/25 bad", "10.0.0.5 172.16.3.4 192.168.1.1 127.0.0.1",
             "127.0.0.2", "300.1.1.1", "172.32.0.1"]
    assert [len(x) for x in column(spark, texts, pii.exposed_v4)] == [1, 0, 1, 0, 1, 0, 1]
    texts = ["x 2001:db8:85a3::8a2e:370:7334 y", "12:30:45", "a::b", "std::cout", "::"]
    assert [len(x) for x in column(spark, texts, pii.exposed_v6)] == [1, 0, 1, 0, 0]
    assert pii.sensitive_name("My_Card_Number") and pii.sensitive_name("SSN") and not pii.sensitive_name("ip_subnet")


def test_payloads(spark):
    values = ['{"card_number":"4532015112830366","amount":12.5,"ip":"1.2.3.4","note":"x"}', "broken {", '{"caller_ip":"1.1.1.1","a":true}']
    shown = column(spark, values, payload.display_masked)
    assert shown[0]["card_number"] == "453201****0366" and shown[0]["ip"] == "****" and shown[0]["note"] == "x"
    assert shown[1] == {"_raw": "broken {"}
    safe = [json.loads(s) for s in column(spark, values, payload.sanitised)]
    assert safe[0] == {"amount": 12.5, "ip": "1.2.3.4", "note": "x"} and safe[2] == {"a": True}
    assert safe[1] == {"_raw": "broken {"}
    assert len(column(spark, ["y" * 500], payload.preview)[0]) == 120


def test_coercions(spark):
    assert column(spark, ["TRUE", "1", "yes", "no", "", None], coerce.lenient_boolean) == [True, True, True, False, False, None]
    assert [str(v) for v in column(spark, ["1.00005", "x"], coerce.money)] == ["1.0001", "None"]
