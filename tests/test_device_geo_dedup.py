from pyspark.sql import functions as F

from helpers import rows_of
from riskspark.functions.clock import DAY_MS, hours
from riskspark.operators import dedup
from riskspark.operators.device import device_features
from riskspark.operators.features import as_of
from riskspark.operators.geo import geo_enrich
from riskspark.streaming.enrich import geo_by_subnet
from riskspark.sources.lake import GEO_RANGES, read_geo

SCHEMA = "transaction_id string, api_key_id string, event_ms bigint, geo_country string"


def devices(spark, rows, **options):
    df = device_features(spark.createDataFrame(rows, SCHEMA), **options)
    names = ["transaction_id", "device_first_seen", "device_txn_count", "prev_geo_country", "prev_txn_time_ms",
             "device_is_new", "device_count_24h"]
    return rows_of(df.select(*names), "transaction_id")


ROWS = [
    ("t1", "d1", 0, "US"),
    ("t2", "d1", 1_000, None),
    ("t3", "d1", 2 * DAY_MS, "FR"),
    ("t4", "d1", 9 * DAY_MS, "DE"),  # exactly 7 days idle: the profile lives on
    ("t5", "d1", 16 * DAY_MS + 1, "DE"),  # one ms more: a new profile
    ("t6", "d1", 16 * DAY_MS + 2, "DE"),
    ("t7", None, 5, "US"),
    ("t8", "", 6, "US"),
    ("t9", "d2", 7, "US"),
]
EXPECTED = [
    ("t1", 0, 1, None, None, True, 1),
    ("t2", 0, 2, "US", 0, False, 2),
    ("t3", 0, 3, None, 1_000, False, 1),
    ("t4", 0, 4, "FR", 2 * DAY_MS, False, 1),
    ("t5", 16 * DAY_MS + 1, 1, None, None, True, 1),
    ("t6", 16 * DAY_MS + 1, 2, "DE", 16 * DAY_MS + 1, False, 2),
    ("t7", None, None, None, None, None, None),
    ("t8", None, None, None, None, None, None),
    ("t9", 7, 1, None, None, True, 1),
]


def test_device_history(spark):
    assert devices(spark, ROWS) == EXPECTED


def test_device_history_of_hot_devices(spark):
    assert devices(spark, ROWS, hot_rows=1) == EXPECTED


def test_known_fraud_device(spark):
    df = device_features(spark.createDataFrame(ROWS, SCHEMA), known_fraud=spark.createDataFrame([("d2",)], "d string"))
    found = {r.transaction_id: r.device_known_fraud for r in df.collect()}
    assert found["t9"] is True and found["t1"] is False and found["t7"] is None


def test_longest_prefix_wins(spark):
    ranges = spark.createDataFrame(
        [
            ("203.0.0.0", 8, "AA", "wide", None, None),
            ("203.0.113.0", 24, "BB", "near", "HOSTING", 0.5),
            ("203.0.113.0", 28, "CC", "nearest", "MOBILE", 0.25),
            ("2001:db8::", 32, "DD", "six", None, None),
        ],
        GEO_RANGES,
    )
    rows = [("1", "203.0.113.0"), ("2", "203.0.113.0/24"), ("3", "203.9.9.0"), ("4", "198.51.100.0"), ("5", None),
            ("6", "2001:db8:0:1::"), ("7", "garbage")]
    got = rows_of(geo_enrich(spark.createDataFrame(rows, "id string, caller_ip_subnet string"), ranges)
                  .select("id", "geo_country", "geo_network_class", F.round("geo_confidence", 2)), "id")
    assert [(r[0], r[1], r[2]) for r in got] == [
        ("1", "CC", "MOBILE"), ("2", "CC", "MOBILE"), ("3", "AA", "RESIDENTIAL"), ("4", None, None), ("5", None, None),
        ("6", "DD", "RESIDENTIAL"), ("7", None, None),
    ]


def test_missing_geo_table_gives_nulls(spark):
    rows = spark.createDataFrame([("1", "203.0.113.0")], "id string, caller_ip_subnet string")
    assert rows_of(geo_enrich(rows, read_geo(spark, None)), "id") == [("1", "203.0.113.0", None, None, None, None)]


def test_first_within_restarts_after_ttl(spark):
    h = hours(1)
    rows = [("a", 0, 0), ("a", 30 * h, 1), ("a", 47 * h, 2), ("a", 48 * h, 3), ("a", 50 * h, 4), ("a", 95 * h, 5),
            ("a", 96 * h, 6), ("a", 0, 7), ("b", 5, 8)]
    df = spark.createDataFrame(rows, "id string, ms bigint, n int")
    kept = rows_of(dedup.first_within(df, "id", "ms", "n", hours(48)), "id", "ms")
    assert kept == [("a", 0, 0), ("a", 48 * h, 3), ("a", 96 * h, 6), ("b", 5, 8)]


def test_first_and_latest(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y"), ("a", 3, "z"), ("b", 2, "w")], "id string, v int, t string")
    assert rows_of(dedup.first_per_key(df, ["id"], "v", "t"), "id") == [("a", 1, "x"), ("b", 2, "w")]
    assert rows_of(dedup.latest_per_key(df, ["id"], "v", "t"), "id") == [("a", 3, "z"), ("b", 2, "w")]
    tied = spark.createDataFrame([("a", 1, "x"), ("a", 1, "y")], "id string, v int, t string")
    assert dedup.keep_latest_ties(tied, "id", "v").count() == 2
    assert dedup.latest_per_key(df.limit(0), ["id"], "v").count() == 0


def test_as_of_edges(spark):
    features = spark.createDataFrame(
        [("a", "f1", 100, 1.0), ("a", "f2", 200, 2.0), ("a", "f3", 5_000_000, 9.0), (None, "f4", 1, 5.0)],
        "account_id string, transaction_id string, feature_ms bigint, v double",
    )
    entities = spark.createDataFrame(
        [("e0", "a", 99), ("e1", "a", 100), ("e2", "a", 199), ("e3", "a", 200), ("e4", "a", 1_200), ("e5", "a", 1_201),
         ("e6", "b", 500), ("e7", None, 500)],
        "transaction_id string, account_id string, event_ms bigint",
    )
    expected = [("e0", None), ("e1", 1.0), ("e2", 1.0), ("e3", 2.0), ("e4", 2.0), ("e5", None), ("e6", None), ("e7", None)]
    for options in ({}, {"hot_rows": 1, "chunk_ms": 50}):
        got = as_of(entities, features, ["v"], 1_000, **options).select("transaction_id", "v")
        assert rows_of(got, "transaction_id") == expected


def test_ipv6_ranges_of_any_length(spark):
    ranges = spark.createDataFrame(
        [("2001:db8::", 48, "AA"), ("2001:db8:0:1::", 64, "BB"), ("2001:db8:0:1:ffff::", 96, "CC"), ("::ffff:203.0.0.0", 104, "DD"), ("5.0.0.0", 8, "EE")],
        "network string, prefix_len int, country string",
    ).withColumns({"city": F.lit("x"), "network_class": F.lit(None).cast("string"), "confidence": F.lit(None).cast("double")})
    wanted = {"2001:db8:0:1::": "BB", "2001:db8:0:2::": "AA", "2001:db8:0:1:ffff::": "CC", "::ffff:203.0.113.7": "DD", "::ffff:204.0.113.7": None,
              "5.200.7.0": "EE", "9.9.9.0": None, "2001:db9::": None}
    events = spark.createDataFrame([(s,) for s in wanted], "caller_ip_subnet string")
    for found in (geo_enrich(events, ranges), geo_by_subnet(events, ranges)):
        assert {r.caller_ip_subnet: r.geo_country for r in found.collect()} == wanted
    assert geo_by_subnet(events, ranges.limit(0)).where("geo_country IS NULL").count() == len(wanted)
