"""Country, city and network class of a caller's subnet by longest prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions import ip as ipf
from riskspark.operators.geo_segments import flattened, levels_of, lookup
from riskspark.session import stored

GEO_COLUMNS = ["geo_country", "geo_city", "geo_network_class", "geo_confidence"]
# Class and confidence of a hit where the reference table names none.
DEFAULT_CLASS = "RESIDENTIAL"
DEFAULT_CONFIDENCE = 0.9


def keyed_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges by join key and prefix length, with the geo columns."""
    return ranges.select(
        ipf.prefix_key(ipf.all_bits(F.col("network")), F.col("prefix_len")).alias("_prefix"),
        F.col("prefix_len").cast("int").alias("_len"),
        F.col("country").alias("geo_country"),
        F.col("city").alias("geo_city"),
        F.coalesce(F.col("network_class"), F.lit(DEFAULT_CLASS)).alias("geo_network_class"),
        F.coalesce(F.col("confidence"), F.lit(DEFAULT_CONFIDENCE)).cast("float").alias("geo_confidence"),
    )


def subnet_bits(subnet: Column) -> Column:
    """Address bits of the host that stands for the subnet."""
    return ipf.all_bits(ipf.representative_host(subnet))


def geo_pieces(ranges: DataFrame) -> DataFrame:
    """The reference table flattened into disjoint pieces, stored for its readers."""
    return stored(flattened(keyed_ranges(ranges), GEO_COLUMNS))


def resolve_subnets(subnets: DataFrame, ranges: DataFrame, column: str) -> DataFrame:
    """One row per distinct subnet with the attributes of the most specific range that holds it, null if none does.

    The ranges are flattened into disjoint pieces (`geo_segments`), and each
    subnet finds its piece by one equality join, whatever prefix lengths occur.
    """
    table = geo_pieces(ranges)
    bits = subnets.select(F.col(column), subnet_bits(F.col(column)).alias("_bits"))
    return lookup(bits, "_bits", table, GEO_COLUMNS, levels_of(table)).drop("_bits")


def geo_enrich(df: DataFrame, ranges: DataFrame, subnet: str = "caller_ip_subnet") -> DataFrame:
    """Adds the geo columns; a subnet no range holds gets nulls and the row stays.

    The lookup runs on distinct subnets, of which IPv4 has at most 2^24. The join
    back is left to Spark: broadcast when the result is measured small, else a
    sort merge join whose hot subnets adaptive execution splits.
    """
    distinct = df.select(subnet).where(F.col(subnet).isNotNull()).distinct()
    resolved = resolve_subnets(distinct, ranges, subnet)
    return df.join(resolved, subnet, "left").select(*df.columns, *GEO_COLUMNS)
