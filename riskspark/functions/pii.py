"""Personal data in free text and in column names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskspark.functions import ip as ipf

# What the audit looks for.
PAN_PATTERN = r"\b\d{4}[\s-]?\d{4}[\s-]?\d{4}[\s-]?\d{4}\b"
SENSITIVE_NAMES = ("card_number", "full_ip", "ssn")
PRIVATE_V4 = r"^(10\.|172\.(1[6-9]|2[0-9]|3[01])\.|192\.168\.|127\.0\.0\.1$)"
# End of fixed values.
V4_CANDIDATE = r"\b[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}(?:/[0-9]{1,2})?\b"
V6_CANDIDATE = r"(?<![0-9A-Za-z_:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z_:])"
WIDEST_EXEMPT_PREFIX = 24


def has_pan(text: Column) -> Column:
    return text.rlike(PAN_PATTERN)


def _exposed_v4(candidate: Column) -> Column:
    parts = F.split(candidate, "/")
    host, prefix = parts.getItem(0), F.get(parts, F.lit(1)).try_cast("int")
    network_notation = F.coalesce(prefix <= WIDEST_EXEMPT_PREFIX, F.lit(False))
    return ipf.is_v4(host) & ~network_notation & ~host.rlike(PRIVATE_V4)


def exposed_v4(text: Column) -> Column:
    """Public IPv4 addresses in the text that are not written as a /24 or wider network."""
    found = F.regexp_extract_all(text, F.lit(V4_CANDIDATE), 0)
    return F.filter(found, _exposed_v4)


def exposed_v6(text: Column) -> Column:
    """IPv6 addresses in the text."""
    found = F.regexp_extract_all(text, F.lit(V6_CANDIDATE), 0)
    return F.filter(found, lambda c: (F.length(c) > 2) & ipf.is_v6(c))


def sensitive_name(name: str) -> bool:
    return any(word in name.lower() for word in SENSITIVE_NAMES)


def sample_hash(content: Column) -> Column:
    return F.sha2(content, 256)
