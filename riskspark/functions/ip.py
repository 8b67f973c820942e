"""IP addresses as text: check, truncate to the network, turn into a prefix key.

IPv6 stays in Columns too. What is kept of an address covers the first four of the
eight groups, so the zero run that the text form compresses is the trailing one.
Ranges are matched on all eight.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_DOTTED = rf"{_OCTET}(?:\.{_OCTET}){{3}}"
_GROUP = r"[0-9A-Fa-f]{1,4}"
_SIDE = rf"(?:(?:{_GROUP}:)*{_GROUP})?"
V4_PATTERN = rf"^{_DOTTED}$"
# Eight groups, or one '::' that stands for at least one group.
V6_PATTERN = rf"^(?:(?:{_GROUP}:){{7}}{_GROUP}|(?!(?::*{_GROUP}(?![0-9A-Fa-f])){{8}}){_SIDE}::{_SIDE})$"


def is_v4(ip: Column) -> Column:
    return ip.rlike(V4_PATTERN)


def _hex_form(ip: Column) -> Column:
    """The address with a dotted tail replaced by two groups; only its prefix is used later."""
    return F.regexp_replace(ip, rf"(?<=:){_DOTTED}$", "0:0")


def is_v6(ip: Column) -> Column:
    return _hex_form(ip).rlike(V6_PATTERN)


def is_multicast(ip: Column) -> Column:
    return ip.rlike(r"^(?:(?:22[4-9]|23[0-9])\.|[fF]{2}[0-9A-Fa-f]{2}:)")


def v4_number(ip: Column) -> Column:
    """The address as a number; null when it is not IPv4."""
    octets = F.split(ip, r"\.")
    number = F.aggregate(octets, F.lit(0).cast("bigint"), lambda n, octet: n * 256 + octet.try_cast("bigint"))
    return F.when(is_v4(ip), number)


def v4_text(number: Column) -> Column:
    octets = [F.shiftright(number, bits).bitwiseAND(F.lit(255)) for bits in (24, 16, 8, 0)]
    return F.concat_ws(".", *[octet.cast("string") for octet in octets])


def _groups(text: Column) -> Column:
    return F.filter(F.split(text, ":"), lambda g: g != "")


def _all_groups(text: Column) -> Column:
    """The eight groups of an IPv6 address without a dotted tail, zero run written out."""
    zeros = F.concat(F.lit(":"), F.repeat(F.lit("0:"), F.greatest(F.lit(0), 8 - F.size(_groups(text)))))
    return _groups(F.regexp_replace(text, F.lit("::"), zeros))


def _first_groups(ip: Column) -> Column:
    return F.slice(_all_groups(_hex_form(ip)), 1, 4)


def _tail_in_hex(ip: Column) -> Column:
    """The address with its dotted tail written as two groups."""
    tail = v4_number(F.nullif(F.regexp_extract(ip, rf"(?<=:)({_DOTTED})$", 1), F.lit("")))
    groups = F.concat_ws(":", F.hex(F.shiftright(tail, 16)), F.hex(tail.bitwiseAND(F.lit(65535))))
    return F.when(tail.isNull(), ip).otherwise(F.concat(F.regexp_replace(ip, rf"(?<=:){_DOTTED}$", ""), groups))


def v6_network64(ip: Column) -> Column:
    """Text of the /64 network of an IPv6 address."""
    short = F.transform(_first_groups(ip), lambda g: F.regexp_replace(F.lower(g), "^0+(?=.)", ""))
    head = F.regexp_replace(F.array_join(short, ":"), "(^|:)0(:0)*$", "")
    return F.when(is_v6(ip), F.concat(head, F.lit("::")))


def truncate_ip(ip: Column, v4_prefix: int = 24) -> Column:
    """Network address of an IP (IPv4 by `v4_prefix`, IPv6 by 64); null if invalid or multicast."""
    if v4_prefix == 24:
        v4 = F.regexp_replace(ip, r"[0-9]+$", "0")
    else:
        mask = ((1 << v4_prefix) - 1) << (32 - v4_prefix)
        v4 = v4_text(v4_number(ip).bitwiseAND(F.lit(mask).cast("bigint")))
    return F.when(is_multicast(ip), None).when(is_v4(ip), v4).otherwise(v6_network64(ip))


def ip_error(ip: Column) -> Column:
    """Null for a storable address, otherwise why it is not."""
    valid = F.coalesce(is_v4(ip) | is_v6(ip), F.lit(False))
    return F.when(~valid, "MALFORMED").when(is_multicast(ip), "MULTICAST")


def representative_host(subnet: Column) -> Column:
    """'203.0.113.0/24' or '203.0.113.0' to '203.0.113.1', the host that stands for the subnet."""
    host = F.split(subnet, "/").getItem(0)
    return F.regexp_replace(host, r"^([^.]*\.[^.]*\.[^.]*\.)0$", "$11")


def address_bits(ip: Column) -> Column:
    """'4' or '6' followed by the address bits: all 32 of IPv4, the first 64 of IPv6."""
    return F.substr(all_bits(ip), F.lit(1), F.lit(65))


def all_bits(ip: Column) -> Column:
    """'4' or '6' followed by the address bits: 32 of IPv4, 128 of IPv6."""
    v4 = F.concat(F.lit("4"), F.lpad(F.bin(v4_number(ip)), 32, "0"))
    groups = F.transform(_all_groups(_tail_in_hex(ip)), lambda g: F.lpad(F.conv(g, 16, 2), 16, "0"))
    v6 = F.when(is_v6(ip), F.concat(F.lit("6"), F.array_join(groups, "")))
    return F.coalesce(v4, v6)


def prefix_key(bits: Column, prefix_len: Column) -> Column:
    """Join key of the network of `prefix_len` bits that an address lies in."""
    return F.substr(bits, F.lit(1), prefix_len.cast("int") + 1)
