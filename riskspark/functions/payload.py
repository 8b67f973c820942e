"""JSON payloads of dead letters: parse, sanitise, mask for display."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Payload keys dropped before storage, and keys masked on display.
UNMASKED_KEYS = ("card_number", "caller_ip")
DISPLAY_KEYS = ("card_number", "pan", "ip_address", "ip", "email")
PREVIEW_CHARS = 120


def as_map(payload: Column) -> Column:
    """The JSON object as a string map; text that is no object comes back under `_raw`."""
    parsed = F.from_json(payload, "map<string,string>", {"mode": "PERMISSIVE"})
    fallback = F.create_map(F.lit("_raw"), F.coalesce(payload, F.lit("")))
    is_object = F.ltrim(payload).startswith("{")
    return F.when(is_object & parsed.isNotNull(), parsed).otherwise(fallback)


def sanitised(payload: Column) -> Column:
    """JSON text without the keys that may hold an unmasked card or address.

    Values keep their JSON types; text that is no object comes back under `_raw`.
    """
    fields = F.try_variant_get(F.try_parse_json(payload), "$", "map<string,variant>")
    kept = F.to_json(F.map_filter(fields, lambda k, _: ~k.isin(*UNMASKED_KEYS)))
    return F.coalesce(kept, F.to_json(as_map(payload)))


def _masked(value: Column) -> Column:
    long = F.concat(F.substring(value, 1, 6), F.lit("****"), F.right(value, F.lit(4)))
    return F.when(F.length(value) >= 10, long).otherwise("****")


def display_masked(payload: Column) -> Column:
    """String map for display with the personal fields masked."""
    return F.transform_values(
        as_map(payload),
        lambda k, v: F.when(k.isin(*DISPLAY_KEYS) & v.isNotNull(), _masked(v)).otherwise(v),
    )


def preview(payload: Column) -> Column:
    return F.substring(payload, 1, PREVIEW_CHARS)
