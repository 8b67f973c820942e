"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust a score. DataFrame functions only.

The places of a pattern's matches follow from the lengths of the matches and of the text between them. Cards need 16 to 19
digits and the Luhn sum, IBANs the remainder 1 modulo 97, addresses parts of at most 255. These stand by themselves. Weak
proposals, bare digit groups that look like a phone or an identity number, count only if a context word near them lifts
their score to `least`.

The patterns are linear: digits, local parts and separators are matched possessively, and a match is only tried at the
start of a run of its characters or where the last match ended.

Nulls and ties: null text is empty and has no spans; so have texts without any. Rows with null or repeated ids are scanned
one by one. Further columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns of the base kinds, in their linear form, and words that speak for a kind nearby.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}+",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
    "national_id": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "local_phone": r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
}
BASE = ("email", "ip", "card", "phone")
NEEDS = {"email": "@", "ip": ".", "card": None, "phone": "+", "iban": None, "national_id": "-", "local_phone": None}
CONTEXT = {
    "iban": "iban|account|bank|konto|cuenta|compte|transfer",
    "national_id": "ssn|social|security|identity|passport|tax",
    "local_phone": "phone|call|tel|mobile|fax|contact|telefon|teléfono|téléphone",
}
PRIOR = {"iban": 0.9, "national_id": 0.4, "local_phone": 0.4}
LIFT = 0.4
REACH = 40
SPANS = "array<struct<start:int,end:int,match:string>>"
BLOCK = 128


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn sum."""

    def add(total: Column, at: Column) -> Column:
        digit = F.substring(number, F.length(number) - at, F.lit(1)).cast("int")
        doubled = digit * 2
        return total + F.when(at % 2 == 1, F.when(doubled > 9, doubled - 9).otherwise(doubled)).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add) % 10 == 0


def mod_97(iban: Column) -> Column:
    """Whether letters and digits, first four moved to the end, leave 1 when divided by 97."""
    clean = F.replace(iban, F.lit(" "), F.lit(""))
    moved = F.concat(F.substr(clean, F.lit(5)), F.substr(clean, F.lit(1), F.lit(4)))

    def add(total: Column, letter: Column) -> Column:
        value = F.when(letter.rlike("[0-9]"), F.ascii(letter) - 48).otherwise(F.ascii(letter) - 55)
        return (total * F.when(value > 9, 100).otherwise(10) + value) % 97

    letters = F.filter(F.split(moved, ""), lambda letter: letter != "")
    return F.length(clean).between(15, 34) & (F.aggregate(letters, F.lit(0), add) == 1)


def confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        part_of = lambda part: F.ltrim(part, F.lit("0"))
        return F.forall(F.split(match, r"\."), lambda part: (F.length(part_of(part)) <= 3) & (F.lpad(part_of(part), 3, "0") <= "255"))
    if kind == "card":
        return F.when(F.length(digits(match)).between(16, 19), luhn(digits(match))).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits(match)).between(8, 15)
    if kind == "iban":
        return mod_97(match)
    return F.lit(True)


def proposals(kind: str) -> Column:
    """All matches of a kind in column text, each with the number of characters before it that belong to no match."""
    pattern = PATTERNS[kind]
    gaps = F.transform(F.split("text", pattern, -1), lambda gap: F.length(gap))
    matches = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    steps = F.zip_with(matches, gaps, lambda m, gap: F.struct(m.alias("match"), gap.alias("gap")))
    likely = F.col("text").rlike(pattern) if NEEDS[kind] is None else F.contains(F.col("text"), F.lit(NEEDS[kind]))
    return F.when(likely, F.filter(steps, lambda step: step["match"].isNotNull())).otherwise(F.array().cast("array<struct<match:string,gap:int>>"))


def in_blocks(steps: str) -> Column:
    """Places (start, end, match, in code points) of the steps in a column as running sums, block by block, so that many stay cheap."""

    def step_on(state: Column, step: Column) -> Column:
        start = state["at"] + step["gap"]
        end = start + F.length(step["match"])
        return F.struct(end.alias("at"), F.concat(state["found"], F.array(F.struct(start.alias("start"), end.alias("end"), step["match"].alias("match")))).alias("found"))

    def block(number: Column) -> Column:
        return F.aggregate(F.slice(steps, number * BLOCK + 1, BLOCK), F.struct(F.lit(0).alias("at"), F.array().cast(SPANS).alias("found")), step_on)

    def shifted(state: Column, own: Column) -> Column:
        moved = F.transform(own["found"], lambda p: F.struct((p["start"] + state["at"]).alias("start"), (p["end"] + state["at"]).alias("end"), p["match"].alias("match")))
        return F.struct((state["at"] + own["at"]).alias("at"), F.concat(state["found"], F.array(moved)).alias("found"))

    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK).cast("int")), block)
    whole = F.aggregate(blocks, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("found")), shifted, lambda state: F.flatten(state["found"]))
    return F.when(F.size(steps) > 0, whole).otherwise(F.array().cast(SPANS))


def score_of(kind: str, start: Column, end: Column) -> Column:
    """Prior of a kind, lifted where one of its words stands within REACH characters."""
    if kind in BASE:
        return F.lit(1.0)
    near = F.lower(F.substr(F.col("text"), F.greatest(start - REACH, F.lit(0)) + 1, end - start + 2 * REACH))
    return F.least(F.lit(1.0), F.lit(PRIOR[kind]) + F.when(near.rlike(CONTEXT[kind]), LIFT).otherwise(0.0))


def joined(spans: Column) -> Column:
    """kind:start:end of an ordered array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def spans_of(kind: str) -> Column:
    """Confirmed spans of a kind from column raw_<kind>."""
    good = F.filter(f"raw_{kind}", lambda p: confirmed(kind, p["match"]))
    return F.transform(
        good,
        lambda p: F.struct(F.lit(kind).alias("kind"), p["start"].alias("start"), p["end"].alias("end"), p["match"].alias("match"), score_of(kind, p["start"], p["end"]).alias("score")),
    )


def find_pii(docs: DataFrame, least: float = 0.6) -> DataFrame:
    """Per input row: doc_id, n_email, n_ip, n_card, n_phone, base (spans), more (spans of the further kinds).

    A span is a struct kind, start, end, match, score. A further kind never overlaps a base span.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.select("*", *(proposals(kind).alias(f"steps_{kind}") for kind in PATTERNS))
    rows = rows.select("doc_id", "text", *(in_blocks(f"steps_{kind}").alias(f"raw_{kind}") for kind in PATTERNS))
    rows = rows.select("doc_id", "text", *(spans_of(kind).alias(kind) for kind in PATTERNS))
    rows = rows.withColumn("base", F.concat(*BASE))
    further = F.concat(*(kind for kind in PATTERNS if kind not in BASE))
    clear = lambda s: (s["score"] >= least) & ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    rows = rows.withColumn("more", F.filter(further, clear))
    counts = [F.size(kind).cast("bigint").alias(f"n_{kind}") for kind in BASE]
    return rows.select("doc_id", *counts, "base", "more")


def pii_report(docs: DataFrame, least: float = 0.6) -> DataFrame:
    """Per input row: doc_id, counts of the base kinds, base_sha256, spans, max_score of the further kinds."""
    found = find_pii(docs, least)
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone",
        F.sha2(joined(F.col("base")).cast("binary"), 256).alias("base_sha256"), joined(F.concat("base", "more")).alias("spans"),
    )
