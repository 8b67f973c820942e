"""Finds benchmark questions in documents, also where their numbers, names or units were exchanged.

Both sides become templates: words lose their outer punctuation and case, numbers become `<num>`, a word with a
capital inside a sentence `<name>`, a unit after a number `<unit>`. Windows of `width` template words are hash-joined.
Window hits of one document and item that lie on one diagonal form an alignment; its runs and coverage are measured,
and its slots are compared: each value of the item must stand for one value of the document throughout, and the other
way round. A document is contaminated by an item if a consistent alignment has a run of `run` words (the whole item if
it is shorter) or covers the share `coverage` of the item.

Documents are not shuffled. A bit map of fixed size, made of all item windows in Spark, keeps windows that cannot match
from leaving the scan; what passes is joined exactly, by hash and by template text, whatever the number of items.

Nulls and ties: null and empty texts match nothing. Items with fewer than `least` template words match nothing; those
with fewer than `width` are windows of their own length. A null doc_id is reported as null. Repeated rows give one
result. Further columns are not read. Empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskspark.llm.words import Powers, mixed, utf8
from riskspark.session import stored

MAP_BITS = 24

# Units that follow a number, and numbers in words.
UNITS = (
    "% percent mm cm m km inch inches ft feet foot yard yards mile miles mg g kg gram grams kilogram kilograms ton tons oz lb lbs pound pounds "
    "ml l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
    "hz khz mhz ghz v w kw mw j kj cal kcal c f k celsius fahrenheit mph kmh usd eur gbp dollar dollars euro euros cent cents kb mb gb tb"
)
NUMBERS = "zero two three four five six seven eight nine ten eleven twelve thirteen fifteen twenty thirty forty fifty sixty hundred thousand million"

LITERAL, NUM, NAME, UNIT = range(4)
PLACEHOLDERS = {NUM: "<num>", NAME: "<name>", UNIT: "<unit>"}
OUTER = b"!\"#&'()*+,-./:;<=>?@[\\]^_`{|}~"
MIXED = re.compile(rb"[0-9][%A-Za-z]")
GLUED = re.compile(rb"(?<=\d)(?=(?:%|[A-Za-z]{1,4})(?![A-Za-z\d]))")

HIT = "place int, hash bigint, template string, slots array<string>"
CHUNK_BYTES = 1 << 17


def marked(members: bytes) -> np.ndarray:
    table = np.zeros(256, np.int32)
    table[list(members)] = 1
    return table


SPACE, OUTSIDE, STOP, DIGITS = marked(b" \t\n\x0b\x0c\r"), marked(OUTER + b" \t\n\x0b\x0c\r"), marked(b".!?:"), marked(b"0123456789")
NUMERAL = marked("0123456789.,:/$€£".encode())
#: Bytes of the character that a byte begins.
CHARACTER = np.array([1] * 192 + [2] * 32 + [3] * 16 + [4] * 16)
BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def lowered(text: bytes) -> bytes:
    """Lower case of the same number of bytes; the few characters whose case changes their length stay."""
    word = text.decode()
    lower = word.lower().encode()
    if len(lower) == len(text):
        return lower
    return b"".join(low if len(low := c.lower().encode()) == len(raw := c.encode()) else raw for c in word)


def among(values: np.ndarray, few: np.ndarray) -> np.ndarray:
    """Whether each value is in the sorted `few`."""
    return few[np.searchsorted(few, values) % len(few)] == values


class Templates:
    """Template words of some texts, as flat arrays: document, kind, hash, and where the lower-cased word lies."""

    powers = Powers()

    def __init__(self, texts: list[bytes]):
        texts = [GLUED.sub(b" ", text) if MIXED.search(text) else text for text in texts]
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        self.lower = b"\n".join(map(lowered, texts)) + b"\n"
        low = np.frombuffer(self.lower, np.uint8)
        white = SPACE[raw]
        start = np.flatnonzero(np.diff(white, prepend=1) == -1)
        end = np.flatnonzero(np.diff(white, prepend=1) == 1)
        end = end[len(end) - len(start) :]
        inner = np.flatnonzero(OUTSIDE[raw] == 0)
        first, last = np.searchsorted(inner, start), np.searchsorted(inner, end) - 1
        stops = np.append(0, np.cumsum(STOP[raw]))
        worded = first <= last
        body_end = np.where(worded, inner[np.maximum(last, 0)] + 1 if len(inner) else 0, start)
        ends = stops[end] > stops[body_end]
        text_starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
        doc = np.searchsorted(text_starts, start, "right") - 1
        opens = np.append(True, ends[:-1] | (np.diff(doc) != 0)) if len(doc) else np.zeros(0, bool)

        self.start, self.end, self.doc, opens = inner[first[worded]], body_end[worded], doc[worded], opens[worded]
        self.value = self.powers_of(low, self.start, self.end)
        cased = np.append(0, np.cumsum(raw != low, dtype=np.int32))
        letter = np.minimum(self.start + CHARACTER[raw[self.start]], self.end)
        titled = (cased[letter] > cased[self.start]) & (cased[self.end] == cased[letter]) & (letter < self.end)
        digits, numeral = (np.append(0, np.cumsum(table[raw], dtype=np.int32)) for table in (DIGITS, NUMERAL))
        number = (digits[self.end] > digits[self.start]) & (numeral[self.end] - numeral[self.start] == self.end - self.start)
        number |= among(self.value, NUMBER_VALUES)
        unit = among(self.value, UNIT_VALUES) & np.append(False, number[:-1])[: len(number)] & ~number
        unit &= np.append(False, np.diff(self.doc) == 0)[: len(unit)]
        self.kind = np.select([number, unit, titled & ~opens], [NUM, UNIT, NAME], LITERAL).astype(np.int8)
        for kind, mark in MARKS.items():
            self.value[self.kind == kind] = mark

    @classmethod
    def powers_of(cls, low: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return cls.powers.spans(BYTE_VALUES[low], start, end)

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of the windows within one text that have at least as many words as placeholders."""
        hashes = self.powers.windows(self.value, width)
        slots = np.append(0, np.cumsum(self.kind != LITERAL))
        at = np.flatnonzero((2 * (slots[width:] - slots[:-width]) <= width) & (self.doc[width - 1 :] == self.doc[: len(hashes)])) if len(hashes) else np.zeros(0, np.int64)
        return at, hashes[at]

    def places(self, at: np.ndarray) -> np.ndarray:
        """Number within its text of each word in `at`."""
        return at - np.searchsorted(self.doc, self.doc[at])

    def window(self, at: int, width: int) -> tuple[str, list[str]]:
        words = [self.lower[s:e].decode() for s, e in zip(self.start[at : at + width], self.end[at : at + width], strict=True)]
        kinds = self.kind[at : at + width]
        return " ".join(PLACEHOLDERS.get(k, w) for k, w in zip(kinds, words, strict=True)), [w for k, w in zip(kinds, words, strict=True) if k != LITERAL]


def values_of(words: str) -> np.ndarray:
    text = words.encode()
    ends = np.cumsum([len(w) + 1 for w in text.split()]) - 1
    return Templates.powers_of(np.frombuffer(text, np.uint8), np.append(0, ends[:-1] + 1), ends)


NUMBER_VALUES, UNIT_VALUES = np.sort(values_of(NUMBERS)), np.sort(values_of(UNITS))
MARKS = {kind: values_of(text)[0] for kind, text in PLACEHOLDERS.items()}


def chunks(batch: pa.RecordBatch, key: str) -> Iterator[tuple[list, Templates]]:
    """Keys and templates of the rows, some texts at a time."""
    keys, texts, size = [], [], 0
    for value, text in zip(batch.column(key).to_pylist(), utf8(batch.column("text")), strict=True):
        keys.append(value)
        texts.append(text)
        size += len(text)
        if size >= CHUNK_BYTES:
            yield keys, Templates(texts)
            keys, texts, size = [], [], 0
    if keys:
        yield keys, Templates(texts)


def item_windows(benchmark: DataFrame, width: int, least: int) -> DataFrame:
    """item_id, n_words (of the template), width, place, hash, template, slots of every window of every item."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for item_id, text in zip(batch.column("item_id").to_pylist(), utf8(batch.column("text")), strict=True):
                template = Templates([text])
                size = len(template.kind)
                wide = min(width, size)
                if wide >= least:
                    for at, value in zip(*template.windows(wide), strict=True):
                        rows.append((item_id, size, wide, int(at), int(value.view(np.int64)), *template.window(at, wide)))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.string())]
            names = ["item_id", "n_words", "width", "place", "hash", "template", "slots"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    items = benchmark.select(F.col("item_id").cast("bigint"), F.col("text").cast("string"))
    return items.mapInArrow(cut, f"item_id bigint, n_words int, width int, {HIT}")


def bit_map(items: DataFrame, bits: int = MAP_BITS) -> bytes:
    """2**bits bits, one set for every window hash; gathered as at most 2**(bits - 6) numbers."""
    slot = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    words = items.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(F.expr(f"shiftleft(1L, CAST((hash & {(1 << bits) - 1}) & 63 AS INT))")).alias("set"))
    found = np.zeros(1 << (bits - 6), np.int64)
    for row in words.toLocalIterator():
        found[row["word"]] = row["set"]
    return found.tobytes()


def document_windows(docs: DataFrame, widths: list[int], bits: bytes) -> DataFrame:
    """doc_id, width, place, hash, template, slots of the windows whose bit is set."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(bits)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.frombuffer(shared.value, np.uint64)
        mask = np.uint64(len(words) * 64 - 1)
        for batch in batches:
            rows = []
            for doc_ids, template in chunks(batch, "doc_id"):
                for width in widths:
                    at, hashes = template.windows(width)
                    slot = hashes & mask
                    hit = (words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
                    at, hashes = at[hit], hashes[hit].view(np.int64)
                    for first, place, value in zip(at.tolist(), template.places(at).tolist(), hashes.tolist(), strict=True):
                        rows.append((doc_ids[template.doc[first]], width, place, value, *template.window(first, width)))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["doc_id", "width", "place", "hash", "template", "slots"])

    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return texts.mapInArrow(cut, f"doc_id bigint, width int, {HIT}")


def contaminations(docs: DataFrame, benchmark: DataFrame, width: int = 8, run: int = 13, coverage: float = 0.6, least: int = 4) -> DataFrame:
    """One row per contaminated document and item, with its best alignment.

    doc_id, item_id, kind (verbatim or reparameterised), run_words, coverage, n_windows, n_slots, n_changed.
    """
    items = stored(item_windows(benchmark, width, least).distinct())
    widths = sorted(r["width"] for r in items.select("width").distinct().toLocalIterator())  # at most `width` of them
    found = document_windows(docs, widths, bit_map(items)).withColumnsRenamed({"place": "at", "slots": "doc_slots"})
    hits = found.join(items.withColumnRenamed("slots", "item_slots"), ["hash", "template", "width"]).drop("hash", "template")
    hits = hits.withColumn("diagonal", F.col("at") - F.col("place")).drop("at").distinct()

    key = ["doc_id", "item_id", "diagonal"]
    order = Window.partitionBy(*key).orderBy("place")
    runs = hits.withColumn("run", F.col("place") - F.row_number().over(order))
    runs = runs.withColumn("gained", F.least("width", F.coalesce(F.col("place") - F.lag("place").over(order), "width")))
    runs = runs.groupBy(*key, "run").agg(
        F.count("*").alias("n"), (F.count("*") - 1 + F.max("width")).alias("run_words"), F.sum("gained").alias("covered"), F.max("n_words").alias("n_words"),
        F.collect_set(F.when(F.size("item_slots") > 0, F.arrays_zip("item_slots", "doc_slots"))).alias("pairs"),
    )
    whole = runs.groupBy(*key).agg(
        F.sum("n").alias("n_windows"), F.max("run_words").alias("run_words"), (F.sum("covered") / F.max("n_words")).alias("coverage"),
        F.max("n_words").alias("n_words"), F.array_distinct(F.flatten(F.flatten(F.collect_list("pairs")))).alias("pairs"),
    )
    whole = whole.withColumn("n_slots", F.size("pairs")).withColumn("n_changed", F.size(F.filter("pairs", lambda p: p["item_slots"] != p["doc_slots"])))
    one_to_one = F.array_min(F.array(F.size(F.array_distinct("pairs.item_slots")), F.size(F.array_distinct("pairs.doc_slots")))) == F.col("n_slots")
    long = (F.col("run_words") >= F.least(F.lit(run), "n_words")) | (F.col("coverage") >= coverage)
    good = whole.filter(one_to_one & long)
    best = good.groupBy("doc_id", "item_id").agg(F.max(F.struct("run_words", "coverage", "n_windows", -F.col("n_changed"), "n_slots", "n_changed")).alias("b"))
    return best.select(
        "doc_id", "item_id", F.when(F.col("b.n_changed") > 0, "reparameterised").otherwise("verbatim").alias("kind"), F.col("b.run_words").cast("int").alias("run_words"),
        F.col("b.coverage").alias("coverage"), F.col("b.n_windows").alias("n_windows"), F.col("b.n_slots").alias("n_slots"), F.col("b.n_changed").alias("n_changed"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """`docs`, all columns, without the documents that `contaminations` names; rows with a null doc_id share one fate."""
    named = contaminations(docs, benchmark, **options).select(F.col("doc_id").alias("contaminated_id")).distinct()
    return docs.join(named, F.col("doc_id").cast("bigint").eqNullSafe(F.col("contaminated_id")), "left_anti")
