"""Removes line chunks that an earlier place of the corpus already has. Built of DataFrame functions only.

A cyclic-polynomial rolling hash over the hashes of neighbouring lines chooses where a chunk ends, so an inserted line moves
only the boundaries next to it. Chunks of two or more lines with a word that occur again anywhere are compared byte by
byte with their first occurrence, and equal ones are removed. First is the smallest doc_id, then the first place.

A passage need not hold a whole chunk, and its edges are seldom boundaries. So what is left is cut once more, into the smallest
chunks there are: every two neighbouring lines with a word (and the blank lines between). Later copies of a repeated chunk do
not send theirs, as the first copy does. With both, every line of a passage of two worded lines or more that an
earlier place has is removed. A chunk that overlaps its first occurrence in the same text stays.

Only hashes and places travel for the counts, pre-aggregated per task. Texts travel once to take out the repeated chunks
and once to be written without them.

Nulls and ties: null text has no lines and stays null. A null doc_id comes after all others. Rows that repeat both doc_id
and text share one fate: they are one place. Single lines and blank chunks are never removed. All columns of the input
pass through, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.session import stored


def line_hashes(lines: Column) -> Column:
    return F.transform(lines, lambda line: F.xxhash64(line))


def rotated(value: Column) -> Column:
    return F.shiftleft(value, 1).bitwiseOR(F.shiftrightunsigned(value, 63))


def chunk_starts(hashes: Column, mean_lines: int) -> Column:
    """Numbers of the lines that begin a chunk; the hash of the two lines before decides. mean_lines: a power of two."""

    def begins(_: Column, at: Column) -> Column:
        rolling = rotated(rotated(F.get(hashes, at - 2)).bitwiseXOR(F.get(hashes, at - 1)))
        return (at == 0) | F.coalesce(rolling.bitwiseAND(F.lit(mean_lines - 1)) == 0, F.lit(False))

    numbers = F.transform(hashes, lambda _, at: at)
    return F.filter(numbers, begins)


def profiles(rows: DataFrame, mean_lines: int) -> DataFrame:
    """doc_id, text_key, hashes of the lines, spots (numbers of the lines with a word) and chunks with two or more of them."""
    lines = rows.filter("text IS NOT NULL").select("doc_id", "text_key", F.split("text", "\n", -1).alias("lines"))
    worded = F.transform("lines", lambda line: (F.trim(line) != "").cast("int"))
    lines = lines.select("doc_id", "text_key", line_hashes(F.col("lines")).alias("hashes"), worded.alias("worded"))
    numbers = F.transform("worded", lambda has, at: F.when(has == 1, at))
    starts = lines.withColumn("starts", chunk_starts(F.col("hashes"), mean_lines)).withColumn("spots", F.array_compact(numbers))
    each = F.transform("starts", lambda start, at: F.struct(start.alias("start"), F.coalesce(F.get("starts", at + 1), F.size("hashes")).alias("stop")))
    words = lambda c: F.aggregate(F.slice("worded", c["start"] + 1, c["stop"] - c["start"]), F.lit(0), lambda a, b: a + b)
    return starts.select("doc_id", "text_key", "hashes", "spots", F.filter(each, lambda c: words(c) > 1).alias("chunks")).filter(F.size("spots") > 1)


def hashed(found: DataFrame, kind: int) -> DataFrame:
    """doc_id, text_key, start, stop, hash of the spans in column `spans`; `kind` keeps hashes of different cuts apart."""
    each = found.select("doc_id", "text_key", "hashes", F.explode("spans").alias("span"))
    part = F.slice("hashes", F.col("span.start") + 1, F.col("span.stop") - F.col("span.start"))
    return each.select("doc_id", "text_key", "span.*", F.xxhash64(part, F.lit(kind)).alias("hash"))


def repeats(found: DataFrame) -> DataFrame:
    """The places of what occurs more than once, with is_first, and is_apart where a later place does not overlap the first."""
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_key", "start", "stop")
    repeated = stored(found.groupBy("hash").agg(F.min(place).alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n"))
    listed = found.join(repeated, "hash").withColumn("is_first", place == F.col("first"))
    own = (F.col("text_key") == F.col("first.text_key")) & F.col("doc_id").eqNullSafe(F.col("first.doc_id"))
    return listed.withColumn("is_apart", ~own | (F.col("start") >= F.col("first.stop"))).drop("first")


def merged(spans: DataFrame) -> DataFrame:
    """doc_id, text_key, removed: the spans of each text in order, those that overlap or touch made one."""
    before = Window.partitionBy("doc_id", "text_key").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    begins = spans.withColumn("begins", F.coalesce((F.col("start") > F.max("stop").over(before)).cast("int"), F.lit(1)))
    upto = Window.partitionBy("doc_id", "text_key").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, 0)
    islands = begins.withColumn("island", F.sum("begins").over(upto)).groupBy("doc_id", "text_key", "island")
    islands = islands.agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return islands.groupBy("doc_id", "text_key").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("removed"))


def dedup_lines(docs: DataFrame, mean_lines: int = 4) -> DataFrame:
    """Columns `row` (the input row as a struct), lines, removed (array of start and stop), kept_text."""
    rows = docs.select(F.struct("*").alias("row"))
    rows = rows.withColumn("doc_id", F.col("row.doc_id")).withColumn("text", F.col("row.text").cast("string")).withColumn("text_key", F.xxhash64("text"))
    keyed = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", "text_key")
    place = ["doc_id", "text_key"]
    known = stored(profiles(keyed, mean_lines).dropDuplicates(place))
    long = stored(repeats(hashed(known.withColumn("spans", F.col("chunks")), 0)))

    numbers = F.sequence(F.lit(0), F.size("spots") - 2)
    pairs = F.transform(numbers, lambda at: F.struct(F.get("spots", at).alias("start"), (F.get("spots", at + 1) + 1).alias("stop")))
    copied = long.filter("NOT is_first AND is_apart").select(
        F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key"), F.col("stop").alias("end"), F.explode(F.sequence("start", F.col("stop") - 2)).alias("at")
    )
    inside = (F.col("text_key") == F.col("of_key")) & F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("start") == F.col("at")) & (F.col("stop") <= F.col("end"))
    short = repeats(stored(hashed(known.withColumn("spans", pairs), 1).join(copied, inside, "left_anti")))
    listed = long.unionByName(short).groupBy(*place).agg(F.collect_set(F.struct("start", "stop", "hash", "is_first", "is_apart")).alias("chunks"))
    listed = listed.select(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key"), "chunks")

    texts = keyed.join(listed, (F.col("text_key") == F.col("of_key")) & F.col("doc_id").eqNullSafe(F.col("of_id"))).dropDuplicates(place)
    texts = texts.select(*place, F.split("text", "\n", -1).alias("lines"), F.explode("chunks").alias("c"))
    texts = stored(texts.select(*place, "c.*", F.array_join(F.slice("lines", F.col("c.start") + 1, F.col("c.stop") - F.col("c.start")), "\n").alias("bytes")))
    firsts = stored(texts.filter("is_first").select("hash", F.col("bytes").alias("first_bytes")).distinct())
    gone = merged(texts.filter("NOT is_first AND is_apart").join(firsts, "hash").filter("bytes = first_bytes").select(*place, "start", "stop"))
    gone = gone.select(F.col("doc_id").alias("of_id"), F.col("text_key").alias("of_key"), "removed")

    joined = rows.join(gone, (F.col("text_key") == F.col("of_key")) & F.col("doc_id").eqNullSafe(F.col("of_id")), "left")
    joined = joined.select("row", "text", F.coalesce("removed", F.array().cast("array<struct<start:int,stop:int>>")).alias("removed"))
    cut = joined.withColumn("lines", F.split("text", "\n", -1))
    froms = F.concat(F.array(F.lit(0)), F.col("removed.stop"))
    tos = F.concat(F.col("removed.start"), F.array(F.size("lines")))
    kept = F.flatten(F.zip_with(froms, tos, lambda start, stop: F.slice("lines", start + 1, stop - start)))
    return cut.withColumn("kept_text", F.when(F.size("removed") == 0, F.col("text")).otherwise(F.array_join(kept, "\n"))).drop("text")


def line_report(docs: DataFrame, mean_lines: int = 4) -> DataFrame:
    """Per input row: doc_id, n_lines, n_removed, n_chunks (removed stretches), removed (start-stop, comma-joined), kept_sha256."""
    found = dedup_lines(docs, mean_lines)
    gone = F.aggregate("removed", F.lit(0).cast("bigint"), lambda a, c: a + c["stop"] - c["start"])
    return found.select(
        F.col("row.doc_id").cast("bigint").alias("doc_id"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("bigint").alias("n_lines"),
        gone.alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_chunks"),
        F.array_join(F.transform("removed", lambda c: F.concat_ws("-", c["start"], c["stop"])), ",").alias("removed"),
        F.sha2(F.coalesce("kept_text", F.lit("")).cast("binary"), 256).alias("kept_sha256"),
    )


def without_repeated_lines(docs: DataFrame, mean_lines: int = 4) -> DataFrame:
    """`docs` with the repeated chunks taken out of `text`; n_chars follows where the input has it."""
    found = dedup_lines(docs, mean_lines)
    changed = {"text": F.col("kept_text"), "n_chars": F.when(F.size("removed") > 0, F.length("kept_text").cast("bigint")).otherwise(F.col("row.n_chars")) if "n_chars" in docs.columns else None}
    return found.select(*(changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))
