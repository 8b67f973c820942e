"""Removes word passages that an earlier document already has.

Every window of `width` consecutive words has a Rabin-Karp hash. A word goes if it lies in a window whose word sequence
also starts in a document with a smaller doc_id; overlapping repeated windows merge into maximal removal intervals.

The windows are counted in Spark, but most need not travel. Each window chooses the `gram` words with the smallest hash
in it, its anchor. Equal windows choose equal anchors, so a window whose anchor is in one document only cannot repeat.
Neighbouring windows with one anchor form a run. Runs are counted first; only the first copy of a run sends its windows.
Copies of a whole document are found by the digest of their words before all that. Counts are partial before each
shuffle, so a passage or text that fills a third of the table is a few rows per task. Windows and runs are compared by two
64-bit hashes.

Nulls and ties: null text is empty; rows with a null doc_id keep all words and are nobody's earlier document. Rows with
one doc_id do not remove each other's passages. Documents with fewer than `width` words lose nothing. Further columns
of the input are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.words import BASE, Powers, WordHashes, mixed, ragged, utf8
from riskspark.session import stored

#: Base of the second window hash.
SECOND = BASE ^ 0x5555_5555_5555_5554

PROFILE = "doc_id bigint, text_key bigint, n_words bigint, kept_sha256 string, anchors array<bigint>, runs array<bigint>, seconds array<bigint>, starts array<int>"


def digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def key_of(sha256: str) -> int:
    """64 bits of the digest as a signed number."""
    return int.from_bytes(bytes.fromhex(sha256[:16]), "big", signed=True)


def anchors_of(hashes: np.ndarray, powers: Powers, width: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """For each window of `width` words: place and hash of its smallest gram, the leftmost of equals."""
    grams = powers.windows(hashes, gram)
    reach = width - gram + 1
    view = np.lib.stride_tricks.sliding_window_view(grams, reach)
    places = np.empty(len(view), np.int64)
    for at in range(0, len(view), 65536):  # bounds what argmin copies
        places[at : at + 65536] = view[at : at + 65536].argmin(axis=1)
    places += np.arange(len(view))
    return places, grams[places]


def run_starts(places: np.ndarray) -> np.ndarray:
    """First window of every run of windows with one anchor place."""
    return np.flatnonzero(np.diff(places, prepend=-1))


def _profiles(width: int, gram: int):
    def profile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, powers, second = WordHashes(), Powers(), Powers(SECOND)
        for batch in batches:
            counts, digests, anchors, runs, seconds, starts = [], [], [], [], [], []
            for text in utf8(batch.column("text")):
                words = text.split()
                counts.append(len(words))
                digests.append(digest(words))
                if len(words) < width:
                    for kept in (anchors, runs, seconds, starts):
                        kept.append(np.zeros(0, np.int64))
                    continue
                hashes = cache.of(words)
                places, chosen = anchors_of(hashes, powers, width, gram)
                first = run_starts(places)
                last = np.append(first[1:], len(places)) - 1
                anchors.append(chosen[first].view(np.int64))
                runs.append((powers.spans(hashes, first, last + width) + mixed(last - first + 1)).view(np.int64))
                seconds.append(second.spans(mixed(hashes), first, last + width).view(np.int64))
                starts.append(first)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([key_of(d) for d in digests], pa.int64()),
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.string()),
                    ragged(anchors, np.int64),
                    ragged(runs, np.int64),
                    ragged(seconds, np.int64),
                    ragged(starts, np.int32),
                ],
                names=["doc_id", "text_key", "n_words", "kept_sha256", "anchors", "runs", "seconds", "starts"],
            )

    return profile


def _windows(width: int, gram: int):
    """The windows of the listed runs: their two hashes and places."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, powers, second = WordHashes(), Powers(), Powers(SECOND)
        for batch in batches:
            columns: list[list[np.ndarray]] = [[], [], [], [], []]
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(), utf8(batch.column("text")), batch.column("starts").to_pylist(), strict=True)
            for doc_id, text_key, text, listed in rows:
                words = text.split()
                if len(words) < width or key_of(digest(words)) != text_key:
                    continue  # another text under the same doc_id
                hashes = cache.of(words)
                places, _ = anchors_of(hashes, powers, width, gram)
                first = run_starts(places)
                chosen = np.isin(first, listed)
                at = np.flatnonzero(np.repeat(chosen, np.diff(np.append(first, len(places)))))
                one = powers.spans(hashes, at, at + width)
                two = second.spans(mixed(hashes), at, at + width)
                for kept, values in zip(columns, (one, two, np.full(len(at), doc_id), np.full(len(at), text_key), at), strict=True):
                    kept.append(values.view(np.int64))
            flat = [np.concatenate(kept) if kept else np.zeros(0, np.int64) for kept in columns]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v) for v in flat[:4]] + [pa.array(flat[4], pa.int64())], names=["one", "two", "doc_id", "text_key", "place"]
            )

    return windows


def merge_spans(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Maximal intervals of overlapping or touching [start, end)."""
    merged: list[list[int]] = []
    for start, end in sorted(zip(starts, ends, strict=True)):
        if merged and start <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], end)
        else:
            merged.append([start, end])
    return [tuple(m) for m in merged]


def _cut(width: int):
    """Texts with their repeated windows taken out."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("doc_id").to_pylist(), batch.column("text_key").to_pylist(), utf8(batch.column("text")), batch.column("starts").to_pylist(), batch.column("ends").to_pylist(), strict=True)
            out: list[tuple] = []
            for doc_id, text_key, text, starts, ends in rows:
                words = text.split()
                if key_of(digest(words)) != text_key:
                    continue
                spans = merge_spans(starts, ends)
                kept, at = [], 0
                for start, end in spans:
                    kept += words[at:start]
                    at = end
                kept += words[at:]
                out.append((doc_id, text_key, len(words) - len(kept), digest(kept), b" ".join(kept).decode(), [{"start": s, "end": e} for s, e in spans]))
            names = ["doc_id", "text_key", "n_removed", "kept_sha256", "kept_text", "removed"]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)], names=names)

    return cut


def repeated_passages(docs: DataFrame, width: int = 50, gram: int = 12) -> tuple[DataFrame, DataFrame]:
    """A profile per input row, and the removal of each document that loses words.

    Profile: doc_id, text_key, n_words, kept_sha256 (of all words), whole_copy. Removals, one per distinct (doc_id, text_key):
    n_removed, kept_sha256, kept_text, removed (intervals of word numbers). Rows with whole_copy lose every word and have no removal row.
    """
    texts = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    profiles = stored(texts.mapInArrow(_profiles(width, gram), PROFILE))
    whole = profiles.groupBy("kept_sha256").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).filter("first_id < last_id")
    profile = profiles.drop("anchors", "runs", "seconds", "starts").join(whole.drop("last_id"), "kept_sha256", "left")
    profile = profile.withColumn("whole_copy", F.coalesce((F.col("n_words") >= width) & (F.col("doc_id") > F.col("first_id")), F.lit(False))).drop("first_id")

    # One profile for each distinct text of a document; whole copies have nothing that their first document lacks.
    firsts = profiles.filter((F.col("n_words") >= width) & F.col("doc_id").isNotNull()).join(whole, "kept_sha256", "left")
    firsts = firsts.filter("first_id IS NULL OR doc_id = first_id")
    runs = firsts.select(
        "doc_id",
        "text_key",
        F.posexplode("anchors").alias("i", "anchor"),
        F.col("runs"),
        F.col("seconds"),
        F.col("starts"),
        (F.col("n_words") - width + 1).cast("int").alias("n_windows"),
    ).select(
        "doc_id",
        "text_key",
        "anchor",
        F.get("runs", "i").alias("run"),
        F.get("seconds", "i").alias("second"),
        F.get("starts", "i").alias("start"),
        F.coalesce(F.get("starts", F.col("i") + 1), "n_windows").alias("stop"),
    )
    # What is counted is stored before it is joined, so that adaptive execution can split the rows of a hot anchor or run.
    shared = stored(runs.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high").select("anchor"))
    runs = stored(runs.join(shared, "anchor").drop("anchor"))
    first_run = stored(runs.groupBy("run", "second").agg(F.min("doc_id").alias("first_id")))
    runs = stored(runs.join(first_run, ["run", "second"]).withColumn("copied", F.col("doc_id") > F.col("first_id")).drop("run", "second", "first_id"))

    listed = runs.filter("NOT copied").groupBy("doc_id", "text_key").agg(F.collect_list("start").alias("starts"))
    windows = stored(texts.join(listed, "doc_id").mapInArrow(_windows(width, gram), "one bigint, two bigint, doc_id bigint, text_key bigint, place bigint"))
    earliest = windows.groupBy("one", "two").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).filter("low < high").drop("high")
    late = windows.join(earliest, ["one", "two"]).filter("doc_id > low").select("doc_id", "text_key", F.col("place").alias("start"), (F.col("place") + width).alias("end"))
    late = late.unionByName(runs.filter("copied").select("doc_id", "text_key", F.col("start").cast("bigint"), (F.col("stop") - 1 + width).cast("bigint").alias("end")))
    spans = late.groupBy("doc_id", "text_key").agg(F.collect_list("start").alias("starts"), F.collect_list("end").alias("ends"))
    removals = texts.join(spans, "doc_id").mapInArrow(
        _cut(width), "doc_id bigint, text_key bigint, n_removed bigint, kept_sha256 string, kept_text string, removed array<struct<start:bigint,end:bigint>>"
    )
    return profile, removals.dropDuplicates(["doc_id", "text_key"])


def drop_repeated_passages(docs: DataFrame, width: int = 50, gram: int = 12) -> DataFrame:
    """Per input row: doc_id, n_words, n_removed, kept_sha256 of the words left over, joined by one space."""
    profile, removals = repeated_passages(docs, width, gram)
    removals = removals.select("doc_id", "text_key", F.col("n_removed").alias("cut"), F.col("kept_sha256").alias("cut_sha256"))
    joined = profile.join(removals, ["doc_id", "text_key"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return joined.select(
        "doc_id",
        "n_words",
        F.when(F.col("whole_copy"), F.col("n_words")).otherwise(F.coalesce("cut", F.lit(0))).cast("bigint").alias("n_removed"),
        F.when(F.col("whole_copy"), F.lit(nothing)).otherwise(F.coalesce("cut_sha256", "kept_sha256")).alias("kept_sha256"),
    )
