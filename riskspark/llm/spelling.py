"""Spelling variants: words one edit apart, and for each word the far more frequent word it is taken to be a variant of.

Dense prefix-suffix tiling. Words of a tile are rows of two matrices of code points, one aligned at the first letter and one
at the last, padded to the longest. For a pair of rows the common prefix is the place of the first difference in the one, the
common suffix that in the other; two words are exactly one edit apart when prefix + suffix reach the longer length minus one
(they are distinct, and their lengths differ by one at most).

Which rows meet: with m the longer length of a pair, cut m places into pieces of two (of m / 64 beyond 128 letters). One edit
leaves all pieces but one as they are, so both words agree in what is before and what is behind one piece. A word of length l
goes to the blocks (m, piece, letters before it, letters behind it) for m = l and m = l + 1. Up to 128 letters at most
(alphabet + 1)^2 words can share a block, with the letters of the default pattern about 8,300, whatever the size of the corpus,
so no block needs to be split. A pair whose edit could be in several pieces is counted only in the piece that holds the end of
its common prefix.

Scale: occurrences are counted per batch of texts inside the tasks, so one row per word and batch travels. Everything after
that works on distinct words. Both directions of a pair are reduced map-side to a count and the best neighbour. Forms lead to
words at least `ratio` times as frequent, so a chain has at most log_ratio(largest n) links; roots are found by doubling.

Nulls, ties, empty tables: a null text has no words; of equally frequent neighbours the first in code-point order wins;
repeated rows count again; an empty table gives an empty result; other columns are ignored. A null doc_id is passed on to
`edit` as None. A long word is a row like any other; only words of one block are padded to a common length.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.words import Powers, mixed, utf8
from riskspark.session import stored

#: Letters of a word; A-Z are lower-cased before.
LETTERS = "A-Za-zÀ-ÿ"
#: Least places of a piece, and most pieces of a word.
PIECE, PIECES = 2, 64
#: Words of up to so many letters share tiles; longer ones are compared block by block.
SHORT = 64
#: Code points a tile may hold in one matrix.
TILE = 1 << 22
#: Distinct words a task counts before it passes them on.
HELD = 200_000


def misspelt(doc_id: int | None, word: str) -> str:
    """`word` without one letter where 31 divides the crc32 of `<doc_id>:<word>`; unchanged where the id is null."""
    if doc_id is None:
        return word
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    if h % 31:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def word_counts(docs: DataFrame, shortest: int = 7, edit: Callable[[int | None, str], str] | None = None) -> DataFrame:
    """word, n of all words of at least `shortest` code points, after `edit` of each."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = re.compile(f"[{LETTERS}]{{{shortest},}}" if edit is None else f"[{LETTERS}]+")
        held: Counter[str] = Counter()

        def flushed() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8(batch.column("text")), strict=True):
                found = Counter(pattern.findall(text.lower().decode(errors="replace")))
                if edit is None:
                    held.update(found)
                else:
                    for word, n in found.items():
                        word = edit(doc_id, word)
                        if len(word) >= shortest:
                            held[word] += n
                if len(held) >= HELD:
                    yield flushed()
        yield flushed()

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(of, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def points(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points one after another, and the lengths of the words."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32), np.fromiter(map(len, words), np.int64, len(words))


def piece_sizes(longer: np.ndarray) -> np.ndarray:
    return np.maximum(PIECE, -(-longer // PIECES))


def blocks(words: DataFrame) -> DataFrame:
    """block, longer, piece, word, n: a row for each block a word goes to. `block` is a hash; tiles compare the letters."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            letters, sizes = points(batch.column("word").to_pylist())
            if not len(sizes):
                continue
            values = mixed(letters.astype(np.uint64) + np.uint64(1))
            ends = np.cumsum(sizes)
            for more in (0, 1):
                longer = sizes + more
                places = piece_sizes(longer)
                count = -(-longer // places)
                row = np.repeat(np.arange(len(sizes)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                before = np.minimum(places[row] * piece, sizes[row])
                behind = np.maximum(longer[row] - places[row] * (piece + 1), 0)
                head = powers.spans(values, ends[row] - sizes[row], ends[row] - sizes[row] + before)
                tail = powers.spans(values, ends[row] - behind, ends[row])
                key = mixed(mixed(head) + (tail ^ (longer[row] * 64 + piece).astype(np.uint64)))
                columns = [pa.array(key.view(np.int64)), pa.array(longer[row], pa.int32()), pa.array(piece, pa.int32())]
                yield pa.RecordBatch.from_arrays([*columns, batch.column("word").take(pa.array(row)), batch.column("n").take(pa.array(row))], names=["block", "longer", "piece", "word", "n"])

    return words.mapInArrow(of, "block bigint, longer int, piece int, word string, n bigint")


def padded(letters: np.ndarray, sizes: np.ndarray, width: int, at_end: bool) -> np.ndarray:
    """One row of code points per word, aligned at its first or its last letter; 0 elsewhere, which no word holds."""
    out = np.zeros((len(sizes), width), np.uint32)
    ends = np.cumsum(sizes)
    row = np.repeat(np.arange(len(sizes)), sizes)
    column = np.arange(len(letters)) - np.repeat(ends - sizes, sizes)
    out[row, column + (width - sizes[row] if at_end else 0)] = letters
    return out


def common(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Number of equal columns before the first that differs, for each row."""
    differ = left != right
    return np.where(differ.any(axis=1), differ.argmax(axis=1), left.shape[1])


def tile_pairs(words: list[str], keys: np.ndarray, longer: np.ndarray, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (a, b) of the pairs one edit apart, of words sorted by block; each pair in one block only."""
    letters, sizes = points(words)
    width = int(sizes.max())
    ahead, back = padded(letters, sizes, width, False), padded(letters, sizes, width, True)[:, ::-1]
    lefts, rights = [], []
    most = max(1, TILE // width)
    for step in range(1, len(words)):
        met = np.flatnonzero((keys[step:] == keys[:-step]) & (longer[step:] == longer[:-step]) & (piece[step:] == piece[:-step]))
        if not len(met):
            break
        met = met[np.maximum(sizes[met], sizes[met + step]) == longer[met]]
        for part in range(0, len(met), most):
            a = met[part : part + most]
            b = a + step
            prefix, suffix = common(ahead[a], ahead[b]), common(back[a], back[b])
            near = (prefix + suffix >= longer[a] - 1) & (prefix < width) & (np.minimum(prefix, longer[a] - 1) // piece_sizes(longer[a]) == piece[a])
            lefts.append(a[near])
            rights.append(b[near])
    nothing = np.zeros(0, np.int64)
    return np.concatenate([nothing, *lefts]), np.concatenate([nothing, *rights])


def near_pairs(words: DataFrame) -> DataFrame:
    """word, n, other, other_n of all pairs of `words` (word, n; distinct) one edit apart, in both directions."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def compared(table: pa.Table) -> pa.RecordBatch:
            names, n = table.column("word").to_pylist(), table.column("n").to_numpy()
            keys, longer, piece = (table.column(c).to_numpy() for c in ("block", "longer", "piece"))
            rows = np.flatnonzero(longer > SHORT)
            parts = [np.flatnonzero(longer <= SHORT), *np.split(rows, np.flatnonzero(np.diff(keys[rows])) + 1)]
            lefts, rights = [], []
            for rows in parts:
                if len(rows) > 1:
                    a, b = tile_pairs([names[i] for i in rows.tolist()], keys[rows], longer[rows], piece[rows])
                    lefts.append(rows[a])
                    rights.append(rows[b])
            one, two = np.concatenate([*lefts, *rights, np.zeros(0, np.int64)]), np.concatenate([*rights, *lefts, np.zeros(0, np.int64)])
            word = pa.array(names, pa.string())
            return pa.RecordBatch.from_arrays([word.take(pa.array(one)), pa.array(n[one]), word.take(pa.array(two)), pa.array(n[two])], names=["word", "n", "other", "other_n"])

        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            keys = rest.column("block").to_numpy()
            if not len(keys) or keys[0] == keys[-1]:
                continue
            cut = int(np.flatnonzero(keys == keys[-1])[0])  # the last block may go on in the next batch
            yield compared(rest.slice(0, cut))
            rest = rest.slice(cut)
        if rest is not None and rest.num_rows > 1:
            yield compared(rest)

    order = ["block", "longer", "piece", "word"]
    return blocks(words).repartition("block").sortWithinPartitions(*order).mapInArrow(of, "word string, n bigint, other string, other_n bigint")


def spelling_groups(
    docs: DataFrame, shortest: int = 7, least: int = 2, ratio: int = 10, edit: Callable[[int | None, str], str] | None = None
) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of at least `shortest` code points and `least` occurrences.

    The form is the most frequent near word, where it is at least `ratio` times as frequent; the root is the end of the
    chain of forms, the word itself where it has none.
    """
    if ratio < 2:
        raise ValueError("forms must be at least twice as frequent, or chains could be circles")
    words = stored(word_counts(docs, shortest, edit).filter(F.col("n") >= least))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = near_pairs(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = words.join(near, "word", "left")
    far = -F.col("best.less") >= ratio * F.col("n")
    found = found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(far, F.col("best.other")).alias("form"), F.when(far, -F.col("best.less")).alias("form_n"))
    found = stored(found)

    step = found.filter("form is not null").select("word", F.col("form").alias("root"))
    largest = words.agg(F.max("n")).first()[0] or 1
    for _ in range(math.ceil(math.log2(max(1, math.log(largest, ratio))))):
        onward = step.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = stored(step.join(onward, "root", "left").select("word", F.coalesce("beyond", "root").alias("root")))
    return found.join(step, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
