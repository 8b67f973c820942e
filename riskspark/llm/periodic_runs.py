"""Periodic runs: stretches of words that repeat with a period, found by string synchronising sets at dyadic scales.

A run is a stretch of consecutive words with smallest period q, at least max(`least`, 3 q) words long, that no neighbouring
word extends with the same period. All such runs of a text are found; nothing is sampled and no period is left out.

At scale t (8, 16, 32, ...) every window of t words has a hash. Windows whose own period is at most t/3 are set aside. A
position is in the synchronising set when the least hash of the t + 1 windows that begin there is the first or the last one.
So membership depends only on the 2t words that follow, and every 3t - 1 words hold a member unless they lie in a highly
periodic region. A run of period q in [1.5 t, 3 t) therefore has a member i in its first 2q - 2t + 1 places, and i + q is a
member with the same 2t words: pairs of equal contexts q apart propose every such run. Members of equal context are more than
t/3 apart, so a member has a bounded number of partners. Periods below 12, which no scale covers, are found by comparing the
words with themselves shifted by 1 to 11 places; these runs and those of the smaller scales are the highly periodic regions.
Each proposal is extended word by word on exact word numbers, so hashes decide nothing.

Work per scale is linear and only texts of at least 4.5 t words take part in it. A task handles texts one slice of about
SLICE words at a time; a longer text is a slice of its own. There is no shuffle: a lost task is done again by itself.

Nulls, ties, empty tables: a null text has no words; a row is judged by itself, so repeated rows give equal rows; an
empty table gives an empty result; other columns are ignored, whatever their names. Words are cut at 0x20 and 0x09-0x0D.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.words import Powers, mixed, utf8

SLICE = 200_000
FIRST_SCALE = 8
#: Periods that shifted comparisons find; FIRST_SCALE covers those from 12 on.
SHORT = 11
NONE = np.uint64(0xFFFFFFFFFFFFFFFF)

SCHEMA = (
    "doc_id bigint, n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string"
)


def stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of True."""
    edges = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return edges[::2], edges[1::2]


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` consecutive values: block-wise running minima from both sides."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, NONE, np.uint64)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    onward = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:count], onward[width - 1 : width - 1 + count])


def short_runs(words: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """(start, end, period) of the maximal stretches of period 1 to SHORT, three periods and `shortest` words at least."""
    found = []
    for period in range(1, min(SHORT, len(words) - 1) + 1):
        starts, ends = stretches(words[period:] == words[:-period])
        long = ends - starts >= max(shortest, 3 * period) - period
        found += [(s, e + period, period) for s, e in zip(starts[long].tolist(), ends[long].tolist(), strict=True)]
    return found


def members(ids: np.ndarray, scale: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """The synchronising set: `ids` are the hashes of the windows of `scale` words, `runs` all runs of smaller periods."""
    ids = np.where(ids == NONE, NONE - np.uint64(1), ids)
    change = np.zeros(len(ids) + 1, np.int64)
    for start, end, period in runs:
        if 3 * period <= scale <= end - start:
            change[start] += 1
            change[end - scale + 1] -= 1
    ids[np.cumsum(change[:-1]) > 0] = NONE
    if len(ids) <= scale:
        return np.zeros(0, np.int64)
    least = sliding_least(ids, scale + 1)
    return np.flatnonzero((least != NONE) & ((least == ids[: len(least)]) | (least == ids[scale:])))


def proposals(places: np.ndarray, contexts: np.ndarray, low: int, high: int) -> set[tuple[int, int]]:
    """(distance, place) of the pairs of equal contexts whose distance is in [low, high]."""
    order = np.argsort(contexts, kind="stable")
    places, contexts = places[order], contexts[order]
    found = set()
    for step in range(1, len(places)):
        gap = places[step:] - places[:-step]
        near = (contexts[step:] == contexts[:-step]) & (gap <= high)
        if not near.any():
            break
        taken = near & (gap >= low)
        found.update(zip(gap[taken].tolist(), places[:-step][taken].tolist(), strict=True))
    return found


def mismatch(left: np.ndarray, right: np.ndarray) -> int:
    """Number of equal values before the first that differs; looks at ever larger pieces."""
    at, piece = 0, 64
    while at < len(left):
        differ = left[at : at + piece] != right[at : at + piece]
        if differ.any():
            return at + int(differ.argmax())
        at, piece = at + piece, 2 * piece
    return len(left)


def all_runs(words: np.ndarray, shortest: int, ends: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of every maximal stretch of at least three periods and `shortest` words, by start, then period.

    `words` are numbers of texts one after another, each text closed by a number of its own; `ends` are the places of these.
    """
    spread = mixed(words.astype(np.uint64) + np.uint64(1))
    sizes = np.diff(ends, prepend=-1)
    powers, scale = Powers(), FIRST_SCALE
    kept: dict[tuple[int, int], int] = {}

    def keep(runs: list[tuple[int, int, int]]) -> None:
        for start, end, period in runs:
            kept[start, end] = min(period, kept.get((start, end), period))

    keep(short_runs(words, min(shortest, FIRST_SCALE)))
    while (long := sizes > 9 * scale // 2).any():
        # Only the texts that can hold three periods of this scale, put together; `compact` is where a place went.
        inside = np.repeat(long, sizes)
        origin, compact = np.flatnonzero(inside), np.cumsum(inside) - 1
        own, hashes = words[inside], powers.windows(spread[inside], scale)
        known = [(int(compact[s]), int(compact[s]) + e - s, q) for (s, e), q in kept.items() if inside[s]]
        places = members(hashes, scale, known)
        contexts = hashes[places] + mixed(hashes[places + scale])
        reached: dict[int, int] = {}
        found = []
        for gap, place in sorted(proposals(places, contexts, 3 * scale // 2, 3 * scale)):
            if place < reached.get(gap, 0):
                continue
            ahead = mismatch(own[place:-gap], own[place + gap :])
            behind = mismatch(own[:place][::-1], own[gap : place + gap][::-1])
            reached[gap] = place + ahead
            if behind + ahead >= 2 * gap:
                start = int(origin[place - behind])
                found.append((start, start + behind + ahead + gap, gap))
        keep(found)
        scale *= 2
    return sorted((start, end, period) for (start, end), period in kept.items() if end - start >= max(shortest, 3 * period))


def numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all words, a number of its own after each text, and the places of these."""
    known: dict[bytes, int] = {}
    flat = [known.setdefault(word, len(known)) for words in texts for word in words]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1) - 1
    out = np.empty(len(flat) + len(texts), np.int64)
    out[ends] = len(known) + np.arange(len(texts))
    rest = np.ones(len(out), bool)
    rest[ends] = False
    out[rest] = flat
    return out, ends


def stuttered(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a stretch repeated to the end in a tenth of the texts, chosen by crc32 of the id; a null id in none.

    With h the crc32 of the decimal id and g = h // 10: where 10 divides h, word i from a = g % n on is word
    a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8).
    """
    if doc_id is None or not words:
        return words
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    once = words[a : a + p]
    return words[:a] + (once * (-(-(n - a) // p)))[: n - a]


def report(words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    """The columns of a text behind its id; `runs` are (start, length, period)."""
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = words
    if runs:
        dropped = np.zeros(len(words) + 1, np.int64)
        for s, length, q in runs:
            dropped[s + q] += 1
            dropped[s + length] -= 1
        gone = np.cumsum(dropped[:-1]) > 0
        kept = [words[i] for i in np.flatnonzero(~gone).tolist()]
        s, length, q = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]))
        best = (s, length, q, 1000 * length // q)
    else:
        best = (None, None, None, None)
    hashes = hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest()
    return len(words), len(runs), *best, *hashes


def periodic_runs(docs: DataFrame, least: int = 24, edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """Per row: doc_id, n_words, n_runs, the run of greatest length / period (start, length, period, exponent_milli; null
    without runs; ties by start, then period) and SHA-256 of all runs and of the text without repeated periods.

    `edit` changes the words of a text before they are judged.
    """
    names = [part.split()[0] for part in SCHEMA.split(", ")]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, column = batch.column("doc_id").to_pylist(), batch.column("text")
            at = 0
            while at < len(ids):
                texts: list[list[bytes]] = []
                first, total = at, 0
                while at < len(ids) and total < SLICE:
                    words = utf8(column.slice(at, 1))[0].split()
                    texts.append(edit(ids[at], words) if edit else words)
                    total += len(words)
                    at += 1
                flat, ends = numbered(texts)
                found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
                runs = all_runs(flat, least, ends)
                owner = np.searchsorted(ends, [r[0] for r in runs]).tolist()
                for text, (start, end, period) in zip(owner, runs, strict=True):
                    before = int(ends[text - 1]) + 1 if text else 0
                    found[text].append((start - before, end - start, period))
                rows = [(doc_id, *report(words, own)) for doc_id, words, own in zip(ids[first:at], texts, found, strict=True)]
                columns = [pa.array(values, pa.string() if name.endswith("sha256") else pa.int64()) for name, values in zip(names, zip(*rows, strict=True), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(of, SCHEMA)
