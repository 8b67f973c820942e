"""Quality classifier: histogram gradient-boosted trees over statistics of whole texts.

The statistics of a bounded sample of labelled documents (`sample` rows, 160 bytes each) come to the driver, where the
trees grow on binned values. A model is five flat arrays; tasks walk all trees for a batch of rows at once.

Nulls and ties: null text is empty; an empty text has zero statistics and gets the score of such texts. Null ids are scored
and count as held out. Repeated rows get equal scores. Without labelled rows every score is 0.5. Further columns are not
read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.labelled import held_out, training_texts
from riskspark.llm.words import utf8

STATISTICS = (
    "log_words word_bytes log_lines words_per_line longest_word upper punctuation symbols marks bars digits wide_bytes "
    "distinct_words top_word same_as_before repeated_trigrams repeated_lines short_words capital_words byte_entropy"
).split()


def share_of(members: str) -> np.ndarray:
    return np.isin(np.arange(256), list(members.encode()))


UPPER, PUNCTUATION, SYMBOLS = share_of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), share_of(".,;:?'\"()-"), share_of("#*$%&<>@^~=+\\/_{}[]")
MARKS, BARS, DIGITS, WIDE = share_of("!"), share_of("|"), share_of("0123456789"), np.arange(256) >= 128


def statistics(text: bytes) -> list[float]:
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    n, size = len(words), len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    shares = [float(counts[m].sum()) / size for m in (UPPER, PUNCTUATION, SYMBOLS, MARKS, BARS, DIGITS, WIDE)]
    lengths = list(map(len, words))
    tally = Counter(words)
    trigrams = set(zip(words, words[1:], words[2:], strict=False))
    lines = [line for line in text.split(b"\n") if not line.isspace() and line]
    p = counts[counts > 0] / size
    return [
        math.log(n), sum(lengths) / n, math.log(max(len(lines), 1)), n / max(len(lines), 1), math.log(max(lengths)), *shares,
        len(tally) / n, max(tally.values()) / n, sum(map(eq, words, words[1:])) / n, 1 - len(trigrams) / max(n - 2, 1) if n > 2 else 0.0,
        1 - len(set(lines)) / max(len(lines), 1), sum(x <= 3 for x in lengths) / n, sum(w[:1].isupper() for w in words) / n, float(-(p * np.log2(p)).sum()),
    ]


@dataclass
class Trees:
    """All nodes of all trees in flat arrays. A leaf points at itself; values below the cut go left."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def margin(self, rows: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(rows), len(self.roots))).copy()
        line = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            at = np.where(rows[line, self.feature[at]] <= self.cut[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.margin(rows))) if len(rows) else np.zeros(0)


def fit_trees(rows: np.ndarray, labels: np.ndarray, trees: int = 60, depth: int = 4, bins: int = 48, rate: float = 0.15, least: float = 2.0, ridge: float = 1.0) -> Trees:
    """Boosted trees for log loss; splits are chosen on histograms of gradients and curvatures per bin."""
    feature, cut, left, right, value, roots = [], [], [], [], [], []

    def leaf(v: float) -> int:
        feature.append(0), cut.append(0.0), left.append(len(value)), right.append(len(value)), value.append(v)
        return len(value) - 1

    share = float(np.clip(labels.mean() if len(labels) else 0.5, 1e-3, 1 - 1e-3))
    base = math.log(share / (1 - share))
    if len(labels):
        cuts = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1])) for column in rows.T]
        binned = np.stack([np.searchsorted(c, column) for c, column in zip(cuts, rows.T, strict=True)], axis=1)
        width = bins + 1
        offset = np.arange(rows.shape[1]) * width
        margin = np.full(len(labels), base)
        for _ in range(trees):
            chance = 1 / (1 + np.exp(-margin))
            slope, bend = labels - chance, chance * (1 - chance)

            def grow(members: np.ndarray, level: int) -> int:
                g, h = slope[members].sum(), bend[members].sum()
                if level < depth and len(members) >= 2 * least:
                    flat = (binned[members] + offset).ravel()
                    shape = (rows.shape[1], width)
                    gs = np.bincount(flat, np.repeat(slope[members], rows.shape[1]), offset[-1] + width).reshape(shape).cumsum(axis=1)
                    hs = np.bincount(flat, np.repeat(bend[members], rows.shape[1]), offset[-1] + width).reshape(shape).cumsum(axis=1)
                    gain = gs**2 / (hs + ridge) + (g - gs) ** 2 / (h - hs + ridge) - g**2 / (h + ridge)
                    gain[(hs < 1e-3) | (h - hs < 1e-3)] = 0
                    f, b = np.unravel_index(gain.argmax(), shape)
                    if gain[f, b] > 1e-6 and b < len(cuts[f]):
                        low = binned[members, f] <= b
                        one, two = grow(members[low], level + 1), grow(members[~low], level + 1)
                        node = leaf(0.0)
                        feature[node], cut[node], left[node], right[node] = int(f), float(cuts[f][b]), one, two
                        return node
                node = leaf(float(rate * g / (h + ridge)))
                margin[members] += value[node]
                return node

            roots.append(grow(np.arange(len(labels)), 0))
    return Trees(*map(np.array, (feature or [0], cut or [0.0], left or [0], right or [0], value or [0.0], roots or [0])), depth, base)


def measured(docs: DataFrame, extra: str = "") -> DataFrame:
    """doc_id, the statistics of the text as an array, and column `extra` of the input."""
    carried = [extra] if extra else []

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(text) for text in utf8(batch.column("text"))]
            columns = [batch.column("doc_id"), pa.array(rows, pa.list_(pa.float64())), *(batch.column(c) for c in carried)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "statistics", *carried])

    return docs.select("doc_id", "text", *carried).mapInArrow(measure, "doc_id bigint, statistics array<double>" + ", label int" * bool(extra))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = 20_000) -> Trees:
    found = measured(training_texts(docs, labels, label, sample), "label").toPandas().sort_values("doc_id", kind="stable")
    rows = np.array(found["statistics"].tolist(), np.float64).reshape(len(found), len(STATISTICS))
    return fit_trees(rows, found["label"].to_numpy(np.float64))


def score(docs: DataFrame, model: Trees, threshold: float) -> DataFrame:
    """Per input row: doc_id, held_out, score, predicted."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([statistics(text) for text in utf8(batch.column("text"))], np.float64).reshape(batch.num_rows, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.score(rows))], names=["doc_id", "score"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    scored = texts.mapInArrow(of, "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
