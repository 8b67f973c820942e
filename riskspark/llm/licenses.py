"""License scans: an exact set-similarity join of text blocks with license notices, and the places of license phrases.

A block is a window of words that runs across lines: it starts with a word of the notice and has as many words as the notice,
divided by `threshold`, fewer at the end of the text. Both sides are sets of words. A notice matches a block that holds at least
the share `threshold` of its words, all that it `must` hold (what tells it from other licenses) and none that it must `lack`.

The notices' words are ordered by how often the whole corpus uses them, rarest first, and an inverted index holds the first
words of each notice, so many that every match shares one of them (prefix filter). Texts are looked up by these words. Around each
place of one, a notice is skipped if too few of its words stand near (length filter) or too few that come after the shared
word in the order (positional filter); only then the windows are compared. The notices are a fixed list of some dozens, so the
index is part of the task.

Nulls and ties: null text is empty; texts without words have no labels, null first_word and last_word, and score 0. Rows
with null or repeated ids are scanned one by one. Further columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.llm.words import utf8

# Phrases whose places count, and the notices that blocks are compared with, by label.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICES = [
    # label, text, words a block must hold, words it must lack
    ("mit", "released under the MIT license", "mit", ""),
    ("mit", "licensed under the MIT license", "mit", ""),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission granted software", ""),
    ("apache", "licensed under the Apache license version 2.0", "apache", ""),
    ("gpl", "this work is licensed under the GNU general public license version 3", "general public", "lesser affero"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the GNU general public license", "general public", "lesser affero"),
    ("lgpl", "licensed under the GNU lesser general public license", "lesser general public", ""),
    ("agpl", "licensed under the GNU Affero general public license", "affero general public", ""),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution binary permitted", ""),
    ("mpl", "this source code form is subject to the terms of the Mozilla public license", "mozilla", ""),
    ("cc-by", "licensed under CC BY 4.0", "cc by", "sa nc nd"),
    ("cc-by-sa", "licensed under CC BY SA 4.0", "cc by sa", "nc nd"),
    ("cc-by-nc", "licensed under CC BY NC 4.0", "cc by nc", "sa nd"),
    ("cc-by", "licensed under a Creative Commons attribution 4.0 international license", "creative commons attribution", "sharealike noncommercial noderivatives"),
    ("cc0", "dedicated to the public domain under CC0 1.0 universal", "cc0", ""),
    ("proprietary", "all rights reserved", "all rights reserved", ""),
    ("proprietary", "may not be reproduced or distributed without prior written permission", "not reproduced permission", ""),
]

#: Separators become spaces, A-Z small.
WORD_BYTES = bytes(32 if c < 0x30 or 0x3A <= c <= 0x40 or 0x5B <= c <= 0x60 or 0x7B <= c <= 0x7F else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))


Notice = tuple[str, str, str, str]


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class Index:
    """Prefix index of the notices under a global order of their words."""

    def __init__(self, notices: list[Notice], threshold: float, used: dict[bytes, int]):
        texts = [words_of(text.encode()) for _, text, _, _ in notices]
        self.sets = [frozenset(words) for words in texts]
        self.width = [math.ceil(len(words) / threshold - 1e-9) for words in texts]
        self.must = [frozenset(words_of(must.encode())) for _, _, must, _ in notices]
        self.lack = [frozenset(words_of(lack.encode())) for _, _, _, lack in notices]
        order = sorted(set().union(*self.sets), key=lambda w: (used.get(w, 0), w))
        self.rank = {word: at for at, word in enumerate(order)}
        self.need = [math.ceil(threshold * len(s) - 1e-9) for s in self.sets]
        self.heads: dict[bytes, list[int]] = {}
        for number, own in enumerate(self.sets):
            for word in sorted(own, key=self.rank.get)[: len(own) - self.need[number] + 1]:
                self.heads.setdefault(word, []).append(number)
        self.first_words = frozenset(self.heads)

    def matches(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(start, notice, share) of every block of a text that matches."""
        met = self.first_words.intersection(words)
        places: dict[bytes, list[int]] = {}
        if met:
            wanted = frozenset().union(*(self.sets[n] | self.lack[n] for word in met for n in self.heads[word]))
            for at, word in enumerate(words):
                if word in wanted:
                    places.setdefault(word, []).append(at)
        found = []
        for number in sorted({n for word in met for n in self.heads[word]}):
            found += [(start, number, share) for start, share in self.blocks(number, words, places)]
        return found

    def blocks(self, number: int, words: list[bytes], places: dict[bytes, list[int]]) -> Iterator[tuple[int, float]]:
        own, width, need = self.sets[number], self.width[number], self.need[number]
        at = sorted(p for word in own for p in places.get(word, ()))
        barred = sorted(p for word in self.lack[number] for p in places.get(word, ()))
        starts: set[int] = set()
        for word in sorted(own & self.first_words, key=self.rank.get):
            if number not in self.heads[word]:
                continue
            for place in places.get(word, ()):
                near = at[bisect_left(at, place - width + 1) : bisect_left(at, place + width)]
                if len(near) < need or len({words[p] for p in near if self.rank[words[p]] >= self.rank[word]}) < need:
                    continue
                starts.update(p for p in near if p <= place)
        for start in sorted(starts):
            held = {words[p] for p in at[bisect_left(at, start) : bisect_left(at, start + width)]}
            if len(held) >= need and self.must[number] <= held and bisect_left(barred, start) == bisect_left(barred, start + width):
                yield start, len(held) / len(own)


def word_use(docs: DataFrame, notices: list[Notice]) -> dict[bytes, int]:
    """How many documents of the corpus use each word of the notices."""
    wanted = frozenset(w for _, text, _, _ in notices for w in words_of(text.encode()))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used: Counter = Counter()
        for batch in batches:
            for text in utf8(batch.column("text")):
                used.update(wanted.intersection(words_of(text)))
        yield pa.RecordBatch.from_arrays([pa.array(list(used), pa.binary()), pa.array(list(used.values()), pa.int64())], names=["word", "n"])

    counts = docs.select(F.col("text").cast("string")).mapInArrow(count, "word binary, n bigint")
    return {bytes(r["word"]): r["n"] for r in counts.groupBy("word").agg(F.sum("n").alias("n")).collect()}  # one row per word of the notices


def phrase_places(words: list[bytes]) -> list[tuple[int, str]]:
    """Start and label of every place of a phrase."""
    found, at = [], -1
    while True:
        try:
            at = words.index(b"license", at + 1)
        except ValueError:
            return found
        for phrase, label in PHRASES.items():
            parts = phrase.encode().split()
            if at + 1 >= len(parts) and words[at + 1 - len(parts) : at + 1] == parts:
                found.append((at + 1 - len(parts), label))


def license_scan(docs: DataFrame, notices: list[Notice] | None = None, threshold: float = 0.8) -> DataFrame:
    """Per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, blocks.

    blocks: first word, label and share of every matching block and notice. score: 1 where a phrase stands, otherwise the largest share.
    """
    notices = NOTICES if notices is None else notices
    index = Index(notices, threshold, word_use(docs, notices))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("label", pa.string()), ("share", pa.float64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in utf8(batch.column("text")):
                words = words_of(text)
                places = phrase_places(words)
                blocks = [{"start": start, "label": notices[n][0], "share": share} for start, n, share in index.matches(words)]
                base = sorted({label for _, label in places})
                labels = sorted({*base, *(b["label"] for b in blocks)})
                starts = [start for start, _ in places]
                score = 1.0 if places else max((b["share"] for b in blocks), default=0.0)
                rows.append((len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(base), ",".join(labels), score, blocks))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), kind]
            names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "blocks"]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=["doc_id", *names])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(
        scan,
        "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double, "
        "blocks array<struct<start:bigint,label:string,share:double>>",
    )
