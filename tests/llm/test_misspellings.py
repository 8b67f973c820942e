"""Misspelled terms: two edits from nine letters, swaps, and words joined by punctuation."""

import numpy as np
import pytest

from riskspark.llm import toxicity

TERMS = toxicity.SEEDS.split()


def swap_distance(a, b):
    """Edit distance in which a swap of neighbouring letters is one edit."""
    row = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if i * j == 0}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            row[i, j] = min(row[i - 1, j] + 1, row[i, j - 1] + 1, row[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                row[i, j] = min(row[i, j], row[i - 2, j - 2] + 1)
    return row[len(a), len(b)]


def changed(word, rng):
    at, kind = int(rng.integers(0, len(word) - 1)), rng.integers(0, 4)
    return [word[:at] + word[at + 1 :], word[:at] + "q" + word[at:], word[:at] + "z" + word[at + 1 :], word[:at] + word[at + 1] + word[at] + word[at + 2 :]][kind]


def test_matcher_with_swaps_equals_brute_force():
    rng = np.random.default_rng(2)
    words = [changed(t, rng) for t in TERMS for _ in range(6)] + [changed(changed(t, rng), rng) for t in TERMS for _ in range(12)]
    matcher = toxicity.Matcher(TERMS)
    for word in words:
        near = [(d, t) for t in TERMS if (d := swap_distance(word, t)) <= (0 if len(t) < 5 else 1 if len(t) < 9 else 2)]
        assert matcher.nearest(word) == ((min(near)[1], min(near)[0]) if near else None), word


@pytest.mark.parametrize(
    ("text", "terms"),
    [
        ("wrothless", ["worthless"]), ("pahtetic", ["pathetic"]), ("disgsuting", ["disgusting"]), ("wurthles", ["worthless"]), ("idiot's", ["idiot"]), ("idiot’s", ["idiot"]),
        ("(moron,idiot)", ["moron", "idiot"]), ("stupid-idiot", ["stupid", "idiot"]), ("wor*hless", ["worthless"]), ("idi0t", ["idiot"]), ("well-known", []), ("scmu", []),
    ],
)
def test_hits_of_words(text, terms):
    n, hits = toxicity.Scanner(toxicity.Model({t: 1.0 for t in TERMS})).hits(f"you {text} there".encode())
    assert n == 3 and [h[1] for h in hits] == terms and not any(h[3] for h in hits)
