import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import rows_of
from riskspark.llm import spelling


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute(rows, shortest=7, least=2, ratio=10, edit=spelling.misspelt):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            word = edit(doc_id, run) if edit else run
            if len(word) >= shortest:
                counts[word] += 1
    counts = {w: n for w, n in counts.items() if n >= least}
    near = {w: [o for o in counts if one_edit(w, o)] for w in counts}
    form = {}
    for w, others in near.items():
        if others:
            other = min(others, key=lambda o: (-counts[o], o))
            if counts[other] >= ratio * counts[w]:
                form[w] = other

    def root(w):
        return root(form[w]) if w in form else w

    return sorted((w, n, len(near[w]), form.get(w), counts.get(form.get(w)), root(w)) for w, n in counts.items())


def texts(rng, size):
    stems = ["".join(rng.choice("abé") for _ in range(rng.randrange(5, 12))) for _ in range(40)]
    for i in range(size):
        words = []
        for _ in range(rng.randrange(80)):
            word = rng.choice(stems[: rng.choice([2, 10, 40])])
            if rng.random() < 0.2:
                at = rng.randrange(len(word) + 1)
                word = word[:at] + rng.choice(["", "x", "ÿ", "A"]) + word[at + rng.randrange(2) :]
            words.append(word)
        yield i, rng.choice([" ", "-", "9"]).join(words)


@pytest.mark.parametrize("edit", [None, spelling.misspelt])
def test_equals_brute_force(spark, edit):
    rows = list(texts(random.Random(3), 150)) + [(7, None), (8, ""), (9, "ÀÉÎÕÜÇÑ àéîõüçñ ÀÉÎÕÜÇÑ À×÷ÿÀÿÀ"), (None, "straight straight straigt")]
    docs = spark.createDataFrame([(*r, "w", 1) for r in rows], "doc_id bigint, text string, word string, n int")
    got = rows_of(spelling.spelling_groups(docs, edit=edit), "word")
    assert got == brute(rows, edit=edit)
    assert sum(r[3] is not None for r in got) > 20


def test_chains_ties_and_repeated_rows(spark):
    chain = {"abcdefgh": 2, "abcdefghi": 20, "abcdefghij": 200, "abcdefghijk": 2000, "abcdefghijkl": 20000, "zbcdefgh": 20}
    rows = [(i, f"{word} " * n) for i, (word, n) in enumerate(chain.items())] * 1
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.word: r for r in spelling.spelling_groups(docs).collect()}
    assert got["abcdefgh"].form == "abcdefghi" and got["abcdefgh"].n_near == 2  # both have 20; the first in code-point order
    assert got["abcdefgh"].root == "abcdefghijkl" and got["abcdefghijkl"].root == "abcdefghijkl"
    assert [tuple(r) for r in sorted(got.values())] == brute(rows, edit=None)
    twice = {r.word: r.n for r in spelling.spelling_groups(docs.union(docs)).collect()}
    assert twice == {word: 2 * n for word, n in chain.items()}


def test_empty_table_and_very_long_words(spark):
    docs = spark.createDataFrame([(1, "q" * 50_000 + " " + "q" * 49_999), (2, "q" * 50_000 + " " + "q" * 49_999)], "doc_id bigint, text string")
    assert spelling.spelling_groups(docs.limit(0)).count() == 0
    got = rows_of(spelling.spelling_groups(docs).selectExpr("length(word)", "n", "n_near", "form"), "n_near", "length(word)")
    assert got == [(49_999, 2, 1, None), (50_000, 2, 1, None)]


def test_a_pair_is_found_in_one_block_only():
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(6, 10))) for _ in range(300)})
    found = Counter()
    for longer in range(6, 11):
        for piece in range(-(-longer // spelling.PIECE)):
            meet = {}
            for w in words:
                if len(w) in (longer, longer - 1):
                    behind = max(longer - spelling.PIECE * (piece + 1), 0)
                    meet.setdefault((w[: spelling.PIECE * piece], w[len(w) - behind :]), []).append(w)
            for own in meet.values():
                size = len(own)
                a, b = spelling.tile_pairs(own, np.zeros(size, np.int64), np.full(size, longer), np.full(size, piece))
                found.update(tuple(sorted((own[i], own[j]))) for i, j in zip(a, b, strict=True))
    assert found == Counter((a, b) for a in words for b in words if a < b and one_edit(a, b))
