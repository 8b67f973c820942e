import hashlib
import random

import numpy as np
import pytest
from helpers import rows_of
from riskspark.llm import periodic_runs as pr


def brute(words, least):
    """Every run, from all periods and all places."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 3 * q) and j > i:
                found.setdefault((i, j + q - i), q)
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def fast(texts, least):
    flat, ends = pr.numbered([[w.encode() for w in t] for t in texts])
    out = [[] for _ in texts]
    for s, e, q in pr.all_runs(flat, least, ends):
        text = int(np.searchsorted(ends, s))
        out[text].append((s - (int(ends[text - 1]) + 1 if text else 0), e - s, q))
    return [sorted(o) for o in out]


def samples(rng):
    yield []
    yield ["a"] * 24
    yield ["a"] * 23
    yield list("ab" * 40 + "c" + "ab" * 40) * 3
    yield ["a"] * 100 + ["b"] + ["a"] * 100 + ["b"] + ["a"] * 100 + ["b"] + ["a"] * 20
    yield (["a"] * 20 + ["b"]) * 4 + ["c"] + (["a"] * 20 + ["b"]) * 3
    one, two = ["a"], ["a", "b"]
    for _ in range(11):  # Fibonacci words: as many runs as a text can have
        one, two = two, two + one
    yield two
    thue = [0]
    for _ in range(7):
        thue += [1 - x for x in thue]
    yield [str(x) for x in thue] * 3
    for _ in range(120):
        size = rng.choice([30, 80, 300])
        letters = rng.choice([1, 2, 3, 50])
        words = [str(rng.randrange(letters)) for _ in range(size)]
        for _ in range(rng.randrange(4)):
            at, period = rng.randrange(size), 1 + rng.randrange(size // 3)
            times = rng.randrange(2, 6)
            words[at:at] = words[at : at + period] * times
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = "x"
        yield words


@pytest.mark.parametrize("least", [1, 24, 60])
def test_all_runs_equal_brute_force(least):
    texts = list(samples(random.Random(5)))
    assert fast(texts, least) == [brute(t, least) for t in texts]
    assert [fast([t], least)[0] for t in texts[:20]] == [brute(t, least) for t in texts[:20]]


def test_synchronising_set_is_consistent_and_dense():
    rng = random.Random(6)
    words = np.array([rng.randrange(2) for _ in range(2000)])
    scale = 16
    runs = [(s, e, q) for s, e, q in pr.all_runs(np.append(words, 9), 1, np.array([len(words)]))]
    hashes = pr.Powers().windows(pr.mixed(words.astype(np.uint64) + np.uint64(1)), scale)
    inside = set(pr.members(hashes, scale, runs).tolist())
    seen = {}
    for i in range(len(words) - 2 * scale + 1):
        context = words[i : i + 2 * scale].tobytes()
        assert seen.setdefault(context, i in inside) == (i in inside)
    periodic = set()
    for s, e, q in runs:
        if 3 * q <= scale:
            periodic.update(range(s, e - 3 * scale + 2))
    for i in range(len(words) - 3 * scale + 2):
        assert i in periodic or any(j in inside for j in range(i, i + scale))


def expected(doc_id, text, least=24):
    words = pr.stuttered(doc_id, (text or "").encode().split())
    runs = brute(words, least)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else None
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    text = b" ".join(w for i, w in enumerate(words) if i not in gone)
    hashes = (hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(text).hexdigest())
    return (doc_id, len(words), len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, *hashes)


def test_rows(spark):
    rng = random.Random(8)
    rows = [(i, " ".join(rng.choice("abcdefgh") * rng.randrange(1, 3) for _ in range(rng.randrange(1, 200))), "x") for i in range(200)]
    rows += [(1000, None, "x"), (1001, "", None), (1002, " \t\n\v\f\r ", "x"), (1003, "na " * 900, "x"), (1003, "na " * 900, "x")]
    rows += [(1004, "a b " * 30, "x"), (1005, " ".join(map(str, range(600))) * 4, "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, start string")
    got = rows_of(pr.periodic_runs(docs, 24, pr.stuttered), "doc_id")
    assert got == [expected(i, text) for i, text, _ in sorted(rows, key=lambda r: r[0])]
    assert sum(r[2] for r in got) > 15
    null_id = spark.createDataFrame([(None, "la " * 30)], "doc_id bigint, text string")
    assert rows_of(pr.periodic_runs(null_id, 24, pr.stuttered), "doc_id")[0][:7] == (None, 30, 1, 0, 30, 1, 30000)
    assert pr.periodic_runs(docs.limit(0)).count() == 0


def test_a_slice_ends_anywhere(spark, monkeypatch):
    monkeypatch.setattr(pr, "SLICE", 50)
    rows = [(i, "a b c " * (i % 30)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    assert rows_of(pr.periodic_runs(docs, 24, pr.stuttered), "doc_id") == [expected(*r) for r in rows]
