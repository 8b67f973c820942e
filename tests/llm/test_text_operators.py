"""The text operators against brute force on small tables, with nulls, empty and repeated rows and clashing columns."""

import hashlib
import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from riskspark.llm import decontaminate, licenses, line_dedup, packing, pii, quality_model, quality_rules, simhash, substring_dedup, toxicity
from riskspark.llm.queries import ORACLE_SQL, QUERIES

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, words string, hash bigint"
LONG = " ".join(f"word{i}" for i in range(3000))
PASSAGE = " ".join(f"shared{i}" for i in range(60))
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, LONG), (5, LONG), (5, LONG), (None, "null id"), (None, PASSAGE), (6, f"a b {PASSAGE} c"), (7, f"x {PASSAGE}"), (8, "é ñ  |  !!")]


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None, "r", "w", 1) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return table(spark, ODD).cache()


@pytest.fixture(scope="module")
def none(spark):
    return table(spark, [])


@pytest.fixture(scope="module")
def some(spark, small):
    return spark.read.parquet(f"{small}/documents.parquet").cache()


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


def removed_by_brute_force(rows, width=50):
    first = {}
    for doc_id, text in rows:
        words = (text or "").encode().split()
        for s in range(len(words) - width + 1):
            if doc_id is not None:
                key = tuple(words[s : s + width])
                first[key] = min(first.get(key, doc_id), doc_id)
    out = Counter()
    for doc_id, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for s in range(len(words) - width + 1):
            low = first.get(tuple(words[s : s + width]))
            if doc_id is not None and low is not None and low < doc_id:
                gone.update(range(s, s + width))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out[(doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest())] += 1
    return out


def test_substring_dedup(spark, odd, none):
    found = Counter(tuple(r) for r in substring_dedup.drop_repeated_passages(odd).collect())
    assert found == removed_by_brute_force(ODD)
    assert substring_dedup.drop_repeated_passages(none).count() == 0


def test_fingerprints_and_components(spark, odd, none, some):
    rows = [(r["doc_id"], r["text"]) for r in some.collect()]
    got = {r["doc_id"]: r for r in simhash.near_duplicates(some, width=4).collect()}
    prints = {}
    for doc_id, text in rows:
        words = text.encode().lower().split()
        shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        values = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        prints[doc_id] = sum(1 << k for k in range(64) if sum(v >> k & 1 for v in values) * 2 > len(values))
    assert {d: r["fingerprint"] & (2**64 - 1) for d, r in got.items()} == prints
    above = {d: d for d in prints}

    def root(d):
        while above[d] != d:
            d = above[d]
        return d

    for a, b in combinations(sorted(prints), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4:
            a, b = sorted((root(a), root(b)))
            above[b] = a
    assert {d: r["component_id"] for d, r in got.items()} == {d: root(d) for d in prints}
    assert simhash.near_duplicates(odd).count() == len(ODD) and simhash.near_duplicates(none).count() == 0
    kept = simhash.one_per_group(odd)
    assert kept.columns == odd.columns and kept.count() == simhash.near_duplicates(odd).select("root").distinct().count()


@pytest.mark.parametrize("most", [200_000, 20])
def test_trie_join_finds_what_comparing_all_finds(spark, most):
    rng = np.random.default_rng(5)
    prints = set()
    for base in rng.integers(0, 2**63, 60).tolist():
        prints.add(base)
        for _ in range(6):
            for bit in rng.integers(0, 63, rng.integers(1, 6)).tolist():
                base ^= 1 << bit
            prints.add(base)
    above = {p: p for p in prints}

    def root(p):
        while above[p] != p:
            p = above[p]
        return p

    for a, b in combinations(sorted(prints), 2):
        if (a ^ b).bit_count() <= 4:
            a, b = sorted((root(a), root(b)))
            above[b] = a
    nodes = spark.createDataFrame([(p,) for p in prints], "fingerprint bigint")
    found = {p: p for p in prints} | {r["node"]: r["root"] for r in simhash.components(simhash.links(nodes, 4, most)).collect()}
    assert found == {p: root(p) for p in prints}


def test_packing(spark, odd, none, some):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    for docs in (odd, some):
        want = Counter()
        for r in docs.select("doc_id", "text").collect():
            ids = np.array([*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
            want[(r["doc_id"], len(ids))] += 1
        rows = packing.pack(docs).collect()
        pieces = Counter()
        for r in rows:
            pieces[(r["doc_id"], r["start"] + r["length"])] += 1
        assert all(pieces[key] >= n for key, n in want.items())
        bins = {}
        for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
            assert r["offset"] == bins.get(r["sequence_id"], 0)
            bins[r["sequence_id"]] = r["offset"] + r["length"]
        assert max(bins.values()) <= 1024 and len(bins) <= -(-sum(r["length"] for r in rows) // 1024) * 1.02 + 1
    whole = {r["doc_id"]: r for r in rows if r["start"] == 0}
    text = some.filter("doc_id = 7").first()["text"]
    ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], "<u4")
    assert whole[7]["ids_crc32"] == zlib.crc32(ids[: whole[7]["length"]].tobytes())
    assert packing.pack(none).count() == 0


def test_segments_equal_the_tokenizer():
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    segments = packing.Segments(path("byte_bpe_50k.tiktoken"), packing.added_tokens(path("byte_bpe_50k.json")))
    for text in [" ", "a  b", "a \n b", "a\n b c", " x", "x ", "tab\t y", "don't 's x", "é ñ  ", "<|endoftext|> a", "<|endoftext|>", " <|endoftext|><|endoftext|> b c<|endoftext|>  d", "<|endoftext|", "1234 5 , . !! ||  |", "\n\n a", "a\n\n\nb", "a b  c"]:
        assert np.frombuffer(segments.of(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_added_tokens_of_a_text_keep_their_ids(spark):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    text = "one two<|endoftext|> three"
    row = packing.pack(table(spark, [(1, text)])).first()
    ids = np.array([*Tokenizer.from_file(path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids, 2], "<u4")
    assert (row["length"], row["ids_crc32"]) == (len(ids), zlib.crc32(ids.tobytes()))


def test_decontamination(spark, odd, none):
    item = "Once Tom has 5 apples and Anna gives him 7 apples more, how many apples does Tom have after 3 days of eating 2kg each"
    same = item.replace("Tom", "Bob").replace("Anna", "Eve").replace("5", "9").replace("7", "4").replace("3", "6").replace("2kg", "8 kg")
    docs = table(spark, [(1, f"Well. {item} or so"), (2, f"Yes. {same}"), (3, same.replace("does Bob", "does Sue")), (4, "nothing of it at all"), *ODD[:3]])
    bench = spark.createDataFrame([(1, item), (2, None), (3, "too short")], "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]): r["kind"] for r in decontaminate.contaminations(docs, bench).collect()}
    assert found == {(1, 1): "verbatim", (2, 1): "reparameterised"}
    kept = decontaminate.without_contaminated(docs, bench)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == [3, 3, 4]
    assert decontaminate.contaminations(none, bench).count() == 0 and decontaminate.contaminations(docs, bench.limit(0)).count() == 0


def repeated_lines(rows):
    """(doc_id, line number) of the worded lines in pairs of neighbouring worded lines that an earlier place has."""
    first, gone, worded = {}, set(), set()
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        lines = (text or "").split("\n")
        spots = [i for i, line in enumerate(lines) if line.strip(" ")]
        worded |= {(doc_id, i) for i in spots}
        for i, j in zip(spots, spots[1:]):
            key = "\n".join(lines[i : j + 1])
            at = first.setdefault(key, (doc_id, i, j + 1))
            if at[0] != doc_id or i >= at[2]:
                gone |= {(doc_id, n) for n in range(i, j + 1)}
    return gone & worded, worded


def removed_lines(report):
    return {(r["doc_id"], n) for r in report for span in filter(None, r["removed"].split(",")) for n in range(*map(int, span.split("-")))}


def test_line_dedup(spark, odd, none):
    block = "\n".join(f"line number {i} of a shared block" for i in range(40))
    docs = table(spark, [(101, f"head one\n{block}\ntail one"), (102, f"head two\nmore\n{block}\ntail two"), (103, "alone\nand short"), *ODD])
    report = {r["doc_id"]: r for r in line_dedup.line_report(docs).collect()}
    assert report[101]["n_removed"] == 0 and report[102]["n_removed"] == 40 and report[103]["n_removed"] == 0
    clean = line_dedup.without_repeated_lines(docs)
    assert clean.columns == docs.columns and clean.count() == docs.count()
    text = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert text[101] == f"head one\n{block}\ntail one" and text[102] == "head two\nmore\ntail two"
    assert line_dedup.line_report(none).count() == 0


def test_every_repeated_pair_of_lines_is_removed(spark):
    rng = np.random.default_rng(7)
    passages = [[f"p{p} line {i} {rng.integers(10**6)}" for i in range(int(rng.integers(2, 12)))] for p in range(40)]
    rows = []
    for doc in range(200):
        lines = []
        for part in range(int(rng.integers(1, 7))):
            lines += [f"own {doc} {part} {i}" for i in range(int(rng.integers(0, 4)))] + [""] * int(rng.integers(0, 2))
            if rng.random() < 0.5:
                passage = passages[rng.integers(40)]
                low, high = sorted(rng.integers(0, len(passage) + 1, 2))
                lines += passage[low:high] if rng.random() < 0.5 else passage
            if rng.random() < 0.1:
                lines += ["same", "same", "same", " ", "same"]
        rows.append((doc, "\n".join(lines)))
    report = line_dedup.line_report(table(spark, [*rows, *rows[:5]])).collect()
    gone, worded = repeated_lines(rows)
    assert removed_lines(report) & worded == gone and len(gone) > 500
    assert len(report) == 205


def test_repeated_lines_of_the_given_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    gone, worded = repeated_lines(rows)
    found = removed_lines(line_dedup.line_report(docs).collect()) & worded
    assert gone <= found and len(found - gone) <= 0.01 * len(gone)


def test_quality_statistics_and_list(spark, odd, none, some, small):
    for docs in (some, odd):
        for r in quality_rules.judge(docs, []).join(docs.select("doc_id", "text").distinct(), "doc_id").collect():
            text = r["text"] or ""
            words = [w.decode() for w in text.encode().split()]
            windows = list(zip(words, words[1:], words[2:], strict=False))
            count = Counter(windows)
            marked = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
            lines = [x for x in text.split("\n") if x.encode().split()]
            assert (r["n_words"], r["word_chars"], r["n_symbols"]) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)))
            assert (r["n_dup_lines"], r["n_repeat_words"]) == (len(lines) - len(set(lines)), len(marked))
            assert r["base_failed"] == (len(words) < 50 or 100 * len(marked) > 50 * len(words))
    rules = [(quality_rules.Condition("symbol_share", True, 0.3),)]
    kept = quality_rules.keep_good(some, rules)
    assert kept.columns == some.columns and 0 < kept.count() < some.count()
    assert quality_rules.learn(some, labels(spark, [])) == [] and quality_rules.keep_good(none, rules).count() == 0


def test_pii(spark, odd, none):
    text = "mail é a.b@c.de, c_d@e.f.g ip 1.2.3.4 999.1.1.1 card 4785 3805 9239 1139 or 4785380592391138 call +1 (743) 555-3824 now. account GB82 WEST 1234 5698 7654 32"
    found = pii.pii_report(table(spark, [(1, text), *ODD])).filter("doc_id = 1").first()
    spans = [s.split(":") for s in found["spans"].split(",")]
    shown = {(k, text[int(s) : int(e)]) for k, s, e in spans}
    assert {("email", "a.b@c.de"), ("ip", "1.2.3.4"), ("phone", "+1 (743) 555-3824"), ("iban", "GB82 WEST 1234 5698 7654 32")} <= shown
    assert found["n_email"] == 2 and found["n_ip"] == 1 and found["n_phone"] == 1
    assert pii.pii_report(odd).count() == len(ODD) and pii.pii_report(none).count() == 0
    many = " ".join(["x@y.zz"] * 1000)
    places = pii.pii_report(table(spark, [(1, many)])).first()["spans"]
    assert places == ",".join(f"email:{7 * i}:{7 * i + 6}" for i in range(1000))


def license_blocks(text, threshold=0.8):
    """(start, label, share) of every block, from all windows of all notices."""
    words = re.findall("[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+", text)
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words]
    found = []
    for label, notice, must, lack in licenses.NOTICES:
        own = re.findall("[a-z0-9]+", notice.lower())
        width = -(-len(own) * 10 // 8)
        for start, word in enumerate(words):
            block = set(words[start : start + width])
            share = len(block & set(own)) / len(set(own))
            if word in own and share >= threshold - 1e-9 and block >= set(must.split()) and not block & set(lack.split()):
                found.append((start, label, round(share, 9)))
    return sorted(found)


def test_licenses(spark, odd, none):
    texts = [
        ("so it is Released under the MIT License.\nx", "mit"),
        ("Licensed under\nCC BY-NC 4.0", "cc-by-nc"),
        ("licensed under CC BY 4.0", "cc-by"),
        ("the shop is licensed under the city license office", ""),
        ("Licensed under the Apache License, Version 2.0.", "apache"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
        ("licensed under the GNU Lesser General\npublic license", "gpl,lgpl"),  # the phrase is there, so the base label stays
        ("licensed under the GNU Affero general public license", "agpl,gpl"),
        ("Permission is hereby granted, free of charge, to any\n person obtaining a copy of\nthis software and associated documentation files", "mit"),
        ("This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License", "gpl"),
        ("the permission of free people to copy this", ""),
    ]
    rows = {r["doc_id"]: r for r in licenses.license_scan(table(spark, [(i, t) for i, (t, _) in enumerate(texts)])).collect()}
    assert [rows[i]["labels"] for i in range(len(texts))] == [labels for _, labels in texts]
    assert rows[0]["base_labels"] == "mit" and rows[0]["first_word"] == 6 and rows[0]["score"] == 1
    assert rows[1]["base_labels"] == "" and 0.8 <= rows[1]["score"] <= 1
    assert licenses.license_scan(odd).count() == len(ODD) and licenses.license_scan(none).count() == 0


def test_license_blocks_equal_all_windows(spark):
    rng = np.random.default_rng(2)
    notices = [re.findall("[A-Za-z0-9]+", text) for _, text, _, _ in licenses.NOTICES]
    common = "the of a under license public general copy free to mit cc by sa nc lesser".split()
    rows = []
    for i in range(150):
        words = []
        for _ in range(rng.integers(1, 6)):
            own = list(notices[rng.integers(len(notices))])
            for _ in range(rng.integers(0, 5)):
                at = int(rng.integers(len(own)))
                own[at : at + int(rng.integers(0, 2))] = [str(rng.choice(common))]
            words += own + [str(w) for w in rng.choice(common, rng.integers(0, 9))]
        rows.append((i, "\n".join([" ".join(words[at : at + 7]) for at in range(0, len(words), 7)])))
    found = {r["doc_id"]: sorted((b["start"], b["label"], round(b["share"], 9)) for b in r["blocks"]) for r in licenses.license_scan(table(spark, rows)).collect()}
    assert found == {i: license_blocks(text) for i, text in rows}
    assert sum(map(len, found.values())) > 200


@pytest.mark.parametrize("folder", ["sf0.01", "sf0.1"])
def test_license_lines_of_the_given_tables_get_their_label(spark, folder):
    docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
    lines = {
        "Licensed under the Apache License, Version 2.0.": "apache", "Released under the MIT License.": "mit", "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "This work is licensed under the GNU General Public License, version 3.": "gpl", "All rights reserved": "proprietary",
    }
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    rows = licenses.license_scan(docs).filter("labels <> ''").collect()
    for r in rows:
        expected = {label for line, label in lines.items() if line in texts[r["doc_id"]]}
        assert r["labels"] == ",".join(sorted(expected)), r["doc_id"]
    assert {r["doc_id"] for r in rows} == {i for i, t in texts.items() if any(line in t for line in lines)}


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (x != y)))
    return row[-1]


def test_matcher_equals_edit_distance():
    terms = ["idiot", "moron", "pathetic", "disgusting", "scum"]
    matcher = toxicity.Matcher(terms)
    rng = np.random.default_rng(1)
    words = ["".join(rng.choice(list("idotmrnpahecsgux"), rng.integers(1, 11))) for _ in range(300)]
    words += [t[:k] + "x" + t[k + j :] for t in terms for k in range(len(t)) for j in (0, 1)] + [t[:k] + t[k + 1 :] for t in terms for k in range(len(t))] + terms
    for word in words:
        near = [(distance(word, t), t) for t in terms if distance(word, t) <= toxicity.budget(t)]
        assert matcher.nearest(word) == ((min(near)[1], min(near)[0]) if near else None), word


def test_classifiers(spark, odd, none):
    rows = [(i, ("you idi0t worthless moron " if i % 3 == 0 else "kind calm words ") + f"text {i} goes on " * 20 + ("*** $$$ " * 40 if i % 4 == 0 else "")) for i in range(300)]
    docs = table(spark, rows)
    marks = labels(spark, [(i, int(i % 4 != 0), int(i % 3 == 0)) for i, _ in rows])
    for found, truth in (
        (toxicity.score(docs, toxicity.fit(docs, marks)), lambda i: i % 3 == 0),
        (quality_model.score(docs, quality_model.fit(docs, marks), 0.3), lambda i: i % 4 != 0),
    ):
        held = [r for r in found.collect() if r["held_out"]]
        assert held and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in held)
        assert np.mean([r["predicted"] == truth(r["doc_id"]) for r in held]) > 0.95
    empty = labels(spark, [])
    assert toxicity.score(odd, toxicity.fit(odd, empty)).count() == len(ODD) and quality_model.score(odd, quality_model.fit(odd, empty), 0.3).count() == len(ODD)
    assert toxicity.score(none, toxicity.Model({"idiot": 1.0})).count() == 0


def test_pipeline_stages(spark, small):
    import corpus_pipeline

    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, small)
        assert kept.columns == columns and 0 < kept.count() <= docs.count()
        docs = kept
    assert corpus_pipeline.STAGES[-1][1](spark, docs, small).filter(F.col("length") > 1024).count() == 0


def test_every_operator_is_registered():
    assert [sum(name.startswith(f"op{n}_") for name in QUERIES) for n in range(1, 11)] == [1] * 10 and set(ORACLE_SQL) <= set(QUERIES)
