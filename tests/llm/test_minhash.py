"""Min-max hashing against all pairs of exact shingle sets."""

import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from rides.llm import minhash, text_hash
from rides.llm.graph import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text, k):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    w = WORD.findall(low)
    if not w:
        return set()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)}


def brute(rows, k):
    """{doc_id: (shingles, smallest linked id)} by an inverted index."""
    sets = {d: shingles(t, k) for d, t in rows}
    by = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            by[x].append(d)
    both = defaultdict(int)
    for docs in by.values():
        for i, a in enumerate(docs):
            for b in docs[:i]:
                both[a, b] += 1
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for (a, b), n in both.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in sets}


def answer(df, **options):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in minhash.near_duplicates(df, **options).collect()}


def test_documents_equal_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], 4)
    assert answer(docs, words=4) == want


@pytest.mark.parametrize("block,columns", [(512, 4096), (5, 64)])
def test_chains_and_edits_equal_all_pairs(spark, monkeypatch, block, columns):
    monkeypatch.setattr(minhash, "BLOCK", block)
    monkeypatch.setattr(minhash, "COLUMNS", columns)
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(500)]
    rows, doc = [], 0
    for _ in range(12):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(30, 120))]
        for step in range(12):      # copies of the copy before: chains, and pairs about the threshold
            rows.append((doc, " ".join(base)))
            doc += 1
            for _ in range(rng.randint(0, 2)):
                base[rng.randrange(len(base))] = rng.choice(vocabulary)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert answer(df, words=4) == brute(rows, 4)


def test_defined_cases(spark):
    same = "one two three four five six seven eight nine ten"
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n", "c"), (4, "Short Text", "d"), (5, "short text", "e"),
            (6, same, "f"), (7, same.upper(), "g"), (7, same.upper(), "g"), (None, same, "h"), (None, "lonely words", "i"),
            (8, "x " * 30000, "j"), (9, "x " * 20000, "k"), (10, "ÄB c d e f", "l"), (11, "äb c d e f", "m")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    out = minhash.near_duplicates(df).collect()
    assert len(out) == len(rows)
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in out)
    assert got == sorted([
        ("1", 0, "1", True), ("2", 0, "2", True), ("3", 0, "3", True), ("4", 1, "4", True), ("5", 1, "4", False),
        ("6", 6, "6", True), ("7", 6, "6", False), ("7", 6, "6", False), ("None", 6, "6", False),
        ("None", 1, "None", True), ("8", 1, "8", True), ("9", 1, "8", False), ("10", 1, "10", True), ("11", 1, "11", True)])
    assert minhash.near_duplicates(df.limit(0)).count() == 0
    kept = minhash.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, [1, 2, 3, 4, 6, None, None, 8, 10, 11]))


def test_one_row_of_each_component(spark):
    a, b, c, d, e = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcde")
    rows = [(2, a, 0), (5, a, 1), (5, b, 2),            # id 5: a copy of 2, and a text of its own
            (1, c, 3), (1, c, 4), (1, c, 4), (9, c, 5),     # a repeated row with the smallest id
            (7, d, 6), (7, d + " d30", 7),              # near duplicates that share their id
            (None, a, 8), (None, e, 9), (None, e, 10), (None, e + " e30", 11),
            (4, None, 12), (4, None, 13), (None, "", 14)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n long")
    judged = minhash.near_duplicates(df.where("n < 3")).collect()
    assert sorted((r["doc_id"], r["component_id"], r["kept"]) for r in judged) == [
        (2, 2, True), (5, 2, False), (5, 5, True)]
    got = [(r["doc_id"], r["text"], r["n"]) for r in minhash.deduplicated(df, judge_null_ids=True).collect()]
    assert set(got) <= set(rows)
    n = sorted(r[2] for r in got)
    assert {0, 2, 12, 13, 14} <= set(n) and len(n) == len(set(n)) == 8
    assert [len(set(n) & x) for x in ({0, 1, 8}, {3, 4, 5}, {6, 7}, {9, 10, 11})] == [1, 1, 1, 1] and 5 not in n
    named = sorted(r["n"] for r in minhash.deduplicated(df).collect())
    assert set(named) - {3, 4, 6, 7} == {0, 2, 8, 9, 10, 11, 12, 13, 14} and len(named) == 11


def test_ids_to_the_ends_of_their_range(spark):
    a, b, c = (" ".join(f"{x}{i}" for i in range(30)) for x in "abc")
    top, low = 2**63 - 1, -2**63
    rows = [(top, a), (top - 4, a), (2**63 - 2**48, b), (None, b), (low, c), (None, c), (top - 1, "own text here")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(top, top - 4, False), (top - 4, top - 4, True), (2**63 - 2**48, 2**63 - 2**48, True),
                          (None, 2**63 - 2**48, False), (low, low, True), (None, low, False),
                          (top - 1, top - 1, True)], key=str)
    kept = minhash.deduplicated(df, judge_null_ids=True).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted([top - 4, 2**63 - 2**48, low, top - 1])


def test_columns_named_as_those_used_inside(spark):
    from rides.llm import decontamination

    a = " ".join(f"a{i}" for i in range(30))
    df = spark.createDataFrame([(1, a, 7, "x", "k"), (2, a, 8, "y", "l"), (2, a, 8, "y", "l"), (3, "b", 9, "z", "m")],
                               "doc_id long, text string, _judged_id long, _judged_key string, _hit_id string")
    kept = minhash.deduplicated(df)
    assert kept.columns == df.columns
    assert sorted(tuple(r) for r in kept.collect()) == [(1, a, 7, "x", "k"), (3, "b", 9, "z", "m")]
    items = spark.createDataFrame([("i", a)], "item_id string, text string")
    left = decontamination.clean(df.withColumn("_hit_key", df["_judged_id"]), items)
    assert [r["doc_id"] for r in left.collect()] == [3]


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5)]
    rng = random.Random(1)
    rng.shuffle(edges)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 260)]}
    assert got == want


def test_word_hashes_in_blocks(monkeypatch):
    texts = ["aa bb  cc\tAA", None, "", " x ", "dd" * 40, "bb aa \x1c é"]
    raw, at = text_hash.arrow_bytes(pa.array(texts))
    whole, firsts = text_hash.words(raw, at)
    monkeypatch.setattr(text_hash, "BLOCK", 8)
    small, again = text_hash.words(raw, at)
    assert np.array_equal(whole, small) and firsts.tolist() == again.tolist() == [0, 4, 4, 4, 5, 6, 10]
    assert whole[0] == whole[3] == whole[7] and whole[1] == whole[6] and len(set(whole.tolist())) == 7
