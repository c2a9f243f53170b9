"""Repeated strings against a dictionary of all strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from rides.llm import suffix_array


def brute(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(x[i:i + length] for x in data for i in range(len(x) - length + 1))
    out = []
    for (doc, _), x in zip(rows, data):
        gone = bytearray(len(x))
        for i in range(len(x) - length + 1):
            if seen[x[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(x, gone) if not g)
        out.append((str(doc), len(x), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def answer(df, length=200):
    rows = suffix_array.cut_digest(suffix_array.cut(df, length)).collect()
    return sorted((str(r["doc_id"]), r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows)


def test_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert answer(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()], 200)


@pytest.mark.parametrize("length", [8, 20, 41])
def test_random_passages_equal_brute_force(spark, length):
    rng = random.Random(length)
    letters = "abé "
    passages = ["".join(rng.choice(letters) for _ in range(rng.randint(length - 3, 4 * length))) for _ in range(6)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            parts.append(rng.choice(passages)[rng.randint(0, 3):] if rng.random() < .5 else
                         "".join(chr(rng.randint(97, 122)) for _ in range(rng.randint(0, 30))))
        rows.append((i, "".join(parts)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert answer(df, length) == brute(rows, length)


def test_defined_cases(spark):
    rows = [(1, None, 1), (2, "", 2), (3, "x" * 1000, 3), (4, "short", 4), (4, "short", 4), (5, "ab" * 99 + "a", 5),
            (6, "abc" * 300, 6), (7, "abc" * 300, 7), (None, "abc" * 300, 8), (8, "é" * 99 + "q", 9), (9, "x" * 199, 10),
            (10, "".join(chr(33 + i % 90) + str(i) for i in range(300)), 11), (11, "z" * 200 + "y", 12)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    assert answer(df) == brute([(a, b) for a, b, _ in rows], 200)
    assert suffix_array.cut(df.limit(0)).count() == 0


@pytest.mark.parametrize("shallow", [0, 8, 24, 64])
def test_deep_and_shallow_agree(shallow):
    rng = np.random.default_rng(shallow)
    raw = rng.integers(0, 2, 4000).astype(np.uint8)
    raw[2000:2600] = raw[100:700]
    starts = np.arange(0, 4000 - 37)
    found = suffix_array.repeated(raw, starts, starts * 0, 37, shallow)
    data = raw.tobytes()
    seen = Counter(data[i:i + 37] for i in starts.tolist())
    assert found.tolist() == [seen[data[i:i + 37]] > 1 for i in starts.tolist()]


def test_chunks_of_a_long_text_agree(monkeypatch):
    raw = np.random.default_rng(2).integers(0, 3, 5000).astype(np.uint8)
    whole = suffix_array.anchors(raw, 40)
    monkeypatch.setattr(suffix_array, "CHUNK", 300)
    parts = suffix_array.anchors(raw, 40)

    def each(blocks):
        return [(s, p, g) for a, b, p, g in zip(*[x.tolist() for x in blocks]) for s in range(a, b + 1)]

    assert each(whole) == each(parts)


@pytest.mark.parametrize("at_a_time", [1, 700, 1 << 21])
def test_ranges_of_distances_agree(at_a_time, monkeypatch):
    """Blocks of one hot gram, sorted some distances at a time."""
    monkeypatch.setattr(suffix_array, "SORT_STARTS", at_a_time)
    rng = np.random.default_rng(5)
    shared = rng.integers(97, 123, 90).astype(np.uint8).tobytes()
    rows, texts = [], []
    for i in range(60):
        cut, more = int(rng.integers(0, 12)), rng.integers(97, 100, 30).astype(np.uint8).tobytes()
        text = more[:int(rng.integers(0, 30))] + shared[cut:] + more
        texts.append(text)
        grams = suffix_array.anchors(np.frombuffer(text, np.uint8), 40)
        for a, b, p, g in zip(*[x.tolist() for x in grams]):
            rows.append((g, i, a, p - a, text[a:b + 40]))
    rows.sort(key=lambda r: r[0])
    seen = Counter(t[i:i + 40] for t in texts for i in range(len(t) - 39))
    got = {(k, i) for k, a, b in suffix_array._joined(suffix_array._sorted_blocks(rows, 40)) for i in range(a, b)}
    want = {(k, i + j) for k, t in enumerate(texts) for i in range(len(t) - 39) if seen[t[i:i + 40]] > 1
            for j in range(40)}
    assert got == want
