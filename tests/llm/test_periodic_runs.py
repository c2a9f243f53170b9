"""Periodic runs against a search of all periods, and the collapsed texts."""

import hashlib
import random
import zlib

from rides.llm import periodic_runs as p

DOCS = "doc_id long, text string"


def brute(words, least=24):
    out, n = [], len(words)
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            s, e = i, j + q
            if e - s >= max(least, 3 * q) and not any(words[s:e - t] == words[s + t:e] for t in range(1, q)):
                out.append((s, e - s, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def sample(rng):
    letters = [str(i) for i in range(rng.choice([2, 2, 3, 5, 50]))]

    def some(n):
        return [rng.choice(letters) for _ in range(n)]
    kind = rng.randrange(6)
    if kind == 0:
        return some(rng.randrange(300))
    if kind == 1:
        block = some(rng.randrange(1, 120))
        return some(30) + block * rng.randrange(3, 6) + block[:rng.randrange(len(block))] + some(20)
    if kind == 2:       # long inner runs of period 1
        return ((["a"] * rng.randrange(1, 100) + ["b"]) * rng.randrange(3, 7))[rng.randrange(3):]
    if kind == 3:       # runs in runs
        return (["a", "b"] * rng.randrange(1, 30) + ["c"] * rng.randrange(1, 40)) * rng.randrange(3, 5)
    if kind == 4:       # Fibonacci words: many overlapping periods
        a, b = ["a"], ["a", "b"]
        while len(b) < 400:
            a, b = b, b + a
        return b[:rng.randrange(400)]
    x, y, z = (some(rng.randrange(1, 60)) for _ in range(3))
    whole = (x + y + x + z) * rng.randrange(3, 5)       # equal contexts nearer than the period
    return whole[rng.randrange(5):len(whole) - rng.randrange(5)]


def test_every_run_is_found_in_batches_of_texts():
    rng = random.Random(7)
    for _ in range(40):
        texts = [sample(rng) for _ in range(6)]
        for least in (24, 3):
            found = p._runs_of_texts([[w.encode() for w in t] for t in texts], least)
            assert found == [brute(t, least) for t in texts]


def test_rows_nulls_repeats_and_long_texts(spark):
    rng = random.Random(3)
    texts = [None, "", " \t\n", "a " * 30, "a b c " * 9 + "d", "é 中 " * 20, "x" * 50_000,
             " ".join(sample(rng)), "one two " * 20_000, "  " * 40, "no run in this text"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[4]), (None, None)]
    df = spark.createDataFrame([(i, t, "clash", 5) for i, t in rows],
                               DOCS + ", runs string, n_words int").repartition(3)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, tuple(map(tuple, r.runs)), r.collapsed)
                 for r in p.periodic_runs(df).collect())
    want = []
    for i, t in rows:
        words = [w.decode() for w in (t or "").encode().split()]
        runs = [(0, 40_000, 2)] if words[:1] == ["one"] else brute(words)
        want.append((i is None, i or 0, len(words), tuple(runs), collapsed(words, runs)))
    assert got == sorted(want)
    assert p.runs_digest(p.periodic_runs(df.where("false"))).count() == 0


def test_digest_picks_the_greatest_exponent(spark):
    three = "a b c " * 10 + "x y " + "d e " * 15 + "z " + "f g " * 15     # 30/3, then 30/2 twice
    row = p.runs_digest(p.periodic_runs(spark.createDataFrame([(1, three), (2, "a")], DOCS))).orderBy(
        "doc_id").collect()
    assert (row[0].n_runs, row[0].start, row[0].length, row[0].period, row[0].exponent_milli) == (3, 32, 30, 2, 15_000)
    assert row[0].runs_sha256 == hashlib.sha256(b"0,30,3\n32,30,2\n63,30,2\n").hexdigest()
    assert row[1].n_runs == 0 and row[1].start is None and row[1].exponent_milli is None
    assert row[1].runs_sha256 == hashlib.sha256(b"").hexdigest()
    assert row[1].collapsed_sha256 == hashlib.sha256(b"a").hexdigest()


def test_planted_repeats(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(f"w{rng.randrange(1000)}" for _ in range(i % 90))) for i in range(-40, 400)]
    rows += [(None, "a b c"), (7, None)]
    got = {(r.doc_id, r.text) for r in p.planted(spark.createDataFrame(rows, DOCS)).collect()}
    want = set()
    for i, t in rows:
        words = (t or "").split()
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            q = 1 + (n - a) // (3 + g % 8)
            t = " ".join(words[k] if k < a else words[a + (k - a) % q] for k in range(n))
        want.add((i, t))
    assert got == want
