"""The bit-sliced index against products of all pairs."""

import math
import random

import numpy as np
import pytest

from rides.llm import bit_sliced as b

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k, every):
    kept = [(i, v, [math.floor(64 * float(np.float32(c))) for c in v]) for i, v in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for a, (query, _, x) in enumerate(kept):
        if query is None or query % every:
            continue
        found = sorted((-sum(p * q for p, q in zip(x, y)), i is None, i or 0)
                       for c, (i, _, y) in enumerate(kept) if c != a and len(x) == len(y))[:k]
        out += [(query, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(found)]
    return sorted(out, key=str)


def answers(df, **options):
    return sorted(((r.query_id, r.rank, r.vec_id, r.score) for r in b.top_k(df, **options).collect()), key=str)


def test_all_pairs_ties_nulls_and_lengths(spark):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 0.2) for _ in range(9)]) for i in range(-30, 150)]
    hot = [0.5, -0.25, 0.125, 0.0, 0.0, -1.0, 1.0, 0.3, 0.1]
    rows += [(200 + i, hot) for i in range(90)]                              # a third of equal vectors
    rows += [(40, rows[3][1]), (40, rows[3][1]), (None, hot), (None, rows[0][1])]   # repeated and null ids
    rows += [(300, None), (320, [None] * 9), (340, [math.nan] * 9), (360, [math.inf] + [0.0] * 8),
             (380, [1.0, 2.0]), (400, [1.0, -2.0]), (420, []), (440, [])]
    df = spark.createDataFrame([(i, v, "clash") for i, v in rows], SCHEMA + ", block string").repartition(3)
    assert answers(df, k=7, every=20, block_rows=64, chunk=8, group_rows=100) == brute(rows, 7, 20)
    assert answers(df, k=500, every=40) == brute(rows, 500, 40)
    assert answers(df.where("false")) == []


def test_large_components_are_exact_and_too_large_ones_fail(spark):
    rows = [(i, [(-1) ** i * 200_000.5, 0.001 * i, -131_072.0 + i]) for i in range(50)]
    df = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in rows], "vec_id long, embedding array<double>")
    want = sorted(((q, r, v, s) for q, r, v, s in brute_double(rows, 5, 20)), key=str)
    assert answers(df, k=5) == want
    with pytest.raises(Exception, match="component beyond"):
        answers(spark.createDataFrame([(0, [1e9])], SCHEMA))


def brute_double(rows, k, every):
    whole = [(i, [math.floor(64 * c) for c in v]) for i, v in rows]
    for query, x in whole:
        if query % every == 0:
            found = sorted((-sum(p * q for p, q in zip(x, y)), i) for i, y in whole if i != query)[:k]
            yield from ((query, r + 1, i, -s) for r, (s, i) in enumerate(found))


def test_selection_from_the_most_significant_slice_down():
    rng = np.random.default_rng(2)
    for _ in range(100):
        n, d, k = int(rng.integers(1, 200)), int(rng.integers(1, 8)), int(rng.integers(1, 25))
        x = rng.integers(-9, 10, (n, d))
        block = b._Block(b._block_row(0, list(range(n)), x))
        assert (block.values() == x).all()
        asked = [((0, 0, i), x[i]) for i in range(min(n, 11))]
        got = {}
        for key, vec_id, score, _ in b._best_of_block(block, asked, list(range(len(asked))), k):
            got.setdefault(key[2], []).append((-score, vec_id))
        for i, (_, q) in enumerate(asked):
            assert sorted(got.get(i, [])) == sorted((-int(q @ x[j]), j) for j in range(n) if j != i)[:k]
