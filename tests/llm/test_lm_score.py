"""Stupid-backoff scores against plain dictionaries."""

import math
import re
from collections import Counter

import pytest

from rides.llm import lm_score, text_hash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(texts, order, held_out=True):
    docs = [words(t) for t in texts]
    count = Counter(tuple(d[i:i + n]) for d in docs for n in range(1, order + 1) for i in range(len(d) - n + 1))
    size, out = sum(map(len, docs)), []
    for d in docs:
        own = Counter(tuple(d[i:i + n]) for n in range(1, order + 1) for i in range(len(d) - n + 1))
        if not held_out:
            own = Counter()
        rest = size - (len(d) if held_out else 0)

        def score(gram):
            c = count[gram] - own[gram]
            if len(gram) == 1:
                return c / rest if c > 0 else 1 / (rest + 1)
            return c / (count[gram[:-1]] - own[gram[:-1]]) if c > 0 else lm_score.BACKOFF * score(gram[1:])

        out.append(sum(math.log(score(tuple(d[max(0, i - order + 1):i + 1]))) for i in range(len(d))) if d else None)
    return out


@pytest.mark.parametrize("order,held_out", [(3, True), (2, True), (1, True), (3, False)])
def test_documents_equal_dictionaries(spark, order, held_out, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, ""), (-3, "word"), (-4, "The THE the the"), (None, "a a a a a")],
                                "doc_id long, text string")
    both = docs.union(odd).repartition(4)
    rows = both.collect()
    want = dict(zip([r["doc_id"] for r in rows], brute([r["text"] for r in rows], order, held_out)))
    got = {r["doc_id"]: r for r in lm_score.lm_scores(both, order, held_out=held_out).collect()}
    assert set(got) == set(want)
    for d, s in want.items():
        assert got[d]["n_words"] == len(words(next(r["text"] for r in rows if r["doc_id"] == d)))
        assert (got[d]["log_score"] is None) == (s is None)
        if s is not None:
            assert got[d]["log_score"] == pytest.approx(s, rel=1e-9, abs=1e-9)
            assert got[d]["mean_log"] == pytest.approx(s / got[d]["n_words"], rel=1e-9)


def test_empty_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "a b c", "x"), (1, "a b c", "y"), (2, None, "z")], "doc_id long, text string, piece string")
    rows = lm_score.lm_scores(df).collect()
    assert sorted(r["n_words"] for r in rows) == [0, 3, 3]
    assert lm_score.lm_scores(df.limit(0)).count() == 0


def test_more_text_gives_more_counts():
    import numpy as np
    import pyarrow as pa

    word, first = text_hash.words(*text_hash.arrow_bytes(pa.array(["a b a b", "a b"])))
    grams, ends = lm_score._grams(word, np.array([0, 1, 2, 3, 0, 1]), 2)
    assert ends.tolist() == [1, 2, 3, 5] and len(set(grams.tolist())) == 2


def test_parts_follow_the_words(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").repartition(4)
    whole = {r["doc_id"]: r["log_score"] for r in lm_score.lm_scores(docs).collect()}
    asked = []
    totals = lm_score._totals
    monkeypatch.setattr(lm_score, "_totals", lambda p, n, bits: asked.append(bits) or totals(p, n, bits))
    monkeypatch.setattr(lm_score, "PART_WORDS", 2000)
    parts = {r["doc_id"]: r["log_score"] for r in lm_score.lm_scores(docs).collect()}
    n_words = sum(len(words(r["text"])) for r in docs.collect())
    assert asked == [(n_words // 2000).bit_length()] * 3 and asked[0] > 2
    assert parts.keys() == whole.keys()
    assert all(parts[d] == whole[d] or parts[d] == pytest.approx(whole[d], rel=1e-9) for d in whole)
