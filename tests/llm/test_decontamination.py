"""Winnowed matches against every window of every item."""

import hashlib
import random
import re

import pytest

from rides.llm import decontamination as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))


def brute(docs, items, window=10):
    out = []
    named = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        if n:
            named.setdefault("" if i is None else str(i), set()).update(
                (n, tuple(w[j:j + n])) for j in range(len(w) - n + 1))
    for doc, t in docs:
        w, hit, found = words(t), set(), set()
        for name, wins in named.items():
            for n in {n for n, _ in wins}:
                for j in range(len(w) - n + 1):
                    if (n, tuple(w[j:j + n])) in wins:
                        hit.update(range(j, j + n))
                        found.add(name)
        out.append((str(doc), len(w), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def answer(docs, items, **options):
    rows = d.contamination_digest(d.contamination(docs, items, **options)).collect()
    return sorted((str(r["doc_id"]), r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in rows)


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(9)
    vocabulary = [f"v{i}" for i in range(40)]
    long = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(long(rng.randint(8, 60)))) for i in range(12)]
    items += [(20, "Three-word item!"), (21, "solo"), (22, None), (23, " ,.;"), (None, "no id but nine words are in this one"),
              (24, "a " * 30), (24, "second text of item twenty four is here now ok"), (25, "Ünï cödé wörds thät üse nön ascii létters ànd möre")]
    docs = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 4)):
            if rng.random() < .6:
                w = words(rng.choice(items)[1])
                a = rng.randint(0, max(0, len(w) - 9))
                parts += w[a:a + rng.randint(5, 25)]
            parts += long(rng.randint(0, 15))
        docs.append((i, rng.choice([" ", ", ", "\n"]).join(parts)))
    docs += [(100, None), (101, ""), (102, "a " * 500), (103, "THREE WORD ITEM"), (104, "Solo."), (100, "again solo"), (None, "a " * 12),
             (105, "ünï cödé wörds thät üse nön ascii létters ànd möre"), (106, "Ünï CÖDÉ wörds thät üse nön ascii létters ànd möre")]
    return docs, items


@pytest.mark.parametrize("broadcast_rows", [d.BROADCAST_ROWS, 0])
def test_random_spans_equal_brute_force(spark, cases, broadcast_rows):
    docs, items = cases
    df = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, words string")
    bench = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    assert answer(df, bench, broadcast_rows=broadcast_rows) == brute(docs, items)
    clean = d.clean(df, bench, broadcast_rows=broadcast_rows)
    assert clean.columns == df.columns
    assert sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(r[0] for r in brute(docs, items) if not r[5])


def test_empty_tables(spark, cases):
    docs = spark.createDataFrame(cases[0], "doc_id long, text string")
    items = spark.createDataFrame(cases[1], "item_id long, text string")
    assert {r[5] for r in answer(docs, items.limit(0))} == {False}
    assert answer(docs.limit(0), items) == []


def test_plan_runs_no_python_and_reads_no_other_column(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    plan = d.contamination(docs, bench)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
    assert "source" not in plan and "n_chars" not in plan
