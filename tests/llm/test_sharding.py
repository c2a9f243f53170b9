"""Extendible hashing against a directory built bucket by bucket."""

from collections import defaultdict

import pytest

from rides.llm import sharding
from rides.llm.common import scratch


def brute(rows, limit):
    """{prefix: members} by splitting oversized buckets, one bit at a time."""
    out, todo = {}, [("", rows)]
    while todo:
        prefix, members = todo.pop()
        if sum(s for _, s in members) <= limit or len(prefix) == sharding.BITS:
            if members:
                out[prefix] = members
            continue
        for bit in "01":
            todo.append((prefix + bit, [m for m in members if m[0][len(prefix)] == bit]))
    return out


def bits(doc_id):
    import hashlib

    h = hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:15]
    return format(int(h, 16), "060b")


def nbytes(row):
    """16 for a row, 8 for a number, the bytes of a string."""
    return 16 + sum(len(v.encode()) if isinstance(v, str) else 0 if v is None else 8 for v in row)


@pytest.mark.parametrize("limit", [3000, 20000, 1 << 30])
def test_shards_equal_split_buckets(spark, limit):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = sharding.write_shards(docs, scratch(spark, "test-shards"), limit).collect()
    want = brute([(bits(r["doc_id"]), nbytes(r)) for r in docs.collect()], limit)
    got = defaultdict(int)
    for r in rows:
        assert bits(r["doc_id"]).startswith(r["shard"][1:])
        got[r["shard"][1:]] += 1
    assert {k: len(v) for k, v in want.items()} == got
    assert sorted((r["doc_id"], r["text"]) for r in rows) == sorted((r["doc_id"], r["text"]) for r in docs.collect())


def test_repeated_and_null_ids_form_chains(spark):
    data = [(1, "x" * 50, "s", 0)] * 40 + [(None, None, "t", 1)] * 3 + [(2, "y" * 5000, "u", 2), (3, "", "v", 3)]
    df = spark.createDataFrame(data, "doc_id long, text string, shard string, `a.b` int")
    out = sharding.assign(df, 300)
    assert out.columns == ["doc_id", "text", "shard", "a.b", "_shard", "part"]
    rows = out.collect()
    assert sorted(map(str, ((r[0], r[1]) for r in rows))) == sorted(map(str, ((d[0], d[1]) for d in data)))
    load = defaultdict(list)
    for r in rows:
        load[r["_shard"], r["part"]].append(nbytes(r[:4]) + (8 if r[0] is None else 0))
    assert all(sum(v) <= 300 or len(v) == 1 for v in load.values())
    assert sharding.assign(df.limit(0), 300).count() == 0


def test_all_columns_count_and_large_rows_stand_alone(spark, tmp_path):
    """41 rows of one id, one of them above the limit, with the bytes in another
    column than the text: ten small rows fill no more than a part, and files stay
    within the limit and the little that Parquet adds."""
    import random

    rng = random.Random(3)

    def noise(n):
        return "".join(chr(rng.randint(33, 126)) for _ in range(n))

    limit = 50_000
    data = [(1, "t", noise(4900), [noise(40)]) for _ in range(40)] + [(1, "large", noise(3 * limit), None)]
    data += [(i, None, noise(20_000), [None]) for i in range(2, 30)]
    df = spark.createDataFrame(data, "doc_id long, text string, note string, tags array<string>").repartition(1)
    path = str(tmp_path / "shards")
    rows = sharding.write_shards(df, path, limit).collect()
    assert sorted(r["note"] for r in rows) == sorted(d[2] for d in data)
    load = defaultdict(list)
    for r in rows:
        load[r["shard"], r["part"]].append(len(r["note"]) + sum(len(t or "") for t in r["tags"] or []))
    assert all(sum(v) <= limit or len(v) == 1 for v in load.values())
    chain = [v for (s, _), v in load.items() if len(s) == sharding.BITS + 1]
    assert 1 + 5 <= len(chain) <= 1 + 10
    sizes = [f.stat().st_size for f in (tmp_path / "shards").rglob("*.parquet")]
    assert len(sizes) == len(load) and sum(s > limit + 5000 for s in sizes) == 1


def test_a_hot_id_is_numbered_range_by_range(spark):
    from pyspark.sql import functions as F

    df = spark.range(0, 4000, numPartitions=6).select(
        F.lit(None).cast("long").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"))
    rows = sharding.assign(df, 5000).groupBy("shard", "part").agg(
        F.sum(F.octet_length("text") + 24).alias("bytes"), F.count("*").alias("n")).collect()
    assert len({r["shard"] for r in rows}) == 1 and sum(r["n"] for r in rows) == 4000
    assert max(r["bytes"] for r in rows) <= 5000 and len(rows) <= 4000 * 48.5 / (5000 - 74) + 8


def test_coarse_directory_gives_the_same_depths(spark, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    whole = {r["doc_id"]: r["shard"] for r in sharding.assign(docs, 3000).collect()}
    monkeypatch.setattr(sharding, "COARSE_BITS", 3)
    assert {r["doc_id"]: r["shard"] for r in sharding.assign(docs, 3000).collect()} == whole
