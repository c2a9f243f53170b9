"""Near-duplicate documents by min-max hashing.

Every permutation of a document's word shingles gives two signature values,
its smallest and its largest, so half the permutations are evaluated. Bands of
``ROWS`` values, from different permutations, name buckets. Documents with equal sets are one
node from the start. Links are confirmed on the full sets, in two rounds: each
bucket's members with its smallest and with its largest node; then, for what is
in buckets that still hold several components, all remaining pairs of different
components, compared inside tasks, block against block. Before that go the
documents that cannot have a link to another component because too few of their
shingles occur in any, such as those that only share a passage. So a group of
copies costs its size; only a group of documents that are almost, but not quite,
near duplicates of each other costs comparisons of all with all.

A pair of similarity s shares no bucket with probability
``(1 - s ** ROWS) ** BANDS``: 1.1e-6 at 0.8, less above.

Defined cases: null and empty texts have no shingles and are linked with
nothing; rows that repeat an id are judged by their own texts, and an id with
several texts does not link them; documents without an id take part, named by
their texts, and a component of only such ones has a null id; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rides.llm.common import col, free, map_arrow, saved
from rides.llm.graph import components

WORDS = 5
PERCENT = 80
ROWS = 4
BANDS = 26
PERMUTATIONS = ROWS * BANDS // 2
# What names a row here: whether it has no id, and the id or the hash of its
# text in place of one. Rows without an id so come after all ids, none of which
# is set aside for them.
NAME = "struct<no_id:boolean,number:bigint>"
# Pairs up to this many (two longs each) are broadcast to the table of sets.
BROADCAST_PAIRS = 200_000
# Documents of a block, and shingles of a matrix, when all are compared.
BLOCK = 512
COLUMNS = 4096


def signatures(hashes, offsets):
    """(texts, PERMUTATIONS) smallest and largest values; rows without any
    shingle are undefined."""
    import numpy as np

    rng = np.random.default_rng(4)
    factors = rng.integers(1, 2**64, PERMUTATIONS, dtype=np.uint64) | np.uint64(1)
    shifts = rng.integers(0, 2**64, PERMUTATIONS, dtype=np.uint64)
    filled = np.flatnonzero(np.diff(offsets))
    low = np.zeros((len(offsets) - 1, PERMUTATIONS), np.uint64)
    high = np.zeros_like(low)
    if len(filled):
        at, value = offsets[:-1][filled], np.empty_like(hashes)
        for j in range(PERMUTATIONS):
            np.multiply(hashes, factors[j], out=value)
            np.add(value, shifts[j], out=value)
            low[filled, j] = np.minimum.reduceat(value, at)
            high[filled, j] = np.maximum.reduceat(value, at)
    return low, high


def bands(low, high):
    """(texts, BANDS) bucket names: two minima and two maxima each, of four
    permutations."""
    import numpy as np

    from rides.llm.text_hash import mixed

    out = np.empty((len(low), BANDS), np.uint64)
    for b in range(BANDS):
        mins = [low[:, (2 * b + i) % PERMUTATIONS] for i in range(ROWS // 2)]
        maxs = [high[:, (2 * b + BANDS + i) % PERMUTATIONS] for i in range(ROWS // 2)]
        h = np.full(len(low), b + 1, np.uint64)
        for v in mins + maxs:
            h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + v)
        out[:, b] = h
    return out


def _set_keys(hashes, at) -> list:
    import hashlib

    return [hashlib.blake2b(hashes[a:b].tobytes(), digest_size=16).digest() if b > a else None
            for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def _features(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, text_key, n_shingles, set_key (16 bytes, null without shingles),
    bands of (doc_id, text, text_key) rows."""
    def run(rows: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from rides.llm import text_hash as t

        for whole in rows:
            for batch in t.batches(whole, 1):
                hashes, at = t.shingle_sets(*t.words(*t.arrow_bytes(batch.column(1))), k)
                sizes = np.diff(at)
                keys = _set_keys(hashes, at)
                named = bands(*signatures(hashes, at)).astype(np.int64, copy=False).view(np.int64)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(sizes) + 1) * BANDS, pa.int32()), pa.array(named.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(2), pa.array(sizes), pa.array(keys, pa.binary()), lists],
                    ["doc_id", "text_key", "n_shingles", "set_key", "bands"])

    return map_arrow(docs, run, f"doc_id {NAME}, text_key long, n_shingles long, set_key binary, bands array<long>")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """node, shingles (sorted unsigned 64-bit hashes) of (doc_id, text) rows."""
    def run(rows: Iterator) -> Iterator:
        import pyarrow as pa

        from rides.llm import text_hash as t

        for whole in rows:
            for batch in t.batches(whole, 1):
                hashes, at = t.shingle_sets(*t.words(*t.arrow_bytes(batch.column(1))), k)
                raw = [hashes[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_set_keys(hashes, at), pa.binary()), pa.array(raw, pa.binary())],
                    ["set_key", "shingles"])

    return map_arrow(docs, run, "set_key binary, shingles binary").where("set_key is not null").select(
        F.xxhash64("set_key").alias("node"), "shingles")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) rows whose full sets are similar enough."""
    def run(rows: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in rows:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                small, big = (x, y) if len(x) <= len(y) else (y, x)
                if 100 * len(small) < percent * len(big):
                    keep.append(False)
                    continue
                place = np.minimum(np.searchsorted(big, small), len(big) - 1)
                both = int(np.count_nonzero(big[place] == small))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    if pairs.count() <= BROADCAST_PAIRS:
        pairs = F.broadcast(pairs)
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    return map_arrow(pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y"), run, "a long, b long")


def _star(members: DataFrame, centre) -> DataFrame:
    """Pairs of each bucket's members with one of them, of another component."""
    hub = members.groupBy("bucket").agg(centre(F.struct("node", "component")).alias("c"))
    pairs = members.join(hub.select("bucket", "c.*").withColumnsRenamed(
        {"node": "hub", "component": "hub_component"}), "bucket")
    return pairs.where("component != hub_component").select(
        F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct()


def _shared(sets: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The (node, component) rows of which at least ``percent`` hundredths of
    the shingles occur in other components of these rows. A link needs as much
    of both its sets. Linear in the shingles, whatever a shingle's frequency."""
    def run(rows: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in rows:
            sizes = np.array([len(x.as_buffer()) // 8 for x in batch.column(2)], np.int64)
            raw = b"".join(x.as_buffer().to_pybytes() for x in batch.column(2))
            node, component = (np.repeat(np.asarray(batch.column(i)), sizes) for i in range(2))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node), pa.array(component), pa.array(np.repeat(sizes, sizes)),
                 pa.array(np.frombuffer(raw, np.int64))], ["node", "component", "n", "shingle"])

    each = map_arrow(sets.join(nodes, "node").select("node", "component", "shingles"), run,
                     "node long, component long, n long, shingle long")
    across = each.groupBy("shingle").agg(
        F.min("component").alias("u"), F.max("component").alias("v")).where("u < v").select("shingle")
    enough = each.join(across, "shingle").groupBy("node", "component").agg(
        F.count(F.lit(1)).alias("c"), F.max("n").alias("n")).where(100 * F.col("c") >= percent * F.col("n"))
    return saved(enough.select("node", "component"), "minhash-shared")


def _linked(raw: list, component, percent: int) -> list[tuple[int, int]]:
    """Links between components among the sets ``raw``, as a forest: (i, j)
    that join what is not joined yet. Intersections are counted as a product
    of incidence matrices, over the shingles that two sets or more hold."""
    import numpy as np

    sizes = np.array([len(x) for x in raw])
    every, place, holders = np.unique(np.concatenate(raw), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(raw)), sizes)
    keep = holders[place] > 1
    rank = np.cumsum(holders > 1) - 1
    owner, place = owner[keep], rank[place[keep]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    both = np.zeros((len(raw), len(raw)), np.float32)
    for low in range(0, int(place[-1]) + 1 if len(place) else 0, COLUMNS):
        a, b = np.searchsorted(place, (low, low + COLUMNS))
        part = np.zeros((len(raw), COLUMNS), np.float32)
        part[owner[a:b], place[a:b] - low] = 1
        both += part @ part.T
    like = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    like &= component[:, None] != component[None, :]
    forest, seen = [], np.zeros(len(raw), bool)
    for i in range(len(raw)):
        todo = [] if seen[i] else [i]
        seen[i] = True
        while todo:
            u = todo.pop()
            for v in np.flatnonzero(like[u] & ~seen).tolist():
                seen[v] = True
                forest.append((u, v))
                todo.append(v)
    return forest


def _rest(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): confirmed links between components of (bucket, node, component)
    rows, enough to join what belongs together. Documents that buckets connect
    form a cluster; a cluster is compared in blocks of about BLOCK documents, so
    a task holds two blocks, a set travels once for each block of its cluster,
    and pairs that are no link never become rows."""
    open_ = members.select("node", "component").distinct()
    for _ in range(2):      # what goes may have been what another shared
        open_ = _shared(sets, open_, percent)
    left = _mixed(members.join(open_.select("node"), "node"))
    hub = left.groupBy("bucket").agg(F.min("node").alias("b"))
    cluster = saved(components(left.join(hub, "bucket").select(F.col("node").alias("a"), "b")), "minhash-clusters") \
        .withColumnRenamed("component", "cluster")
    counts = cluster.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    placed = (cluster.join(counts, "cluster").join(open_, "node")
              .withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
              .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
              .select("node", "component", "cluster", F.least("block", "other").alias("i"),
                      F.greatest("block", "other").alias("j")))

    def run(group):
        import numpy as np
        import pyarrow as pa

        node = np.asarray(group["node"])
        raw = [np.frombuffer(x.as_buffer(), np.uint64) for x in group["shingles"]]
        forest = _linked(raw, np.asarray(group["component"]), percent)
        return pa.table({"a": pa.array([int(node[i]) for i, _ in forest], pa.int64()),
                         "b": pa.array([int(node[j]) for _, j in forest], pa.int64())})

    return placed.join(sets, "node").groupBy("cluster", "i", "j").applyInArrow(run, "a long, b long")


def _mixed(members: DataFrame) -> DataFrame:
    """The members of buckets that hold several components."""
    several = members.groupBy("bucket").agg(
        F.min("component").alias("u"), F.max("component").alias("v")).where("u < v")
    return members.join(several.select("bucket"), "bucket")


def _joined(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame | None:
    """(node, component) of the linked nodes, or None without any link."""
    own = members.withColumn("component", F.col("node"))
    pairs = saved(_star(own, F.min).union(_star(own, F.max)).distinct(), "minhash-pairs")
    links = saved(_confirmed(pairs, sets, percent), "minhash-links")
    joined = saved(components(links), "minhash-components")
    now = _mixed(members.join(joined, "node", "left").withColumn(
        "component", F.coalesce("component", "node")))
    more = saved(_rest(now, sets, percent), "minhash-links")
    if not more.isEmpty():
        links = links.unionByName(more)
        joined = saved(components(links), "minhash-components")
    return None if links.isEmpty() else joined


def _named(df: DataFrame, id_col: str, text_col: str) -> tuple:
    """A row's ``NAME`` and its text's key."""
    own, key = col(id_col).cast("long"), F.xxhash64(col(text_col))
    return F.struct(own.isNull().alias("no_id"), F.coalesce(own, key).alias("number")), key


def _judged(df: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_key, n_shingles, first of every row of ``df``: ``first`` is
    the smallest (doc_id, text_key) of the row's component, null without
    shingles. A node is a set, not an id, which may come with several."""
    number, key = _named(df, id_col, text_col)
    docs = df.select(number.alias("doc_id"), col(text_col).alias("text"), key.alias("text_key"))
    features = saved(_features(docs, words), "minhash-features")
    nodes = saved(features.where("n_shingles > 0").groupBy("set_key").agg(
        F.min(F.struct("doc_id", "text_key")).alias("first"), F.first("n_shingles").alias("n"),
        F.first("bands").alias("bands")).withColumn("node", F.xxhash64("set_key")), "minhash-nodes")
    rows = nodes.select("node", "n", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.min("node").alias("u"), F.max("node").alias("v")).where("u < v")
    members = saved(rows.join(shared.select("bucket"), "bucket"), "minhash-members")
    wanted = nodes.join(members.select("node").distinct(), "node", "left_semi").select("first.*")
    texts = docs.join(wanted, ["doc_id", "text_key"], "left_semi").select("doc_id", "text")
    sets = saved(_sets(texts, words), "minhash-sets")
    joined = _joined(members, sets, percent)
    named = nodes.select("set_key", "first")
    if joined is not None:
        linked = nodes.select("set_key", "node", "first").join(joined, "node")
        least = linked.groupBy("component").agg(F.min("first").alias("least"))
        linked = saved(linked.join(least, "component").select("set_key", "least"), "minhash-linked")
        named = named.join(linked, "set_key", "left").select(
            "set_key", F.coalesce("least", "first").alias("first"))
    return features.select("doc_id", "text_key", "n_shingles", "set_key").join(
        named, "set_key", "left").drop("set_key")


def near_duplicates(df: DataFrame, words: int = WORDS, percent: int = PERCENT,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``df``. Two
    documents are linked if their shingle sets' intersection has at least
    ``percent`` hundredths of their union (80 or more, as the bands assume)."""
    component = F.coalesce("first.doc_id", "doc_id")

    def real(c):
        return F.when(~c["no_id"], c["number"])

    return _judged(df, words, percent, id_col, text_col).select(
        real(F.col("doc_id")).alias("doc_id"), "n_shingles", real(component).alias("component_id"),
        (F.col("doc_id") == component).alias("kept"))


def deduplicated(df: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id",
                 text_col: str = "text", judge_null_ids: bool = False) -> DataFrame:
    """One row of ``df`` for each component: of the smallest id, then of the
    smallest hash of the text, then of the row. Rows without shingles all stay,
    and so do rows without an id unless ``judge_null_ids``."""
    rows = _judged(df, words, percent, id_col, text_col).where("n_shingles > 0")
    if not judge_null_ids:
        rows = rows.where(~F.col("doc_id.no_id"))
    names = [free(df, "_judged_id"), free(df, "_judged_key")]
    rows = saved(rows.groupBy("doc_id", "text_key").agg(
        F.first("first").alias("first"), F.count(F.lit(1)).alias("n")).select(
            F.col("doc_id").alias(names[0]), F.col("text_key").alias(names[1]), "n",
            (F.struct("doc_id", "text_key") != F.col("first")).alias("gone")).where("gone or n > 1"),
        "minhash-gone")
    number, key = _named(df, id_col, text_col)
    same = (number == F.col(names[0])) & key.eqNullSafe(F.col(names[1]))
    left = df.join(rows.select(*names), same, "left_anti")
    repeated = rows.where("not gone").select(*names)
    if repeated.isEmpty():
        return left
    row = F.struct(*[col(c) for c in df.columns])
    one = df.join(repeated, same).groupBy(*names).agg(F.min_by(row, F.xxhash64(row)).alias("row"))
    return left.union(one.select("row.*"))
