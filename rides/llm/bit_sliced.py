"""Exact top-k inner products on a bit-sliced index.

Vectors are quantised to integers and stored in blocks of rows, ordered by id.
A block keeps, for each component, its least value and one bitmap over the
rows for every bit of the distance from it (a slice), and for each slice its
complement. A query's integer components are written in signed binary digits
with few non-zeros; each digit adds a shifted slice, or for a negative digit
the complement and a constant that all rows share. Carry-save adders on the
bitmaps sum all of them into the slices of the score. The selection goes from
the most significant slice downward and keeps the set of rows surely among
the k best and the set tied with the boundary so far; what is tied after the
last slice has equal scores, and the smallest ids of it fill up the k places.

Every query meets every block: queries are dealt in chunks and blocks in
groups, and a task takes one chunk with one group. Its answers are merged by
query. Both sides travel through shuffles, nothing is broadcast.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rides.llm.common import col, map_arrow, saved

SCALE = 64
BLOCK_ROWS = 8192
CHUNK = 8192                # queries of a task
GROUP_ROWS = 16 * BLOCK_ROWS    # rows that a task compares them with
LIMIT = 1 << 24             # scores stay within a long for up to 2^14 components
BATCH = 8                   # queries whose slices are added together


def quantised(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
              scale: int = SCALE) -> DataFrame:
    """(vec_id, x): components as floor(scale * component), taken as double.
    Rows with a null vector or a null or non-finite component are left out; a
    finite component beyond +-2^24 after scaling is an error."""
    x = F.transform(col(vector_column), lambda v: F.floor(F.lit(float(scale)) * v.cast("double")))
    fit = F.forall(col(vector_column), lambda v: v.isNotNull() & ~F.isnan(v.cast("double"))
                   & (F.abs(v.cast("double")) < F.lit(math.inf)))
    small = F.forall("x", lambda v: F.abs(v) <= LIMIT)
    return (vectors.where(col(vector_column).isNotNull() & fit)
                   .select(col(id_column).alias("vec_id"), x.alias("x"))
                   .withColumn("x", F.when(small, F.col("x")).otherwise(
                       F.raise_error(F.lit(f"component beyond {LIMIT} after scaling")))))


# ---------------------------------------------------------------------------
# Blocks

def _packed(bits: np.ndarray) -> np.ndarray:
    """Boolean [..., rows] as words of 64 rows."""
    rows = bits.shape[-1]
    padded = np.zeros((*bits.shape[:-1], -(-rows // 64) * 64), bool)
    padded[..., :rows] = bits
    return np.packbits(padded, axis=-1, bitorder="little").view(np.uint64)


def _unpacked(words: np.ndarray, rows: int) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(words).view(np.uint8), axis=-1,
                         bitorder="little")[..., :rows].astype(bool)


def _block_row(block: int, ids: list, x: np.ndarray) -> dict:
    """One block of the index: x is [rows, components]."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
    x = x[order]
    low = x.min(axis=0) if x.size else np.zeros(x.shape[1], np.int64)
    above = (x - low).T
    widths = [int(row.max()).bit_length() for row in above]
    planes = [above[d] >> b & 1 for d, w in enumerate(widths) for b in range(w)]
    slices = _packed(np.array(planes, bool)) if planes else np.zeros((0, -(-len(ids) // 64)), np.uint64)
    return {"block": block, "dim": x.shape[1], "n_rows": len(ids), "ids": [ids[i] for i in order], "low": low.tolist(),
            "widths": widths, "slices": slices.tobytes()}


class _Block:
    """A stored block with its slices and their complements."""

    def __init__(self, row: dict):
        self.block, self.n, self.ids = row["block"], row["n_rows"], row["ids"]
        self.low, self.widths = np.array(row["low"], np.int64), row["widths"]
        self.words = -(-self.n // 64)
        slices = np.frombuffer(row["slices"], np.uint64).reshape(-1, self.words)
        # slices, then their complements, then an empty one
        self.planes = np.concatenate([slices, ~slices, np.zeros((1, self.words), np.uint64)])
        self.first = np.concatenate(([0], np.cumsum(self.widths))).astype(np.int64)
        self.n_slices = len(slices)
        self.every = _packed(np.ones(self.n, bool))

    def values(self) -> np.ndarray:
        """The stored integers, [rows, components]."""
        x = np.repeat(self.low[None, :], self.n, axis=0)
        for d, w in enumerate(self.widths):
            for b in range(w):
                x[:, d] += _unpacked(self.planes[self.first[d] + b], self.n).astype(np.int64) << b
        return x


def _index_blocks(rows_in_block: int):
    schema = pa.schema([("block", pa.int64()), ("dim", pa.int32()), ("n_rows", pa.int32()),
                        ("ids", pa.list_(pa.int64())), ("low", pa.list_(pa.int64())),
                        ("widths", pa.list_(pa.int32())), ("slices", pa.binary())])

    def build(batches):
        from pyspark import TaskContext

        serial = TaskContext.get().partitionId() << 32
        held: dict[int, list] = {}

        def full(dim, parts):
            nonlocal serial
            ids = [i for p in parts for i in p[0]]
            row = _block_row(serial, ids, np.concatenate([p[1] for p in parts]))
            serial += 1
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            ids, lists = batch.column(0).to_pylist(), batch.column(1)
            sizes = np.diff(lists.offsets.to_numpy())
            flat = lists.flatten().to_numpy()
            starts = np.concatenate(([0], np.cumsum(sizes)))
            for dim in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == dim)
                x = flat[starts[rows][:, None] + np.arange(dim)] if dim else np.zeros((len(rows), 0), np.int64)
                parts = held.setdefault(dim, [])
                at = 0
                while at < len(rows):
                    room = rows_in_block - sum(len(p[0]) for p in parts)
                    take = rows[at:at + room]
                    parts.append(([ids[i] for i in take], x[at:at + room]))
                    at += room
                    if len(take) == room:
                        yield full(dim, parts)
                        parts.clear()
        for dim, parts in held.items():
            if parts:
                yield full(dim, parts)
    return build


def build_index(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The bit-sliced index of ``quantised`` rows, written in the shared folder
    and read back: one row a block, ids ascending in it (null ids last). Blocks
    hold vectors of one length."""
    return saved(map_arrow(
        rows.select(F.col("vec_id").cast("long").alias("vec_id"), "x"), _index_blocks(block_rows),
        "block long, dim int, n_rows int, ids array<long>, low array<long>, widths array<int>, "
        "slices binary"), "bit-sliced")


def _queries_of(every: int):
    schema = pa.schema([("query_id", pa.int64()), ("block", pa.int64()), ("place", pa.int32()),
                        ("dim", pa.int32()), ("x", pa.list_(pa.int32()))])

    def take(batches):
        for batch in batches:
            for row in batch.to_pylist():
                places = [i for i, v in enumerate(row["ids"]) if v is not None and v % every == 0]
                if places:
                    x = _Block(row).values()[places]
                    yield pa.RecordBatch.from_pylist(
                        [{"query_id": row["ids"][i], "block": row["block"], "place": i,
                          "dim": row["dim"], "x": v} for i, v in zip(places, x.tolist(), strict=True)],
                        schema)
    return take


# ---------------------------------------------------------------------------
# Scores by bitmap arithmetic

def _signed_digits(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Non-adjacent form: indexes into ``values``, exponents and signs of all
    non-zero digits."""
    rest, sign = np.abs(values).astype(np.int64), np.sign(values).astype(np.int64)
    at, power, digit, e = [], [], [], 0
    while rest.any():
        d = np.where(rest & 1, 2 - (rest & 3), 0)
        hit = np.flatnonzero(d)
        at.append(hit)
        power.append(np.full(len(hit), e))
        digit.append(d[hit] * sign[hit])
        rest = (rest - d) >> 1
        e += 1
    if not at:
        return (np.zeros(0, np.int64),) * 3
    return np.concatenate(at), np.concatenate(power), np.concatenate(digit)


def _terms(block: _Block, x: np.ndarray) -> tuple[list[list[int]], int]:
    """Planes to add at each power of two, and the constant of all rows, so
    that their sum is the inner product with x."""
    comp, power, digit = _signed_digits(x)
    weights: list[list[int]] = []
    constant = int(np.dot(x.astype(object), block.low.astype(object))) if len(x) else 0
    for d, e, s in zip(comp.tolist(), power.tolist(), digit.tolist(), strict=True):
        w = block.widths[d]
        while len(weights) < e + w:
            weights.append([])
        first = int(block.first[d]) + (0 if s > 0 else block.n_slices)
        for b in range(w):
            weights[e + b].append(first + b)
        if s < 0:
            constant -= ((1 << w) - 1) << e
    return weights, constant


def _score_slices(block: _Block, terms: list[list[list[int]]]) -> np.ndarray:
    """[slices, queries, words]: the sums of the planes of several queries."""
    depth = max((len(t) for t in terms), default=0)
    out, carried, level = [], [], 0
    while level < depth or carried:
        lists = [t[level] if level < len(t) else [] for t in terms]
        most = max(map(len, lists))
        stack = np.empty((most + len(carried), len(terms), block.words), np.uint64)
        if most:
            empty = len(block.planes) - 1
            index = np.array([p + [empty] * (most - len(p)) for p in lists]).T
            np.take(block.planes, index, axis=0, out=stack[:most])
        if carried:
            stack[most:] = carried
        carried = []
        while len(stack) > 2:
            third = len(stack) // 3
            a, b, c = stack[:third], stack[third:2 * third], stack[2 * third:3 * third]
            half = a ^ b
            carry = a & b
            total = half ^ c
            half &= c
            carry |= half
            carried.extend(carry)
            stack = np.concatenate([total, stack[3 * third:]])
        if len(stack) == 2:
            carried.append(stack[0] & stack[1])
            stack = stack[:1] ^ stack[1:]
        out.append(stack[0] if len(stack) else np.zeros((len(terms), block.words), np.uint64))
        level += 1
    return np.array(out) if out else np.zeros((0, len(terms), block.words), np.uint64)


def _select(slices: np.ndarray, candidates: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """From the most significant slice downward: rows surely among the k best,
    and rows tied at the boundary ([queries, words] each)."""
    sure, tied = np.zeros_like(candidates), candidates
    for plane in slices[::-1]:
        upper = tied & plane
        both = sure | upper
        n = np.bitwise_count(both).sum(axis=1, dtype=np.int64)
        many, few = (n > k)[:, None], (n < k)[:, None]
        sure = np.where(many, sure, both)
        tied = np.where(many, upper, np.where(few, tied & ~plane, 0))
    return sure, tied


def _best_of_block(block: _Block, queries: list[tuple[tuple, np.ndarray]], own: list[int | None],
                   k: int):
    """(query, vec_id, score) of the k best rows of one block for each query;
    ``own`` is the query's place in it, which is no candidate."""
    for at in range(0, len(queries), BATCH):
        part = queries[at:at + BATCH]
        made = [_terms(block, x) for _, x in part]
        slices = _score_slices(block, [t for t, _ in made])
        candidates = np.repeat(block.every[None, :], len(part), axis=0)
        for i, place in enumerate(own[at:at + BATCH]):
            if place is not None:
                candidates[i, place // 64] &= ~(np.uint64(1) << np.uint64(place % 64))
        sure, tied = _select(slices, candidates, k)
        for i, (key, _) in enumerate(part):
            rows = np.flatnonzero(_unpacked(sure[i], block.n))
            if len(rows) < k:       # ties, smallest ids first: rows stand in the order of their ids
                rows = np.concatenate([rows, np.flatnonzero(_unpacked(tied[i], block.n))[:k - len(rows)]])
            score = np.zeros(len(rows), np.int64)
            for b, plane in enumerate(slices[:, i]):
                score += (plane[rows // 64] >> (rows % 64).astype(np.uint64) & np.uint64(1)).astype(np.int64) << b
            for row, s in zip(rows.tolist(), score.tolist(), strict=True):
                yield key, block.ids[row], s + made[i][1], (block.block, row)


def _scorer(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("block", pa.int64()), ("place", pa.int32()),
                        ("vec_id", pa.int64()), ("score", pa.int64())])

    def score(queries, blocks):
        asked = [((q["query_id"], q["block"], q["place"]), np.array(q["x"], np.int64))
                 for q in queries.to_pylist()]
        best: dict[tuple, list] = {key: [] for key, _ in asked}
        for i in range(blocks.num_rows):
            block = _Block(blocks.slice(i, 1).to_pylist()[0])
            own = [key[2] if key[1] == block.block else None for key, _ in asked]
            for key, vec_id, s, place in _best_of_block(block, asked, own, k):
                best[key].append((-s, vec_id is None, vec_id or 0, place, vec_id))
            for key, found in best.items():
                found.sort()
                del found[k:]
        return pa.Table.from_pylist(
            [{"query_id": key[0], "block": key[1], "place": key[2], "vec_id": f[4], "score": -f[0]}
             for key, found in best.items() for f in found], schema)
    return score


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, id_column: str = "vec_id",
          vector_column: str = "embedding", chunk: int = CHUNK, block_rows: int = BLOCK_ROWS,
          group_rows: int = GROUP_ROWS) -> DataFrame:
    """The ``k`` rows with the greatest integer inner product for every row
    whose id is divisible by ``every``: (query_id, rank from 1, vec_id, score),
    ties by smaller id, null ids last.

    Candidates are all rows but the query's own, told by its place in the
    index: a row that repeats the query, id included, is a candidate, and each
    row of a repeated id is a query. Rows with a null id are candidates, never
    queries. Vectors of different lengths have no product and are not
    compared. Null or unfit vectors take no part; an empty table gives none."""
    spark = vectors.sparkSession
    index = build_index(quantised(vectors, id_column, vector_column), block_rows)
    asked = saved(map_arrow(index, _queries_of(every),
                            "query_id long, block long, place int, dim int, x array<int>"), "queries")
    size = index.agg(F.count(F.lit(1)).alias("blocks"), F.sum("n_rows").alias("rows")).first()
    chunks = max(-(-asked.count() // chunk), 1)
    groups = max(-(-(size["rows"] or 0) // group_rows),
                 min(-(-spark.sparkContext.defaultParallelism // chunks), size["blocks"]), 1)
    deal, tasks = ["chunk", "part", "dim"], 2 * chunks * groups
    left = (asked.withColumn("chunk", F.pmod(F.xxhash64("block", "place"), F.lit(chunks)).cast("int"))
                 .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
                 .repartition(tasks, *deal))
    right = (index.withColumn("part", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int"))
                  .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))
                  .repartition(tasks, *deal))
    found = left.groupBy(*deal).cogroup(right.groupBy(*deal)).applyInArrow(
        _scorer(k), "query_id long, block long, place int, vec_id long, score long")
    order = Window.partitionBy("block", "place").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                 .select("query_id", "rank", "vec_id", "score"))
