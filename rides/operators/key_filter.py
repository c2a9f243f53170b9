"""Bloom filters of the keys of each month of a table.

A filter answers whether a month may hold a key without reading the month. It
is stored as rows (trip_month, blocks, block, bits): a key belongs to the block
that the low bits of its hash name, and sets ``PROBES`` bits there. The number
of blocks, a power of two, follows from the keys of the month, so that a block
holds some 16,000 keys and both sides of every join and group stay small
however large a month is. At 32 bits a key a key that a month lacks passes
with a probability of about 3e-7.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rides.sources.parquet import MONTH_COL

BLOCK_KEYS = 1 << 14
BITS_PER_KEY = 32
PROBES = 16
FILTER = "blocks long, block long, bits array<long>"


def blocks_for(keys: int) -> int:
    """Blocks of a month of so many keys: a power of two."""
    return 1 << max((keys - 1) // BLOCK_KEYS, 0).bit_length()


def _hashes(key: Column) -> tuple[Column, Column, Column]:
    """Block hash, first bit and step of the double hashing (31 bits each, so
    that no product overflows)."""
    second = F.xxhash64(key, F.lit(1))
    return (F.xxhash64(key), F.shiftrightunsigned(second, 33),
            second.bitwiseAND(F.lit(0x7FFFFFFF)).bitwiseOR(F.lit(1)))


def _set_bits(key, rows):
    """One block: its keys' bits."""
    month, blocks, block = (k.as_py() for k in key)
    first, step = (rows.column(c).to_numpy() for c in ("first", "step"))
    size = max(-(-len(first) * BITS_PER_KEY // 64), 1) * 64
    bits = np.zeros(size, np.uint8)
    for j in range(PROBES):
        bits[(first + j * step) % size] = 1
    words = np.packbits(bits, bitorder="little").view(np.int64)
    return pa.table({MONTH_COL: pa.array([month], pa.string()), "blocks": pa.array([blocks], pa.int64()),
                     "block": pa.array([block], pa.int64()),
                     "bits": pa.array([words], pa.list_(pa.int64()))})


def build_filters(rows: DataFrame, key: str, counts: dict[str, int]) -> DataFrame:
    """Filters of the non-null keys of ``rows`` (key, trip_month); ``counts``
    gives the rows of each month."""
    hashed, first, step = _hashes(F.col(key))
    sizes = rows.sparkSession.createDataFrame(
        [(m, blocks_for(n)) for m, n in counts.items()], f"{MONTH_COL} string, blocks long")
    return (rows.where(F.col(key).isNotNull())
                .join(F.broadcast(sizes), MONTH_COL)          # one row a month
                .select(MONTH_COL, "blocks", hashed.bitwiseAND(F.col("blocks") - 1).alias("block"),
                        first.alias("first"), step.alias("step"))
                .groupBy(MONTH_COL, "blocks", "block")
                .applyInArrow(_set_bits, f"{MONTH_COL} string, {FILTER}"))


def _probe(key, keys, filters):
    """Months whose filter of one block passes at least one of the keys."""
    first, step = (keys.column(c).to_numpy() for c in ("first", "step"))
    passed = []
    for i in range(filters.num_rows):
        bits = filters.column("bits")[i].values.to_numpy().view(np.uint64)
        size, f, s = 64 * len(bits), first, step
        for j in range(PROBES):
            at = (f + j * s) % size
            hit = bits[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1) == 1
            f, s = f[hit], s[hit]
            if not len(f):
                break
        else:
            passed.append(filters.column(MONTH_COL)[i].as_py())
    return pa.table({MONTH_COL: pa.array(passed, pa.string())})


TASK_KEYS = 1 << 18


def months_that_may_hold(keys: DataFrame, key: str, filters: DataFrame, sizes: list[int],
                         n_keys: int) -> list[str]:
    """Months whose filter passes at least one of the ``keys``, about
    ``n_keys`` of them. ``sizes`` are the numbers of blocks that occur among
    the filters (a handful); keys of a block are dealt over several tasks where
    they are many, each of which gets the block's filters."""
    hashed, first, step = _hashes(F.col(key))
    shares = {b: max(-(-n_keys // (b * TASK_KEYS)), 1) for b in sizes}
    asked = (keys.where(F.col(key).isNotNull())
                 .select(hashed.alias("_h"), first.alias("first"), step.alias("step"))
                 .withColumn("size", F.explode(F.array(*(F.struct(
                     F.lit(b).cast("long").alias("blocks"), F.lit(n).cast("long").alias("shares"))
                     for b, n in shares.items()))))
                 .select("size.*", "_h", "first", "step")
                 .select("blocks", F.col("_h").bitwiseAND(F.col("blocks") - 1).alias("block"),
                         F.pmod(F.shiftright("_h", 40), F.col("shares")).alias("share"), "first", "step"))
    copies = F.coalesce(*(F.when(F.col("blocks") == b, F.lit(n).cast("long")) for b, n in shares.items()))
    held = filters.withColumn("share", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
    by = ["blocks", "block", "share"]
    found = asked.groupBy(*by).cogroup(held.groupBy(*by)).applyInArrow(_probe, f"{MONTH_COL} string")
    return sorted(r[0] for r in found.distinct().collect())
