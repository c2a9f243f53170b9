"""Sharding by extendible hashing.

A row's key is 60 bits of a hash of its id. The directory starts with one
bucket of depth 0; a bucket over the byte limit splits on the next bit of the
key, and only such buckets do. The directory is worked out from a histogram of
key prefixes, so rows are not moved until their shard is known; cells of the
histogram that are still too large are counted again with more bits.

A row's size is that of all its columns, as files hold them all. Rows that
share one id share all bits. A bucket that no bit can split becomes a chain of
numbered parts, as an overflow chain does; a row above the limit is a part of
its own there. The rows of chains are written first, and each file range of
them numbers its own parts, so that no task holds the whole chain of a hot id.

Defined cases: null text has no bytes; null ids share one key; repeated rows
are kept, each in one part; a bucket that holds one row above the limit is a
shard above the limit; an empty table gives no shards; the columns ``shard``
and ``part`` get leading underscores where the input has such names. Which rows
of a chain share a part may differ between runs; numbers may have gaps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from rides.llm.common import col, free, prepare, saved

BITS = 60
LIMIT = 16 << 20
ROW_BYTES = 16      # counted for each row besides its columns
VALUE_BYTES = 8     # counted for a value of a type of fixed width
MORE_BITS = 3       # histogram bits beyond the expected depth, and per recount
COARSE_BITS = 12    # directories up to these bits are worked out in one task
TASK_SHARDS = 4     # shards that a writing task gets, on average, were all full
# Directory cells up to this many (two numbers each) are broadcast.
BROADCAST_ROWS = 500_000


def key_of(doc_id: Column) -> Column:
    """60 bits of md5 of the id's decimal text (null: of the empty text)."""
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))
    return F.conv(F.substr(digest, F.lit(1), F.lit(BITS // 4)), 16, 10).cast("long")


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row of ``df``: of its strings and binaries, of the text of
    its nested values, and fixed numbers for other values and the row."""
    size = F.lit(ROW_BYTES).cast("long")
    for field in df.schema.fields:
        value = col(field.name)
        if not isinstance(field.dataType, (StringType, BinaryType)):
            if not isinstance(field.dataType, (ArrayType, MapType, StructType)):
                size = size + VALUE_BYTES
                continue
            value = value.cast("string")
        size = size + F.coalesce(F.octet_length(value), F.lit(0))
    return size


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _depths(cells: DataFrame, low: int, high: int, limit: int) -> DataFrame:
    """``cells`` (prefixes of ``high`` bits) with the smallest depth from
    ``low`` on at which the bucket of each is within the limit; null where
    none is. The buckets of the first bits hold very many cells and are worked
    out from sums, of which there are at most 2^COARSE_BITS."""
    coarse = None
    if low <= COARSE_BITS < high:
        prefix = F.shiftrightunsigned("cell", high - COARSE_BITS)
        sums = cells.groupBy(prefix.alias("cell")).agg(F.sum("bytes").alias("bytes"))
        coarse = F.broadcast(_depths(sums, low, COARSE_BITS, limit).select(
            F.col("cell").alias("prefix"), F.col("depth").alias("coarse")))
        cells = cells.withColumn("prefix", prefix)
        low = COARSE_BITS + 1
    depth, sums = F.lit(None).cast("int"), {}
    for d in range(high, low - 1, -1):
        over = Window.partitionBy(F.shiftrightunsigned("cell", high - d))
        sums[f"at{d}"] = F.sum("bytes").over(over)
        depth = F.when(F.col(f"at{d}") <= limit, F.lit(d)).otherwise(depth)
    found = cells.withColumns(sums).withColumn("depth", depth)
    if coarse is not None:
        found = found.join(coarse, "prefix", "left").withColumn("depth", F.coalesce("coarse", "depth"))
    return found.drop("prefix", "coarse", *sums)


def directory(keys: DataFrame, limit: int = LIMIT) -> tuple[int, list[tuple[int, DataFrame, int]]]:
    """Bytes of all rows, and (bits, cells, number of cells) of each round of
    splitting rows of (key, size): cells holds ``cell``, ``bytes``, ``depth`` and
    ``chain``. Depth is null for cells above the limit: chains where they hold a
    single key, else split on in the next round, which counts their rows only. A
    round has about 2^MORE_BITS cells for every shard it makes."""
    total = keys.agg(F.sum("size").alias("t")).collect()[0]["t"] or 0
    low, high, rest, rounds = 0, min(BITS, (total // limit).bit_length() + MORE_BITS), keys, []
    while True:
        cell = F.shiftrightunsigned("key", BITS - high)
        cells = saved(rest.groupBy(cell.alias("cell")).agg(
            F.sum("size").alias("bytes"), (F.min("key") == F.max("key")).alias("chain")), "cells")
        cells = saved(_depths(cells, low, high, limit), "directory")
        rounds.append((high, cells, cells.count()))
        large = cells.where("depth is null and not chain").select("cell")
        n = large.count()
        if not n:
            return total, rounds
        rest = rest.withColumn("cell", cell).join(_small(large, n), "cell", "left_semi").drop("cell")
        low, high = high + 1, min(BITS, high + MORE_BITS)


def _chained(rows: DataFrame, limit: int) -> DataFrame:
    """Rows of chains with their ``part``. A file range is the unit that
    numbers parts: rows up to the limit by the bytes before them, then one part
    for each row above it; the numbers of a key's ranges follow each other."""
    rows = saved(rows, "chains").withColumn("range", F.spark_partition_id())
    small = F.col("size") <= limit
    least = F.when(small, F.col("size"))
    unit = Window.partitionBy("key", "range")
    before = unit.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    stride = limit + 1 - F.coalesce(F.max(least).over(unit), F.lit(0))
    rows = rows.withColumn("place", F.monotonically_increasing_id()).withColumns({
        "stride": stride, "bytes_before": F.coalesce(F.sum(least).over(before), F.lit(0)),
        "large_before": F.coalesce(F.count_if(~small).over(before), F.lit(0)),
        "all_bytes": F.coalesce(F.sum(least).over(unit), F.lit(0))})
    above = F.floor(F.col("all_bytes") / F.col("stride")) + 1 + F.col("large_before")
    rows = rows.withColumn("part", F.when(small, F.floor(F.col("bytes_before") / F.col("stride"))).otherwise(above))
    # One row for each file range that holds the key.
    ranges = rows.groupBy("key", "range").agg((F.max("part") + 1).alias("n"))
    earlier = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("key", "range", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    return rows.join(ranges, ["key", "range"]).withColumn("part", F.col("part") + F.col("first"))


def _assigned(df: DataFrame, limit: int, id_col: str) -> tuple[DataFrame, int]:
    """The rows of ``assign`` and their bytes."""
    prepare(df.sparkSession)
    size = row_bytes(df)
    names = [free(df, "shard"), free(df, "part")]
    total, rounds = directory(df.select(key_of(col(id_col)).alias("key"), size.alias("size")), limit)
    rows = df.select(F.struct(*[col(c) for c in df.columns]).alias("row"),
                     key_of(col(id_col)).alias("key"), size.alias("size"))
    depth = []
    for high, cells, n in rounds:
        name = f"depth{high}"
        found = cells.where("depth is not null").select(F.col("cell"), F.col("depth").alias(name))
        rows = rows.withColumn("cell", F.shiftrightunsigned("key", BITS - high)).join(
            _small(found, n), "cell", "left").drop("cell")
        depth.append(F.col(name))
    rows = rows.withColumn("depth", F.coalesce(*depth, F.lit(BITS)))
    bits = F.expr(f"shiftrightunsigned(key, {BITS} - depth)")
    shard = F.concat(F.lit("b"), F.when(F.col("depth") > 0, F.lpad(
        F.conv(bits.cast("string"), 10, 2), F.col("depth"), F.lit("0"))).otherwise(""))
    out = ["row", "shard", "part"]
    rows = rows.withColumns({"shard": shard, "part": F.lit(0).cast("long")})
    if any(not cells.where("depth is null and chain").isEmpty() for _, cells, _ in rounds):
        single = F.coalesce(*depth).isNotNull()
        chains = rows.where(~single).select("row", "key", "size", "shard")
        rows = rows.where(single).select(*out).unionByName(_chained(chains, limit).select(*out))
    return rows.select("row.*", F.col("shard").alias(names[0]), F.col("part").alias(names[1])), total


def assign(df: DataFrame, limit: int = LIMIT, id_col: str = "doc_id") -> DataFrame:
    """``df`` with ``shard`` ("b" and the bits of its bucket) and ``part``
    (0 but in chains of rows that share one id)."""
    return _assigned(df, limit, id_col)[0]


def write_shards(df: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id") -> DataFrame:
    """Write every shard's part as a folder of Parquet files under ``path``
    (one shuffle, by shard, with tasks counted from the bytes) and return what
    is there."""
    rows, total = _assigned(df, limit, id_col)
    folders = rows.columns[-2:]
    tasks = total // (TASK_SHARDS * limit) + 1
    rows.repartition(tasks, *[col(c) for c in folders]).write.partitionBy(*folders).parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)
