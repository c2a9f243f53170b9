"""Rows of written Parquet files named by their place, and left out by it.

A place is a file and a row number within it. Places of rows to leave out are
shuffled instead of whole rows; they become one bit a row (64 MB for half a
thousand million rows), in blocks of ``BLOCK_ROWS`` rows, which every task that
reads the files gets. A file is named by 128 bits of hashes of its path.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

BLOCK_ROWS = 1 << 18        # a power of two
# Files of more rows are left to a join of the rows themselves.
MOST_ROWS = 1 << 29
BY = ["_file", "_file2", "_block"]
BIT = "_bit"
MARKS = "_file long, _file2 long, _block long, _bits array<long>"


def _place() -> list[Column]:
    path, row = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    return [F.xxhash64(path).alias("_file"), F.xxhash64(path, F.lit(1)).alias("_file2"),
            F.shiftright(row, BLOCK_ROWS.bit_length() - 1).alias("_block"),
            row.bitwiseAND(F.lit(BLOCK_ROWS - 1)).cast("int").alias(BIT)]


def placed(rows: DataFrame, *columns: str) -> DataFrame:
    """``columns`` of rows read from files, with the place of each row."""
    return rows.select(*columns, *_place())


def _set_bits(key, rows):
    bits = np.zeros(BLOCK_ROWS, np.uint8)
    bits[rows.column(BIT).to_numpy()] = 1
    words = np.packbits(bits, bitorder="little").view(np.int64)
    return pa.table({**{c: pa.array([k.as_py()], pa.int64()) for c, k in zip(BY, key, strict=True)},
                     "_bits": pa.array([words], pa.list_(pa.int64()))})


def marks(places: DataFrame) -> DataFrame:
    """One row a block that holds any of the ``places``."""
    return places.select(*BY, BIT).groupBy(*BY).applyInArrow(_set_bits, MARKS)


def without(rows: DataFrame, marked: DataFrame) -> DataFrame:
    """``rows``, read from files, without those that are marked."""
    word = F.get("_bits", F.shiftright(BIT, 6))
    out = placed(rows, *rows.columns).join(F.broadcast(marked), BY, "left")
    return out.where(F.coalesce(F.getbit(word, F.col(BIT).bitwiseAND(63)), F.lit(0)) == 0).select(*rows.columns)
