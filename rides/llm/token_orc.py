"""Token ids as ORC files in ascending document order.

Each file holds one range of document ids, each row one document: its ids as a
list of ints (ORC's integer run-length encoding), its length and its place in
the file. Row indexes and a Bloom filter on doc_id let a lookup skip files,
stripes and row groups; a full read is split by stripe.

Defined cases: null text is empty (only the end id); null ids come first;
rows that repeat an id are separate documents, ordered by a hash of their text;
an empty table gives files without rows; other input columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rides.llm.common import col, map_arrow, slices
from rides.llm.tokens import END_ID, default_tokenizer, encode_documents

SCHEMA = "part int, place long, doc_id long, n_tokens long, ids array<int>"
ORC_OPTIONS = {
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
    "orc.stripe.size": str(16 << 20),
    "compression": "zstd",
    "orc.compression.zstd.level": "1",
}


def _tokenized(docs: DataFrame, path: str, end_id: int) -> DataFrame:
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        part, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids = batch.column(0)
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            for a, b in slices(texts, 4 << 20):
                raw = encode_documents(texts[a:b], path, end_id)
                n = np.array([len(x) // 4 for x in raw], np.int64)
                stops = np.concatenate(([0], np.cumsum(n)))
                lists = pa.ListArray.from_arrays(
                    pa.array(stops, pa.int32()),
                    pa.array(np.frombuffer(b"".join(raw), np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(b - a, part, np.int32)), pa.array(place + stops[:-1]),
                     ids.slice(a, b - a), pa.array(n), lists],
                    ["part", "place", "doc_id", "n_tokens", "ids"])
                place += int(stops[-1])

    return map_arrow(docs, run, SCHEMA)


def write_tokens(df: DataFrame, path: str, tokenizer: str | None = None,
                 end_id: int = END_ID, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Encode every text and write the ORC files to ``path``. One range
    shuffle of the texts, which also spreads documents evenly."""
    docs = df.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    ranged = (docs.withColumn("tie", F.xxhash64("text"))
              .repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie"))
    tokens = _tokenized(ranged.select("doc_id", "text"), tokenizer or default_tokenizer(), end_id)
    tokens.write.options(**ORC_OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids of every document written to ``path``.
    ``start`` adds the total of the files before (from their n_tokens column
    alone) to the document's place in its file."""
    rows = spark.read.schema(SCHEMA).orc(path)
    totals = rows.groupBy("part").agg(F.sum("n_tokens").alias("total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    # One row a file: bounded by the number of write tasks.
    return (rows.join(F.broadcast(bases), "part")
            .select("doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "ids"))


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Rows of the given documents. The filter reaches the reader, where file,
    stripe and row-group statistics and the Bloom filter prune."""
    rows = spark.read.schema(SCHEMA).orc(path)
    return rows.where(F.col("doc_id").isin([int(i) for i in doc_ids])).select(
        "doc_id", "n_tokens", "ids")


def tokens_digest(rows: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 from rows read back."""
    def run(batches: Iterator) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            lists = batch.column(3)
            stops = np.asarray(lists.offsets).astype(np.int64) * 4
            # offsets of a slice count from the whole buffer
            raw = np.ascontiguousarray(np.asarray(lists.values).astype("<i4", copy=False))
            raw = memoryview(raw.view(np.uint8))
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(stops[:-1].tolist(), stops[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(crc, pa.int64())],
                ["doc_id", "start", "n_tokens", "ids_crc32"])

    return map_arrow(rows.select("doc_id", "start", "n_tokens", "ids"), run,
                     "doc_id long, start long, n_tokens long, ids_crc32 long")
