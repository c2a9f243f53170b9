"""Harmonic packing of tokenized documents into training sequences.

A piece of n tokens belongs to class k = capacity // n; a bin of class k takes
k pieces of at most capacity // k tokens, so each class fills its bins by
counting alone, and every worker fills its own bins without a shuffle. The last
class holds the short rests and is filled one after the other, as in the
original scheme. A document is cut where its rest would waste a slot: at the
next smaller reciprocal size. What is left in unfilled bins when a worker's
rows end joins the last class; its final partial sequence is cut into sequences
whose lengths are powers of two, which need no padding.

Defined cases: null text is an empty text (its end id is one piece); a null id
passes through; rows that repeat an id are separate documents; an empty table
gives no pieces; input columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rides.llm.common import col, map_arrow, slices
from rides.llm.tokens import END_ID, default_tokenizer, encode_documents

SCHEMA = ("doc_id long, start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long, sequence_tokens long")
ID_BITS = 33    # sequences of one task


def cut(n: int, capacity: int, classes: int, slack: int) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document of n tokens. A piece may
    waste 1/slack of its slot; ``classes`` marks the last class."""
    out = [(capacity, 1)] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        size = capacity // k
        if k >= classes:
            out.append((rest, classes))
            break
        if (size - rest) * slack <= size:
            out.append((rest, k))
            break
        smaller = capacity // (k + 1)
        if k + 1 >= classes:
            out.append((rest, classes))
            break
        out.append((smaller, k + 1))
        rest -= smaller
    return out


class Packer:
    """One worker's bins. ``rows`` collects finished pieces."""

    def __init__(self, first_id: int, capacity: int, classes: int, slack: int):
        self.capacity, self.classes, self.slack = capacity, classes, slack
        self.next_id = first_id
        self.bins: dict[int, list] = {}
        self.rest: list = []
        self.rest_tokens = 0
        self.rows: list[tuple] = []

    def _close(self, pieces: list) -> None:
        total, at = sum(len(p[2]) // 4 for p in pieces), 0
        for doc, start, ids, n in pieces:
            length = len(ids) // 4
            self.rows.append((doc, start, length, ids, n, self.next_id, at, total))
            at += length
        self.next_id += 1

    def _append(self, piece: tuple, room: int) -> None:
        """Add to the last class, closing a sequence at every ``room`` tokens."""
        doc, start, ids, n = piece
        while len(ids) // 4 >= room - self.rest_tokens:
            take = room - self.rest_tokens
            self.rest.append((doc, start, ids[:4 * take], n))
            self._close(self.rest)
            self.rest, self.rest_tokens = [], 0
            start, ids = start + take, ids[4 * take:]
            if not ids:
                return
        self.rest.append((doc, start, ids, n))
        self.rest_tokens += len(ids) // 4

    def add(self, doc, ids: bytes) -> None:
        n, at = len(ids) // 4, 0
        for length, k in cut(n, self.capacity, self.classes, self.slack):
            piece = (doc, at, ids[4 * at:4 * (at + length)], n)
            at += length
            if k >= self.classes:
                self._append(piece, self.capacity)
                continue
            held = self.bins.setdefault(k, [])
            held.append(piece)
            if len(held) == k:
                self._close(held)
                del self.bins[k]

    def finish(self) -> None:
        for k in sorted(self.bins):
            for piece in self.bins[k]:
                self._append(piece, self.capacity)
        left, total = self.rest, self.rest_tokens
        self.bins, self.rest, self.rest_tokens = {}, [], 0
        bit = 1 << total.bit_length()
        while left:
            bit >>= 1
            if not total & bit:
                continue
            pending, left = left, []
            for i, piece in enumerate(pending):
                doc, start, ids, n = piece
                need = bit - self.rest_tokens
                if len(ids) // 4 < need:
                    self.rest.append(piece)
                    self.rest_tokens += len(ids) // 4
                    continue
                self.rest.append((doc, start, ids[:4 * need], n))
                self._close(self.rest)
                self.rest, self.rest_tokens = [], 0
                if ids[4 * need:]:
                    left.append((doc, start + need, ids[4 * need:], n))
                left += pending[i + 1:]
                break


def pack(df: DataFrame, tokenizer: str | None = None, capacity: int = 4096,
         classes: int = 64, slack: int = 128, end_id: int = END_ID,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents with their place in a sequence.

    Columns: doc_id, start (ids of the document before the piece), length, ids
    (little-endian unsigned 32-bit), doc_tokens, sequence_id, offset in the
    sequence, sequence_tokens. One pass, no shuffle; a worker holds at most
    ``classes`` unfilled bins."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << ID_BITS
        packer = Packer(first, capacity, classes, slack)
        types = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 4]
        names = [c.split()[0] for c in SCHEMA.split(", ")]

        def flush():
            rows, packer.rows = packer.rows, []
            columns = list(zip(*rows)) or [()] * len(names)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in batches:
            docs = batch.column(0).to_pylist()
            texts = ["" if t is None else t for t in batch.column(1).to_pylist()]
            for a, b in slices(texts, 4 << 20):
                for doc, ids in zip(docs[a:b], encode_documents(texts[a:b], path, end_id)):
                    packer.add(doc, ids)
                if packer.rows:
                    yield flush()
        packer.finish()
        if packer.rows:
            yield flush()

    docs = df.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    return map_arrow(docs, run, SCHEMA)


def packed_digest(pieces: DataFrame) -> DataFrame:
    """The pieces with the checksum of their ids in place of the ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
                         "doc_tokens", "sequence_id", "offset", "sequence_tokens")
