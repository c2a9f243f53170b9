"""Stupid-backoff language-model scores of all documents.

The model is the counts of all word n-grams up to ``order``, over every
document. Documents are gathered into pieces of a few megabytes of text; a
piece names its distinct n-grams once, dealt out by the leading bits of their
hash. Each part of the count table sums its n-grams over all pieces and sends
the totals back, so an n-gram travels once per piece and not once per
occurrence, and no part depends on how common an n-gram is. The number of
parts follows the words counted, that of scoring tasks the pieces, so neither
grows with the corpus. Pieces then look up every position and add up the
logarithms per document.

A document is scored by the other documents: its own n-grams are taken off the
counts (``held_out``). With c the remaining count, a word after a context scores
c(context word) / c(context) if that is not 0, else ``backoff`` times its score
after the shorter context; a single word scores c(word) / N, and one without
any count 1 / (N + 1).

Words are ``[^\\x20\\x09-\\x0D]+``, A-Z equal to a-z; contexts stay within a
document. Defined cases: null and empty texts have no words and a null score;
null ids pass through; rows that repeat an id are separate documents; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rides.llm.common import col, map_arrow, saved

ORDER = 3
BACKOFF = 0.4
PIECE_BYTES = 4 << 20
PART_WORDS = 1 << 20    # words of the corpus for each part of a count table
TASK_PIECES = 4         # pieces that a scoring task gets, on average
PIECE = "piece long, doc_ids array<long>, lengths array<int>, vocabulary binary, places binary, n_words long"


def _pieces(docs: DataFrame) -> DataFrame:
    """Documents as places in a vocabulary of word hashes, in pieces."""
    def run(batches: Iterator) -> Iterator:
        import os
        import zlib

        import numpy as np
        import pyarrow as pa

        from rides.llm import text_hash as t

        for whole in batches:
            for batch in t.batches(whole, 1, PIECE_BYTES):
                word, first = t.words(*t.arrow_bytes(batch.column(1)))
                vocabulary, places = np.unique(word, return_inverse=True)
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays([
                    pa.array([int.from_bytes(os.urandom(8), "little") >> 1]),
                    pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), batch.column(0)),
                    pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), pa.array(np.diff(first), pa.int32())),
                    pa.array([vocabulary.tobytes()], pa.binary()),
                    pa.array([zlib.compress(places.astype(np.uint32).tobytes(), 1)], pa.binary()),
                    pa.array([len(word)]),
                ], [f.split()[0] for f in PIECE.split(", ")])

    return map_arrow(docs, run, PIECE)


def _unpacked(vocabulary: bytes, places: bytes, lengths: list):
    """Word hashes, and for each position its document and place in it."""
    import zlib

    import numpy as np

    at = np.frombuffer(zlib.decompress(places), np.uint32)
    lengths = np.asarray(lengths, np.int64)
    doc = np.repeat(np.arange(len(lengths)), lengths)
    inner = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    return np.frombuffer(vocabulary, np.uint64)[at], doc, inner


def _grams(word, inner, n: int):
    """Hashes of the n-grams inside documents, and the positions they end at."""
    import numpy as np

    from rides.llm.text_hash import runs

    ends = np.flatnonzero(inner >= n - 1)
    return runs(word, n)[ends - (n - 1)], ends


def _requests(pieces: DataFrame, n: int, bits: int) -> DataFrame:
    """part, piece, grams (sorted hashes), counts of the piece, by the leading
    bits of the hash."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for piece, lengths, vocabulary, places in zip(*[c.to_pylist() for c in batch.columns]):
                word, _, inner = _unpacked(vocabulary, places, lengths)
                grams, counts = np.unique(_grams(word, inner, n)[0], return_counts=True)
                part = (grams >> np.uint64(64 - bits)).astype(np.int64)
                first = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1]))) if len(part) else part
                stop = np.append(first[1:], len(part))
                spans = list(zip(first.tolist(), stop.tolist())) if len(part) else []
                counts = counts.astype(np.uint32)
                yield pa.RecordBatch.from_arrays([
                    pa.array(part[first], pa.int64()), pa.array(np.full(len(spans), piece, np.int64)),
                    pa.array([grams[a:b].tobytes() for a, b in spans], pa.binary()),
                    pa.array([counts[a:b].tobytes() for a, b in spans], pa.binary())],
                    ["part", "piece", "grams", "counts"])

    rows = pieces.select("piece", "lengths", "vocabulary", "places")
    return map_arrow(rows, run, "part long, piece long, grams binary, counts binary")


def _totals(pieces: DataFrame, n: int, bits: int) -> DataFrame:
    """piece, n, part, totals: corpus counts of a piece's n-grams, in order."""
    def count(group):
        import zlib

        import numpy as np
        import pyarrow as pa

        grams = [np.frombuffer(x.as_buffer(), np.uint64) for x in group["grams"]]
        counts = [np.frombuffer(x.as_buffer(), np.uint32) for x in group["counts"]]
        every, place = np.unique(np.concatenate(grams), return_inverse=True)
        total = np.zeros(len(every), np.int64)
        np.add.at(total, place, np.concatenate(counts))
        own, at, out = total[place], 0, []
        for g in grams:
            out.append(zlib.compress(own[at:at + len(g)].tobytes(), 1))
            at += len(g)
        return pa.table({"piece": group["piece"].combine_chunks(), "n": pa.array([n] * len(out), pa.int32()),
                         "part": group["part"].combine_chunks(), "totals": pa.array(out, pa.binary())})

    requests = _requests(pieces, n, bits).repartition(1 << bits, "part")
    return saved(requests.groupBy("part").applyInArrow(
        count, "piece long, n int, part long, totals binary"), f"lm-totals-{n}")


def _scored(word, doc, inner, lengths, totals: dict, size: int, backoff: float, held_out: bool):
    """Summed logarithms per document of a piece."""
    import numpy as np

    total = {}      # per order: count at each position, 0 where there is no such n-gram
    for n, known in totals.items():
        grams, ends = _grams(word, inner, n)
        place = np.unique(grams, return_inverse=True)[1]
        count = known[place]
        if held_out and len(grams):
            pair = doc[ends] * (len(known) + 1) + place
            _, where, own = np.unique(pair, return_inverse=True, return_counts=True)
            count = count - own[where]
        total[n] = np.zeros(len(word), np.int64)
        total[n][ends] = count
    rest = (size - lengths if held_out else np.full(len(lengths), size))[doc]
    score = np.zeros(len(word))
    open_, factor = np.ones(len(word), bool), np.zeros(len(word))
    for n in sorted(totals, reverse=True):
        if n == 1:
            continue
        here = open_ & (inner >= n - 1)
        hit = np.flatnonzero(here & (total[n] > 0))
        # The context is the (n-1)-gram that ends one word before.
        score[hit] = np.log(total[n][hit]) - np.log(total[n - 1][hit - 1]) + factor[hit]
        open_[hit] = False
        here[hit] = False
        factor[here] += np.log(backoff)
    left = np.flatnonzero(open_)
    seen = total[1][left] > 0
    single = np.where(seen, total[1][left], 1) / np.where(seen, rest[left], rest[left] + 1)
    score[left] = np.log(single) + factor[left]
    # A piece without words would be counted in integers.
    return np.bincount(doc, score, len(lengths)).astype(np.float64)


def lm_scores(df: DataFrame, order: int = ORDER, backoff: float = BACKOFF, held_out: bool = True,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, log_score (natural, summed), mean_log of every row."""
    docs = df.select(col(id_col).cast("long").alias("doc_id"), col(text_col).alias("text"))
    pieces = saved(_pieces(docs), "lm-pieces")
    counted = pieces.agg(F.sum("n_words").alias("n"), F.count(F.lit(1)).alias("pieces")).collect()[0]
    size, tasks = counted["n"] or 0, counted["pieces"] // TASK_PIECES + 1
    bits = max(1, (size // PART_WORDS).bit_length())
    totals = None
    for n in range(1, order + 1):
        found = _totals(pieces, n, bits)
        totals = found if totals is None else totals.unionByName(found)
    # At most ``order`` rows a part, for the n-grams of one piece.
    per_piece = totals.repartition(tasks, "piece").groupBy("piece").agg(F.collect_list(F.struct("n", "part", "totals")).alias("totals"))

    def run(batches: Iterator) -> Iterator:
        import zlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for i in range(batch.num_rows):
                ids, lengths, vocabulary, places, answers = (c[i] for c in batch.columns)
                word, doc, inner = _unpacked(vocabulary.as_py(), places.as_py(), lengths.as_py())
                known: dict = {n: [np.zeros(0, np.int64)] for n in range(1, order + 1)}
                for a in sorted(answers.as_py() or (), key=lambda a: (a["n"], a["part"])):
                    known[a["n"]].append(np.frombuffer(zlib.decompress(a["totals"]), np.int64))
                n_words = np.asarray(lengths.as_py(), np.int64)
                score = _scored(word, doc, inner, n_words, {n: np.concatenate(v) for n, v in known.items()},
                                size, backoff, held_out)
                empty = n_words == 0
                mean = score / np.maximum(n_words, 1)
                yield pa.RecordBatch.from_arrays(
                    [ids.values, pa.array(n_words), pa.array(score, mask=empty), pa.array(mean, mask=empty)],
                    ["doc_id", "n_words", "log_score", "mean_log"])

    rows = pieces.repartition(tasks, "piece").join(per_piece, "piece", "left").select("doc_ids", "lengths", "vocabulary", "places", "totals")
    return map_arrow(rows, run, "doc_id long, n_words long, log_score double, mean_log double")
