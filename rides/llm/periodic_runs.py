"""Maximal periodic runs of words, found with string synchronising sets.

A run is a stretch of words with smallest period q (words q apart are equal),
at least 3q words and at least ``least`` words long, that no neighbouring word
extends. A task takes the texts of an Arrow batch as one string of word
numbers, with a word of its own after each text, so that no run crosses texts.

* Periods below 16 are found by comparing the string with itself shifted.
  Together with the runs of earlier scales these are the highly periodic
  regions that a synchronising set leaves out.
* At scale t = 8, 16, 32, ... the set holds the positions i at which the least
  hash among the t-word grams that start in [i, i + t] stands at i or at i + t;
  grams with a period of t/3 or less take no part. Membership depends on the
  2t words from i alone, so a run of period p in [2t, 4t) repeats its members
  at distance p, and it has one with both contexts inside: without a member
  in its first p places these would have a period of at most t/3, and so would
  the run. Pairs of members with equal contexts, 2t to 4t apart, propose
  periods; each is extended word by word, and kept if no smaller period fits.

Every pair is compared on word numbers, so hashes decide nothing. A scale
reads only texts of 6t words or more. A text is handled whole in one task.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rides.llm.common import col, let, map_arrow, space_words
from rides.llm.text_hash import batches, mixed

LEAST_WORDS = 24
DIRECT = 16         # periods below it are compared directly; the first scale is half of it
BATCH_BYTES = 4 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.uint64(2**64 - 1)


@lru_cache(maxsize=1 << 14)
def _prime_factors(n: int) -> tuple[int, ...]:
    out, f = [], 2
    while f * f <= n:
        if n % f == 0:
            out.append(f)
            while n % f == 0:
                n //= f
        f += 1
    return (*out, n) if n > 1 else tuple(out)


def _is_smallest(x: np.ndarray, start: int, stop: int, period: int) -> bool:
    """No period below ``period`` (which fits thrice or more) fits the stretch."""
    return not any(np.array_equal(x[start:stop - t], x[start + t:stop])
                   for t in (period // f for f in _prime_factors(period)))


def _equal_stretch(x: np.ndarray, i: int, d: int) -> tuple[int, int]:
    """The longest [a, b) around i with x[k] == x[k + d] for every k in it."""
    b, step = i, 64
    while b < len(x) - d:
        c = min(b + step, len(x) - d)
        differs = x[b:c] != x[b + d:c + d]
        if differs.any():
            b += int(differs.argmax())
            break
        b, step = c, 2 * step
    a, step = i, 64
    while a > 0:
        c = max(a - step, 0)
        differs = (x[c:a] != x[c + d:a + d])[::-1]
        if differs.any():
            a -= int(differs.argmax())
            break
        a, step = c, 2 * step
    return a, b


def _shifted(values: np.ndarray, by: int) -> np.ndarray:
    out = np.zeros_like(values)
    out[:len(values) - by] = values[by:]
    return out


def _direct(x: np.ndarray) -> list[tuple[int, int, int]]:
    """Every run of period below DIRECT and at least three periods."""
    out = []
    for p in range(1, min(DIRECT, len(x))):
        same = np.zeros(len(x) - p + 2, np.int8)
        np.equal(x[:-p], x[p:], out=same[1:-1].view(bool))
        edges = np.flatnonzero(same[1:] != same[:-1])
        a, b = edges[::2], edges[1::2]
        for i in np.flatnonzero(b - a >= 2 * p):
            start, stop = int(a[i]), int(b[i]) + p
            if _is_smallest(x, start, stop, p):
                out.append((start, stop, p))
    return out


def _members(grams: np.ndarray, t: int, periodic: np.ndarray) -> np.ndarray:
    """Positions of the synchronising set of scale t."""
    ids = grams >> np.uint64(1)
    ids[periodic] = _NONE
    low, span = ids.copy(), 1
    while span < t:
        low[:-span] = np.minimum(low[:-span], low[span:])
        span *= 2
    low[:-1] = np.minimum(low[:-1], low[1:])
    chosen = ids == low
    chosen[:-t] |= ids[t:] == low[:-t]
    return np.flatnonzero(chosen & (low != _NONE))


def _proposals(members: np.ndarray, contexts: np.ndarray, t: int) -> list[tuple[int, int]]:
    """(distance, position) of members with equal contexts, 2t to 4t apart."""
    found, k = [], 1
    while k < len(members):
        gap = members[k:] - members[:-k]
        near = gap < 4 * t
        if not near.any():
            break
        hit = np.flatnonzero(near & (gap >= 2 * t) & (contexts[k:] == contexts[:-k]))
        found.extend(zip(gap[hit].tolist(), members[hit].tolist(), strict=True))
        k += 1
    return sorted(found)


def _all_runs(x: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, stop, period) of every run of three periods or more. ``sizes``
    are the words of each text, its end mark included."""
    runs = _direct(x)
    place = np.arange(len(x))
    grams = mixed(x.astype(np.uint64) * _ODD + _ODD)

    def twice(h, width):
        return mixed(h * _ODD + _shifted(h, width) if width < len(h) else h)

    width, t = 1, DIRECT // 2
    while width < t:
        grams, width = twice(grams, width), 2 * width
    while True:
        deep = sizes > 6 * t
        if not deep.any():
            return runs
        if not deep.all():
            inside = np.repeat(deep, sizes)
            x, place, grams, sizes = x[inside], place[inside], grams[inside], sizes[deep]
        periodic = np.zeros(len(x) + 1, np.int32)
        for start, stop, p in runs:
            if 3 * p <= t <= stop - start:
                at = int(np.searchsorted(place, start))
                if at < len(place) and place[at] == start:
                    periodic[at] += 1
                    periodic[at + stop - start - t + 1] -= 1
        members = _members(grams, t, np.cumsum(periodic[:-1]) > 0)
        grams = twice(grams, t)
        last = (0, 0, 0)                                # distance, and its newest stretch
        for d, i in _proposals(members, grams[members], t):
            if d == last[0] and last[1] <= i < last[2]:
                continue
            a, b = _equal_stretch(x, i, d)
            last = (d, a, b)
            if b - a >= 2 * d and _is_smallest(x, a, b + d, d):
                start = int(place[a])
                runs.append((start, start + b + d - a, d))
        t *= 2


def _runs_of_texts(words: list[list[bytes]], least: int) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each text, by start, then period."""
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    stops = np.cumsum(sizes)
    numbers: dict[bytes, int] = {}
    flat = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in words for w in ws), np.int32)
    x = np.empty(int(sizes.sum()), np.int32)
    marks = stops - 1
    is_word = np.ones(len(x), bool)
    is_word[marks] = False
    x[is_word] = flat
    x[marks] = np.arange(len(numbers), len(numbers) + len(words))
    out: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for start, stop, p in sorted(_all_runs(x, sizes), key=lambda r: (r[0], r[2])):
        if stop - start >= max(least, 3 * p):
            text = int(np.searchsorted(stops, start, "right"))
            out[text].append((start - int(stops[text] - sizes[text]), stop - start, p))
    return out


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    if not runs:
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, np.int32)
    for start, length, p in runs:
        drop[start + p] += 1
        drop[start + length] -= 1
    return b" ".join(compress(words, np.cumsum(drop[:-1]) == 0))


RUN = "struct<start:bigint,length:bigint,period:bigint>"


def _finder(least: int):
    def find(arrow_batches):
        run_type = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))
        for batch in arrow_batches:
            for part in batches(batch, 1, BATCH_BYTES):
                words = [(t or "").encode().split() for t in part.column(1).to_pylist()]
                runs = _runs_of_texts(words, least)
                yield pa.RecordBatch.from_arrays([
                    part.column(0), pa.array([len(w) for w in words], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in rs]
                              for rs in runs], run_type),
                    pa.array([_collapsed(w, r) for w, r in zip(words, runs, strict=True)],
                             pa.binary()).cast(pa.string()),
                ], ["doc_id", "n_words", "runs", "collapsed"])
    return find


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                  least: int = LEAST_WORDS) -> DataFrame:
    """Per row its id, number of words ``[^\\x20\\x09-\\x0D]+``, periodic runs
    (by start, then period) and collapsed text: the words that no run contains
    after its first period, joined by one space.

    A null or empty text has no words, no runs and an empty collapsed text; a
    row stays a row whatever repeats, null ids included. Other columns of
    ``docs`` are not read."""
    rows = docs.select(col(id_column).alias("doc_id"), col(text_column).cast("string").alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return map_arrow(rows, _finder(least),
                     f"doc_id {id_type}, n_words bigint, runs array<{RUN}>, collapsed string")


def planted(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) in which every tenth document, by the CRC-32 of
    its id, repeats a part of its words to its end; others keep their text, as
    does a document without id or words."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / F.lit(10)).cast("long")

    def repeated(words):
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8)).cast("long")
        return F.concat_ws(" ", F.transform(
            F.sequence(F.lit(0).cast("long"), n - 1),
            lambda i: F.element_at(words, (F.when(i < a, i).otherwise(a + (i - a) % p) + 1).cast("int"))))

    text = F.when(h % 10 == 0, let(space_words(F.col("text")), lambda w: F.when(F.size(w) > 0, repeated(w))))
    return docs.select("doc_id", F.coalesce(text, F.col("text")).alias("text"))


def runs_digest(found: DataFrame) -> DataFrame:
    """One row a document: number of runs, the run with the greatest exact
    length over period (ties: smallest start, then period; nulls without a
    run), and digests of all runs and of the collapsed text."""
    def before(a, b):
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        return (F.when(left > right, -1).when(left < right, 1)
                 .when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1)
                 .when(a["period"] < b["period"], -1).when(a["period"] > b["period"], 1).otherwise(0))

    best = F.get(F.array_sort("runs", before), F.lit(0))
    lines = F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"),
                    r["period"].cast("string")), F.lit("\n")))
    top = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                       F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
                       F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
    return top.select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256")
