"""Benchmark decontamination by winnowing.

A window is ``window`` consecutive words of a benchmark item. Both sides keep
the smallest hash of ``gram`` consecutive words in every run of
``window - gram + 1`` such grams, so any shared span of ``window`` words shares
a kept gram at the same place. Kept grams are joined by hash, and each match is
extended word by word to both sides: it is a hit if the equal run around the
gram has ``window`` words. Items shorter than a window are one window, looked
up at every place of the documents by a hash of all their words, then compared.

Defined cases: null and empty texts have no words, are never hit and hit
nothing; rows that repeat an item id are one item; a null item id counts as an
item named by the empty string; document rows that repeat an id are judged by
their own texts; empty tables give no rows or no hits; other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rides.llm.common import ASCII_LOWER, ASCII_UPPER, col, free, let, prepare, saved

WINDOW = 10
GRAM = 5
# A kept gram is one long: 35 bits of hash, then its place. A text that Spark
# can hold as an array of words has far fewer than 2^28 of them.
HASH_MASK = (1 << 35) - 1
PLACE_BITS = 28
# Benchmark grams up to this many rows (about 400 bytes each) are broadcast.
BROADCAST_ROWS = 100_000

# What ends a word: \x00-\x2F, \x3A-\x40, \x5B-\x60, \x7B-\x7F.
_BREAKS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def words_of(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z."""
    plain = F.translate(F.coalesce(text, F.lit("")), ASCII_UPPER + _BREAKS,
                        ASCII_LOWER + " " * len(_BREAKS))
    return F.array_remove(F.split(plain, " "), "")


def _paired(a: Column, b: Column, shift: int, both) -> Column:
    """``both(a[i], b[i + shift])`` for every i that has both; ``b`` is not
    longer than ``a`` and ends ``shift`` places or less before it."""
    return let(F.size(b) - shift, lambda n: F.zip_with(
        F.slice(a, 1, n), F.slice(b, shift + 1, n), both))


def _spread(values: Column, width: int, both, twice: bool) -> Column:
    """``both`` folded over every ``width`` consecutive values, by doubling.
    ``twice``: a value may enter more than once, as with a minimum."""
    def grow(done: Column, have: int) -> Column:
        if have == width:
            return done
        step = min(have, width - have)
        if step == have:
            return let(_paired(done, done, have, both), lambda x: grow(x, 2 * have))
        if twice:
            return _paired(done, done, step, both)
        return let(_spread(values, step, both, twice), lambda r: _paired(done, r, have, both))

    return grow(values, 1)


def winnowed(words: Column, window: int, gram: int) -> Column:
    """Kept grams of an array of words, in order; none below a window. A
    minimum holds its place, so its windows are neighbours and one stays."""
    def kept(w: Column) -> Column:
        grams = _spread(w, gram, lambda x, y: F.xxhash64(x, y), False)
        placed = F.transform(grams, lambda h, i: F.shiftleft(
            h.bitwiseAND(F.lit(HASH_MASK)), PLACE_BITS).bitwiseOR(i.cast("long")))
        return F.array_distinct(let(placed, lambda g: _spread(
            g, window - gram + 1, lambda x, y: F.least(x, y), True)))

    return let(words, lambda w: F.when(F.size(w) >= window, let(
        F.transform(w, lambda x: F.xxhash64(x)), kept)).otherwise(F.array().cast("array<bigint>")))


def _place(pick: Column) -> Column:
    return pick.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)).cast("int")


def _around(words: Column, place: Column, before: int, length: int) -> Column:
    """``length`` words from ``before`` words ahead of ``place``; null outside."""
    return F.transform(F.sequence(F.lit(0), F.lit(length - 1)),
                       lambda j: F.get(words, place - before + j))


def _equal_run(a: Column, b: Column, first: int, step: int, most: int) -> Column:
    """How many of the words from ``first`` on, by ``step``, are equal in a row."""
    unequal = F.filter(F.sequence(F.lit(0), F.lit(most - 1)), lambda j: ~F.coalesce(
        F.get(a, F.lit(first) + j * step) == F.get(b, F.lit(first) + j * step), F.lit(False)))
    return F.coalesce(F.array_min(unequal), F.lit(most))


def _texts(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = col(text_col)
    return documents.select(col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"),
                            words_of(text).alias("words"))


def _long_hits(docs: DataFrame, items: DataFrame, window: int, gram: int,
               broadcast_rows: int) -> DataFrame:
    reach = window - gram          # words of a window beside its gram
    span = 2 * reach + gram
    grams = (items.where(F.size("words") >= window)
             .select("item_id", "words", F.explode_outer(winnowed(F.col("words"), window, gram)).alias("pick"))
             .select("item_id", F.shiftright("pick", PLACE_BITS).alias("hash"),
                     _around(F.col("words"), _place(F.col("pick")), reach, span).alias("near")))
    grams = saved(grams.distinct(), "benchmark-grams")
    small = grams.count() <= broadcast_rows
    near = _around(F.col("words"), F.col("place"), reach, span).alias("doc_near")
    picks = (docs.select("doc_id", "text_key", "words",
                         winnowed(F.col("words"), window, gram).alias("picks"))
             .select("doc_id", "text_key", "words", F.explode_outer("picks").alias("pick"))
             .select("doc_id", "text_key", "words", F.shiftright("pick", PLACE_BITS).alias("hash"),
                     _place(F.col("pick")).alias("place")))
    if small:
        found = picks.join(F.broadcast(grams), "hash").select(
            "doc_id", "text_key", "place", "item_id", "near", near)
    else:
        # Beyond a broadcast the rows carry their surrounding words, not the text.
        found = picks.select("doc_id", "text_key", "hash", "place", near).join(
            grams.hint("shuffle_merge"), "hash")
    same = F.slice("near", reach + 1, gram) == F.slice("doc_near", reach + 1, gram)
    left = _equal_run(F.col("near"), F.col("doc_near"), reach - 1, -1, reach)
    right = _equal_run(F.col("near"), F.col("doc_near"), reach + gram, 1, reach)
    # Through an array of one, so that the comparison stays behind the join.
    seen = F.explode(F.array(F.struct(same.alias("same"), left.alias("l"), right.alias("r"))))
    return (found.select("doc_id", "text_key", "item_id", "place", seen.alias("s"))
            .where(F.col("s.same") & (F.col("s.l") + F.col("s.r") + gram >= window))
            .select("doc_id", "text_key", "item_id", (F.col("place") - F.col("s.l")).alias("first"),
                    (F.col("place") + gram + F.col("s.r")).alias("stop")))


def _short_hits(docs: DataFrame, items: DataFrame, window: int, broadcast_rows: int) -> DataFrame:
    short = saved(items.where(F.size("words").between(1, window - 1))
                  .select("item_id", F.size("words").alias("n"),
                          F.xxhash64("words").alias("hash"),
                          F.col("words").alias("near")).distinct(), "benchmark-short")
    lengths = sorted(r["n"] for r in short.select("n").distinct().collect())   # below window
    if not lengths:
        return None
    small = short.count() <= broadcast_rows
    spot = "array<struct<n:int,place:int,hash:bigint>>"

    def runs(n: int) -> Column:
        """Every run of ``n`` words of a document."""
        return F.when(F.size("words") >= n, F.transform(
            F.sequence(F.lit(1), F.greatest(F.size("words") - (n - 1), F.lit(1))),
            lambda i: F.struct(F.lit(n).alias("n"), (i - 1).alias("place"),
                               F.xxhash64(F.slice("words", i, n)).alias("hash")))
        ).otherwise(F.array().cast(spot))

    at = F.explode(F.concat(*[runs(n) for n in lengths]))
    places = docs.select("doc_id", "text_key", "words", at.alias("at")).select(
        "doc_id", "text_key", "words", "at.n", "at.place", "at.hash")
    cut = F.slice(F.col("words"), F.col("place") + 1, F.col("n")).alias("doc_near")
    if small:
        found = places.join(F.broadcast(short), ["n", "hash"]).select(
            "doc_id", "text_key", "item_id", "place", "n", "near", cut)
    else:
        found = places.select("doc_id", "text_key", "place", "n", "hash", cut).join(
            short.hint("shuffle_merge"), ["n", "hash"])
    return found.where(F.col("near") == F.col("doc_near")).select(
        "doc_id", "text_key", "item_id", F.col("place").alias("first"),
        (F.col("place") + F.col("n")).alias("stop"))


def hits(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, gram: int = GRAM,
         id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text_col: str = "text", broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """doc_id, text_key, item_id, first, stop: word spans of a document equal
    to a span of an item (a window at least). Spans overlap."""
    prepare(documents.sparkSession)
    docs = _texts(documents, id_col, text_col)
    items = benchmark.select(F.coalesce(col(item_col).cast("string"), F.lit("")).alias("item_id"),
                             words_of(col(item_text_col)).alias("words"))
    found = _long_hits(docs, items, window, gram, broadcast_rows)
    short = _short_hits(docs, items, window, broadcast_rows)
    return found if short is None else found.unionByName(short)


def contamination(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", **options) -> DataFrame:
    """One row per document row: doc_id, n_words, spans (sorted, overlapping),
    items (sorted), n_hit."""
    found = hits(documents, benchmark, id_col=id_col, text_col=text_col, **options)
    per_doc = found.groupBy(F.col("doc_id").alias("d"), F.col("text_key").alias("t")).agg(
        F.sort_array(F.collect_set(F.struct("first", "stop"))).alias("spans"),
        F.sort_array(F.collect_set("item_id")).alias("items"))
    state = "struct<n:bigint,reach:int>"
    covered = F.aggregate(
        "spans", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach")).cast(state),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(x["stop"] - F.greatest(x["first"], s["reach"]), F.lit(0))).alias("n"),
            F.greatest(x["stop"], s["reach"]).alias("reach")).cast(state),
        lambda s: s["n"])
    docs = _texts(documents, id_col, text_col).select(
        "doc_id", "text_key", F.size("words").cast("long").alias("n_words"))
    joined = docs.join(per_doc, docs["doc_id"].eqNullSafe(per_doc["d"])
                       & (docs["text_key"] == per_doc["t"]), "left")
    return joined.select("doc_id", "n_words", "spans", "items",
                         F.coalesce(covered, F.lit(0)).alias("n_hit"))


def clean(documents: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
          text_col: str = "text", **options) -> DataFrame:
    """The rows of ``documents`` that no window of an item hits."""
    found = hits(documents, benchmark, id_col=id_col, text_col=text_col, **options)
    hit_id, hit_key = free(documents, "_hit_id"), free(documents, "_hit_key")
    keys = found.select(F.col("doc_id").alias(hit_id), F.col("text_key").alias(hit_key)).distinct()
    own = col(id_col).eqNullSafe(F.col(hit_id)) & (F.xxhash64(col(text_col)) == F.col(hit_key))
    return documents.join(keys, own, "left_anti")


def contamination_digest(rows: DataFrame) -> DataFrame:
    items = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select("doc_id", "n_words", "n_hit", F.size(items).cast("long").alias("n_items"),
                       F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
                       (F.col("n_hit") > 0).alias("contaminated"))
