"""Repeated byte strings by sorting suffixes, deep and shallow.

A string of ``length`` bytes counts as repeated if it also starts anywhere
else in the corpus. Its anchor is the place of its smallest gram hash, so equal
strings have equal anchors at equal distances, and the strings of one anchor
are a run of consecutive starts: a block. Only blocks whose anchor gram occurs
more than once are moved, to the task of their gram. There the suffixes that
start in a block are ordered: multikey quicksort, eight bytes at a time, down
to a shallow depth; the groups that still agree go on in blind tries, which
pass over bytes that a whole group shares and only sort where it branches.
Suffixes that agree to ``length`` bytes are repeated. Blocks that are equal as
a whole enter the sort once, and are joined where they are cut.

Equal texts are one text, all of it repeated. Defined cases: null text is
empty; texts are UTF-8 bytes; rows are judged one by one, so rows that repeat
an id are copies of each other if their texts are equal; null ids pass through;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rides.llm.common import col, map_arrow, saved

LENGTH = 200
SHALLOW = 24        # bytes ordered by multikey quicksort
CHUNK = 1 << 22     # starts looked at together; places take PLACE_BITS
PLACE_BITS = 24
SORT_BYTES = 4 << 20
SORT_STARTS = 1 << 21   # suffixes ordered at a time in a task
SPAN = "text_key long, first long, stop long"
BLOCK = "gram long, text_key long, first long, stop long, lead int, block binary"


def _grams(raw, k: int):
    """Hash of the k bytes from every place."""
    import numpy as np

    from rides.llm.text_hash import _BYTE, _power_tables, mixed

    power, inverse = _power_tables(len(raw))
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_BYTE[raw] * power[:len(raw)], out=total[1:])
    n = len(raw) - k + 1
    return mixed((total[k:] - total[:n]) * inverse[:n])


def _sliding_min(x, width: int):
    """Minimum of every ``width`` consecutive values, by block prefixes."""
    import numpy as np

    n = len(x) - width + 1
    full = np.full(-(-len(x) // width) * width, np.iinfo(np.uint64).max, np.uint64)
    full[:len(x)] = x
    rows = full.reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def anchors(raw, length: int):
    """(first start, last start, anchor, gram hash) of every block of a text."""
    import numpy as np

    k = length // 4
    width, n = length - k + 1, len(raw) - length + 1
    parts = []
    for low in range(0, max(n, 0), CHUNK):
        count = min(CHUNK, n - low)
        grams = _grams(raw[low:low + count + length - 1], k)
        place = np.uint64((1 << PLACE_BITS) - 1)
        keyed = (grams & ~place) | np.arange(len(grams), dtype=np.uint64)
        at = (_sliding_min(keyed, width) & place).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        last = np.concatenate((first[1:] - 1, [count - 1]))
        parts.append((first + low, last + low, at[first] + low, grams[at[first]].view(np.int64)))
    if not parts:
        return [np.zeros(0, np.int64)] * 4
    return [np.concatenate(x) for x in zip(*parts)]


def _words(raw):
    """Eight bytes from every place as one big-endian number: a view of the
    bytes, so it takes no room of its own."""
    import numpy as np

    padded = np.concatenate((raw, np.zeros(8, np.uint8)))
    return np.ndarray(len(raw) + 1, ">u8", padded, 0, (1,))


def _split(at, group, key):
    """Order each group by key; keep the new groups of two or more."""
    import numpy as np

    order = np.lexsort((key, group))
    at, group, key = at[order], group[order], key[order]
    fresh = np.ones(len(at), bool)
    fresh[1:] = (group[1:] != group[:-1]) | (key[1:] != key[:-1])
    ids = np.cumsum(fresh) - 1
    keep = np.bincount(ids)[ids] > 1
    return at[keep], ids[keep]


def repeated(raw, starts, group, length: int = LENGTH, shallow: int = SHALLOW):
    """Which suffixes of ``raw`` agree with another of their group for
    ``length`` bytes."""
    import numpy as np

    word = _words(raw)

    def key(at, depth):
        cut = max(0, depth + 8 - length)
        return word[starts[at] + depth].astype(np.uint64) >> np.uint64(8 * cut)

    at = np.arange(len(starts))
    depth = 0
    while depth < min(shallow, length) and len(at):
        at, group = _split(at, group, key(at, depth))
        depth += 8
    while depth < length and len(at):
        here = key(at, depth)
        heads = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        sizes = np.diff(np.append(heads, len(at)))
        unlike = here != np.repeat(here[heads], sizes)
        if unlike.any():        # branching nodes; the others pass over these bytes
            branch = np.repeat(np.logical_or.reduceat(unlike, heads), sizes)
            some, ids = _split(at[branch], group[branch], here[branch])
            ids = ids + (int(group.max()) + 1)
            at, group = np.concatenate((at[~branch], some)), np.concatenate((group[~branch], ids))
        depth += 8
    out = np.zeros(len(starts), bool)
    out[at] = True
    return out


def _runs(mask):
    """(begin, end) of the True runs of a mask."""
    import numpy as np

    edge = np.flatnonzero(np.diff(np.concatenate(([0], mask.astype(np.int8), [0]))))
    return zip(edge[::2].tolist(), edge[1::2].tolist())


def _sorted_blocks(rows: list, length: int) -> list:
    """Spans of the (gram, text_key, first, lead, block) rows of whole grams."""
    import numpy as np

    classes: dict = defaultdict(list)
    for gram, key, first, lead, block in rows:
        classes[gram, lead, block].append((key, first))
    per_gram: dict = defaultdict(int)
    for gram, _, _ in classes:
        per_gram[gram] += 1
    spans, suffixes, number, texts, at = [], [], [], [], 0
    for n, (what, members) in enumerate(classes.items()):
        gram, lead, block = what
        if len(set(members)) > 1:
            spans += [(key, first, first + len(block)) for key, first in members]
        elif per_gram[gram] == 1:
            continue
        if per_gram[gram] > 1:
            suffixes.append((at, len(block) - length + 1, lead, gram, members))
            texts.append(block)
            at += len(block)
    if not suffixes:
        return spans
    raw = np.frombuffer(b"".join(texts), np.uint8)
    texts.clear()
    ids = {g: i for i, g in enumerate(dict.fromkeys(s[3] for s in suffixes))}
    place, counts, lead, gram = (np.array(x) for x in zip(*((p, c, d, ids[g]) for p, c, d, g, _ in suffixes)))
    begin = np.cumsum(counts) - counts
    found = np.zeros(int(counts.sum()), bool)
    # Equal strings have their anchor at an equal distance, so a range of
    # distances is sorted by itself: room for SORT_STARTS at a time.
    width = max(1, SORT_STARTS // len(suffixes))
    for low in range(0, length, width):
        first = np.clip(lead - (low + width - 1), 0, counts)
        n = np.clip(lead - low + 1, 0, counts) - first
        n = np.maximum(n, 0)
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - first, n)
        group = np.repeat(gram * (length + 1) + lead, n) - inner
        found[np.repeat(begin, n) + inner] = repeated(raw, np.repeat(place, n) + inner, group, length)
    for (_, count, _, _, members), low in zip(suffixes, begin.tolist()):
        mask = found[low:low + count]
        if len(set(members)) > 1 or not mask.any():
            continue
        for a, b in _runs(mask):
            spans += [(key, first + a, first + b - 1 + length) for key, first in members]
    return spans


def _joined(spans: list) -> list:
    """(text_key, first, stop) with the spans of a text merged."""
    by_text = defaultdict(list)
    for key, first, stop in spans:
        by_text[key].append((first, stop))
    return [(key, a, b) for key, marks in by_text.items() for a, b in _merged(marks)]


def _batch(rows: list, schema: str):
    import pyarrow as pa

    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(columns, fields)],
                                      [n for n, _ in fields])


def _anchor_rows(texts: DataFrame, length: int) -> DataFrame:
    """gram, text_key, twice: the anchors of each text, once each."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        from rides.llm import text_hash as t

        for whole in batches:
            for batch in t.batches(whole, 1):
                keys = batch.column(0).to_pylist()
                raw, at = t.arrow_bytes(batch.column(1))
                out = []
                for i, key in enumerate(keys):
                    grams = anchors(raw[at[i]:at[i + 1]], length)[3]
                    grams, n = np.unique(grams, return_counts=True)
                    out.append((grams, np.full(len(grams), key, np.int64), n > 1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*out)], ["gram", "text_key", "twice"])

    return map_arrow(texts, run, "gram long, text_key long, twice boolean")


def _blocks(texts: DataFrame, length: int) -> DataFrame:
    """Block rows of (text_key, text, grams); blocks that a batch holds more
    than once leave their spans (no block) and go on once."""
    def run(batches: Iterator) -> Iterator:
        import numpy as np

        from rides.llm import text_hash as t

        before = None
        for whole in batches:
            for batch in t.batches(whole, 1):
                keys = batch.column(0).to_pylist()
                raw, at = t.arrow_bytes(batch.column(1))
                classes: dict = {}
                for i, key in enumerate(keys):
                    if key == before:       # the join puts equal texts together
                        continue
                    before = key
                    text = raw[at[i]:at[i + 1]]
                    wanted = np.asarray(batch.column(2)[i].values)
                    first, last, place, gram = anchors(text, length)
                    some = np.flatnonzero(np.isin(gram, wanted))
                    data = text.tobytes()
                    for a, b, p, g in zip(first[some].tolist(), last[some].tolist(),
                                          place[some].tolist(), gram[some].tolist()):
                        what = (g, p - a, data[a:b + length])
                        classes.setdefault(what, {})[key, a] = None
                rows, found = [], []
                for (g, lead, block), members in classes.items():
                    if len(members) > 1:
                        found += [(k, a, a + len(block)) for k, a in members]
                    k, a = next(iter(members))
                    rows.append((g, k, a, a + len(block), lead, block))
                # Spans have no gram to meet at: any even key will do.
                rows += [(k, k, a, b, None, None) for k, a, b in _joined(found)]
                if rows:
                    yield _batch(rows, BLOCK)

    return map_arrow(texts, run, BLOCK)


def _spans_of(blocks: DataFrame, length: int) -> DataFrame:
    """Spans of block rows that are dealt out and sorted by gram."""
    def run(batches: Iterator) -> Iterator:
        held, size, gram = [], 0, None
        for batch in batches:
            spans = []
            for g, key, first, stop, lead, block in zip(*[c.to_pylist() for c in batch.columns]):
                if block is None:
                    spans.append((key, first, stop))
                    continue
                if size >= SORT_BYTES and g != gram:
                    spans += _sorted_blocks(held, length)
                    held, size = [], 0
                held.append((g, key, first, lead, block))
                size, gram = size + len(block), g
            if spans:
                yield _batch(_joined(spans), SPAN)
        if held:
            yield _batch(_joined(_sorted_blocks(held, length)), SPAN)

    return map_arrow(blocks, run, SPAN)


def spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """text_key, first, stop: repeated strings of the texts of (text_key,
    text) rows; spans of a text may overlap."""
    marks = saved(_anchor_rows(docs.where(F.octet_length("text") >= length), length), "anchors")
    grams = saved(marks.groupBy("gram").agg(
        F.min("text_key").alias("u"), F.max("text_key").alias("v"), F.max("twice").alias("w"))
        .where("u != v or w").select("gram"), "repeated-grams")
    wanted = marks.join(grams, "gram").select("text_key", "gram").groupBy("text_key").agg(
        F.collect_set("gram").alias("grams"))     # at most the anchors of one text
    texts = docs.join(wanted, "text_key").select("text_key", "text", "grams")
    blocks = _blocks(texts, length)
    # A text that many rows hold is cut in each of them; its blocks are equal
    # members then, told apart only by text and place.
    dealt = blocks.repartition("gram").sortWithinPartitions("gram")
    found = _spans_of(dealt, length)
    copies = docs.groupBy("text_key").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("text")).alias("size"))
    whole = copies.where((F.col("n") > 1) & (F.col("size") >= length)).select(
        "text_key", F.lit(0).cast("long").alias("first"), F.col("size").cast("long").alias("stop"))
    return saved(found.unionByName(whole), "repeated-spans")


def _merged(marks: list) -> list[list[int]]:
    """Maximal runs of (first, stop) pairs."""
    out: list[list[int]] = []
    for first, stop in sorted(marks):
        if out and first <= out[-1][1]:
            out[-1][1] = max(out[-1][1], stop)
        else:
            out.append([first, stop])
    return out


def _without(data: bytes, runs: list) -> bytes:
    at, parts = 0, []
    for a, b in runs:
        parts.append(data[at:a])
        at = b
    return b"".join([*parts, data[at:]])


def _whole_characters(data: bytes, runs: list) -> list:
    """The runs without the characters that they cover only in part."""
    out = []
    for a, b in runs:
        while a < b and data[a] & 0xC0 == 0x80:
            a += 1
        while b > a and b < len(data) and data[b] & 0xC0 == 0x80:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def _marked(df: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """``df`` (with text_key) and the spans of each text."""
    found = spans(docs, length).groupBy("text_key").agg(
        F.collect_set(F.struct("first", "stop")).alias("spans"))    # at most the blocks of one text
    return df.join(found, "text_key", "left")


def cut(df: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, spans (maximal removed runs of bytes), kept (the other
    bytes) for every row of ``df``."""
    docs = df.select(col(id_col).alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("text")) \
        .withColumn("text_key", F.xxhash64("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.list_(pa.struct([("first", pa.int64()), ("stop", pa.int64())]))
        for batch in batches:
            texts = [t.as_buffer().to_pybytes() for t in batch.column(1)]
            runs = [_merged((m["first"], m["stop"]) for m in marks or ()) for marks in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(t) for t in texts], pa.int64()),
                pa.array([[{"first": a, "stop": b} for a, b in r] for r in runs], kind),
                pa.array([_without(t, r) for t, r in zip(texts, runs)], pa.binary())],
                ["doc_id", "n_bytes", "spans", "kept"])

    rows = _marked(docs, docs.select("text_key", "text"), length).select("doc_id", "text", "spans")
    return map_arrow(rows, run, f"doc_id {id_type}, n_bytes long, spans array<struct<first:bigint,stop:bigint>>, kept binary")


def without_repeats(df: DataFrame, length: int = LENGTH, text_col: str = "text") -> DataFrame:
    """``df`` with the repeated strings taken out of its texts (null stays
    null); a character that a string covers in part stays whole."""
    text = F.coalesce(col(text_col), F.lit(""))
    docs = df.select(F.struct(*[col(c) for c in df.columns]).alias("row"), text.alias("text"),
                     F.xxhash64(text).alias("text_key"))
    kind = docs.schema["row"].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            out = []
            for text, marks in zip(batch.column(1), batch.column(2).to_pylist()):
                data = text.as_buffer().to_pybytes()
                runs = _merged((m["first"], m["stop"]) for m in marks or ())
                out.append(_without(data, _whole_characters(data, runs)).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.string())], ["row", "text"])

    rows = _marked(docs, docs.select("text_key", "text"), length).select("row", "text", "spans")
    cleaned = map_arrow(rows, run, f"row {kind}, text string")
    old = F.col("row").getField(text_col)
    return cleaned.select(*[F.when(old.isNotNull(), F.col("text")).alias(c) if c == text_col
                            else F.col("row").getField(c).alias(c) for c in df.columns])


def cut_digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                       F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
