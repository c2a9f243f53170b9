"""The pipeline, stage by stage, against plain Python."""

import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from rides.llm import tokens
from rides.llm.common import saved

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ITEM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def good(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    seen = defaultdict(list)
    for i in range(len(w) - 7):
        seen[tuple(w[i:i + 8])].append(i)
    repeat = {i + j for v in seen.values() if len(v) > 1 for i in v for j in range(8)}
    chars = sum(map(len, w))
    return not (len(w) < 20 or 100 * len(repeat) > 30 * len(w)
                or 10 * sum(c in "#*$%&|<>" for c in text) > len(w)
                or chars < 3 * len(w) or chars > 10 * len(w)
                or 2 * (len(lines) - len(set(lines))) > len(lines))


def smallest_of_groups(rows):
    sets = {}
    for d, t in rows:
        w = WORD.findall(lower(t))
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d for d in ids if root(d) == d}


def without_repeats(rows):
    data = {d: t.encode() for d, t in rows}
    seen = Counter(x[i:i + 200] for x in data.values() for i in range(len(x) - 199))
    out = {}
    for d, x in data.items():
        gone = bytearray(len(x))
        for i in range(len(x) - 199):
            if seen[x[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        kept, at = [], 0
        for c in x.decode():
            n = len(c.encode())
            if not all(gone[at:at + n]):
                kept.append(c)
            at += n
        out[d] = "".join(kept)
    return out


def test_stages_equal_plain_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    outs = []
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, SF), "test-stage")
        outs.append(docs)
    assert [o.columns == names for o in outs] == [True] * 4 + [False]
    rows = [{r["doc_id"]: r for r in o.collect()} for o in outs[:4]]

    kept = {d for d, t in text.items() if good(t)}
    assert set(rows[0]) == kept and 0 < len(kept) < len(text)
    first = smallest_of_groups([(d, text[d]) for d in kept])
    assert set(rows[1]) == first and len(first) < len(kept)
    cut = without_repeats([(d, text[d]) for d in sorted(first)])
    assert {d: r["text"] for d, r in rows[2].items()} == cut
    assert all(r["n_chars"] == len(r["text"]) for r in rows[2].values())
    items = [ITEM_WORD.findall(lower(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    windows = {tuple(w[i:i + n]) for w in items if w for n in [min(10, len(w))] for i in range(len(w) - n + 1)}
    clean = set()
    for d, t in cut.items():
        w = ITEM_WORD.findall(lower(t))
        if not any(tuple(w[i:i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1)):
            clean.add(d)
    assert set(rows[3]) == clean and len(clean) < len(first)

    pieces = defaultdict(list)
    for r in outs[4].collect():
        pieces[r["doc_id"]].append(r)
    assert set(pieces) == clean
    raw = dict(zip(sorted(clean), tokens.encode_documents([cut[d] for d in sorted(clean)], tokens.default_tokenizer())))
    import zlib

    for d, ps in pieces.items():
        for p in ps:
            part = raw[d][4 * p["start"]:4 * (p["start"] + p["length"])]
            assert zlib.crc32(part) == p["ids_crc32"] and p["doc_tokens"] == len(raw[d]) // 4
        assert sum(p["length"] for p in ps) == len(raw[d]) // 4


def test_run_with_null_rows(spark, tmp_path):
    plain = "plain words of a clean document number {0} that go on for a while so that no rule has a reason to reject it {0}"
    rows = [(i, plain.format(i), "en", "s", 0) for i in range(5)] + [(None, plain.format("x"), None, None, None), (9, None, "en", None, 3)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, None), (2, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in out} == {0, 1, 2, 3, 4, None}


@pytest.mark.parametrize("table", ["documents"])
def test_run_on_an_empty_table(spark, tmp_path, table):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/{table}.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
