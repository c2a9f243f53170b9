"""Packing and token files against plain encoding by the library."""

import zlib
from collections import defaultdict

import pytest

from rides.llm import packing, token_orc, tokens
from rides.llm.common import map_arrow, scratch

SF = "/root/testdata/sf0.001"
ODD = ["", None, " ", "a", "Hello, World. it's we'll", "ÉCOLE naïve Σας İstanbul", "éà x",
       "<|endoftext|> and <|startoftext|>x", "tab\tnew\nline\x0bv\x1cq nb em\u0085nel",
       "1234 5,678.9 $%& ... ,,, .", "日本語 テキスト 😀😀 👩‍👩‍👧", "word, word. Word,. WORD", "x" * 20000,
       "ab " * 9000, "İ, ẞ. ﬁn", "''s 's 't' don't", "\x00 null \x00a", "ǅ ǆ ǅ."]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokens.default_tokenizer())
    return lambda s: t.encode(s or "", add_special_tokens=False).ids + [2]


def raw(ids):
    import array

    return array.array("I", ids).tobytes()


def test_chunk_encoding_equals_the_library(library):
    import pyarrow.parquet as pq

    texts = ODD + pq.read_table(f"{SF}/documents.parquet")["text"].to_pylist()
    assert tokens.encode_documents(texts, tokens.default_tokenizer()) == [raw(library(t)) for t in texts]


def test_capital_sigma_at_the_end_of_a_word(library):
    texts = ["ΟΔΟΣ ΕΛΛΑΣ", "ΟΔΟΣ, ΕΛΛΑΣ.", "Σ ΑΣ. σΣ ΣΣΣ", "οδοσ οδος ΟΔΟς", "ΟΔΟΣ's ΈΛΛΑΣ"]
    assert tokens.encode_documents(texts, tokens.default_tokenizer()) == [raw(library(t)) for t in texts]


def test_marks_behind_a_word_are_put_together_with_it(library, monkeypatch):
    """Only the marks themselves go through the whole tokenizer, not each chunk."""
    enc, words = tokens.Encoder(tokens.default_tokenizer()), ["Haus", "ΟΔΟΣ", "école", "naïve", "x"]
    chunks = [w + m for w in words for m in ("", ".", "...", "!!", "###", ",&&&", ")*", "?\"", "'s", "'s.", "<|", "|>.")]
    texts = [" ".join(chunks), "### ... Haus###", " ".join(reversed(chunks)) + " end!!"]
    whole, encode = [], enc._encode_chunks
    monkeypatch.setattr(enc, "_encode_chunks", lambda part: whole.extend(part) or encode(part))
    assert enc.encode(texts) == [raw(library(t)[:-1]) for t in texts]
    assert "Haus###" not in whole and "###" in whole and "x's" in whole
    assert all(enc.table[c] == raw(library(c)[:-1]) for c in chunks)


def test_chunk_table_restart(library, monkeypatch):
    monkeypatch.setattr(tokens, "CHUNKS", 3)
    enc = tokens.Encoder(tokens.default_tokenizer())
    for t in ODD:
        assert enc.encode([t or ""])[0] == raw(library(t)[:-1])


@pytest.mark.parametrize("write", [
    lambda docs: packing.pack(docs).collect(),
    lambda docs: token_orc.write_tokens(docs, scratch(docs.sparkSession, "test-orc"))])
def test_chunk_table_goes_with_its_stage(spark, write):
    """Later stages run in the same Python workers (F1: pipeline)."""
    def held(batches):
        import pyarrow as pa

        from rides.llm import tokens

        for _ in batches:
            yield pa.RecordBatch.from_arrays([pa.array([sum(len(e.table) for e in tokens._ENCODERS.values())])], ["n"])

    docs = spark.createDataFrame([(i, f"word{i} other. Words, {i}") for i in range(400)], "doc_id long, text string")
    write(docs.repartition(8))
    kept = [r["n"] for r in map_arrow(spark.range(0, 64, 1, 64), held, "n long").collect()]
    assert max(kept) == 1       # the encoder stays, with the entry of the empty chunk


def check_pieces(rows, want, capacity):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    assert set(by_doc) == set(want)
    for doc, pieces in by_doc.items():
        ids = b"".join(bytes(p["ids"]) for p in sorted(pieces, key=lambda p: p["start"]))
        assert ids == raw(want[doc]) and {p["doc_tokens"] for p in pieces} == {len(want[doc])}
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] == len(p["ids"]) // 4 > 0
            at += p["length"]
    padding = total = 0
    for pieces in by_seq.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= capacity and {p["sequence_tokens"] for p in pieces} == {at}
        total += at
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / total


def test_pack_whole_documents(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r["doc_id"]: library(r["text"]) for r in docs.collect()}
    rows = packing.pack(docs.repartition(3)).collect()
    assert check_pieces(rows, want, 4096) < 0.02


def test_pack_odd_rows(spark, library):
    data = [(i, t, "x", 1) for i, t in enumerate(ODD)] + [(None, "no id", "y", 2)]
    df = spark.createDataFrame(data, "doc_id long, text string, ids string, length int")
    rows = packing.pack(df.coalesce(1), capacity=256, classes=16).collect()
    want = {i: library(t) for i, t in enumerate(ODD)} | {None: library("no id")}
    assert check_pieces(rows, want, 256) < 0.05
    assert packing.pack(df.limit(0)).count() == 0


def test_pack_repeated_rows(spark, library):
    df = spark.createDataFrame([(1, "same text")] * 5, "doc_id long, text string").coalesce(1)
    rows = packing.pack(df).collect()
    assert sum(r["length"] for r in rows) == 5 * len(library("same text"))


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 100, 1365, 1366, 2048, 2049, 4095, 4096, 4097, 9000])
def test_cut_covers_a_document(n):
    pieces = packing.cut(n, 4096, 64, 128)
    assert sum(x for x, _ in pieces) == n
    assert all(x * k <= 4096 for x, k in pieces if k < 64)


def digest(rows):
    return sorted((r["doc_id"] is not None, r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows)


def test_orc_round_trip(spark, library):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-i - 1, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    path = scratch(spark, "test-orc")
    both = docs.union(odd)
    token_orc.write_tokens(both, path)
    got = token_orc.tokens_digest(token_orc.read_tokens(spark, path)).collect()
    start, want = 0, []
    for r in sorted(both.collect(), key=lambda r: r["doc_id"]):
        ids = library(r["text"])
        want.append((True, r["doc_id"], start, len(ids), zlib.crc32(raw(ids))))
        start += len(ids)
    assert digest(got) == want
    one = token_orc.lookup(spark, path, [7]).collect()
    assert [(r["doc_id"], list(r["ids"])) for r in one] == [(7, library(docs.where("doc_id = 7").first()["text"]))]
    plan = token_orc.lookup(spark, path, [7])._jdf.queryExecution().toString()
    assert "PushedFilters: [EqualTo(doc_id,7)" in plan or "PushedFilters: [In(doc_id" in plan or "PushedFilters: [IsNotNull(doc_id)" in plan


def test_orc_nulls_ties_and_empty(spark, library):
    df = spark.createDataFrame([(None, "b", 1), (3, None, 2), (3, "x y", 3), (3, "x y", 4)],
                               "doc_id long, text string, ids int")
    path = scratch(spark, "test-orc")
    token_orc.write_tokens(df, path)
    got = token_orc.tokens_digest(token_orc.read_tokens(spark, path)).collect()
    assert len(got) == 4
    at = 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])] == [None, 3, 3, 3]
    path = scratch(spark, "test-orc")
    token_orc.write_tokens(df.limit(0), path)
    assert token_orc.tokens_digest(token_orc.read_tokens(spark, path)).count() == 0
