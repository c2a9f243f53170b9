"""The Merkle manifest against trees built whole in Python."""

import hashlib
import zlib

from pyspark.sql import functions as F

from rides.llm import merkle as m

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = (row[0], row[3], row[2], row[4], text)
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
    return out


def fold(tree, i, node):
    proof = ""
    for level in tree[:-1]:
        run = level[i - i % 8:i - i % 8 + 8]
        proof += "".join(run[:i % 8] + run[i % 8 + 1:])
        node = sha("".join(run[:i % 8] + [node] + run[i % 8 + 1:]))
        i //= 8
    return proof, node


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r, r[1]), r))
    langs = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {x: levels([n[2] for n in sorted(trees[x], key=lambda n: n[:3])]) for x in langs}
    top = levels([built[x][-1][0] for x in langs])
    out = []
    for k, lang in enumerate(langs):
        for i, (_, _, node, r) in enumerate(sorted(trees[lang], key=lambda n: n[:3])):
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            inner, node2 = fold(built[lang], i, leaf(r, lowered(r[1])) if tampered else node)
            outer, root = fold(top, k, node2)
            out.append((r[0], node, built[lang][-1][0], top[-1][0], sha(inner + outer), root, root == top[-1][0]))
    return sorted(out, key=str)


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def answers(df):
    proven = m.proofs(m.build_manifest(m.document_leaves(df), "lang", "doc_id"))
    return sorted((tuple(r) for r in m.proofs_digest(proven).select(*COLUMNS).collect()), key=str)


def test_trees_of_all_sizes_and_odd_rows(spark):
    rows, at = [], -5
    for k, size in enumerate((1, 2, 8, 9, 64, 65, 100, 513)):
        for i in range(size):
            rows.append((at, f"Text {i} ÉA", f"l{k}" if k else None, None if i % 7 == 0 else "s", i))
            at += 3
    rows += [(None, None, "l4", None, None), (None, "", "l4", None, None), (4, "A", "", "s", 1), (4, "A", "", "s", 1),
             (4, "B", "", "s", 1), (5, "same", "中", "", 0)]
    df = spark.createDataFrame([(*r, 9, "x") for r in rows], DOCS + ", place int, leaf string").repartition(5)
    assert answers(df) == brute(rows)


def test_trees_of_several_builders_and_a_log_in_postorder(spark):
    sizes = {"one": 4096, "two": 4097, "three": 9001}
    rows = [(i, f"T{i}", lang, "s", i) for lang, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, DOCS)
    assert answers(df) == brute(rows)
    manifest = m.build_manifest(m.document_leaves(df), "lang", "doc_id")
    for lang, n in sizes.items():
        log = {}
        for r in manifest.runs.where(F.col("tree") == lang).collect():
            for j in range(len(r.nodes) // 64):
                log[r.position + j] = r.nodes[64 * j:64 * j + 64]
        for r in manifest.upper.where(F.col("tree") == lang).collect():
            if n > m.SPAN:
                assert log.get(r.position, r.digest) == r.digest
                log[r.position] = r.digest
        tree = levels([leaf(r, r[1]) for r in rows if r[2] == lang])
        assert sorted(log) == list(range(sum(map(len, tree))))          # gapless
        order, done = [], [0] * len(tree)

        def complete(level, tree=tree, order=order, done=done):
            order.append(tree[level][done[level]])
            done[level] += 1
            if level + 1 < len(tree) and (done[level] % 8 == 0):
                complete(level + 1)
        for _ in range(n):
            complete(0)
        for level in range(1, len(tree)):                               # the shorter last runs
            if done[level] < len(tree[level]):
                complete(level)
        assert [log[i] for i in range(len(log))] == order


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, "same", "en", "s", 4)] * 300 + [(None, "x", None, None, None)] * 20
    assert answers(spark.createDataFrame(rows, DOCS)) == brute(rows)
    assert answers(spark.createDataFrame([], DOCS)) == []
