"""Merkle manifest of a dataset as a postorder append log.

Leaves are digests of rows; in each tree (one a language) they ascend by id,
and every 8 consecutive nodes of a level have their parent, until one node is
left. The roots of the trees, in the order of their names, are the leaves of
one tree above them.

The log of a tree holds its nodes in the order in which they are completed:
node j of level h, whose last leaf is l, stands at l + l/8 + l/64 + ... + h
(whole quotients), since l leaves and l/8^t nodes of each level t are complete
before leaf l, and the nodes that end with it follow upward. Aligned builders
each take 8^4 consecutive leaves and write one run of the log, complete but for
the nodes above their top; those are made level by level and stand at the
places that the runs leave free. Nothing has to be searched: the places of a
node's siblings follow from the number of leaves, inside a run as offsets from
its first place, above it as keys of a join.

Leaves are ranked by range partitions and their counts, never in one task;
a tree holding most rows only has more builders.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rides.llm.common import ascii_lower, col, saved

FANOUT = 8
TOP = 4                         # level of a builder's root
SPAN = FANOUT ** TOP            # leaves of a builder


# ---------------------------------------------------------------------------
# Leaves

def _encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(*values: Column) -> Column:
    """Lowercase hex SHA-256 of the values, each as UTF-8 length, colon and
    text, a null as ``-``."""
    return F.sha2(F.concat(*map(_encoded, values)).cast("binary"), 256)


def ranked(rows: DataFrame, tree: str, order: list[str]) -> DataFrame:
    """``rows`` with ``place``, their number from 0 within ``tree`` by
    ``order`` (nulls first), and ``n``, the rows of the tree. Rows are dealt by
    ranges of tree, order and, so that repeated rows do not meet in one task,
    their number in the written input; counts of the ranges give the first
    place of each."""
    rows = saved(rows, "rank-input").withColumn("_salt", F.monotonically_increasing_id())
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(tree).asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order), F.col("_salt").asc()]
    dealt = saved(rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
                      .withColumn("_range", F.spark_partition_id())
                      .withColumn("_serial", F.monotonically_increasing_id())
                      .drop("_salt"), "ranges")
    counts = dealt.groupBy(tree, "_range").agg(F.count(F.lit(1)).alias("_n"),
                                               F.min("_serial").alias("_first"))
    whole = Window.partitionBy(tree)
    before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(tree).alias("_tree"), F.col("_range").alias("_at"), "_first",
                           F.coalesce(F.sum("_n").over(before), F.lit(0).cast("long")).alias("_before"),
                           F.sum("_n").over(whole).alias("n"))
    return (dealt.join(starts, F.col(tree).eqNullSafe(F.col("_tree")) & (F.col("_range") == F.col("_at")))
                 .withColumn("place", F.col("_before") + F.col("_serial") - F.col("_first"))
                 .drop("_tree", "_at", "_first", "_before", "_range", "_serial"))


# ---------------------------------------------------------------------------
# The log

def position(level: Column, last_leaf: Column, height: int) -> Column:
    """Place in the log of the node of ``level`` that ends with ``last_leaf``."""
    return sum((F.floor(last_leaf / F.lit(FANOUT ** t)).cast("long") for t in range(1, height + 1)),
               last_leaf) + level


def _first_position(leaf: int) -> int:
    out, rest = leaf, leaf // FANOUT
    while rest:
        out, rest = out + rest, rest // FANOUT
    return out


def _built(leaves: list[bytes]) -> list[bytes]:
    """All nodes over the leaves in postorder, up to the root."""
    out: list[bytes] = []
    open_nodes: list[list[bytes]] = [[]]            # of each level, those without a parent yet

    def put(node: bytes, level: int) -> None:
        out.append(node)
        if level == len(open_nodes):
            open_nodes.append([])
        open_nodes[level].append(node)
        if len(open_nodes[level]) == FANOUT and level < TOP:
            close(level)

    def close(level: int) -> None:
        children, open_nodes[level] = open_nodes[level], []
        put(sha256(b"".join(children)).hexdigest().encode(), level + 1)

    for leaf in leaves:
        put(leaf, 0)
    level = 0
    while level < TOP and (len(open_nodes[level]) > 1 or len(open_nodes) > level + 1):
        if open_nodes[level]:                       # the last run, shorter than the others
            close(level)
        level += 1
    return out


def _raised(root: bytes, level: int) -> Iterator[bytes]:
    """Parents of a lone node up to the builders' level."""
    for _ in range(level, TOP):
        root = sha256(root).hexdigest().encode()
        yield root


def _levels(n: int) -> int:
    """Level of the root over n leaves."""
    level = 0
    while n > 1:
        n, level = -(-n // FANOUT), level + 1
    return level


_RUN = pa.schema([("tree", pa.string()), ("builder", pa.int64()), ("n", pa.int64()),
                  ("position", pa.int64()), ("nodes", pa.string()), ("top", pa.string())])
RUN = "tree string, builder long, n long, position long, nodes string, top string"


def _build(key, rows):
    """One run of the log: 64 characters a node."""
    rows = rows.sort_by("place")
    tree, builder = (k.as_py() for k in key)
    size = rows.column("n")[0].as_py()
    nodes = _built([x.encode() for x in rows.column("leaf").to_pylist()])
    if size > SPAN:                                 # a tree of several builders: each ends at TOP
        nodes.extend(_raised(nodes[-1], _levels(rows.num_rows)))
    return pa.Table.from_pylist([{
        "tree": tree, "builder": builder, "n": size, "position": _first_position(builder * SPAN),
        "nodes": b"".join(nodes).decode(), "top": nodes[-1].decode()}], _RUN)


def _parents(nodes: DataFrame, keys: list[str]) -> DataFrame:
    """Parents of one level's nodes (keys, index, digest), at most 8 each."""
    run = F.array_sort(F.collect_list(F.struct("index", "digest")))
    return (nodes.groupBy(*keys, F.floor(F.col("index") / F.lit(FANOUT)).cast("long").alias("index"))
                 .agg(run.alias("run"))
                 .select(*keys, "index", F.sha2(F.array_join(F.transform(
                     "run", lambda x: x["digest"]), "").cast("binary"), 256).alias("digest")))


def _power(level: Column) -> Column:
    return F.pow(F.lit(float(FANOUT)), level).cast("long")


def _grown(nodes: DataFrame, keys: list[str], first: int, most: int, name: str) -> DataFrame:
    """``nodes`` (keys, n, index, digest; all of level ``first``) and every
    level above them, with their places in the log; a tree stops at its root.
    ``n`` counts the leaves, ``most`` is the greatest."""
    out, level, h = nodes.withColumn("level", F.lit(first)), nodes, first
    while FANOUT ** h < most:
        level = saved(_parents(level.where(F.col("n") > F.lit(FANOUT ** h)), [*keys, "n"]), name)
        h += 1
        out = out.unionByName(level.withColumn("level", F.lit(h)))
    last = F.least(F.col("n"), (F.col("index") + 1) * _power(F.col("level"))) - 1
    return saved(out.withColumn("position", position(F.col("level"), last, _levels(most))), name)


@dataclass
class Manifest:
    """The written tables of a manifest.

    ``leaves``: the given columns, ``place`` in the tree, its leaves ``n`` and
    ``builder``. ``runs`` (tree, builder, n, position, nodes, top) and ``upper``
    (tree, n, level, index, position, digest) are the logs: runs of nodes from
    a first place on, and the single nodes from the runs' tops upward (a tree
    of one builder has its root there, under level 4). ``trees`` (tree,
    subroot, place, n) are the leaves of the tree above, whose nodes are
    ``roof`` and whose top is ``root`` (None for an empty table)."""
    leaves: DataFrame
    runs: DataFrame
    upper: DataFrame
    trees: DataFrame
    roof: DataFrame
    root: str | None


def build_manifest(rows: DataFrame, tree: str, order: str) -> Manifest:
    """The manifest of ``rows`` with a column ``leaf`` (hex digest); each value
    of ``tree`` has a tree of its leaves ascending by ``order``. A null tree is
    one of its own, before all others; rows with equal or null ``order`` (nulls
    first) stand by their leaves, and repeated rows are leaves each."""
    leaves = saved(ranked(rows.withColumnRenamed(tree, "tree"), "tree", [order, "leaf"]).withColumn(
        "builder", F.floor(F.col("place") / F.lit(SPAN)).cast("long")), "leaves")
    size = leaves.agg(F.max("n").alias("most"), F.count_if(F.col("place") == 0).alias("trees")).first()
    most, trees = size["most"] or 0, size["trees"]
    runs = saved(leaves.select("tree", "builder", "place", "n", "leaf").groupBy("tree", "builder")
                       .applyInArrow(_build, RUN), "log")
    upper = _grown(runs.select("tree", "n", F.col("builder").alias("index"), F.col("top").alias("digest")),
                   ["tree"], TOP, most, "upper")
    subroots = upper.where((F.col("index") == 0) & (F.col("n") <= _power(F.col("level")))).select(
        "tree", F.col("digest").alias("subroot"), F.lit(0).alias("forest"))
    named = saved(ranked(subroots, "forest", ["tree"]).drop("forest"), "trees")
    roof = _grown(named.select("n", F.col("place").alias("index"), F.col("subroot").alias("digest")),
                  [], 0, trees, "roof")
    root = roof.where(F.col("level") == _levels(trees)).first()
    return Manifest(leaves, runs, upper, named, roof, root["digest"] if root else None)


# ---------------------------------------------------------------------------
# Proofs

PROOF = "array<struct<at:int,siblings:string>>"


def _paths(nodes: DataFrame, keys: list[str], first: int, most: int) -> DataFrame:
    """For each node of level ``first`` the proof from there to its root: per
    level its number in the run and the run's other digests, joined. Siblings
    are looked up by their places in the log."""
    start = nodes.where(F.col("level") == first).select(*keys, "n", F.col("index").alias("base"))
    height = _levels(most)
    if height <= first:
        return start.select(*keys, "base", F.array().cast(PROOF).alias("path"))
    level, node = F.col("step"), F.col("node")
    steps = (start.withColumn("step", F.explode(F.sequence(F.lit(first), F.lit(height - 1))))
                  .where(F.col("n") > _power(level))
                  .withColumn("node", F.floor(F.col("base") / _power(level - first)).cast("long"))
                  .withColumn("sibling", F.explode(F.sequence(
                      node - node % FANOUT,
                      F.least(node - node % FANOUT + FANOUT - 1,
                              F.floor((F.col("n") - 1) / _power(level)).cast("long")))))
                  .withColumn("spot", position(level, F.least(
                      F.col("n"), (F.col("sibling") + 1) * _power(level)) - 1, height)))
    log = nodes.select(*(F.col(k).alias(f"_{k}") for k in keys), "position", "digest")
    same = F.col("spot") == F.col("position")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    others = F.array_sort(F.collect_list(F.when(F.col("sibling") != node, F.struct("sibling", "digest"))))
    per_level = steps.join(log, same).groupBy(*keys, "base", "step").agg(
        F.count_if(F.col("sibling") < node).cast("int").alias("at"),
        F.array_join(F.transform(others, lambda x: x["digest"]), "").alias("siblings"))
    whole = per_level.groupBy(*keys, "base").agg(F.array_sort(F.collect_list(
        F.struct("step", "at", "siblings"))).alias("steps")).select(
            *(F.col(k).alias(f"_{k}") for k in keys), F.col("base").alias("_base"),
            F.transform("steps", lambda x: F.struct(x["at"], x["siblings"])).alias("path"))
    same = F.col("base") == F.col("_base")
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    return start.join(whole, same, "left").select(
        *keys, "base", F.coalesce("path", F.array()).cast(PROOF).alias("path"))


def _run_proofs(nodes: str, count: int, whole: bool) -> list[tuple[list[int], list[str]]]:
    """For each leaf of a run its numbers and joined siblings, level by level.
    ``whole``: the run ends at TOP even where a lower level has one node."""
    below: list[tuple[list[int], list[str]]] = [([], []) for _ in range(count)]
    size, level = count, 0
    while level < TOP and (size > 1 or whole):
        reach = FANOUT ** level
        at_level = []
        for j in range(size):
            last = min((j + 1) * reach, count) - 1
            # within an aligned run only quotients up to TOP differ from its first place
            at = 64 * (last + sum(last // FANOUT ** t for t in range(1, TOP + 1)) + level)
            at_level.append(nodes[at:at + 64])
        for start in range(0, size, FANOUT):
            run = at_level[start:start + FANOUT]
            for own in range(len(run)):
                others = "".join(run[:own] + run[own + 1:])
                for leaf in range((start + own) * reach, min((start + own + 1) * reach, count)):
                    below[leaf][0].append(own)
                    below[leaf][1].append(others)
        size, level = -(-size // FANOUT), level + 1
    return below


def _prover(columns: list[str]):
    def prove(key, leaves, runs):
        leaves = leaves.sort_by("place")
        run = runs.to_pylist()[0]
        above = [*run["inner"], *run["outer"]]
        ats, siblings = [x["at"] for x in above], [x["siblings"] for x in above]
        sizes, flat_at, flat_siblings = [0], [], []
        for at, others in _run_proofs(run["nodes"], leaves.num_rows, run["n"] > SPAN):
            flat_at.extend(at + ats)
            flat_siblings.extend(others + siblings)
            sizes.append(len(flat_at))
        proof = pa.ListArray.from_arrays(
            pa.array(sizes, pa.int32()),
            pa.StructArray.from_arrays([pa.array(flat_at, pa.int32()), pa.array(flat_siblings, pa.string())],
                                       ["at", "siblings"]))
        return pa.table([*(leaves.column(c) for c in columns), proof,
                         pa.array([run["subroot"]] * leaves.num_rows, pa.string())],
                        [*columns, "proof", "subroot"])
    return prove


def proofs(manifest: Manifest) -> DataFrame:
    """Every leaf's row with ``subroot``, ``root`` and ``proof``: level by level
    from the leaf to the root, its number in the run and the joined digests of
    the run's others. A task reads one run of the log with its leaves; what is
    above the run comes with it, found once a run."""
    m = manifest
    size = m.leaves.agg(F.max("n").alias("most")).first()["most"] or 0
    trees = m.trees.count()
    inner = _paths(m.upper, ["tree"], TOP, size).select(
        F.col("tree").alias("_t"), F.col("base").alias("_b"), F.col("path").alias("inner"))
    outer = m.trees.join(_paths(m.roof, [], 0, trees), F.col("place") == F.col("base")).select(
        F.col("tree").alias("_u"), "subroot", F.col("path").alias("outer"))
    runs = (m.runs.join(inner, F.col("tree").eqNullSafe(F.col("_t")) & (F.col("builder") == F.col("_b")))
                  .join(outer, F.col("tree").eqNullSafe(F.col("_u")))
                  .select("tree", "builder", "n", "position", "nodes", "inner", "outer", "subroot"))
    columns = [c for c in m.leaves.columns if c not in ("place", "n", "builder")]
    fields = ", ".join(f"`{c}` {m.leaves.schema[c].dataType.simpleString()}" for c in columns)
    return (m.leaves.groupBy("tree", "builder").cogroup(runs.groupBy("tree", "builder"))
                    .applyInArrow(_prover(columns), f"{fields}, proof {PROOF}, subroot string")
                    .withColumn("root", F.lit(m.root)))


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf digest and its proof give."""
    return F.aggregate(proof, leaf, lambda node, x: F.sha2(F.concat(
        F.substring(x["siblings"], F.lit(1), 64 * x["at"]), node,
        F.substring(x["siblings"], 64 * x["at"] + 1, F.lit(64 * FANOUT))).cast("binary"), 256))


# ---------------------------------------------------------------------------
# Documents

def document_leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, claimed): the leaf digest of each row, and the one
    claimed for it later: of every third document, by the CRC-32 of its id,
    with A-Z of the text lower-cased (a tampered copy), else the same."""
    named = ("doc_id", "source", "lang", "n_chars")
    leaf = leaf_digest(*map(col, named), col("text"))
    chosen = F.crc32(col("doc_id").cast("string").cast("binary")) % 3 == 0
    rows = docs.select(*map(col, named), "text").select(
        "doc_id", F.col("lang").cast("string").alias("lang"), leaf.alias("leaf"),
        F.when(chosen, leaf_digest(*map(col, named), ascii_lower(F.col("text")))).alias("tampered"))
    return rows.select("doc_id", "lang", "leaf", F.coalesce("tampered", "leaf").alias("claimed"))


def proofs_digest(proven: DataFrame) -> DataFrame:
    joined = F.array_join(F.transform("proof", lambda x: x["siblings"]), "")
    return proven.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(joined.cast("binary"), 256).alias("proof_sha256"),
        folded(F.col("claimed"), F.col("proof")).alias("folded_root")).withColumn(
            "verified", F.col("folded_root") == F.col("root"))
