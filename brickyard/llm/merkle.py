"""Merkle manifest of a dataset, with octopus multiproofs.

Every row is a leaf: the sha256 of its columns, each as byte count, colon and
value (``-`` for null). Per ``lang`` the leaves stand in the order of doc_id;
every ``FAN`` consecutive nodes become their parent until one is left, the
subroot. The subroots, in the order of lang, make a tree of the same shape,
whose top is the root.

Build: leaves get their place by one range sort of digests (texts are never
shuffled). A leaf partition is a subtree of ``HEIGHT`` levels; a task hashes
it whole, and its top is a node of the next tier. Nodes are stored as rows
(tree, level, place, digest); tree -1 holds the subroots.

Proofs: a leaf partition unites the coordinates of the nodes that the proofs of
its rows need and that its own rows don't give (the octopus), fetches each of
them once by an equi-join, derives the shared interiors, and expands every
row's own proof from these. High nodes, wanted by very many partitions, are few
and are broadcast as far as their number is proven small; the others are each
wanted by a bounded number of partitions.

Defined results: null doc_ids come first, a null lang is the first tree. Rows
that repeat an id stand in the order of their digests; equal rows are leaves of
their own. Null columns hash as ``-`` and differ from empty ones. Texts of any
length are hashed whole, in the scan. An empty table gives no rows. Columns
beyond the five hashed ones are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import global_rank, written

FAN_BITS, HEIGHT = 3, 3
FAN = 1 << FAN_BITS
#: Bits of a leaf's place within its partition.
BITS = FAN_BITS * HEIGHT
#: The tree of subroots.
TOP = -1
#: A level of at most so many nodes is broadcast (some 100 bytes a node).
FEW_NODES = 100_000
#: A table with one row a lang is broadcast below this count.
FEW_TREES = 100_000
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
NODE = "tree long, level int, place long, digest string, n long"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Manifest(NamedTuple):
    """``leaves`` (doc_id, leaf, tampered, tree, place, n), ``nodes`` (the
    interiors), ``trees`` (tree, n, subroot), their number, the root."""
    leaves: DataFrame
    nodes: DataFrame
    trees: DataFrame
    n_trees: int
    root: str | None


def field(value: Column) -> Column:
    s = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def leaf_digest(**replaced: Column) -> Column:
    """The leaf of a row; ``replaced`` columns stand in for the row's own."""
    return F.sha2(F.concat(*(field(replaced.get(c, F.col(c))) for c in COLUMNS)), 256)


def is_tampered() -> Column:
    """Crc32 of the id as text is divisible by 3 (false for a null id)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))


def height(n: int) -> int:
    """Levels above ``n`` leaves."""
    h = 0
    while n > 1:
        n, h = -(-n >> FAN_BITS), h + 1
    return h


def _few(df: DataFrame, rows: int, bound: int) -> DataFrame:
    return F.broadcast(df) if rows <= bound else df


def _hash(parts) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for b in batches:
        yield from zip(*(c.to_pylist() for c in b.columns), strict=True)


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == size:
            yield _record(held, schema)
            held = []
    if held:
        yield _record(held, schema)


def _record(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


_NODES = pa.schema([("tree", pa.int64()), ("level", pa.int32()), ("place", pa.int64()), ("digest", pa.string()), ("n", pa.int64())])


def _tier(level: int):
    """The interiors of whole partitions, from rows (tree, place, digest, n) of one level, sorted by tree and place."""
    def interiors(batches):
        for (tree, _), rows in groupby(_rows(batches), lambda r: (r[0], r[1] >> BITS)):
            rows = list(rows)
            n, now = rows[0][3], [r[1:3] for r in rows]
            for at in range(level + 1, min(level + HEIGHT, height(n)) + 1):
                now = [(p, _hash(d for _, d in run)) for p, run in groupby(now, lambda x: x[0] >> FAN_BITS)]
                yield from ((tree, at, p, d, n) for p, d in now)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(interiors(batches), _NODES)
    return run


def _interiors(level0: DataFrame, most: int, tag: str) -> DataFrame:
    """Interior nodes over ``level0`` (tree, place, digest, n); the largest tree has ``most`` leaves."""
    nodes = level0.sparkSession.createDataFrame([], NODE)
    now = level0
    for level in range(0, height(most), HEIGHT):
        tier = written(now.select("tree", "place", "digest", "n").repartition(F.col("tree"), F.shiftright("place", BITS))
                       .sortWithinPartitions("tree", "place").mapInArrow(_tier(level), NODE), tag)
        nodes = nodes.unionByName(tier)
        now = tier.filter(F.col("level") == level + HEIGHT)
    return nodes


def build(docs: DataFrame, tampered: Column | None = None) -> Manifest:
    """The tree over ``docs``. ``tampered``: text that the column of the same
    name hashes instead of the row's own, if given."""
    spark = docs.sparkSession
    # the row number is stored: equal rows keep their order, and a large group of them can be split
    first = written(docs.select("doc_id", F.when(F.col("lang").isNull(), "").otherwise(F.concat(F.lit("+"), "lang")).alias("_lang"),
                                leaf_digest().alias("leaf"), leaf_digest(text=F.col("text") if tampered is None else tampered).alias("tampered"),
                                F.monotonically_increasing_id().alias("_tie")), "leaves")
    ranked = global_rank(first, [F.col("_lang"), F.col("doc_id"), F.col("leaf"), F.col("_tie")], "ranked")
    langs = written(ranked.groupBy("_lang").agg(F.count("*").alias("n"), F.min("rank").alias("_start")), "langs")
    trees = written(global_rank(langs, [F.col("_lang")], "trees").withColumnRenamed("rank", "tree"), "trees")
    n_trees, most = trees.agg(F.count("*"), F.max("n")).first()
    leaves = (ranked.join(_few(trees, n_trees, FEW_TREES), "_lang")
              .select("doc_id", "leaf", "tampered", "tree", (F.col("rank") - F.col("_start")).alias("place"), "n"))
    if not n_trees:
        return Manifest(leaves, spark.createDataFrame([], NODE), trees.select("tree", "n", F.lit("").alias("subroot")), 0, None)
    nodes = _interiors(leaves.withColumnRenamed("leaf", "digest"), most, "interiors")
    tops = (leaves.filter("n = 1").select("tree", F.col("leaf").alias("subroot"))
            .unionByName(nodes.filter(F.col("level") == _height(F.col("n"))).select("tree", F.col("digest").alias("subroot"))))
    trees = written(trees.select("tree", "n").join(tops, "tree"), "subroots")
    subroots = trees.select(F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("place"), F.col("subroot").alias("digest"), F.lit(n_trees).cast("long").alias("n"))
    above = _interiors(subroots, n_trees, "above")
    root = subroots.filter("n = 1").select("digest").unionByName(
        above.filter(F.col("level") == height(n_trees)).select("digest")).first()[0]
    # the subroots themselves are nodes that proofs need
    top_leaves = subroots.select("tree", F.lit(0).alias("level"), "place", "digest", "n")
    return Manifest(leaves, nodes.unionByName(above).unionByName(top_leaves), trees, n_trees, root)


def _height(n: Column) -> Column:
    """``height`` of a column of counts: levels at which more than one node is left."""
    h = F.lit(0)
    for k in range(1, 63 // FAN_BITS + 1):
        h = F.when(n > F.lit(1 << (FAN_BITS * (k - 1))), k).otherwise(h)
    return h


def _path(place: int, n: int, level: int = 0) -> Iterator[tuple[int, int, range]]:
    """(level, own place, the run it stands in) from ``level`` to below the top of a tree of ``n`` leaves."""
    for at in range(height(n)):
        if at >= level:
            yield at, place, range(place >> FAN_BITS << FAN_BITS, min((place >> FAN_BITS) + 1 << FAN_BITS, -(-n >> FAN_BITS * at)))
        place >>= FAN_BITS


def missing(tree: int, places: set[int], n: int, n_trees: int) -> Iterator[tuple[int, int, int]]:
    """Coordinates (tree, level, place) that the joint proof of the leaves
    ``places`` of one partition needs beside them: siblings at each level
    that can't be derived from the level below, up to the root."""
    known = places
    for at in range(height(n)):
        width = -(-n >> FAN_BITS * at)
        parents = {p >> FAN_BITS for p in known}
        for up in sorted(parents):
            yield from ((tree, at, p) for p in range(up << FAN_BITS, min(up + 1 << FAN_BITS, width)) if p not in known)
        known = parents
    for at, own, run in _path(tree, n_trees):
        yield from ((TOP, at, p) for p in run if p != own)


def _wants(n_trees: int):
    """Requests (tree, block, t, level, place) of the partitions whose rows (tree, place, n) come sorted."""
    schema = pa.schema([("tree", pa.int64()), ("block", pa.int64()), ("t", pa.int64()), ("level", pa.int32()), ("place", pa.int64())])

    def wants(batches):
        for (tree, block), rows in groupby(_rows(batches), lambda r: (r[0], r[1] >> BITS)):
            rows = list(rows)
            yield from ((tree, block, *c) for c in missing(tree, {r[1] for r in rows}, rows[0][2], n_trees))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(wants(batches), schema)
    return run


def _fetched(requests: DataFrame, m: Manifest) -> DataFrame:
    """``requests`` with the digests of their nodes. The low levels join by
    shuffle, the high ones by a broadcast where the counted nodes allow it."""
    at = [F.col("t") == F.col("node.tree"), F.col("r.level") == F.col("node.level"), F.col("r.place") == F.col("node.place")]
    cols = ["r.tree", "r.block", "r.t", "r.level", "r.place", "node.digest"]
    nodes = m.nodes.select("tree", "level", "place", "digest")
    sizes = {r[0]: r[1] for r in nodes.groupBy("level").count().collect()}  # one row a level
    cut, held = 1 + max(sizes, default=0), 0
    while cut > 0 and held + sizes.get(cut - 1, 0) <= FEW_NODES:
        cut, held = cut - 1, held + sizes.get(cut - 1, 0)
    r = requests.alias("r")
    high = r.filter(F.col("r.level") >= cut).join(F.broadcast(nodes.filter(F.col("level") >= cut)).alias("node"), at).select(*cols)
    low = r.filter(F.col("r.level") < cut).join(nodes.filter(F.col("level") < cut).alias("node"), at).select(*cols)
    leaf = m.leaves.select("tree", F.lit(0).alias("level"), "place", F.col("leaf").alias("digest"))
    # empty where whole partitions are proven
    bare = r.filter((F.col("r.level") == 0) & (F.col("r.t") >= 0)).join(leaf.alias("node"), at).select(*cols)
    return (high if not cut else high.unionByName(low)).unionByName(bare)


_PROOFS = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("tree", pa.int64()), ("proof_sha256", pa.string()), ("folded_root", pa.string())])


def expand(tree: int, n: int, n_trees: int, leaves: dict[int, str], fetched: dict[tuple[int, int, int], str]):
    """A function from (place, leaf) to (siblings of each level, folded root),
    over the interiors that the partition's rows and the fetched nodes give."""
    have = dict(fetched)
    have.update({(tree, 0, p): d for p, d in leaves.items()})
    runs: dict[tuple[int, int, int], list[str]] = {}

    def run_of(t, at, run):
        key = (t, at, run.start)
        if key not in runs:
            runs[key] = [have[t, at, p] for p in run]
        return runs[key]

    known = set(leaves)
    for at in range(height(n)):  # shared interiors, each once
        known = {p >> FAN_BITS for p in known}
        for up in known:
            width = -(-n >> FAN_BITS * at)
            run = range(up << FAN_BITS, min(up + 1 << FAN_BITS, width))
            have.setdefault((tree, at + 1, up), _hash(run_of(tree, at, run)))
    have[TOP, 0, tree] = have[tree, height(n), 0]
    for at, own, run in _path(tree, n_trees):
        have[TOP, at + 1, own >> FAN_BITS] = _hash(run_of(TOP, at, run))

    def prove(place: int, leaf: str) -> tuple[list[list[str]], str]:
        levels, digest = [], leaf
        for t, p, count in ((tree, place, n), (TOP, tree, n_trees)):
            for at, own, run in _path(p, count):
                digests, i = run_of(t, at, run), own - run.start
                levels.append(digests[:i] + digests[i + 1:])
                digest = _hash([*digests[:i], digest, *digests[i + 1:]])
        return levels, digest
    return prove


def _prove(n_trees: int):
    """Proofs from rows (tree, block, t, level, place, digest, folded, doc_id, n), nodes before leaves in a block."""
    def proofs(batches):
        for (tree, _), rows in groupby(_rows(batches), lambda r: (r[0], r[1])):
            fetched, mine = {}, []
            for r in rows:
                if r[8] is None:
                    fetched[r[2:5]] = r[5]
                else:
                    mine.append(r)
            prove = expand(tree, mine[0][8], n_trees, {r[4]: r[5] for r in mine}, fetched)
            for r in mine:
                levels, folded = prove(r[4], r[6])
                yield r[7], r[5], tree, _hash(d for siblings in levels for d in siblings), folded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batched(proofs(batches), _PROOFS)
    return run


def prove(m: Manifest, wanted: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) for
    the rows ``wanted`` of ``m.leaves``: their proofs, folded from the
    ``tampered`` digest."""
    block = F.shiftright("place", BITS)
    requests = written(wanted.select("tree", "place", "n").repartition(F.col("tree"), block).sortWithinPartitions("tree", "place")
                       .mapInArrow(_wants(m.n_trees), "tree long, block long, t long, level int, place long"), "requests")
    none = {c: F.lit(None).cast(t) for c, t in (("folded", "string"), ("doc_id", "long"), ("n", "long"))}
    rows = _fetched(requests, m).select("tree", "block", "t", "level", "place", "digest", *(v.alias(k) for k, v in none.items())).unionByName(
        wanted.select("tree", block.alias("block"), F.lit(None).cast("long").alias("t"), F.lit(None).cast("int").alias("level"), "place",
                      F.col("leaf").alias("digest"), F.col("tampered").alias("folded"), F.col("doc_id").cast("long").alias("doc_id"), "n"))
    proofs = (rows.repartition("tree", "block").sortWithinPartitions("tree", "block")
              .mapInArrow(_prove(m.n_trees), "doc_id long, leaf string, tree long, proof_sha256 string, folded_root string"))
    root = F.lit(m.root).cast("string")
    return (proofs.join(_few(m.trees.select("tree", "subroot"), m.n_trees, FEW_TREES), "tree")
            .select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified")))


def manifest(docs: DataFrame) -> DataFrame:
    """Every row's proof, folded with lower-cased text where ``is_tampered``."""
    m = build(docs, F.when(is_tampered(), F.translate("text", _UPPER, _LOWER)).otherwise(F.col("text")))
    return prove(m, m.leaves)
