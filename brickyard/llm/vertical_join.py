"""N-gram Jaccard self-join with vertical partitioning.

A document is the set of its distinct k-word shingles (64-bit hashes; the
hash order is the global n-gram order). Two documents link when
``100 * |A & B| >= percent * |A | B|``. The global order is cut into
fragments and fragments do all the work:

* **Candidates.** Sets that link differ in at most D shingles, D known from
  their lengths. With D + 1 fragments and some spare, a known number of
  fragments at least is equal in both. A key per fragment, made of its
  content, is counted: sets that share enough keys are candidates. Keys that
  only a few sets share give pairs, which are summed; sets join hot keys (near
  copies, common passages) only if they have enough hot keys to link by these
  alone, and then by star edges, never as pairs. Sets are compared within
  length windows whose ends differ by the square of the threshold ratio.
* **Verification.** Candidates connect into clusters. A cluster is cut into
  chunks of bounded size; a tile of two chunks counts partial overlaps
  fragment by fragment (small dense products) and sums them per pair. Only a
  spanning forest of the verified links leaves a tile. Clusters of more than
  one chunk are first compared with a few centres, round by round; sets that
  these connect need not meet each other, and only the others meet everything.

Copies (equal sets) collapse to one node before anything else, inside the
scan already, so a group of copies costs one row a task.

Nulls: null, empty or blank text gives the empty set, which links with
nothing (``n_shingles`` 0, ``component_id`` its own id). Rows with a null id
take part with a null id: they can link others, and a component's id is the
least id that isn't null. Repeated ids keep one output row per input row.
Very long texts are read whole.
Other columns of the input are ignored. A node is a 64-bit hash of a set:
two sets share one with odds of about (sets squared) / 2^65.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import connected_components, fresh, global_rank, lean, mix64, parts, shingle_hashes, small_or_shuffled, text_batches, word_hashes, worker_cache, written

#: Shingles (and sets) in a chunk of a cluster: bounds the memory of a tile.
CHUNK_SHINGLES, CHUNK_SETS = 400_000, 512
#: Sets of a length band that a round of a large cluster compares with all others.
CENTRES = 32
#: Columns of the n-gram order in one fragment of a tile's dense product.
FRAGMENT = 8192
#: Keys gathered before those of a task leave it, and keys of a range that a task sorts.
FLUSH_KEYS, RANGE_KEYS = 400_000, 1_000_000
#: Sets that share a key become pairs up to this many; a key of more is hot.
GROUP = 8
#: Stands for the owner of a key that is hot in some task.
HOT = -(2**63)


def _sets(batch: pa.RecordBatch, k: int):
    """Per row: the sorted distinct shingles of column ``text``."""
    for t in batch.column(batch.schema.get_field_index("text")):
        raw = t.as_py()
        if not raw:
            yield np.empty(0, np.uint64)
            continue
        words, _ = word_hashes(raw.encode("utf-8", "surrogatepass"))
        yield np.unique(shingle_hashes(words, k))


def _node(s: np.ndarray) -> int:
    """A signed 64-bit hash of a set (its size included)."""
    with np.errstate(over="ignore"):
        return int(mix64(np.array([mix64(s ^ np.uint64(0x5851F42D4C957F2D)).sum() + np.uint64(len(s))])).view(np.int64)[0])


def window_of(n: int, percent: int) -> int:
    """Window j holds lengths from r^j, r = 100 / percent (by exact integer steps)."""
    j = int(math.log(n) / math.log(100 / percent))
    while lower_end(j + 1, percent) <= n:
        j += 1
    while j > 0 and lower_end(j, percent) > n:
        j -= 1
    return j


def lower_end(j: int, percent: int) -> float:
    return (100 / percent) ** j


def fragments_of(j: int, percent: int) -> tuple[int, int]:
    """(fragments, spare) of window j, for pairs whose shorter set lies in
    [r^j, r^(j+1)): they differ in D shingles at most, so that D fragments at
    most differ and spare + 1 at least are equal. The spare ones outweigh empty
    ones (sizes are near Poisson), four deviations over."""
    low = lower_end(j, percent)
    short = math.ceil(lower_end(j + 1, percent)) + 1
    total = short + math.floor(short * 100 / percent)
    d = total - 2 * math.ceil(total * percent / (100 + percent))
    if d < 1:
        return 1, 0
    spare, want = -1, 0
    while want > spare and want < 2 * (d + 1) + 6:
        spare = want
        empty = (d + 1 + spare) * math.exp(-low / (d + 1 + spare))
        want = math.ceil(empty + 4 * math.sqrt(empty))
    return d + 1 + spare, spare


def keys_of(s: np.ndarray, percent: int) -> list[tuple[int, int, np.ndarray]]:
    """(window, need, keys) of one set, for the one or two windows it belongs
    to: a key for the content of each non-empty fragment. A set shares ``need``
    keys at least with any that it links with in that window; where its empty
    fragments outnumber the spare ones that is one, a marker."""
    n, out = len(s), []
    if not n:
        return out
    j = window_of(n, percent)
    for w in (j, j - 1):
        if w < 0:
            continue
        known = worker_cache().setdefault(("fragments", percent), {})
        f, spare = known.get(w) or known.setdefault(w, fragments_of(w, percent))
        if f <= 1:
            continue  # no two different sets of this length link
        at = ((s >> np.uint64(32)) * np.uint64(f)) >> np.uint64(32)
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
        salt = np.uint64((w * 0x632BE59BD9B4E019 + 0x1234567) & (2**64 - 1))
        keys = mix64(np.add.reduceat(mix64(s + salt), first) + mix64(at[first] + salt))
        empty = f - len(first)
        if empty > spare:
            keys = np.append(keys, mix64(np.array([salt ^ np.uint64(0xE0)])))
        out.append((w, max(1, spare + 1 - empty), keys))
    return out


def _doc_rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, node = [], []
            for s in _sets(b, k):
                n.append(len(s))
                node.append(_node(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(b.schema.get_field_index("doc_id")), pa.array(n, pa.int64()), pa.array(node, pa.int64())],
                names=["doc_id", "n_shingles", "node"])
    return run


BLOBS = "p int, hot boolean, nodes binary, windows binary, needs binary, counts binary, keys binary"
FOUND = "hot boolean, a long, b long, w int, need int, c int"


def _blob(p: int, hot: bool, owner: np.ndarray, keys: np.ndarray, nodes, windows, needs, width: int) -> tuple:
    """Keys grouped by owner (a node in a window)."""
    o = np.argsort(owner, kind="stable")
    own, counts = np.unique(owner, return_counts=True)
    return (p, hot, nodes[own].tobytes(), windows[own].tobytes(), needs[own].tobytes(), counts.astype(np.uint32).tobytes(),
            np.ascontiguousarray(keys[o].view(np.uint8).reshape(-1, 8)[:, :width]).tobytes())


def _key_rows(k: int, percent: int, n: int):
    """Each task sends the keys of its different sets, packed by range of the
    key: owners (node, window, need), how many keys each has, and 48 bits of
    every key (the range stands for the leading ones; equal bits of different
    keys would only add a candidate). A key that GROUP sets of a flush share
    already is hot: its rows go on under its id, spread over all ranges, and
    its own range is only told so (owner ``HOT``)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        found: list[tuple[int, int, int, np.ndarray]] = []
        held = turn = 0

        def flush():
            nonlocal turn
            nodes = np.array([f[0] for f in found] + [HOT], dtype=np.int64)
            windows = np.array([f[1] for f in found] + [0], dtype=np.uint8)
            needs = np.array([f[2] for f in found] + [0], dtype=np.uint32)
            key = np.concatenate([f[3] for f in found])
            owner = np.repeat(np.arange(len(found)), [len(f[3]) for f in found])
            o = np.argsort(key, kind="stable")
            key, owner = key[o], owner[o]
            first = np.concatenate(([True], key[1:] != key[:-1]))
            run_of = np.cumsum(first) - 1
            size = np.bincount(run_of)
            hot = size[run_of] > GROUP
            rng = ((key >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
            rows = []
            if hot.any():
                ids = (key[hot] & np.uint64(2**48 - 1)) ^ (rng[hot] << np.uint64(48))
                turn += 1
                part = np.arange(len(ids)) * 8 // len(ids)
                for i in np.unique(part):
                    rows.append(_blob((turn * 8 + int(i)) % n, True, owner[hot][part == i], ids[part == i], nodes, windows, needs, 8))
                told = hot & first
                keep = ~hot | told
                owner = np.where(told, len(found), owner)[keep]
                key, rng = key[keep], rng[keep]
            ends = np.searchsorted(rng, np.arange(n + 1, dtype=np.uint64))
            for i in np.flatnonzero(np.diff(ends)):
                at = slice(ends[i], ends[i + 1])
                rows.append(_blob(int(i), False, owner[at], key[at], nodes, windows, needs, 6))
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], (pa.int32(), pa.bool_(), *[pa.binary()] * 5)[i]) for i in range(7)],
                                              names=[c.split()[0] for c in BLOBS.split(", ")])

        for b in batches:
            for s in _sets(b, k):
                if not len(s) or (node := _node(s)) in seen:
                    continue
                seen.add(node)
                for w, need, keys in keys_of(s, percent):
                    found.append((node, w, need, keys))
                    held += len(keys)
                if held >= FLUSH_KEYS:
                    yield flush()
                    seen.clear(), found.clear()
                    held = 0
        if found:
            yield flush()
    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The blobs of one or more ranges, sorted by range. Sets that share a key
    with few others leave as pairs (a, b, window, need, shared keys), summed
    within the range; the rows of hot keys as (key, node, window, need, 1)."""
    held: list[tuple] = []
    now = None

    def table(hot, a, b, w, need, c):
        return pa.RecordBatch.from_arrays([pa.array(np.full(len(a), hot)), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(w, pa.int32()),
                                           pa.array(need, pa.int32()), pa.array(c, pa.int32())], names=[x.split()[0] for x in FOUND.split(", ")])

    def of(nodes, windows, needs, counts, raw, width):
        n = np.frombuffer(counts, np.uint32)
        full = np.zeros((len(raw) // width, 8), np.uint8)
        full[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
        return (full.view(np.uint64)[:, 0], *(np.repeat(np.frombuffer(x, t), n) for x, t in ((nodes, np.int64), (windows, np.uint8), (needs, np.uint32))))

    def close(p):
        key, node, w, need = (np.concatenate([h[i] for h in held]) for i in range(4))
        o = np.lexsort((node, key))
        key, node, w, need = key[o], node[o], w[o], need[o]
        # copies of a set from several tasks are one
        own = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))
        key, node, w, need = key[own], node[own], w[own], need[own]
        first = np.concatenate(([True], key[1:] != key[:-1]))
        run_of = np.cumsum(first) - 1
        size = np.bincount(run_of)
        told = np.bincount(run_of, node == HOT) > 0
        hot = ((size > GROUP) | told)[run_of]
        h = hot & (node != HOT)
        if h.any():
            ids = (key[h] ^ (np.uint64(p) << np.uint64(48))).view(np.int64)
            yield table(True, ids, node[h], w[h], need[h], np.ones(h.sum(), np.int32))
        a, b = [], []
        for gap in range(1, GROUP):
            at = np.flatnonzero((run_of[gap:] == run_of[:-gap]) & ~hot[gap:]) if len(key) > gap else []
            a.append(np.asarray(at, dtype=np.int64))
            b.append(a[-1] + gap)
        a, b = np.concatenate(a), np.concatenate(b)
        if len(a):
            pair = np.stack([node[a], node[b], w[a].astype(np.int64), np.maximum(need[a], need[b]).astype(np.int64)], 1)
            pair, c = np.unique(pair, axis=0, return_counts=True)
            yield table(False, pair[:, 0], pair[:, 1], pair[:, 2], pair[:, 3], c)

    for batch in batches:
        for p, hot, *cols in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if hot:
                ids, node, w, need = of(*cols, 8)
                yield table(True, ids.view(np.int64), node, w, need, np.ones(len(ids), np.int32))
                continue
            if p != now and held:
                yield from close(now)
                held = []
            now = p
            held.append(of(*cols, 6))
    if held:
        yield from close(now)


def _member_sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            want = b.column(b.schema.get_field_index("node")).to_pylist()
            rows = [(w, s.tobytes()) for w, s in zip(want, _sets(b, k), strict=True) if len(s) and _node(s) == w]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()),
                                              pa.array([r[1] for r in rows], pa.binary())], names=["node", "shingles"])
    return run


def tile_links(x: list[np.ndarray], y: list[np.ndarray] | None, percent: int) -> list[tuple[int, int]]:
    """Linked pairs (i, j) of two lists of sets (y None: pairs i < j within x).
    Overlaps are counted per fragment of the n-gram order and summed per pair."""
    both = x + (y or [])
    sizes = np.array([len(s) for s in both])
    grams, col = np.unique(np.concatenate(both), return_inverse=True)
    row = np.repeat(np.arange(len(both)), sizes)
    o = np.argsort(col, kind="stable")
    row, col = row[o], col[o]
    nx = len(x)
    total = np.zeros((nx, len(both) - nx if y else nx), dtype=np.float32)
    for at in range(0, len(grams), FRAGMENT):
        lo, hi = np.searchsorted(col, [at, at + FRAGMENT])
        m = np.zeros((len(both), min(FRAGMENT, len(grams) - at)), dtype=np.float32)
        m[row[lo:hi], col[lo:hi] - at] = 1
        total += m[:nx] @ (m[nx:] if y else m).T
    sx, sy = sizes[:nx, None], (sizes[nx:] if y else sizes)[None, :]
    link = 100 * total.astype(np.int64) >= percent * (sx + sy - total.astype(np.int64))
    if not y:
        link = np.triu(link, 1)
    return list(zip(*(v.tolist() for v in np.nonzero(link)), strict=True))


def _tiles(percent: int):
    """Rows sorted by tile: (tile, side, node, shingles) -> a spanning forest of its links."""
    def forest(rows):
        x = [(n, np.frombuffer(s, np.uint64)) for side, n, s in rows if side == 0]
        y = [(n, np.frombuffer(s, np.uint64)) for side, n, s in rows if side == 1]
        nodes = [n for n, _ in x + y]
        up = list(range(len(nodes)))

        def root(i):
            while up[i] != i:
                up[i] = up[up[i]]
                i = up[i]
            return i

        for i, j in tile_links([s for _, s in x], [s for _, s in y] or None, percent) if len(nodes) > 1 and x else ():
            j += len(x) if y else 0
            if (a := root(i)) != (b := root(j)):
                up[b] = a
                yield nodes[i], nodes[j]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, out = None, [], []
        for b in batches:
            for tile, side, node, s in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if tile != now:
                    out += forest(rows)
                    now, rows = tile, []
                rows.append((side, node, s))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([e[i] for e in out], pa.int64()) for i in (0, 1)], names=["a", "b"])
                out = []
        out += forest(rows)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([e[i] for e in out], pa.int64()) for i in (0, 1)], names=["a", "b"])
    return run


def candidate_edges(docs: DataFrame, k: int, percent: int, shingles: int) -> DataFrame:
    """Edges (a, b) that connect all sets which may link. ``shingles``: how
    many there are in all, which sizes the key ranges.

    Two sets that link share ``need`` keys. Either they share a key with few
    others -- then they are a pair, and its shared keys, with the hot ones that
    both have, must reach ``need`` -- or all shared keys are hot, and each set
    has ``need`` hot keys; such sets are joined to the least one of each key."""
    n = max(parts(docs.sparkSession), -(-shingles * (100 - percent) // (30 * RANGE_KEYS)))
    found = written(docs.select("text").mapInArrow(lean(_key_rows(k, percent, n)), BLOBS)
                    .repartitionById(n, "p").sortWithinPartitions("p").mapInArrow(lean(_pairs), FOUND), "keys")
    hot = found.filter("hot").select(F.col("a").alias("key"), F.col("b").alias("node"), "w", "need").distinct()
    per = written(hot.groupBy("node", "w").agg(F.count("*").alias("h"), F.max("need").alias("need")), "hot-keys")
    strong = hot.join(per.filter("h >= need").select("node", "w"), ["node", "w"])
    stars = strong.join(strong.groupBy("key").agg(F.min("node").alias("b")), "key").select(F.col("node").alias("a"), "b").filter("a <> b")
    pairs = found.filter("not hot").groupBy("a", "b", "w").agg(F.sum("c").alias("c"), F.max("need").alias("need"))
    h = per.select("node", "w", "h")
    near = (pairs.join(h.select(F.col("node").alias("a"), "w", F.col("h").alias("ha")), ["a", "w"], "left")
            .join(h.select(F.col("node").alias("b"), "w", F.col("h").alias("hb")), ["b", "w"], "left")
            .filter(F.col("c") + F.least(F.coalesce("ha", F.lit(0)), F.coalesce("hb", F.lit(0))) >= F.col("need")).select("a", "b"))
    return near.unionByName(stars)


def ngram_jaccard_join(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, node, label, component_id) per row of ``docs`` (doc_id, text).

    ``node`` is the class of documents with the same set, ``label`` the least
    node reachable over links, ``component_id`` the least doc_id reachable
    (its own without a link).
    """
    text_batches(docs.sparkSession)
    src = docs.select("doc_id", "text")
    rows = written(src.mapInArrow(lean(_doc_rows(k)), "doc_id long, n_shingles long, node long"), "sets")
    nodes = rows.filter("node is not null").groupBy("node").agg(F.min("doc_id").alias("least"), F.max("n_shingles").alias("n"))
    shingles = rows.agg(F.coalesce(F.sum("n_shingles"), F.lit(0))).first()[0]
    links = verified_links(src, nodes, k, percent, shingles)
    labels = connected_components(links, "links")
    ids = nodes.join(labels, "node", "left").select("node", "least", F.coalesce("label", "node").alias("label"))
    comp = ids.join(ids.groupBy("label").agg(F.min("least").alias("component_id")), "label").select("node", "label", "component_id")
    return (rows.join(comp, "node", "left")
            .select("doc_id", "n_shingles", "node", "label", F.coalesce("component_id", "doc_id").alias("component_id")))


def verified_links(src: DataFrame, nodes: DataFrame, k: int, percent: int, shingles: int) -> DataFrame:
    """Links between nodes, (a, b), that connect what all links connect."""
    clusters = connected_components(candidate_edges(src, k, percent, shingles), "candidates")
    ratio = math.log(100 / percent)
    members = written(clusters.withColumnRenamed("label", "cluster").join(nodes, "node")
                      .select("node", "cluster", F.col("least").alias("doc_id"), "n",
                              F.floor(F.log(F.col("n").cast("double")) / ratio).cast("int").alias("band")), "members")
    needed, largest = members.groupBy("cluster").agg(F.count("*").alias("c")).agg(F.coalesce(F.sum("c"), F.lit(0)), F.max("c")).first()
    want = small_or_shuffled(members.select("doc_id", "node"), needed)
    sets = written(src.join(want, src.doc_id.eqNullSafe(want.doc_id)).select("node", "text")
                   .mapInArrow(lean(_member_sets(k)), "node long, shingles binary").dropDuplicates(["node"]), "member-sets")
    members = members.drop("doc_id").withColumn("main", F.lit(False))
    stars = None
    if largest and largest > CHUNK_SETS:
        large = members.groupBy("cluster").agg(F.count("*").alias("c")).filter(F.col("c") > CHUNK_SETS).select("cluster")
        stars, main = _star_links(written(members.join(large, "cluster", "left_semi"), "large"), sets, percent)
        members = (members.drop("main").join(main.select("node", F.lit(True).alias("main")), "node", "left")
                   .withColumn("main", F.coalesce("main", F.lit(False))))
    chunked, chunks = _chunks(members, percent)
    links = _compared(sets, chunked, _chunk_pairs(chunks, percent), percent)
    return links if stars is None else links.unionByName(stars)


def _chunks(members: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """``members`` (node, cluster, band, n, main) with their chunk within
    (cluster, length band, main), by rank, and the chunks: a band's sets are alike in size."""
    per = F.greatest(F.lit(1), F.least(F.lit(CHUNK_SETS), F.floor(CHUNK_SHINGLES / F.pow(F.lit(100 / percent), F.col("band") + 1)).cast("long")))
    own = ["cluster", "band", "main"]
    ranked = global_rank(members, [*map(F.col, own), F.col("node")], "members-ranked")
    base = ranked.groupBy(*own).agg(F.min("rank").alias("base"))
    chunked = (ranked.join(base, own).withColumn("chunk", F.floor((F.col("rank") - F.col("base")) / per).cast("long"))
               .select("node", "n", *own, "chunk"))
    return chunked, chunked.groupBy(*own, "chunk").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.count("*").alias("c"))


def _chunk_pairs(chunks: DataFrame, percent: int) -> DataFrame:
    """(cluster, p, q) of the chunks that must meet: pairs of one cluster that
    the lengths allow, but for those of two chunks of its main component, whose
    sets are connected already. Found by cluster and band: sets that link are
    one band apart at most."""
    a = chunks.filter(~F.col("main")).select("cluster", F.struct("main", "band", "chunk").alias("p"), "lo", "hi", "c", "band")
    b = chunks.select("cluster", F.struct("main", "band", "chunk").alias("q"), F.col("lo").alias("lo2"), F.col("hi").alias("hi2"),
                      F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
    same = F.col("p") == F.col("q")
    return (a.join(b, ["cluster", "band"])
            .filter((F.col("p") < F.col("q")) & (F.col("lo2") * percent <= F.col("hi") * 100) & (F.col("lo") * percent <= F.col("hi2") * 100)
                    | same & (F.col("c") > 1))
            .select("cluster", "p", "q"))


def _compared(sets: DataFrame, chunked: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """A spanning forest, per tile, of the links between the chunks of each pair."""
    tiles = pairs.withColumn("tile", F.xxhash64("cluster", "p", "q"))
    side = lambda c, n: F.struct(F.col(c).alias("c"), F.lit(n).alias("side"))
    sides = (tiles.select("cluster", "tile", F.explode(F.when(F.col("p") == F.col("q"), F.array(side("p", 0)))
                                                       .otherwise(F.array(side("p", 0), side("q", 1)))).alias("s"))
             .select("cluster", "s.c.main", "s.c.band", "s.c.chunk", "s.side", "tile"))
    placed = chunked.join(sides, ["cluster", "band", "main", "chunk"]).select("node", "tile", "side")
    return _linked(sets, placed, percent)


def _linked(sets: DataFrame, placed: DataFrame, percent: int) -> DataFrame:
    """(a, b): a spanning forest of the links of each tile; ``placed`` (node, tile, side)."""
    tiles = (sets.join(placed, "node").select("tile", "side", "node", "shingles")
             .repartition(parts(sets.sparkSession), "tile").sortWithinPartitions("tile", "side", "node"))
    return tiles.mapInArrow(lean(_tiles(percent)), "a long, b long")


def _star_links(members: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links (centre, node) of large clusters around a few centres, and of each
    cluster the nodes that these connect with its most linked centre.

    A round takes ``CENTRES`` sets of each length band that are not connected
    yet and compares them with every chunk of their cluster, so its tiles number
    as the chunks do. Rounds go on while they shrink what is left by half, down
    to a few chunks; what is left then meets everything in ``_chunk_pairs``."""
    chunked = written(_chunks(members, percent)[0], "large-chunks")
    tile = F.xxhash64("cluster", "band", "chunk")
    each = chunked.select("cluster", "band", "chunk").distinct()
    links, main, total = None, None, chunked.count()
    outside = total
    while True:
        left = chunked if main is None else chunked.join(main, "node", "left_anti")
        first = Window.partitionBy("cluster", "band").orderBy("node")
        centres = left.withColumn("i", F.row_number().over(first)).filter(F.col("i") <= CENTRES).select("cluster", "band", "node")
        near = centres.select("cluster", "node", F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
        placed = (near.join(each, ["cluster", "band"]).select("node", tile.alias("tile"), F.lit(0).alias("side"))
                  .unionByName(chunked.select("node", tile.alias("tile"), F.lit(1).alias("side"))))
        found = _linked(sets, placed, percent)
        links = written(found if links is None else links.unionByName(found), "star-links")
        main = written(_around_best(links, chunked.select("node", "cluster")), "main")
        now = total - main.count()
        if 2 * now > outside or now <= 4 * CHUNK_SETS:
            return links, main
        outside = now


def _around_best(links: DataFrame, owner: DataFrame) -> DataFrame:
    """(node) of what is connected with the most linked centre of each cluster
    over at most two more centres: ``links`` (a: centre, b), ``owner`` (node, cluster)."""
    best = (links.groupBy("a").agg(F.count("*").alias("c")).join(owner.withColumnRenamed("node", "a"), "a")
            .groupBy("cluster").agg(F.max(F.struct("c", "a")).alias("m")).select(F.col("m.a").alias("a")))
    inner = links.join(best, "a", "left_semi").select("b")
    centres = links.join(inner.distinct(), "b", "left_semi").select("a").distinct()
    all_of = links.join(centres, "a", "left_semi")
    return all_of.select(F.col("a").alias("node")).unionByName(all_of.select(F.col("b").alias("node"))).distinct()


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near copies: the one with the least doc_id
    (null last, then by set and text, where ids repeat). Rows without words stay."""
    rows = written(ngram_jaccard_join(docs, k, percent), "near-copies")
    odd = written(rows.groupBy("doc_id").agg(F.count("*").alias("c")).filter("c > 1 or doc_id is null").select("doc_id"), "odd-ids")
    gone = written(rows.filter("doc_id <> component_id").select("doc_id").join(odd, "doc_id", "left_anti"), "gone")
    m = odd.count()
    kept = docs.join(small_or_shuffled(gone, gone.count()), "doc_id", "left_anti").select(docs.columns)
    if not m:
        return kept
    # null and repeated ids are decided row by row, by id and set
    key, node = fresh(docs, "id"), fresh(docs, "set")
    ids = small_or_shuffled(odd.withColumnRenamed("doc_id", key), m)
    same = F.col("doc_id").eqNullSafe(F.col(key))
    plain = kept.join(ids, same, "left_anti")
    tagged = _tag_node(kept.join(ids, same, "left_semi"), k, node)
    win = fresh(tagged, "winner")
    best = (rows.filter("node is not null").groupBy("label")
            .agg(F.min(F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "node")).alias("w"))
            .select(F.col("w.doc_id").alias(key), F.col("w.node").alias(win)))
    stay = tagged.filter(F.col(node).isNotNull()).join(best, same & (F.col(node) == F.col(win)), "left_semi")
    one = stay.groupBy(node).agg(F.min_by(F.struct(*docs.columns), "text").alias("r")).select("r.*")
    return plain.unionByName(one).unionByName(tagged.filter(F.col(node).isNull()).select(docs.columns))


def _tag_node(docs: DataFrame, k: int, name: str) -> DataFrame:
    @F.arrow_udf("long")
    def node(text: pa.Array) -> pa.Array:
        b = pa.RecordBatch.from_arrays([text], names=["text"])
        return pa.array([_node(s) if len(s) else None for s in _sets(b, k)], pa.int64())

    return docs.withColumn(name, node("text"))
