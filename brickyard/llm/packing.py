"""Sequence packing: shortest-pack-first over the length histogram.

1. Every document is tokenised once and cut into pieces: whole sequences,
   then, of what remains, powers of two down to ``least_cut`` and a tail.
   Only (doc_id, start, length, checksum) leaves the task.
2. The histogram of piece lengths has ``size`` rows at most. Lengths are
   placed longest first, each time into the pack with the most room, by
   counts: a step moves a whole count of equal packs to a new pattern, so the
   patterns number a small multiple of ``size`` whatever the data.
3. Patterns meet documents by rank: pieces are ranked by length (a range
   shuffle, so a hot length spreads over tasks), and a slot of a pattern owns
   a run of ranks.

Nulls: null text is empty; an empty document is its end token alone. Null or
repeated ids, and repeated rows, are packed as separate rows. Very long texts
are tokenised whole and cut into pieces. An empty table gives no rows. Other
columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import global_rank, lean, text_batches, worker_cache, written

SIZE, END_ID, LEAST_CUT = 2048, 1, 1024
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
# Fixed value: the word pattern of byte-level BPE vocabularies of this family.
BYTE_LEVEL_PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _byte_of() -> dict[str, int]:
    """Byte-level vocabularies write byte b as chr(b) where that is printable
    Latin-1, and as chr(256 + i) for the i-th of the others."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def encoder(path: str):
    """text -> uint32 ids, as ``tokenizers`` gives with add_special_tokens=False.

    A plain byte-level BPE file whose ids are its merge ranks is run by
    ``tiktoken`` (the same merges, four times as fast); any other file, and
    any text that holds one of the file's added tokens, by ``tokenizers``.
    """
    cache = worker_cache()
    if path in cache:
        return cache[path]
    from tokenizers import Tokenizer
    slow = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    added = [t["content"] for t in spec.get("added_tokens") or ()]

    def by_tokenizers(text: str) -> np.ndarray:
        return np.array(slow.encode(text, add_special_tokens=False).ids, dtype="<u4")

    out = by_tokenizers
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if (model.get("type", "BPE") == "BPE" and "merges" in model and spec.get("normalizer") is None and pre.get("type") == "ByteLevel"
            and not pre.get("add_prefix_space") and pre.get("use_regex", True) and not model.get("end_of_word_suffix")
            and not model.get("ignore_merges")):
        byte = _byte_of()
        ranks = {bytes(byte[c] for c in w): i for w, i in model["vocab"].items() if w not in added}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if sorted(ranks.values()) == list(range(len(ranks))) and all(
                model["vocab"].get(a + b) == 256 + i for i, (a, b) in enumerate(merges)):
            import tiktoken
            fast = tiktoken.Encoding("bytes", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})

            def out(text: str) -> np.ndarray:
                if any(a in text for a in added):
                    return by_tokenizers(text)
                return np.array(fast.encode_ordinary(text), dtype="<u4")
    cache[path] = out
    return out


def cuts(n: int, size: int = SIZE, least: int = LEAST_CUT) -> list[int]:
    """Piece lengths of a document of n tokens."""
    out, left, p = [size] * (n // size), n % size, size // 2
    while p >= least and left:
        if left >= p:
            out.append(p)
            left -= p
        p //= 2
    return out + [left] * (left > 0)


def _pieces(path: str, size: int, least: int, end_id: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for b in batches:
            rows, chunks = [], []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                text = text.as_py()
                ids = np.append(encode(text) if text else np.empty(0, "<u4"), np.array([end_id], "<u4")).astype("<u4")
                start = 0
                for n in cuts(len(ids), size, least):
                    part = ids[start:start + n]
                    rows.append((doc_id, start, n, zlib.crc32(part.tobytes()), len(ids)))
                    if with_ids:
                        chunks.append(part)
                    start += n
            cols = [pa.array([r[i] for r in rows], pa.int64()) for i in range(5)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                cols, names = [*cols, pa.array([c.tolist() for c in chunks], pa.list_(pa.int64()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names=names)
    return run


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths in order, count of packs)."""
    room: list[tuple[int, int]] = []  # (-room left, pattern id): the pack with most room first
    patterns: list[list] = []         # [lengths as a linked list, count, room left]

    def add(items, count, left):
        patterns.append([items, count, left])
        if left:
            heapq.heappush(room, (-left, len(patterns) - 1))

    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        while n:
            if room and -room[0][0] >= length:
                _, i = heapq.heappop(room)
                items, count, left = patterns[i]
                m = min(n, count)
                patterns[i][1] -= m
                if patterns[i][1]:
                    heapq.heappush(room, (-left, i))
                add((length, items), m, left - length)
                n -= m
            else:  # no pack has room: open new ones, filled with this length
                k = min(size // length, n)
                items = None
                for _ in range(k):
                    items = (length, items)
                add(items, n // k, size - k * length)
                n -= n // k * k
    out = []
    for items, count, _ in patterns:
        if count:
            lengths = []
            while items:
                lengths.append(items[0])
                items = items[1]
            out.append((tuple(reversed(lengths)), count))
    return out


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> list[np.ndarray]:
    """(first rank, first sequence id, offset) of every slot, by descending length."""
    found, seq = [], 0
    for i, (lengths, count) in enumerate(patterns):
        at = 0
        for length in lengths:
            found.append((-length, i, at, seq, count))
            at += length
        seq += count
    found.sort()
    counts = np.array([f[4] for f in found], dtype=np.int64)
    return [np.concatenate(([0], np.cumsum(counts)))[:-1], np.array([f[3] for f in found], dtype=np.int64),
            np.array([f[2] for f in found], dtype=np.int64)]


def pack(docs: DataFrame, path: str | None = None, size: int = SIZE, end_id: int = END_ID, least_cut: int = LEAST_CUT,
         with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) per
    piece of ``docs`` (doc_id, text); with_ids adds the tokens themselves."""
    text_batches(docs.sparkSession)
    schema = PIECES + (", ids array<long>" if with_ids else "")
    pieces = docs.select("doc_id", "text").mapInArrow(
        lean(_pieces(path or tokenizer_path(), size, least_cut, end_id, with_ids)), schema)
    # written first: the range shuffle of the ranking reads its input twice
    ranked = global_rank(written(pieces, "pieces"), [F.col("length").desc(), F.col("doc_id").asc_nulls_last(), F.col("start"), F.col("ids_crc32")], "ranked")
    histogram = {r[0]: r[1] for r in ranked.groupBy("length").count().collect()}  # ``size`` rows at most
    first, seq, offset = slots(shortest_pack_first(histogram, size))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rank = b.column(b.schema.get_field_index("rank")).to_numpy()
            i = np.searchsorted(first, rank, side="right") - 1
            cols = {n: b.column(j) for j, n in enumerate(b.schema.names) if n != "rank"}
            cols |= {"sequence_id": pa.array(seq[i] + rank - first[i]), "offset": pa.array(offset[i])}
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    return ranked.mapInArrow(place, schema + ", sequence_id long, offset long")


def padding(patterns: list[tuple[tuple[int, ...], int]], size: int = SIZE) -> int:
    """Tokens of padding: sequences fill up to ``size`` unless they are a power of two long."""
    return sum((size - n) * c for p, c in patterns if (n := sum(p)) & (n - 1))


