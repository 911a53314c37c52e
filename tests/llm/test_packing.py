import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from brickyard.llm import packing as P


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(P.tokenizer_path())


def check(rows, corpus, tokenizer, size):
    want = Counter()
    for d, t in corpus:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        start = 0
        for n in P.cuts(len(ids), size, max(1, size // 2)):
            want[d, start, n, zlib.crc32(np.array(ids[start:start + n], "<u4").tobytes()), len(ids)] += 1
            start += n
        assert start == len(ids)
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    assert sorted(seqs) == list(range(len(seqs)))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= size


def test_round_trip(docs, corpus, tokenizer):
    rows = P.pack(docs).collect()
    check(rows, [(r[0], r[1]) for r in corpus], tokenizer, 2048)
    again = P.pack(docs.repartition(2)).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))


def test_ids_and_small_size(docs, corpus, tokenizer):
    rows = P.pack(docs, size=64, least_cut=32, with_ids=True).collect()
    check(rows, [(r[0], r[1]) for r in corpus], tokenizer, 64)
    for r in rows:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_agrees_with_tokenizers(name):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(P.tokenizer_path(name))
    encode = P.encoder(P.tokenizer_path(name))
    r = random.Random(3)
    texts = ["", " ", "\n\n  a", "it's we'll I'M", "a<|endoftext|>b", "é́ ｆｕｌｌ １２３４", "x" * 3000, "日本語テキスト", "  z\t\r\n", "🙂🙂 \x00\x07"]
    texts += ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(0x80, 0x3000), 32, 10, r.randrange(0x10000, 0x1F000)])) for _ in range(200)) for _ in range(50)]
    for x in texts:
        assert encode(x).tolist() == t.encode(x, add_special_tokens=False).ids


def test_patterns_use_every_length():
    r = random.Random(1)
    for size in (8, 64, 2048):
        hist = {n: r.randint(1, 500) for n in r.sample(range(1, size + 1), min(size, 40))}
        patterns = P.shortest_pack_first(hist, size)
        used = Counter()
        for lengths, count in patterns:
            assert sum(lengths) <= size and count > 0
            for n in lengths:
                used[n] += count
        assert used == hist and len(patterns) <= 4 * len(hist)
    assert P.shortest_pack_first({}, 8) == [] and P.padding([((4, 4), 2), ((3,), 1), ((2, 2), 5)], 8) == 5


def test_cuts():
    assert P.cuts(5000, 2048, 1024) == [2048, 2048, 904] and P.cuts(1500, 2048, 1024) == [1024, 476]
    assert all(sum(P.cuts(n, 64, 8)) == n and min(P.cuts(n, 64, 8)) > 0 for n in range(1, 300))


def test_empty_table(no_docs):
    assert P.pack(no_docs).count() == 0
