import hashlib

import numpy as np

from brickyard.llm import imatch


def test_edited_texts_and_likeness(docs, corpus):
    rows = [tuple(r) for r in imatch.edited_fingerprints(docs).collect()]
    assert len(rows) == len(corpus)
    order = sorted(((r[0], r[1] or "") for r in corpus), key=lambda r: (r[0] is None, -(r[0] or 0), r[1].encode()))
    want = []
    for i, (d, t) in enumerate(order):
        nxt, m = order[(i + 1) % len(order)][1], len(t) // 3
        e = t[:len(t) - m] + nxt[:m]
        want.append((d, len(t), hashlib.sha256(e.encode()).hexdigest()))
    assert sorted((r[:3] for r in rows), key=str) == sorted(want, key=str)
    by_id = {r[0]: r for r in rows if r[0] not in (None, 3)}
    # equal texts, equal prints; likeness is the share of equal hashes
    for ids in ((80, 81, 85), (89, 90), (86, 87)):
        assert len({by_id[i][3] for i in ids}) == 1

    def like(a, b):
        return float(np.mean([a[i:i + 8] == b[i:i + 8] for i in range(0, len(a), 8)]))

    for i in range(5, 84):
        assert by_id[i][5] == like(by_id[i][3], by_id[i][4])
        assert by_id[i][6] == like(by_id[i][3], by_id[i - 1][3])
    assert by_id[86][3] == "0" * (8 * imatch.SUBSETS)
    # a changed third leaves more in common than another document does
    far = [by_id[i] for i in range(5, 60) if by_id[i][1] > 300]
    assert np.mean([r[5] for r in far]) > 2 * np.mean([r[6] for r in far])


def test_counts_are_exact_over_chunks(docs, corpus, monkeypatch):
    monkeypatch.setattr(imatch, "FLUSH_TERMS", 40)
    lex = imatch.lexicon(docs, low=0.05, high=0.5)
    df = {}
    for r in corpus:
        for t in imatch.terms(r[1]):
            df[t] = df.get(t, 0) + 1
    n = len(corpus)
    assert set(lex["band"]) == {t for t, c in df.items() if max(2, 0.05 * n) <= c <= 0.5 * n}
    assert set(lex["above"]) == {t for t, c in df.items() if c > 0.5 * n}


def test_many_candidates_are_counted_by_a_shuffle(docs, monkeypatch):
    few = imatch.lexicon(docs, low=0.05, high=0.5)
    monkeypatch.setattr(imatch, "CANDIDATES", 3)
    assert imatch.lexicon(docs, low=0.05, high=0.5) == few


def test_nested_subsets_ignore_order_and_repeats():
    lex = {"band": {}, "above": {}}
    a, b, c = imatch.fingerprints(["x y z", "z  y x x", ""], lex)
    assert (a == b).all() and not c.any()
    assert imatch.as_text(np.array([[1, 2**32 - 1]], np.uint32)) == ["00000001ffffffff"]


def test_empty_single_and_plain(spark, no_docs):
    assert imatch.edited_fingerprints(no_docs).count() == 0
    one = spark.createDataFrame([(7, "abcdef ghi")], "doc_id long, text string")
    r = imatch.edited_fingerprints(one).first()
    assert r.edited_sha256 == hashlib.sha256(b"abcdef abc").hexdigest() and r.near_next == 1.0
    assert imatch.fingerprint(one).first().fingerprint == r.fingerprint


M = 2**64 - 1


def mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & M
    x = (x ^ x >> 27) * 0x94D049BB133111EB & M
    return x ^ x >> 31


def slow_print(text, lex, subsets):
    """One text by plain integers: per seed, the smallest nested subset that it meets, its terms in sorted order."""
    found = imatch.terms(text)
    own = sorted([lex["band"][x] for x in found if x in lex["band"]] or [lex["above"][x] for x in found if x in lex["above"]] or [imatch._hash(x) for x in found])
    out = []
    for k in range(subsets):
        place = sorted(mix(h + 0x9E3779B97F4A7C15 * (k + 1) & M) >> 11 for h in own)
        total = 0
        for x in place:
            if x < 1 << place[0].bit_length():
                total = (total + x * 0xD6E8FEB86659FD93) & M
        out.append(mix(total) >> 32 | 1 if own else 0)
    return out


def test_fingerprints_against_plain_integers(docs, corpus):
    lex = imatch.lexicon(docs, low=0.02, high=0.5)
    texts = [r[1] for r in corpus] + ["", "nowhere else", "z"]
    got = imatch.fingerprints(texts, lex, 7)
    assert got.tolist() == [slow_print(t, lex, 7) for t in texts]


def test_why_the_subsets_are_nested(spark, sf_small):
    """Lexicon subsets of one fixed size keep hardly a hash of a text whose last third is replaced, or are mostly
    empty; nested ones keep about as many as terms are kept."""
    docs = [r.text for r in spark.read.parquet(f"{sf_small}/documents.parquet").orderBy("doc_id").collect() if r.text and len(r.text) > 300]
    pairs = [(t, t[:len(t) - len(t) // 3] + n[:len(t) // 3]) for t, n in zip(docs, docs[1:], strict=False) if not n.startswith(t[:50])]
    lex = {"band": {x: imatch._hash(x) for t in docs for x in imatch.terms(t)}, "above": {}}
    a, b = (imatch.fingerprints([p[i] for p in pairs], lex) for i in (0, 1))
    nested = float(np.mean(imatch.likeness(a, b)))

    def fixed(share):
        same, empty, n = 0, 0, 0
        for x, y in pairs:
            sets = [[(mix(imatch._hash(t) + 0x9E3779B97F4A7C15 * (k + 1) & M) >> 11, t) for t in imatch.terms(z)] for z in (x, y) for k in range(8)]
            kept = [tuple(sorted(t for place, t in s if place < share * 2**53)) for s in sets]
            for u, v in zip(kept[:8], kept[8:], strict=True):
                n, empty, same = n + 1, empty + (not u), same + (bool(u) and u == v)
        return same / n, empty / n

    for share in (0.5, 0.25, 1 / 16, 1 / 64, 1 / 256):
        same, empty = fixed(share)
        assert same < nested / 2 or empty > 0.25, (share, same, empty, nested)
    assert nested > 0.4
