import random

import pytest

VOCAB = [f"{a}{b}{c}" for a in ("ba", "ko", "ri", "tu", "ze") for b in ("nal", "dor", "mis") for c in ("", "en", "ta", "os")]


def words(seed, n):
    r = random.Random(seed)
    return [r.choice(VOCAB) + r.choice(VOCAB) for _ in range(n)]


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text, lang, source, n_chars, node): copies, near copies, nulls, blanks, repeats, a very long text."""
    r = random.Random(7)
    rows = []
    base = words(1, 120)
    for i in range(60):
        rows.append((i, " ".join(words(100 + i, r.randint(1, 150)))))
    for i in range(60, 80):  # near copies, some too far to link
        w = list(base)
        for _ in range(r.randint(0, 8)):
            w[r.randrange(len(w))] = "changed" + str(r.randrange(10**6))
        rows.append((i, " ".join(w)))
    rows += [(i, " ".join(base)) for i in range(80, 86)]
    rows += [(86, None), (87, ""), (88, " \t\n"), (89, "one"), (90, "one"), (91, "One  TWO"), (92, "one two"), (93, "É é"),
             (94, " ".join(words(5, 30000))), (95, "\U0001f600 😀 ᚠ x"), (3, rows[3][1]), (3, "another text of row three"),
             (None, " ".join(base)), (None, "null id text alone here")]
    return [(i, t, ("aa", "bb", None)[k % 3], ("s1", "s2", None)[k % 3], len(t or ""), k) for k, (i, t) in enumerate(rows)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long"


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
