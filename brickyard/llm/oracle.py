"""DuckDB SQL for the queries that SQL can express."""

ORACLE: dict[str, str] = {}

# Sizes, water level (sources sorted by cap over weight: the clamped ones are a
# prefix), then the seeded order's running words, cut at the rest.
ORACLE["op2_mixing"] = r"""
WITH rows AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('42|' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h,
         ('0x' || substr(md5('42|' || coalesce(text, '')), 1, 15))::BIGINT AS t, row_number() OVER () AS u
  FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS size FROM rows GROUP BY source),
weighted AS (
  SELECT source, size, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM totals),
sorted AS (
  SELECT *, (3 * size)::DOUBLE / weight AS ratio,
         coalesce(sum(3 * size) OVER (ORDER BY (3 * size)::DOUBLE / weight, source NULLS LAST
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS clamped,
         sum(weight) OVER (ORDER BY (3 * size)::DOUBLE / weight, source NULLS LAST
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS open
  FROM weighted),
level AS (
  SELECT coalesce(arg_min(lv, clamped), 0) AS lv FROM (
    SELECT ((SELECT sum(size) FROM weighted) - clamped)::DOUBLE / open AS lv, ratio, clamped FROM sorted) WHERE ratio >= lv),
plan AS (
  SELECT source, size AS source_size, least((3 * size)::DOUBLE, lv * weight) AS target,
         CASE WHEN size > 0 THEN least(3, floor(least((3 * size)::DOUBLE, lv * weight) / size)) ELSE 0 END::BIGINT AS whole
  FROM weighted, level),
ordered AS (
  SELECT r.doc_id, r.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
         sum(r.size) OVER (PARTITION BY r.source ORDER BY r.h, r.t, r.u)::BIGINT AS upto
  FROM rows r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (size * whole + CASE WHEN upto <= rest THEN size WHEN upto - size < rest THEN floor(rest - (upto - size)) ELSE 0 END)::BIGINT AS taken,
       target / source_size AS epochs
FROM ordered
"""

# Dense products of a stated query set with all rows.
ORACLE["op4_topk"] = r"""
WITH v AS (
  SELECT vec_id, row_number() OVER () AS rid, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT AS score,
         row_number() OVER (PARTITION BY a.rid ORDER BY list_inner_product(a.q::DOUBLE[], b.q::DOUBLE[])::BIGINT DESC, b.vec_id) AS rank
  FROM v a JOIN v b ON a.rid <> b.rid AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0 AND len(a.q) > 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM scored WHERE rank <= 5
"""


def _url_tree(n: int = 6) -> str:
    """The same tree in SQL: ``n`` levels of branches over the labelled urls, then every url's way down."""
    host, path = (f"regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', {i})" for i in (1, 2))
    fits = {r: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
            for r, h, p in (("org/", "org", "/"), ("example.org/es/", "example.org", "/es/"), ("example.org/en/1", "example.org", "/en/1"),
                            ("com/fr/", "com", "/fr/"), ("com/de/", "com", "/de/"))}
    rule = "CASE " + " ".join(f"WHEN {fits[r]} THEN '{r}'" for r in sorted(fits, key=len, reverse=True)) + " END"
    levels = ""
    for d in range(1, n + 1):
        def down(name, cols, d=d):
            return f"""
{name}{d} AS (
  SELECT {cols}, r.host, segs, CASE WHEN len(segs) < {d} THEN r.node ELSE coalesce(o.next, r.node || '/*') END AS node,
         CASE WHEN len(segs) < {d} THEN r.p WHEN o.next IS NOT NULL THEN o.p ELSE coalesce(w.p, r.p) END AS p
  FROM {name}{d - 1} r LEFT JOIN step{d} o ON r.host = o.host AND r.node = o.node AND segs[{d}] = o.seg
  LEFT JOIN step{d} w ON r.host = w.host AND r.node = w.node AND w.seg IS NULL),"""
        levels += f"""
kids{d} AS (SELECT host, node, segs[{d}] AS seg, sum(l)::BIGINT AS l, sum(b)::BIGINT AS b, any_value(p) AS p FROM lab{d - 1} WHERE len(segs) >= {d} GROUP BY ALL),
sums{d} AS (SELECT *, sum(l) OVER w - l AS rl, sum(b) OVER w - b AS rb, sum(b) OVER w / sum(l) OVER w::DOUBLE AS rate FROM kids{d} WINDOW w AS (PARTITION BY host, node)),
own{d} AS (SELECT *, CASE WHEN rl > 0 AND abs(b::DOUBLE / l - rb::DOUBLE / rl) > 1.96::DOUBLE * sqrt(rate * (1 - rate) * (1.0::DOUBLE / l + 1.0::DOUBLE / rl)) THEN seg END AS own FROM sums{d}),
step{d} AS (SELECT host, node, own AS seg, node || '/' || coalesce(own, '*') AS next, (sum(b) + 4.0::DOUBLE * any_value(p)) / (sum(l) + 4.0::DOUBLE) AS p
  FROM own{d} GROUP BY host, node, own),{down("lab", "l, b")}{down("url", "page_id, path, rule, ruled, known")}"""
    return f"""
WITH urls AS (SELECT page_id, translate({host}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, {path} AS path FROM pages),
cut AS (SELECT *, {rule} AS rule, [s FOR s IN string_split(path, '/') IF s <> ''] AS every FROM urls),
judged AS (
  SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS ruled,
         CASE WHEN len(every) > {n} THEN every[1:{n - 1}] || [array_to_string(every[{n}:], '/')] ELSE every END AS segs
  FROM cut),
labelled AS (SELECT host, segs, count(*) AS l, count(*) FILTER (ruled = 'block') AS b FROM judged WHERE ruled IS NOT NULL GROUP BY host, path, segs),
prior AS (SELECT coalesce(sum(b)::DOUBLE / nullif(sum(l), 0), 0) AS prior FROM labelled),
hosts AS (SELECT host, (sum(b) + 4.0::DOUBLE * any_value(prior)) / (sum(l) + 4.0::DOUBLE) AS p FROM labelled, prior GROUP BY host),
lab0 AS (SELECT l, b, host, segs, '' AS node, p FROM labelled JOIN hosts USING (host)),
url0 AS (SELECT page_id, path, rule, ruled, h.host IS NOT NULL AS known, j.host, segs, '' AS node, coalesce(h.p, prior) AS p
  FROM judged j LEFT JOIN hosts h ON j.host = h.host, prior),{levels.rstrip(",")}
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN known AND p >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
       CASE WHEN node = '' THEN '/' ELSE node END AS template, p AS purity
FROM url{n}
"""


ORACLE["op5_url_tree"] = _url_tree()


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _crc32(text: str) -> str:
    """Unsigned crc32 of a string's UTF-8 bytes, bit by bit: a byte is mixed in, then eight shifts (-1) follow."""
    steps = (f"flatten(list_transform(range(0, (length(hex({text})) // 2)::BIGINT), "
             f"lambda i: [('0x' || substr(hex({text}), (2 * i + 1)::BIGINT, 2))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))")
    return (f"xor(4294967295::BIGINT, list_reduce([4294967295::BIGINT] || {steps}, lambda c, x: "
            "CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END))")


# Bucket totals of both tables, gains, weights, seeded noise and the draw.
ORACLE["op12_importance"] = rf"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
raw AS (SELECT rid, unnest(ws) AS w FROM docs),
target AS (SELECT unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
words AS (SELECT DISTINCT w FROM (SELECT w FROM raw UNION ALL SELECT w FROM target)),
coded AS (SELECT w, {_crc32("w")} % 10000 AS bucket FROM words),
raw_of AS (SELECT bucket, count(*) AS s FROM raw JOIN coded USING (w) GROUP BY bucket),
target_of AS (SELECT bucket, count(*) AS t FROM target JOIN coded USING (w) GROUP BY bucket),
gain AS (
  SELECT bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM raw) + 10000)::DOUBLE)
         / ((s + 1)::DOUBLE * ((SELECT count(*) FROM target) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM raw_of LEFT JOIN target_of USING (bucket)),
weighed AS (SELECT rid, sum(gain)::BIGINT AS weight FROM raw JOIN coded USING (w) JOIN gain USING (bucket) GROUP BY rid),
scored AS (
  SELECT rid, doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
                                                    / 4294967296::DOUBLE))))::BIGINT AS score
  FROM docs LEFT JOIN weighed USING (rid)),
ranked AS (SELECT rid, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END::BIGINT AS rank FROM scored LEFT JOIN ranked USING (rid)
"""


def _merkle() -> str:
    """Levels by recursion (each row carries its tree's size, and stops at one node); a row's
    proof and fold follow its path: the siblings of each level, left and right."""
    def enc(x):
        return f"coalesce(strlen({x}::VARCHAR) || ':' || {x}::VARCHAR, '-')"

    def leaf(text):
        return "sha256(" + " || ".join(map(enc, ("doc_id", "source", "lang", "n_chars", text))) + ")"

    def levels(name, base):
        return f"""
{name} AS (
  SELECT tree, 0 AS level, place, digest, n FROM {base}
  UNION ALL
  SELECT tree, level + 1, place // 8, sha256(string_agg(digest, '' ORDER BY place)), (any_value(n) + 7) // 8 FROM {name} WHERE n > 1 GROUP BY tree, level, place // 8)"""

    def folds(name, base, nodes):
        """Fold (digest, proof so far) of every row of ``base`` (rid, tree, place, digest, proof) to the top of its tree in ``nodes``."""
        return f"""
{name}_sides AS (
  SELECT tree, level, place, n, coalesce(string_agg(digest, '' ORDER BY place) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
         coalesce(string_agg(digest, '' ORDER BY place) OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
  FROM {nodes} WHERE n > 1 WINDOW w AS (PARTITION BY tree, level, place // 8 ORDER BY place)),
{name} AS (
  SELECT rid, tree, 0 AS level, place, digest, proof FROM {base}
  UNION ALL
  SELECT f.rid, f.tree, f.level + 1, f.place // 8, sha256(s.lft || f.digest || s.rgt), f.proof || s.lft || s.rgt
  FROM {name} f JOIN {name}_sides s ON f.tree = s.tree AND f.level = s.level AND f.place = s.place)"""

    tampered = f"CASE WHEN {_crc32('doc_id::VARCHAR')} % 3 = 0 THEN {_LOWER.format('text')} ELSE text END"
    return f"""
WITH RECURSIVE hashed AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, {leaf('text')} AS leaf, {leaf(f'({tampered})')} AS changed FROM documents),
placed AS (
  SELECT rid, doc_id, leaf, changed, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS n
  FROM hashed),
base AS (SELECT tree, place, leaf AS digest, n FROM placed),{levels('inner_nodes', 'base')},
subroots AS (SELECT tree, digest AS subroot FROM inner_nodes WHERE n = 1),
above AS (SELECT 0 AS tree, tree AS place, subroot AS digest, (SELECT count(*) FROM subroots) AS n FROM subroots),{levels('upper_nodes', 'above')},
top AS (SELECT digest AS root FROM upper_nodes WHERE n = 1),
start AS (SELECT rid, tree, place, changed AS digest, '' AS proof FROM placed),{folds('inner_fold', 'start', 'inner_nodes')},
last_of AS (SELECT rid, max(level) AS level FROM inner_fold GROUP BY rid),
middle AS (SELECT rid, 0 AS tree, tree AS place, digest, proof FROM inner_fold JOIN last_of USING (rid, level)),{folds('upper_fold', 'middle', 'upper_nodes')},
last_up AS (SELECT rid, max(level) AS level FROM upper_fold GROUP BY rid)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, digest AS folded_root, digest = root AS verified
FROM upper_fold JOIN last_up USING (rid, level) JOIN placed p USING (rid) JOIN subroots s ON s.tree = p.tree, top
"""


ORACLE["op13_merkle"] = _merkle()
