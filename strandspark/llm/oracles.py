"""DuckDB SQL for the corpus queries that SQL can express, over whole tables."""

from . import urls

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = r"[^\x20\x09-\x0D]+"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _low(x: str) -> str:
    return f"translate({x}, '{_UPPER}', '{_LOWER}')"


_REMOVED = rf"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS m FROM win) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j FROM late),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS j FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS t FROM each ANTI JOIN gone USING (doc_id, j) GROUP BY 1),
n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)"""

_TOP = """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v::DOUBLE[], c.v::DOUBLE[]) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s) SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10"""

_LINKED = rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_low("coalesce(text, '')")}, '{_WORDS}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
e AS (SELECT a AS u, b AS v FROM l UNION SELECT b, a FROM l),
r AS (SELECT u, u AS c FROM e UNION SELECT e.u, r.c FROM e JOIN r ON e.v = r.u),
m AS (SELECT u AS doc_id, min(c) AS c FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)"""


def _judged() -> str:
    hit = lambda term: rf"regexp_matches(low, '(^|[^a-z0-9]){term}([^a-z0-9]|$)')"
    strict = " + ".join(f"CAST({hit(x)} AS INT)" for x in urls.STRICT)
    soft = " + ".join(f"CAST({hit(x)} AS INT)" for x, _ in urls.SOFT)
    weight = " + ".join(f"{n} * CAST({hit(x)} AS INT)" for x, n in urls.SOFT)
    fits = lambda h, p: f"((host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}'))"
    longest = sorted(urls.RULES, key=lambda r: -len(r[0] + r[1]))
    rule = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{h}{p}'" for h, p, _ in longest) + " END"
    verdict = "CASE " + " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for h, p, v in longest) + f" WHEN n_strict > 0 OR n_soft > 1 AND soft_weight >= {urls.SOFT_LIMIT} THEN 'block' ELSE 'allow' END"
    return rf"""WITH u AS (SELECT page_id, {_low("coalesce(url, '')")} AS low, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, low, {_low("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, {strict} AS n_strict, {soft} AS n_soft, {weight} AS soft_weight FROM u)
SELECT page_id, host, path, {rule} AS rule, {verdict} AS verdict, n_strict, n_soft, soft_weight FROM h"""


_HITS = rf"""WITH d AS (SELECT doc_id, regexp_extract_all({_low("coalesce(text, '')")}, '{_ALNUM}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_low("coalesce(text, '')")}, '{_ALNUM}') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT item, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)),
hit AS (SELECT doc_id, i, dw.n, item FROM dw JOIN bw ON dw.s = bw.s AND dw.n = bw.n),
covered AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS t FROM hit GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(t, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""

_MINED = """WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score FROM e a JOIN e c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same) WHERE r <= 5),
n AS (SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank, vec_id AS negative_id, positive_score, score AS negative_score FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5"""

ORACLES = {"op2_fm_substring_dedup": _REMOVED, "op3_ball_tree_topk": _TOP, "op7_jaccard_join": _LINKED, "op8_url_vocabulary": _judged(), "op10_winnowing": _HITS, "op12_radix_negatives": _MINED}
