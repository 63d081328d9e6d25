"""DuckDB SQL of the queries that SQL can express."""

from __future__ import annotations

from gleanery.llm import decontaminate, importance, neardup, negatives

_SPLIT = "regexp_split_to_array({}, '[\\x20\\x09-\\x0D]+')"


def decontamination() -> str:
    """The masked runs as strings, joined; then the texts laid over each other along each diagonal, and the places in good windows counted together."""
    d = decontaminate
    words = lambda c: _SPLIT.format(f"trim(lower(coalesce({c}, '')), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")
    text = lambda places: " || ' ' || ".join(f"w[p + {i + 1}]" for i in places)
    run = lambda t, k, n, places, more="": f"SELECT {t}.*, {k} AS mask, {text(places)} AS run FROM {t} WHERE p + {n} <= len(w){more}"
    spaced = lambda t, more="": [run(t, k, max(mask) + 1, mask, more) for k, mask in enumerate(d.MASKS)]
    least, short = d.LEAST_WORDS, range(d.SHORTEST, d.LEAST_WORDS)
    item_runs = " UNION ALL ".join([*spaced("ip", f" AND len(w) >= {least}"), run("ip", 100 + least, least, range(least), f" AND len(w) >= {least}"), *[run("ip", 100 + n, n, range(n), f" AND len(w) = {n}") for n in short]])
    doc_runs = " UNION ALL ".join([*spaced("dp"), *[run("dp", 100 + n, n, range(n)) for n in [*short, least]]])
    return f"""WITH iw AS (SELECT DISTINCT item_id, {words('text')} AS w FROM benchmark WHERE item_id IS NOT NULL), dw AS (SELECT doc_id, {words('text')} AS w FROM documents WHERE doc_id IS NOT NULL),
ip AS (SELECT item_id, w, unnest(range(0, len(w) - {d.SHORTEST - 1})) AS p FROM iw WHERE len(w) >= {d.SHORTEST}), dp AS (SELECT doc_id, w, unnest(range(0, len(w) - {d.SHORTEST - 1})) AS p FROM dw WHERE len(w) >= {d.SHORTEST}),
ir AS ({item_runs}), dr AS ({doc_runs}),
m AS (SELECT DISTINCT dr.doc_id, ir.item_id, greatest(0, ir.p - dr.p) AS fi, greatest(0, dr.p - ir.p) AS fd FROM dr JOIN ir ON dr.mask = ir.mask AND dr.run = ir.run),
l AS (SELECT m.*, least(len(iw.w) - fi, len(dw.w) - fd) AS n_laid, iw.w AS i, dw.w AS d FROM m JOIN iw ON iw.item_id = m.item_id JOIN dw ON dw.doc_id = m.doc_id),
a AS (SELECT doc_id, item_id, fi, len(i) AS n_item, n_laid, least({d.STRETCH}, n_laid) AS wide, list_transform(range(1, n_laid + 1), lambda k: d[fd + k] = i[fi + k]) AS same FROM l),
g AS (SELECT *, list_filter(range(1, n_laid - wide + 2), lambda k: 100 * len(list_filter(same[k:k + wide - 1], lambda x: x)) >= {d.AGREE} * wide) AS good FROM a),
f AS (SELECT doc_id, item_id, n_item, fi + unnest(list_filter(range(1, n_laid + 1), lambda k: same[k] AND (100 * len(list_filter(same, lambda x: x)) >= {d.AGREE} * n_laid OR len(list_filter(good, lambda s: s <= k AND k < s + wide)) > 0))) AS place FROM g),
c AS (SELECT doc_id, item_id, n_item, count(DISTINCT place) AS n_found FROM f GROUP BY ALL)
SELECT doc_id, item_id, CAST(n_found AS BIGINT) AS n_found, CAST(n_item AS BIGINT) AS n_item FROM c WHERE CASE WHEN n_item < {least} THEN n_found = n_item ELSE n_found >= {least} AND (100 * n_found >= {d.COVER} * n_item OR n_found >= {d.ENOUGH}) END"""


def near_duplicates() -> str:
    """All pairs that share a shingle, their similarity, and what is reachable over links."""
    n = neardup.SHINGLE
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""WITH RECURSIVE w AS (SELECT doc_id, list_filter({_SPLIT.format(lower)}, lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= {n} THEN list_transform(range(1, len(w) - {n - 2}), lambda k: array_to_string(w[k:k + {n - 1}], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id), p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {neardup.PERCENT} * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.c)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id) LEFT JOIN n USING (doc_id)"""


def resampling() -> str:
    """Words by the pattern, the CRC of each distinct feature bit by bit, both histograms, gains, weights, scores and ranks."""
    i = importance
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    runs = lambda t, more: f"SELECT {more}w, list_concat(w, list_transform(range(1, len(w)), lambda k: w[k] || ' ' || w[k + 1])) AS f FROM (SELECT {more}regexp_extract_all({lower}, '{i.WORD}') AS w FROM {t})"
    step = "CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    return f"""WITH d AS MATERIALIZED ({runs('documents', "row_number() OVER () AS r, doc_id, ").replace("SELECT row_number() OVER () AS r, doc_id, w,", "SELECT r, doc_id, w,")}), b AS ({runs('benchmark', '')}),
tab AS (SELECT list(list_reduce(list_concat([CAST(i AS BIGINT)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, x: {step}) ORDER BY i) AS t FROM range(256) s(i)),
df AS (SELECT r, unnest(f) AS f FROM d), bf AS (SELECT unnest(f) AS f FROM b), h AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM (SELECT f FROM df UNION ALL SELECT f FROM bf))),
c AS (SELECT f, xor(list_reduce(list_concat([4294967295], list_transform(range(0, len(x) // 2), lambda k: CAST('0x' || substr(x, 2 * k + 1, 2) AS BIGINT))), lambda a, y: xor(a >> 8, t[(xor(a, y) & 255) + 1])), 4294967295) % {i.BUCKETS} AS bucket FROM h, tab),
s AS (SELECT bucket, count(*) AS s FROM df JOIN c USING (f) GROUP BY bucket), t AS (SELECT bucket, count(*) AS t FROM bf JOIN c USING (f) GROUP BY bucket),
n AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS big_s, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS big_t),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (big_s + {i.BUCKETS}) / ((s + 1.0::DOUBLE) * (big_t + {i.BUCKETS})))) AS gain FROM s LEFT JOIN t USING (bucket), n),
m AS (SELECT r, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM df JOIN c USING (f) JOIN g USING (bucket) GROUP BY r),
w AS (SELECT doc_id, len(w) AS n_words, CAST(len(f) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight, CAST('0x' || substr(sha256('{i.SEED}:' || doc_id), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN m USING (r)),
z AS (SELECT doc_id, n_words, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM w),
o AS (SELECT *, n_words >= {i.LEAST_WORDS} AND score IS NOT NULL AS able, row_number() OVER (PARTITION BY n_words >= {i.LEAST_WORDS} AND score IS NOT NULL ORDER BY score DESC, doc_id) AS place FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= (SELECT {i.PERCENT} * count(*) // 100 FROM o WHERE able) THEN place END AS rank FROM o"""


def hard_negatives() -> str:
    """All scores of anchors, the first positives, and the first rows of other labels below each."""
    m = negatives
    return f"""WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor({m.SCALE} * CAST(x AS DOUBLE))) AS e
FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS ar, a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.r <> b.r AND len(a.e) = len(b.e)),
p AS (SELECT ar, anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, id) <= {m.POSITIVES})
SELECT p.anchor_id, positive_id, row_number() OVER w AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.ar = p.ar AND NOT same AND {m.LEAST_PERCENT} * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
WINDOW w AS (PARTITION BY p.ar, positive_id ORDER BY score DESC, id) QUALIFY rank <= {m.NEGATIVES}"""
