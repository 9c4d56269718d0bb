"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_TEXT = _LOWER.format("coalesce(text, '')")
# The word and term patterns of the queries, on texts with A-Z lower-cased.
_TERM = r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_RUN = "'[a-zÀ-ÿ]+'"

OP5 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_TEXT}, {_SPACED}) AS w FROM documents),
g AS (SELECT doc_id, w, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM d),
classes AS (SELECT min(doc_id) AS c, s, len(s) AS n FROM (SELECT doc_id, list_sort(s) AS s FROM g) WHERE len(s) > 0 GROUP BY s),
e AS (SELECT c, n, unnest(s) AS x FROM classes),
near AS (SELECT a.c AS a, b.c AS b FROM e a JOIN e b ON a.x = b.x AND a.c < b.c
         GROUP BY a.c, a.n, b.c, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
links AS (SELECT a, b FROM near UNION SELECT b, a FROM near),
walk AS (SELECT c AS start, c AS node FROM classes UNION SELECT walk.start, links.b FROM walk JOIN links ON walk.node = links.a),
root AS (SELECT start AS c, min(node) AS component FROM walk GROUP BY start)
SELECT g.doc_id, len(g.s)::BIGINT AS n_shingles, coalesce(root.component, g.doc_id) AS component_id,
       coalesce(root.component, g.doc_id) = g.doc_id AS kept
FROM g LEFT JOIN classes ON classes.s = list_sort(g.s) LEFT JOIN root ON root.c = classes.c
"""

_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
OP6 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_TEXT}, {_WORD}) AS w FROM documents),
i AS (SELECT item_id::VARCHAR AS id, regexp_extract_all({_TEXT}, {_WORD}) AS w FROM benchmark),
win AS (SELECT DISTINCT id, n, array_to_string(w[s:s + n - 1], ' ') AS g FROM (
          SELECT id, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM win),
dw AS (SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS g FROM (
         SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT r, s, n, id FROM dw JOIN win USING (n, g)),
hit AS (SELECT r, count(DISTINCT p)::BIGINT AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM (SELECT DISTINCT r, s, n FROM m)) GROUP BY r),
its AS (SELECT r, count(DISTINCT id)::BIGINT AS n_items, sha256(array_to_string(list_sort(list(DISTINCT id)), ',')) AS x FROM m GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(x, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""

OP11 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256,
       NOT earlier AND bool_or(earlier) OVER same AS repeats_history
FROM (SELECT *, doc_id % 2 = 0 AS earlier FROM documents)
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP12 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_TEXT}, {_TERM}) AS terms FROM documents),
s AS (SELECT r, doc_id, terms, len(terms)::BIGINT AS n FROM d WHERE len(terms) > 0),
g AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM s),
tf AS (SELECT r, doc_id, n, t, count(*)::BIGINT AS tf FROM (SELECT r, doc_id, n, unnest(terms) AS t FROM s) GROUP BY ALL),
df AS (SELECT t, count(*)::BIGINT AS df FROM tf GROUP BY t),
q AS (SELECT item_id, t, count(*)::BIGINT AS times
      FROM (SELECT item_id, unnest(regexp_extract_all({_TEXT}, {_TERM})) AS t FROM benchmark) GROUP BY ALL),
w AS (SELECT q.item_id, q.t, q.times, floor(1000 * ln((2 * g.big_n + 2)::DOUBLE / (2 * df.df + 1)::DOUBLE))::BIGINT AS w
      FROM q JOIN df USING (t), g),
sc AS (SELECT w.item_id, tf.r, tf.doc_id,
         sum(w.times * w.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (25 + (75 * tf.n * g.big_n) // g.big_l))))::BIGINT AS score
       FROM w JOIN tf USING (t), g GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS "rank", doc_id, score
FROM sc WHERE score > 0 QUALIFY "rank" <= 10
"""

# crc32 byte by byte, from a table made by its rule; near words by the strings
# that are left when one position is dropped.
OP13 = f"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
       lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT doc_id, run, count(*)::BIGINT AS n FROM (SELECT doc_id, unnest(regexp_extract_all({_TEXT}, {_RUN})) AS run FROM documents)
         WHERE length(run) >= 6 GROUP BY ALL),
hexed AS (SELECT run, n, hex(encode(doc_id || ':' || run)) AS x FROM runs),
summed AS (SELECT run, n, xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(range(length(x) // 2),
       lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
       lambda c, b: xor(crc.t[(xor(c, b) & 255) + 1], c >> 8))) AS h FROM hexed, crc),
said AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM summed),
w AS (SELECT word, sum(n)::BIGINT AS n FROM said WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
        FROM (SELECT word, n, unnest(range(length(word))) AS i FROM w)),
pairs AS (SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
          UNION SELECT cut.word, w.word FROM cut JOIN w ON cut.rest = w.word
          UNION SELECT w.word, cut.word FROM cut JOIN w ON cut.rest = w.word),
ranked AS (SELECT a, b, w.n AS b_n, count(*) OVER (PARTITION BY a) AS n_near,
             row_number() OVER (PARTITION BY a ORDER BY w.n DESC, encode(b)) AS k FROM pairs JOIN w ON w.word = pairs.b),
forms AS (SELECT w.word, w.n, coalesce(r.n_near, 0)::BIGINT AS n_near, CASE WHEN r.b_n >= 5 * w.n THEN r.b END AS form,
            CASE WHEN r.b_n >= 5 * w.n THEN r.b_n END AS form_n FROM w LEFT JOIN ranked r ON r.a = w.word AND r.k = 1),
walk AS (SELECT word, word AS at FROM forms UNION ALL
         SELECT walk.word, forms.form FROM walk JOIN forms ON forms.word = walk.at WHERE forms.form IS NOT NULL)
SELECT forms.word, forms.form, walk.at AS root, forms.n, forms.n_near, forms.form_n
FROM forms JOIN walk USING (word) JOIN forms AS last ON last.word = walk.at AND last.form IS NULL
"""
