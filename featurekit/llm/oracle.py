"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from featurekit.llm import chat, decontaminate, mixing, trie

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP2 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE [array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
sets AS (SELECT doc_id, sha256(string_agg(g, chr(10) ORDER BY g)) AS k FROM s GROUP BY 1),
reps AS (SELECT k, min(doc_id) AS r FROM sets GROUP BY 1),
rs AS (SELECT s.doc_id, s.g FROM s JOIN reps ON s.doc_id = reps.r),
pr AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM rs a JOIN rs b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pr JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
sym AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT r AS a, r AS b FROM reps UNION SELECT reach.a, sym.b FROM reach JOIN sym ON reach.b = sym.a),
lst AS (SELECT a, min(b) AS m FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(lst.m, d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN sets ON sets.doc_id = d.doc_id
LEFT JOIN reps ON reps.k = sets.k LEFT JOIN lst ON lst.a = reps.r
"""

OP5 = rf"""
WITH d AS (SELECT doc_id, source, len({_WORDS.format("coalesce(text, '')")})::BIGINT AS size,
             md5('{mixing.SEED}|' || coalesce(doc_id::VARCHAR, 'null')) AS h FROM documents),
src AS (SELECT source, sum(size)::BIGINT AS words, count(*) AS docs FROM d GROUP BY 1),
ranked AS (SELECT *, ([5.0, 2.0, 1.0]::DOUBLE[])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w,
             row_number() OVER (ORDER BY source NULLS LAST) AS o FROM src),
filled AS (SELECT *, ((sum(words) OVER ())::DOUBLE - coalesce(sum(3 * words) OVER b, 0)::DOUBLE)
             / ((sum(w) OVER ()) - coalesce(sum(w) OVER b, 0)) AS c FROM ranked
           WINDOW b AS (ORDER BY 3 * words / w, o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT c FROM filled WHERE c * w < 3 * words ORDER BY 3 * words / w, o LIMIT 1),
t AS (SELECT source, words, docs, o, coalesce(least((SELECT c FROM level) * w, 3.0 * words), 3.0 * words) AS target,
        ceil(docs / {mixing.SHARD_DOCS}.0)::BIGINT AS shards FROM ranked),
seats AS (SELECT round((SELECT sum(target ORDER BY o) FROM t) / {mixing.BLOCK_WORDS})::BIGINT AS n),
q AS (SELECT o, target, unnest(range(1, ceil(target / (SELECT sum(target) FROM t) * (SELECT n FROM seats))::BIGINT + 40)) AS k FROM t WHERE target > 0),
won AS (SELECT o, count(*) AS quota FROM (SELECT o, row_number() OVER (ORDER BY target / (2 * k - 1) DESC, o, k) AS r FROM q)
        WHERE r <= (SELECT n FROM seats) GROUP BY 1),
dealt AS (SELECT d.*, t.o, t.words, t.target, ('0x' || substr(d.h, 1, 8))::BIGINT % t.shards AS shard, coalesce(won.quota, 0) AS quota
          FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN won ON won.o = t.o),
sh AS (SELECT o, any_value(source) AS source, shard, sum(size)::BIGINT AS sw, any_value(quota) AS quota FROM dealt GROUP BY o, shard),
sq AS (SELECT o, shard, sw, quota, unnest(range(1, ceil(sw * quota / sum(sw) OVER (PARTITION BY o))::BIGINT + 40)) AS k FROM sh WHERE sw > 0),
sw AS (SELECT o, shard, count(*) AS won FROM (SELECT *, row_number() OVER (PARTITION BY o ORDER BY sw::DOUBLE / (2 * k - 1) DESC, shard, k) AS r FROM sq)
       WHERE r <= quota GROUP BY 1, 2),
b AS (SELECT sh.o, sh.shard, ceil(sw / {mixing.BLOCK_WORDS}.0)::BIGINT AS blocks,
        least(coalesce(sw2.won, 0), 3 * ceil(sw / {mixing.BLOCK_WORDS}.0)::BIGINT) AS won,
        ('0x' || substr(md5('{mixing.SEED} start|' || coalesce(sh.source, 'null') || '|' || sh.shard), 1, 8))::BIGINT AS place
      FROM sh LEFT JOIN sw sw2 ON sw2.o = sh.o AND sw2.shard = sh.shard),
run AS (SELECT *, CASE WHEN blocks > 0 THEN won // blocks ELSE 0 END AS epochs, CASE WHEN blocks > 0 THEN place % blocks ELSE 0 END * {mixing.BLOCK_WORDS} AS s,
          CASE WHEN blocks > 0 THEN won % blocks ELSE 0 END * {mixing.BLOCK_WORDS} AS l, blocks * {mixing.BLOCK_WORDS} AS tour FROM b),
line AS (SELECT dealt.*, sum(size) OVER (PARTITION BY o, shard ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS e FROM dealt)
SELECT doc_id, size, words AS source_size, target,
  (epochs * size + greatest(0, least(e, least(s + l, tour)) - greatest(e - size, s)) + greatest(0, least(e, s + l - tour) - greatest(e - size, 0)))::BIGINT AS taken
FROM line JOIN run USING (o, shard)
"""

OP7 = """
WITH q AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS b, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS m FROM q GROUP BY 1)
SELECT page_id, b AS payload_bytes, q.d AS payload_digest, CASE WHEN b >= 100 AND page_id <> m THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN b >= 100 AND page_id <> m THEN m END AS refers_to
FROM q JOIN f ON q.d = f.d
"""

OP8 = rf"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, i, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(i, r)),
p AS (SELECT *, row_number() OVER o AS pos FROM t WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
k AS (SELECT *, role = 'system' AND pos = 1 AS fixed, len(regexp_extract_all(text, '[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}\s]')) AS n FROM p),
y AS (SELECT conv_id, coalesce(max(CASE WHEN fixed THEN n END), 0) AS sys, bool_or(fixed) AS has FROM k GROUP BY 1),
u AS (SELECT k.*, sys, pos - CASE WHEN has THEN 1 ELSE 0 END AS i,
        coalesce(sum(CASE WHEN fixed THEN 0 ELSE n END) OVER (PARTITION BY k.conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
      FROM k JOIN y ON y.conv_id IS NOT DISTINCT FROM k.conv_id),
w AS (SELECT conv_id, i, b, n, sys, 0 AS win, n AS used FROM u WHERE i = 1
  UNION ALL SELECT u.conv_id, u.i, u.b, u.n, u.sys,
    CASE WHEN w.used + u.n <= {chat.BUDGET} - u.sys - CASE WHEN w.win = 0 THEN 0 ELSE {chat.HISTORY} END THEN w.win ELSE w.win + 1 END,
    CASE WHEN w.used + u.n <= {chat.BUDGET} - u.sys - CASE WHEN w.win = 0 THEN 0 ELSE {chat.HISTORY} END THEN w.used + u.n ELSE u.n END
  FROM w JOIN u ON u.conv_id IS NOT DISTINCT FROM w.conv_id AND u.i = w.i + 1),
e AS (SELECT conv_id, win, min(b) AS b, greatest(0, least({chat.HISTORY}, {chat.BUDGET} - min(sys) - sum(n))) AS room FROM w GROUP BY 1, 2),
c AS (SELECT conv_id, count(*) AS wins FROM e GROUP BY 1),
o AS (SELECT u.*, 1 + CASE WHEN fixed THEN coalesce(wins, 1) - 1 ELSE (SELECT count(*) FROM e WHERE e.conv_id IS NOT DISTINCT FROM u.conv_id
         AND e.win > w.win AND e.b - u.b <= e.room) END AS times
      FROM u LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM u.conv_id AND w.i = u.i AND NOT u.fixed
      LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM u.conv_id),
g AS (SELECT *, times * (12 + length(url_encode(role)) + 1 + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 11) AS chars FROM o)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256, sum(chars)::BIGINT AS formatted_chars
FROM g GROUP BY conv_id
"""

_BENCH = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP9 = rf"""
WITH i AS (SELECT item_id::VARCHAR AS item_id, {_BENCH.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, unnest(CASE WHEN len(ws) = 0 THEN [] ELSE
          [ws[j:j + {decontaminate.WINDOW - 1}] FOR j IN range(1, greatest(len(ws) - {decontaminate.WINDOW - 1}, 1) + 1)] END) AS g FROM i),
sizes AS (SELECT DISTINCT len(g) AS l FROM win),
d AS (SELECT doc_id, {_BENCH.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM documents),
pos AS (SELECT doc_id, l, ws, unnest(range(1, len(ws) - l + 2)) AS j FROM d, sizes WHERE len(ws) >= l),
hit AS (SELECT doc_id, j, l, item_id FROM pos JOIN win ON array_to_string(ws[j:j + l - 1], ' ') = array_to_string(g, ' ')),
cover AS (SELECT doc_id, count(DISTINCT x) AS n FROM (SELECT doc_id, unnest(range(j, j + l)) AS x FROM hit) GROUP BY 1),
ids AS (SELECT doc_id, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS s FROM (SELECT DISTINCT doc_id, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY 1)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(cover.n, 0)::BIGINT AS n_hit, coalesce(ids.n, 0)::BIGINT AS n_items,
  sha256(coalesce(ids.s, '')) AS items_sha256, coalesce(cover.n, 0) > 0 AND {decontaminate.SHARE} * coalesce(cover.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN ids USING (doc_id)
"""

_CRC = ("xor(4294967295, list_reduce(list_transform(string_split({}::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda c, b: "
        "list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(c, b)), 4294967295::BIGINT))")

OP13 = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
g AS (SELECT conv_id, turn, sha256(length(role)::VARCHAR || ':' || role || text) AS g, len({_WORDS.format("text")})::BIGINT AS w FROM t),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, g) AS pos FROM g),
c AS (SELECT conv_id, conv_id - conv_id % {trie.FAMILY} AS base, {_CRC.format("conv_id")} % {trie.HEADS} AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, pos, g, w FROM c JOIN p ON p.conv_id = c.base AND pos <= h UNION ALL SELECT c.conv_id, pos, g, w FROM c JOIN p ON p.conv_id = c.conv_id WHERE pos > h),
s AS (SELECT c.conv_id, coalesce(list(g ORDER BY pos) FILTER (g IS NOT NULL), []) AS seq, list(w ORDER BY pos) AS ws FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY 1),
pre AS (SELECT *, unnest(range(0, len(seq) + 1)) AS depth FROM s),
node AS (SELECT seq[1:depth] AS k, depth, min(conv_id) AS conv_id, count(*) AS n, any_value(CASE WHEN depth > 0 THEN ws[depth] ELSE 0 END) AS w,
           string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(seq) = depth) AS ids FROM pre GROUP BY 1, 2),
kids AS (SELECT k[1:depth - 1] AS k, count(*) AS c FROM node WHERE depth > 0 GROUP BY 1),
f AS (SELECT node.*, coalesce(kids.c, 0) AS c FROM node LEFT JOIN kids ON kids.k = node.k),
sub AS (SELECT k[1:e] AS k, count(*) FILTER (c = 0) AS leaves, sum((n - 1) * w)::BIGINT AS saved FROM (SELECT *, unnest(range(0, depth + 1)) AS e FROM f) GROUP BY 1)
SELECT f.conv_id, f.depth, up.conv_id AS parent_conv_id, f.n AS n_convs, f.c AS n_children, sub.leaves AS n_leaves, sub.saved AS saved_tokens,
  sha256(coalesce(f.ids, '')) AS ends_sha256
FROM f JOIN sub ON sub.k = f.k LEFT JOIN node up ON f.depth > 0 AND up.k = f.k[1:f.depth - 1]
"""

ORACLE = {"op2_jaccard_join": OP2, "op5_mix_sources": OP5, "op7_warc": OP7, "op8_chat_format": OP8, "op9_decontaminate": OP9, "op13_prefix_trie": OP13}
