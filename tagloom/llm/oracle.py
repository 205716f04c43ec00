"""DuckDB SQL of the numbered queries that SQL can express."""

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(col: str) -> str:
    return f"coalesce(regexp_extract_all(translate({col}, '{_UPPER}', '{_LOWER}'), '{_WORDS}'), [])"


OP3 = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words('text')} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item, least(10, len(w)) AS n, array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS g
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
),
docs AS (SELECT row_number() OVER () AS r, doc_id, {_words('text')} AS w FROM documents),
lengths AS (SELECT DISTINCT n FROM windows),
found AS (
  SELECT r, i, x.n, item
  FROM (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
        FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n)) AS x
  JOIN windows USING (n, g)
),
hits AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
named AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM found WHERE item IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(hits.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (r) LEFT JOIN named USING (r)
"""

# base32: five hex digits are 20 bits, which are four letters
OP8 = """
WITH p AS (
  SELECT page_id, url, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS sha,
         row_number() OVER (PARTITION BY coalesce(html, '') ORDER BY page_id DESC NULLS LAST, url DESC NULLS LAST) AS k,
         max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top
  FROM pages
),
d AS (
  SELECT *, list_transform(range(0, 8), lambda g: list_reduce(
      list_transform(range(1, 6), lambda i: strpos('0123456789abcdef', substr(sha, CAST(5 * g + i AS BIGINT), 1)) - 1),
      lambda a, b: a * 16 + b)) AS groups
  FROM p
)
SELECT page_id, octet_length(payload) AS payload_bytes,
       array_to_string(list_transform(groups, lambda n: array_to_string(list_transform([n // 32768, n // 1024 % 32, n // 32 % 32, n % 32],
           lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(x + 1 AS BIGINT), 1)), '')), '') AS payload_digest,
       CASE WHEN k = 1 THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN k > 1 THEN top END AS refers_to
FROM d
"""

# exact Jaccard similarity of five-word sets; pairs are counted between classes of equal sets
OP7 = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[ \\t\\n\\v\\f\\r]+'), lambda x: x <> '') AS w
  FROM documents
),
sets AS (
  SELECT r, doc_id, list_sort(list_distinct(CASE
      WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s
  FROM docs
),
keyed AS (SELECT r, doc_id, s, md5(array_to_string(s, chr(1))) AS k FROM sets),
classes AS (SELECT k, count(*) AS size, min(doc_id) AS copy_id, any_value(s) AS s FROM keyed GROUP BY k),
grams AS (SELECT k, unnest(s) AS g FROM classes),
shared AS (SELECT a.k AS a, b.k AS b, count(*) AS n FROM grams a JOIN grams b ON a.g = b.g AND a.k <> b.k GROUP BY a.k, b.k),
pairs AS (
  SELECT a, b, y.size FROM shared JOIN classes x ON x.k = a JOIN classes y ON y.k = b
  WHERE n >= 0.8 * (len(x.s) + len(y.s) - n) - 1e-6
),
links AS (SELECT a AS k, count(*) AS texts, sum(size) AS docs FROM pairs GROUP BY a),
reach AS (
  SELECT k AS a, k AS b FROM classes
  UNION
  SELECT reach.a, pairs.b FROM reach JOIN pairs ON pairs.a = reach.b
),
named AS (SELECT reach.a AS k, min(copy_id) AS class_id FROM reach JOIN classes ON classes.k = reach.b GROUP BY reach.a)
SELECT doc_id, class_id, copy_id, CAST(coalesce(docs, 0) + size - 1 AS BIGINT) AS n_links,
       CAST(size - 1 AS BIGINT) AS n_copies, CAST(coalesce(texts, 0) AS BIGINT) AS n_linked_texts
FROM keyed JOIN classes USING (k) JOIN named USING (k) LEFT JOIN links USING (k)
"""

def _crc32(text: str) -> str:
    """The checksum of an ASCII text, bit by bit."""
    byte = f"list_transform(range(1, length({text}) + 1), lambda i: ascii(substr({text}, CAST(i AS BIGINT), 1)))"
    bit = "lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)"
    return (
        f"xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {byte}),"
        f" lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), {bit})))"
    )


# The least (cost, letters) per turn and state, by dynamic programming over the turns.
OP11 = f"""
WITH RECURSIVE given AS (
  SELECT conv_id, dense_rank() OVER (ORDER BY conv_id NULLS FIRST) AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations
),
chosen AS (SELECT *, {_crc32('k')} % 20 AS f FROM given),
damaged AS (
  SELECT c, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN f = 1 THEN '' WHEN f = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN f = 0 THEN [] WHEN f = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM chosen
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, substr(text, 1, 64), text, copy) AS i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS solid
  FROM damaged
),
turns AS (
  SELECT *, substr(role, 1, 1) AS a, lead(substr(role, 1, 1)) OVER (PARTITION BY c ORDER BY i) AS b,
         CASE WHEN solid = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN right(solid, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'sound' END AS fault
  FROM placed
),
inserts(q, r, fee, said, added) AS (
  VALUES ('0', '0', 0, '', ''), ('s', 's', 0, '', ''), ('u', 'u', 0, '', ''), ('a', 'a', 0, '', ''),
         ('0', 'u', 3, 'I', chr(10) || 'user:'), ('s', 'u', 3, 'I', chr(10) || 'user:'), ('a', 'u', 3, 'I', chr(10) || 'user:'),
         ('u', 'a', 3, 'I', chr(10) || 'assistant:'),
         ('0', 'a', 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'), ('s', 'a', 6, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')
),
edits(r, letter, initial, t, due) AS (
  VALUES ('0', 'D', NULL, '0', NULL), ('s', 'D', NULL, 's', NULL), ('u', 'D', NULL, 'u', NULL), ('a', 'D', NULL, 'a', NULL),
         ('0', 'K', 's', 's', NULL), ('0', 'K', 'u', 'u', NULL), ('s', 'K', 'u', 'u', NULL), ('u', 'K', 'a', 'a', NULL), ('a', 'K', 'u', 'u', NULL),
         ('0', 'R', NULL, 'u', 'user'), ('s', 'R', NULL, 'u', 'user'), ('u', 'R', NULL, 'a', 'assistant'), ('a', 'R', NULL, 'u', 'user')
),
states AS (
  SELECT DISTINCT c, CAST(0 AS BIGINT) AS i, '0' AS q, {{'cost': CAST(0 AS BIGINT), 'audit': '', 'text': ''}} AS best FROM turns
  UNION ALL
  SELECT x.c, x.i + 1, e.t, min({{
      'cost': CAST(x.best.cost + n.fee + CASE e.letter WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
                   + CASE WHEN e.letter <> 'D' AND w.fault = 'truncated' THEN 3 ELSE 0 END AS BIGINT),
      'audit': x.best.audit || n.said || e.letter,
      'text': x.best.text || n.added || CASE e.letter WHEN 'D' THEN '' ELSE chr(10) || coalesce(e.due, w.role) || ':' || w.text END}})
  FROM states x JOIN turns w ON w.c = x.c AND w.i = x.i + 1 JOIN inserts n ON n.q = x.q JOIN edits e ON e.r = n.r
  WHERE (e.initial IS NULL OR e.initial = w.a) AND (e.letter = 'D' OR w.fault IN ('sound', 'truncated'))
  GROUP BY x.c, x.i + 1, e.t
),
ends AS (
  SELECT x.c, min({{'cost': CAST(x.best.cost + n.fee AS BIGINT), 'audit': x.best.audit || n.said, 'text': x.best.text || n.added}}) AS best
  FROM states x JOIN (SELECT c, max(i) AS i FROM turns GROUP BY c) m ON m.c = x.c AND m.i = x.i JOIN inserts n ON n.q = x.q
  WHERE n.r IN ('0', 'a') GROUP BY x.c
),
counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(fault = 'blank') AS blank,
         count_if(fault = 'duplicate') AS duplicate, count_if(fault = 'truncated') AS truncated,
         count_if(b IS NOT NULL AND a || b NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY c
),
ids AS (SELECT DISTINCT c, conv_id FROM given)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.cost, 0) AS BIGINT) AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(substr(best.text, 2), '')) AS repaired_sha256
FROM ids LEFT JOIN counts USING (c) LEFT JOIN ends USING (c)
"""

# Nodes as whole lists of turns; every node counts for itself and all its prefixes.
OP13 = f"""
WITH given AS (
  SELECT conv_id, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL
),
ids AS (SELECT conv_id AS c, conv_id - conv_id % 5 AS base, {_crc32('CAST(conv_id AS VARCHAR)')} % 9 AS h FROM (SELECT DISTINCT conv_id FROM given)),
rebuilt AS (
  SELECT c, 1 AS part, k, t FROM ids JOIN given ON given.conv_id = ids.base WHERE k <= h
  UNION ALL
  SELECT c, 2, k, t FROM ids JOIN given ON given.conv_id = ids.c WHERE k > h
),
listed AS (SELECT c, list(t ORDER BY part, k) AS s FROM rebuilt GROUP BY c),
seqs AS (SELECT c, coalesce(s, []) AS s FROM ids LEFT JOIN listed USING (c)),
members AS (SELECT c, len(s) AS size, s[1:d] AS p, d FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM seqs)),
nodes AS (
  SELECT p, d, min(c) AS conv_id, count(*) AS n, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (size = d), '') AS ends,
         CASE WHEN d > 0 THEN (count(*) - 1) * octet_length(encode(p[d].text)) ELSE 0 END AS saved
  FROM members GROUP BY p, d
),
children AS (SELECT p[1:d - 1] AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1),
sums AS (
  SELECT p[1:x] AS p, count_if(leaf) AS leaves, sum(saved) AS saved
  FROM (SELECT nodes.p, saved, children.n IS NULL AS leaf, unnest(range(0, d + 1)) AS x FROM nodes LEFT JOIN children USING (p))
  GROUP BY 1
)
SELECT o.conv_id, o.d AS depth, r.conv_id AS parent_conv_id, o.n AS n_convs, CAST(coalesce(children.n, 0) AS BIGINT) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(sums.saved AS BIGINT) AS saved_tokens, sha256(o.ends) AS ends_sha256
FROM nodes o JOIN sums ON sums.p = o.p LEFT JOIN children ON children.p = o.p
LEFT JOIN nodes r ON o.d > 0 AND r.p = o.p[1:o.d - 1]
"""

ORACLE = {
    "op11_structure_repair": OP11,
    "op13_prefix_trie": OP13,
    "op7_ngram_join": OP7,
    "op8_warc": OP8,
    "op3_decontamination": OP3,
}
