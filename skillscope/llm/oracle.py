"""DuckDB SQL for the queries that SQL can state, written from what they return."""

from __future__ import annotations

from skillscope.llm.rules import MENU_WORDS, NOTICES

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
# A-Z alone are folded.
FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_NIBBLE = "(strpos('0123456789abcdef', sha[{0} + 1]) - 1)"
BASE32 = (
    "array_to_string(list_transform(range(32), lambda i: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'["
    f"1 + (((16 * {_NIBBLE.format('(5 * i) // 4')} + {_NIBBLE.format('(5 * i) // 4 + 1')})"
    " >> CAST(3 - (5 * i) % 4 AS INTEGER)) & 31)]), '')"
)

OP1 = f"""
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS sha FROM pages),
f AS (SELECT sha, min(page_id) AS first FROM p GROUP BY sha)
SELECT page_id, octet_length(payload) AS payload_bytes, {BASE32} AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to, url
FROM p JOIN f USING (sha)"""

# Escaped length: one backslash more for each '##', each closing mark and each backslash.
OP2 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
n AS (
  SELECT *, contains(role, '\') OR contains(text, '\') AS quoted,
         contains(role, '###') OR contains(text, '###') OR contains(role, '</turn>') OR contains(text, '</turn>')
         OR contains(role, chr(10)) AS marked FROM c),
e AS (
  SELECT *, CASE WHEN quoted THEN replace(role, '\', '\\') ELSE role END AS r,
         CASE WHEN quoted THEN replace(text, '\', '\\') ELSE text END AS t FROM n),
l AS (
  SELECT *, CASE WHEN quoted OR marked THEN
      length(replace(replace(replace(r, '##', '#\#'), '</turn>', '<\/turn>'), chr(10), '\N'))
      + length(replace(replace(t, '##', '#\#'), '</turn>', '<\/turn>'))
    ELSE length(role) + length(text) END + 4 + 1 + 8 AS size FROM e)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
         AS loss_sha256,
       CAST(sum(size) AS BIGINT) AS formatted_chars
FROM l GROUP BY conv_id"""

OP3 = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({FOLDED}, '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 3
    THEN list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' '))
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
b AS (SELECT a.doc_id AS x, c.doc_id AS y, count(*) AS common
      FROM s a JOIN s c ON a.shingle = c.shingle AND a.doc_id <> c.doc_id GROUP BY ALL),
e AS (SELECT x, y FROM b JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
      WHERE 100 * common >= 85 * (p.size + q.size - common)),
r AS (SELECT doc_id AS x, doc_id AS reached FROM documents
      UNION SELECT r.x, e.y FROM r JOIN e ON e.x = r.reached)
SELECT w.doc_id, coalesce(n.size, 0) AS n_shingles, m.component_id, w.doc_id = m.component_id AS kept
FROM w LEFT JOIN n USING (doc_id)
JOIN (SELECT x AS doc_id, min(reached) AS component_id FROM r GROUP BY x) m USING (doc_id)"""

OP4 = f"""
WITH w AS (SELECT doc_id, {WORDS} AS words FROM documents),
v AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS hash
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50)),
f AS (SELECT hash, min(doc_id) AS first FROM v GROUP BY hash),
g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS place FROM v JOIN f USING (hash) WHERE doc_id > first),
c AS (SELECT doc_id, list(place) AS places FROM g GROUP BY doc_id),
k AS (SELECT w.doc_id, words, places, CASE WHEN places IS NULL THEN words
        ELSE list_filter(words, lambda x, i: NOT list_contains(places, i)) END AS kept
      FROM w LEFT JOIN c USING (doc_id))
SELECT doc_id, len(words) AS n_words, CAST(len(words) - len(kept) AS BIGINT) AS n_removed,
       sha256(array_to_string(kept, ' ')) AS kept_sha256
FROM k"""

OP10 = rf"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS words, string_split(coalesce(text, ''), chr(10)) AS lines
           FROM documents),
v AS (SELECT doc_id, i, md5(array_to_string(words[i:i + 7], ' ')) AS hash
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM t WHERE len(words) >= 8)),
f AS (SELECT doc_id, hash FROM v GROUP BY doc_id, hash HAVING count(*) > 1),
r AS (SELECT doc_id, count(*) AS n FROM (
        SELECT DISTINCT doc_id, unnest(range(i, i + 8)) FROM v JOIN f USING (doc_id, hash)) GROUP BY doc_id),
l AS (SELECT doc_id, line, trim(line, chr(9) || chr(11) || chr(12) || chr(13) || ' ') AS bare
      FROM (SELECT doc_id, unnest(lines) AS line FROM t)),
b AS (SELECT doc_id, line, bare <> '' AND (
        (NOT contains('.!?:;"'')]}}…”’»', right(bare, 1)) AND len(regexp_extract_all(bare, '[^\x20\x09-\x0D]+')) < 3)
        OR len(regexp_extract_all(bare, '[|»›•·>]')) >= 3
        OR lower(bare) IN ({", ".join(f"'{w}'" for w in MENU_WORDS)})
        OR (length(bare) < 200 AND regexp_matches(lower(bare), '{"|".join(NOTICES)}'))) AS bad FROM l),
n AS (SELECT doc_id, count(*) FILTER (bad) AS n_bad,
             coalesce(sum(length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g'))) FILTER (bad), 0) AS lost FROM b GROUP BY doc_id),
c AS (SELECT doc_id, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols,
             len(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))
             - len(list_distinct(list_filter(lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))) AS n_dup_lines,
             coalesce(r.n, 0) AS n_repeat_words, n_bad AS n_lines_removed, lost
      FROM t LEFT JOIN r USING (doc_id) JOIN n USING (doc_id)),
d AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
             CASE WHEN word_chars > 0 THEN lost / word_chars ELSE 0.0 END AS share FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND share <= 0.5 AS kept, n_lines_removed, CAST(share AS DOUBLE) AS lost_share
FROM d"""

# CRC-32 of a list of bytes, by its table of 256 remainders, which is made first.
_CRC_TABLE = (
    "(SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) "
    "ELSE c >> 1 END) ORDER BY i) FROM range(256) t(i))")


def _crc(data: str, table: str) -> str:
    steps = f"list_reduce(list_concat([4294967295], {data}), lambda c, b: xor(c >> 8, {table}[1 + (xor(c, b) & 255)]))"
    return f"xor({steps}, 4294967295)"


# All letters here are below U+0100, hence one or two bytes.
_BYTES = ("flatten(list_transform(string_split({0}, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] "
          "ELSE [195::BIGINT, CAST(unicode(c) - 64 AS BIGINT)] END))")

OP11 = rf"""
WITH RECURSIVE k AS MATERIALIZED (SELECT {_CRC_TABLE} AS crc),
o AS (SELECT doc_id, unnest(regexp_extract_all({FOLDED}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
d AS (SELECT doc_id, run, count(*) AS n FROM o GROUP BY ALL),
h AS MATERIALIZED (
  SELECT run, n, {_crc(_BYTES.format("concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', run)"), "crc")} AS h FROM d, k),
e AS (SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, CAST(h % length(run) AS BIGINT)) || substring(run, CAST(h % length(run) AS BIGINT) + 2)
             ELSE run END AS word, n FROM h),
w AS MATERIALIZED (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM e WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
g AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
x AS MATERIALIZED (SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest FROM g),
p AS (
  SELECT a.word AS word, b.word AS near FROM x a JOIN x b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT x.word, w.word FROM x JOIN w ON w.word = x.rest
  UNION SELECT w.word, x.word FROM x JOIN w ON w.word = x.rest),
r AS (SELECT p.word, p.near, w.n AS near_n, row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.near) AS place,
             count(*) OVER (PARTITION BY p.word) AS n_near
      FROM p JOIN w ON w.word = p.near),
f AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN near_n >= 2 * w.n THEN near END AS form,
         CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
  FROM w LEFT JOIN r ON r.word = w.word AND place = 1),
t AS (SELECT word, word AS root, form AS next FROM f
      UNION ALL SELECT t.word, t.next, f.form FROM t JOIN f ON f.word = t.next)
SELECT f.word, form, t.root, n, n_near, form_n FROM f JOIN t ON t.word = f.word AND t.next IS NULL"""

OP12 = rf"""
WITH k AS MATERIALIZED (SELECT {_CRC_TABLE} AS crc),
s AS (SELECT conv_id, turn, md5(concat(octet_length(encode(coalesce(role, ''))), ':', coalesce(role, ''), coalesce(text, ''))) AS id,
             len({WORDS}) AS words FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, id, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) AS place FROM s),
c AS MATERIALIZED (
  SELECT conv_id, own, {_crc(_BYTES.format("CAST(conv_id AS VARCHAR)"), "crc")} % 4 AS h
  FROM (SELECT conv_id, count(*) AS own FROM o GROUP BY conv_id), k),
g AS (
  SELECT c.conv_id, o.place, o.id, o.words FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 20 AND o.place <= c.h
  UNION ALL SELECT c.conv_id, c.h + o.place, o.id, o.words FROM c JOIN o ON o.conv_id = c.conv_id AND o.place > c.h),
t AS (SELECT conv_id, id, words, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS depth FROM g),
p AS MATERIALIZED (
  SELECT conv_id, depth, words, md5(string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY depth)) AS key,
         coalesce(md5(string_agg(id, '') OVER (PARTITION BY conv_id ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), 'root') AS parent
  FROM t UNION ALL SELECT conv_id, 0, 0, 'root', NULL FROM c),
n AS MATERIALIZED (
  SELECT key, parent, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(words) AS saved FROM p GROUP BY ALL),
l AS (SELECT conv_id, max(depth) AS depth FROM p GROUP BY conv_id),
e AS (SELECT p.key, string_agg(CAST(p.conv_id AS VARCHAR), ',' ORDER BY p.conv_id) AS ids FROM p JOIN l USING (conv_id, depth) GROUP BY p.key),
ch AS (SELECT parent AS key, count(*) AS n_children FROM n GROUP BY parent),
below AS (
  SELECT p.key, sum(n.saved) AS saved, count(*) FILTER (ch.key IS NULL) AS n_leaves
  FROM n JOIN p ON p.conv_id = n.conv_id AND p.depth <= n.depth LEFT JOIN ch ON ch.key = n.key GROUP BY p.key)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(ch.n_children, 0) AS n_children, below.n_leaves,
       CAST(below.saved AS BIGINT) AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM n JOIN below USING (key) LEFT JOIN ch USING (key) LEFT JOIN e USING (key) LEFT JOIN n u ON u.key = n.parent"""

ORACLE: dict[str, str] = {
    "op1_warc_archive": OP1, "op2_chat_format": OP2, "op3_near_duplicates": OP3, "op4_repeated_passages": OP4,
    "op10_quality_rules": OP10, "op11_spelling_variants": OP11, "op12_prefix_trie": OP12,
}
