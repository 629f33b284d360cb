"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}

ORACLES["op4_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT AS draw
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1]::BIGINT AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 3 * source_size AS cap,
         ((sum(source_size) OVER ())::DOUBLE
          - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
                                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / (sum(weight) OVER (ORDER BY 3 * source_size / weight, source NULLS LAST
                              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM sources),
targets AS (
  SELECT source, source_size,
         CASE WHEN level * weight > cap THEN cap::DOUBLE
              ELSE (max(CASE WHEN NOT level * weight > cap THEN level END) OVER ()) * weight END AS target
  FROM levels),
placed AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target)::BIGINT // t.source_size ELSE 0 END AS whole,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.draw, s.doc_id NULLS FIRST, s.size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target,
       (whole * size + least(size, greatest(floor(target)::BIGINT - whole * source_size - ahead, 0)))::BIGINT AS taken
FROM placed"""

ORACLES["op7_warc"] = r"""
WITH rows AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages),
hashed AS (
  SELECT page_id, payload, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS hex,
         max(page_id) OVER (PARTITION BY payload) AS holder
  FROM rows)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                ((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31)::INT + 1, 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM holder THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM holder THEN holder END AS refers_to
FROM hashed"""

ORACLES["op9_url_filter"] = r"""
WITH split AS (
  SELECT page_id,
         coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's'), '') AS path
  FROM pages),
rules AS (
  SELECT * FROM (VALUES ('allow', 'com/'), ('block', 'example.com/en/'), ('allow', 'www.example.com/en/'),
                        ('block', 'net/es/'), ('block', 'net/fr/')) t(action, rule)),
keyed AS (
  SELECT *, regexp_replace(host, '^(www|m)\.', '') || regexp_replace(path, '(\.html|/)+$', '') AS key FROM split),
listed AS (
  SELECT DISTINCT key FROM keyed
  WHERE key <> '' AND regexp_extract(host, '([^.]+)\.example\.', 1) IN ('cheap-pills', 'spam-farm', 'casino-win')),
judged AS (
  SELECT k.*, k.key IN (SELECT key FROM listed) AS listed,
         (SELECT max_by(r, length(r.rule)) FROM rules r
          WHERE (k.host = split_part(r.rule, '/', 1) OR ends_with(k.host, '.' || split_part(r.rule, '/', 1)))
            AND starts_with(k.path, substr(r.rule, strpos(r.rule, '/')))) AS best
  FROM keyed k)
SELECT page_id, host, path, best.rule AS rule,
       coalesce(best.action, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict,
       listed
FROM judged"""

ORACLES["op10_chat"] = r"""
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
  FROM turns),
chats AS (
  SELECT conv_id, count(*) AS n_turns, list({'role': role, 'text': text} ORDER BY place) AS said
  FROM placed GROUP BY conv_id),
ends AS (
  SELECT n_turns, said, min(conv_id) AS conv_id, count(*) AS n_equal FROM chats GROUP BY n_turns, said),
openings AS (
  SELECT DISTINCT unnest(list_transform(range(1, n_turns), lambda k: said[1:k])) AS said FROM chats),
kept AS (SELECT * FROM ends WHERE said NOT IN (SELECT said FROM openings)),
parts AS (
  SELECT conv_id, coalesce(floor(turn / 256), -1) AS part,
         string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10)
                    || replace(coalesce(text, ''), '<|', '< |') || chr(10), '' ORDER BY place) AS text
  FROM placed GROUP BY ALL)
SELECT k.conv_id, row_number() OVER (PARTITION BY k.conv_id ORDER BY p.part) - 1 AS part, n_turns, n_equal, p.text
FROM kept k JOIN parts p ON k.conv_id IS NOT DISTINCT FROM p.conv_id"""

ORACLES["op1_quality"] = r"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM rows),
windows AS (
  SELECT r, i, words[i:i + 2] AS three
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM words)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, three) AS n FROM windows) WHERE n > 1),
repeated AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) GROUP BY r),
lines AS (
  SELECT r, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS words
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM rows)),
judged AS (
  SELECT r, line, list_sum(list_transform(words, lambda w: length(w))) AS chars,
         NOT regexp_matches(line, '[.!?…:;。！？]["'')\]»”’]*[\x20\x09-\x0D]*$')
         OR 5 * ((length(line) - length(replace(line, '!!', ''))) + (length(line) - length(replace(line, '??', '')))) // 2 >= len(words)
         OR 5 * len(list_filter(words, lambda w: regexp_full_match(w, '[|»>•·/→<–—-]+'))) >= len(words)
         OR (length(text_symbols) > 0 AND 10 * length(text_symbols) >= length(line))
         OR (len(words) <= 30 AND list_bool_or(list_transform(
               ['all rights reserved', 'terms of service', 'terms of use', 'privacy policy', 'cookie policy', 'accept cookies',
                'enable javascript', 'released under the', 'licensed under the', 'lorem ipsum', 'subscribe to our newsletter',
                'click here', 'copyright (c)'],
               lambda p: contains(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), p)))) AS bad
  FROM (SELECT *, regexp_replace(line, '[^#*$%&|<>]', '', 'g') AS text_symbols FROM lines) WHERE len(words) > 0),
by_line AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) FILTER (bad) AS n_bad_lines,
         coalesce(sum(chars) FILTER (bad), 0) AS lost_chars
  FROM judged GROUP BY r),
facts AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         coalesce(n_bad_lines, 0)::BIGINT AS n_bad_lines, coalesce(lost_chars, 0)::BIGINT AS lost_chars
  FROM words w LEFT JOIN by_line USING (r) LEFT JOIN repeated USING (r))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost_chars <= 50 * word_chars AS kept
FROM facts"""

ORACLES["op5_decontam"] = r"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
  FROM documents),
items AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
  FROM benchmark),
windows AS (
  SELECT DISTINCT item, size, words[i:i + size - 1] AS run
  FROM (SELECT item, words, least(10, len(words)) AS size, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i
        FROM items WHERE len(words) > 0)),
runs AS (
  SELECT r, i, size, words[i:i + size - 1] AS run
  FROM (SELECT r, words, size, unnest(range(1, len(words) - size + 2)) AS i
        FROM rows, (SELECT DISTINCT size FROM windows))),
found AS (SELECT r, i, runs.size AS size, item FROM runs JOIN windows ON runs.size = windows.size AND runs.run = windows.run),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + size)) AS p FROM found) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY encode(item)) AS names
  FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM rows LEFT JOIN hit USING (r) LEFT JOIN named USING (r)"""

ORACLES["op8_ngram_join"] = r"""
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x20\x09-\x0D]+'), []) AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT r, doc_id, words[i:i + least(5, len(words)) - 1] AS shingle
  FROM (SELECT r, doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM rows WHERE len(words) > 0)),
sizes AS (SELECT r, doc_id, count(*) AS n FROM shingles GROUP BY r, doc_id),
links AS (
  SELECT a.r AS a, b.r AS b
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.r <> b.r
  GROUP BY a.r, b.r
  HAVING 175 * count(*) >= 75 * ((SELECT n FROM sizes WHERE sizes.r = a.r) + (SELECT n FROM sizes WHERE sizes.r = b.r))),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, coalesce((SELECT n FROM sizes WHERE sizes.r = rows.r), 0) AS n_shingles,
       least(doc_id, (SELECT min(o.doc_id) FROM reach JOIN rows o ON reach.b = o.r WHERE reach.a = rows.r)) AS component_id
FROM rows"""


def _crc32(text: str) -> str:
    """CRC-32 of ASCII text, bit by bit."""
    bit = "lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    byte = f"lambda crc, c: list_reduce(range(8), {bit}, xor(crc, c))"
    codes = f"list_transform(string_split({text}, ''), lambda c: unicode(c)::BIGINT)"
    return f"xor(list_reduce({codes}, {byte}, 4294967295::BIGINT), 4294967295::BIGINT)"


def _leaf(text: str) -> str:
    fields = [f"CAST({name} AS VARCHAR)" for name in ("doc_id", "source", "lang", "n_chars")] + [text]
    return "sha256(" + " || ".join(f"coalesce(strlen({x}) || ':' || {x}, '-')" for x in fields) + ")"


ORACLES["op11_merkle"] = f"""
WITH RECURSIVE leaf AS (
  SELECT doc_id, source, coalesce('s' || source, 'n') AS tree, row_number() OVER () AS r,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS slot, count(*) OVER (PARTITION BY source) AS n,
         {_leaf("text")} AS digest,
         CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 5 = 0
              THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS forged
  FROM documents),
nodes AS (
  SELECT tree, 0 AS level, slot, digest, n FROM leaf
  UNION ALL
  SELECT tree, level + 1, slot // 16, sha256(string_agg(digest, '' ORDER BY slot)), (max(n) + 15) // 16
  FROM nodes WHERE n > 1 GROUP BY tree, level, slot // 16),
subroots AS (
  SELECT tree, level, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS slot, count(*) OVER () AS n FROM nodes WHERE n = 1),
upper AS (
  SELECT '' AS tree, 0 AS level, slot, digest, n FROM subroots
  UNION ALL
  SELECT tree, level + 1, slot // 16, sha256(string_agg(digest, '' ORDER BY slot)), (max(n) + 15) // 16
  FROM upper WHERE n > 1 GROUP BY tree, level, slot // 16),
runs AS (
  SELECT tree, level, slot // 16 AS run, list(digest ORDER BY slot) AS kids
  FROM (FROM nodes UNION ALL FROM upper) WHERE n > 1 GROUP BY tree, level, slot // 16),
walk AS (
  SELECT r, tree, 0 AS level, slot, '' AS proof, coalesce(forged, digest) AS node FROM leaf
  UNION ALL
  SELECT r, w.tree, w.level + 1, w.slot // 16,
         proof || array_to_string(kids[:slot % 16], '') || array_to_string(kids[slot % 16 + 2:], ''),
         sha256(array_to_string(kids[:slot % 16], '') || node || array_to_string(kids[slot % 16 + 2:], ''))
  FROM walk w JOIN runs ON w.tree = runs.tree AND w.level = runs.level AND w.slot // 16 = runs.run),
climb AS (
  SELECT r, '' AS tree, 0 AS level, s.slot, proof, node, s.digest AS subroot
  FROM walk JOIN subroots s ON walk.tree = s.tree AND walk.level = s.level
  UNION ALL
  SELECT r, c.tree, c.level + 1, c.slot // 16,
         proof || array_to_string(kids[:slot % 16], '') || array_to_string(kids[slot % 16 + 2:], ''),
         sha256(array_to_string(kids[:slot % 16], '') || node || array_to_string(kids[slot % 16 + 2:], '')), subroot
  FROM climb c JOIN runs ON c.tree = runs.tree AND c.level = runs.level AND c.slot // 16 = runs.run)
SELECT doc_id, leaf.digest AS leaf, subroot, u.digest AS root, sha256(proof) AS proof_sha256, node AS folded_root,
       node = u.digest AS verified, source, leaf.slot AS slot
FROM climb JOIN leaf USING (r) JOIN upper u ON u.n = 1 AND climb.level = u.level"""


def _edit(state: str, cost: str, letter: str, line: str = "") -> str:
    text = f"{state}.t || CASE WHEN {state}.t = '' THEN '' ELSE chr(10) END || {line}" if line else f"{state}.t"
    return f"CASE WHEN {state} IS NOT NULL THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {text}}} END"


def _best(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _stay(state: str, initial: str) -> str:
    keep = _edit(state, "extra", "K", "role || ':' || text")
    name = {"u": "user", "a": "assistant"}.get(initial)
    options = [f"CASE WHEN NOT must_go AND role[1] = '{initial}' THEN {keep} END"]
    if name:
        turn = _edit(state, "1 + extra", "R", f"'{name}:' || text")
        options.append(f"CASE WHEN NOT must_go THEN {turn} END")
    return ", ".join(options)


_GONE = {s: _edit(s, "2", "D") for s in ("s0", "s1", "s2", "s3")}
ORACLES["op12_repair"] = rf"""
WITH RECURSIVE keyed AS (
  SELECT *, {_crc32("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS d FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
         CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
         unnest(range(CASE WHEN d = 3 THEN 2 ELSE 1 END)) AS copy
  FROM keyed WHERE d <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, encode(role), encode(text), copy) AS place FROM damaged),
judged AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS again,
         lag(role) OVER (PARTITION BY conv_id ORDER BY place) AS role_before,
         NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank, NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS cut
  FROM placed),
rows AS (
  SELECT conv_id, turn, place, role, text, blank, NOT blank AND again AS duplicate, NOT blank AND NOT again AND cut AS truncated,
         blank OR again AS must_go, CASE WHEN cut THEN 5 ELSE 0 END AS extra,
         role_before IS NOT NULL AND role_before[1] || role[1] NOT IN ('su', 'ua', 'au') AS illegal
  FROM judged),
facts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal,
         count(*) AS n
  FROM rows GROUP BY conv_id),
walk AS (
  SELECT conv_id, 0::BIGINT AS place, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR, t VARCHAR) AS s1,
         {{'c': 5::BIGINT, 'a': 'I', 't': 'user:'}} AS s2, {{'c': 10::BIGINT, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:'}} AS s3
  FROM facts
  UNION ALL
  SELECT conv_id, place, s0, s1, s2, {_best("s3", _edit("s2", "5", "I", "'assistant:'"))}
  FROM (SELECT conv_id, place, s0, s1, s3,
               {_best("s2", *[_edit(s, "5", "I", "'user:'") for s in ("s0", "s1", "s3")])} AS s2
        FROM (SELECT walk.conv_id, rows.place, {_GONE["s0"]} AS s0, {_best(_GONE["s1"], _stay("s0", "s"))} AS s1,
                     {_best(_GONE["s2"], *[_stay(s, "u") for s in ("s0", "s1", "s3")])} AS s2,
                     {_best(_GONE["s3"], _stay("s2", "a"))} AS s3
              FROM walk JOIN rows ON walk.conv_id IS NOT DISTINCT FROM rows.conv_id AND rows.place = walk.place + 1))),
ends AS (
  SELECT f.conv_id, gaps, blank, duplicate, truncated, illegal, {_best("s0", "s3")} AS best
  FROM facts f JOIN walk w ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.n = w.place)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost, coalesce(best.a, '') AS audit,
       sha256(coalesce(best.t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN ends e ON c.conv_id IS NOT DISTINCT FROM e.conv_id"""
