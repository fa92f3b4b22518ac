"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

from .license_scan import COPYRIGHT_LINE, EQUIVALENT, NOTICE_MARK
from .license_texts import NOTICES, TEXTS
from .mixing import WEIGHTS
from .quality_rules import FURNITURE, LONG_LINE, MAX_FURNITURE_CHARS, SEPARATORS

_BLANKS = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
_WORDS = r"list_filter(string_split_regex(%s, '[\x20\x09-\x0D]+'), lambda w: w <> '')"
_LOWER = "translate(%s, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
  ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
lowest AS (SELECT x, min(y) AS y FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(y, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(y, vec_id)) AS kept
FROM embeddings LEFT JOIN degree ON vec_id = degree.x LEFT JOIN lowest ON vec_id = lowest.x
"""

OP2 = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (SELECT *, {_LOWER % f"trim(line, {_BLANKS})"} AS k FROM lines),
held AS (SELECT k, min(doc_id) AS first_doc FROM keyed WHERE length(k) >= 10
         GROUP BY k HAVING count(DISTINCT doc_id) > 1),
judged AS (SELECT l.*, h.first_doc IS NOT NULL AND l.doc_id <> h.first_doc AS dropped
           FROM keyed l LEFT JOIN held h ON l.k = h.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

OP3 = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS % (_LOWER % "coalesce(text, '')")} AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT x, y FROM shared JOIN sizes p ON x = p.doc_id JOIN sizes q ON y = q.doc_id
  WHERE 100 * common >= 80 * (p.n + q.n - common)),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
lowest AS (SELECT x, min(y) AS y FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(y, d.doc_id)) AS component_id
FROM documents d LEFT JOIN sizes s ON d.doc_id = s.doc_id LEFT JOIN lowest ON d.doc_id = lowest.x
"""

#: The checksum of a text by a table of 256 remainders, a byte at a time.
OP5 = """
WITH RECURSIVE step(v, x, k) AS (
  SELECT CAST(range AS BIGINT), CAST(range AS BIGINT), 0 FROM range(256)
  UNION ALL SELECT v, xor(x >> 1, 3988292384 * (x & 1)), k + 1 FROM step WHERE k < 8),
tbl AS (SELECT list(x ORDER BY v) AS t FROM step WHERE k = 8),
docs AS (
  SELECT doc_id, source, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size,
         xor(list_reduce(list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda h: CAST('0x' || h AS BIGINT)),
             lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS crc
  FROM documents, tbl),
keyed AS (SELECT *, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
                 md5('29:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || crc || ':' || size) AS place FROM docs),
ranked AS (
  SELECT *, (row_number() OVER (PARTITION BY key ORDER BY place, doc_id, crc, size) - 1
             + CAST('0x' || substr(md5('30:' || key), 1, 8) AS BIGINT) / 4294967296.0) / count(*) OVER (PARTITION BY key) AS rank
  FROM keyed),
placed AS (SELECT *, row_number() OVER (ORDER BY rank, key, place, doc_id, crc, size) - 1 AS place_no, count(*) OVER () AS n FROM ranked)
SELECT doc_id, size, crc AS text_crc32, CAST(place_no * 8 // n AS INTEGER) AS shard, place_no - ((place_no * 8 // n) * n + 7) // 8 AS slot, source,
       'rows' AS law, CAST(NULL AS INTEGER) AS grown_shard
FROM placed
"""

OP8 = f"""
WITH rows AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS key,
         CAST(len({_WORDS % "coalesce(text, '')"}) AS BIGINT) AS size,
         md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || strlen(coalesce(text, ''))) AS place FROM documents),
sizes AS (SELECT key, CAST(sum(size) AS BIGINT) AS size FROM rows GROUP BY key),
weighed AS (
  SELECT key, size, {list(WEIGHTS)}[CAST((row_number() OVER (ORDER BY key) - 1) % {len(WEIGHTS)} AS INTEGER) + 1] AS w
  FROM sizes),
levels AS (
  SELECT *, (CAST(sum(size) OVER () AS BIGINT) * 150 / 100.0 - 2 * CAST(coalesce(sum(size) OVER (
      ORDER BY size / w, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT))
    / CAST(sum(w) OVER (ORDER BY size / w, key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS level
  FROM weighed),
final AS (SELECT (SELECT level FROM levels WHERE level * w < 2 * size ORDER BY size / w, key LIMIT 1) AS level),
targets AS (
  SELECT key, size AS source_size, CASE WHEN final.level IS NULL OR final.level * w >= 2 * size
    THEN CAST(2 * size AS DOUBLE) ELSE final.level * w END AS target FROM levels, final),
placed AS (
  SELECT rows.*, source_size, target, CAST(round(target) AS BIGINT) AS budget, CAST(coalesce(sum(size) OVER (
      PARTITION BY rows.key ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS BIGINT) AS ahead
  FROM rows JOIN targets ON rows.key = targets.key),
passes AS (SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS whole FROM placed)
SELECT doc_id, size, source_size, target,
       whole * size + greatest(0, least(size, budget - whole * source_size - ahead)) AS taken, source
FROM passes
"""


def _count(line: str, chars: str) -> str:
    return f"(length({line}) - length(translate({line}, '{chars}', '')))"


def _line_fails(line: str) -> str:
    n = f"len({_WORDS % line})"
    seps, symbols = _count(line, SEPARATORS), f"length(regexp_replace({line}, '[^#*$%&|<>]', '', 'g'))"
    doubled = (f"((2 * length({line}) - length(replace({line}, '!!', '')) - length(replace({line}, '??', ''))) // 2)")
    # every word between marks of its own, so that a phrase is found as whole words only
    rest = rf"regexp_replace(lower({line}), '([\p{{L}}\p{{N}}]+)', chr(57344) || '\1' || chr(57345), 'g')"
    for p in FURNITURE:
        rest = f"replace({rest}, '" + " ".join(f"\ue000{w}\ue001" for w in p.split()) + "', '')"
    letters = r"length(regexp_replace(%s, '[^\p{L}\p{N}]', '', 'g'))"
    marks = (rf"(regexp_matches({line}, '[.,;:!?]')"
             rf" OR regexp_matches(regexp_replace({line}, '[\x00-\x7F]', '', 'g'), '\p{{P}}'))")
    unmarked = rf"(length({line}) - length(regexp_replace({line}, '[\x{{0E00}}-\x{{0EFF}}]', '', 'g')))"
    return (f"((10 * {symbols} > length(translate({line}, {_BLANKS}, '')))"
            f" OR ({seps} >= 3 AND 3 * {seps} >= {n}) OR ({doubled} >= 3 AND 5 * {doubled} > {n})"
            f" OR (length({line}) >= {LONG_LINE} AND NOT {marks} AND 2 * {unmarked} < length({line}))"
            f" OR (length({line}) <= {MAX_FURNITURE_CHARS} AND 2 * {letters % rest} < {letters % line}))")


OP9 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, {_WORDS % "t"} AS words, string_split(t, chr(10)) AS lines FROM d),
places AS (SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
windows AS (SELECT r, i, [lead(word, k) OVER p FOR k IN []] AS none FROM places WINDOW p AS (PARTITION BY r ORDER BY i)),
grams AS (
  SELECT r, i, word || ' ' || lead(word, 1) OVER p || ' ' || lead(word, 2) OVER p || ' ' || lead(word, 3) OVER p
         || ' ' || lead(word, 4) OVER p AS g FROM places WINDOW p AS (PARTITION BY r ORDER BY i)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams WHERE g IS NOT NULL) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM again, range(5) s(k) GROUP BY r),
judged AS (
  SELECT r, unnest(lines) AS line FROM w),
lost AS (SELECT r, count(*) AS n_lines, count(*) FILTER ({_line_fails("line")}) AS n_failed,
                coalesce(sum(len({_WORDS % "line"})) FILTER ({_line_fails("line")}), 0) AS n_lost FROM judged GROUP BY r),
m AS (
  SELECT w.*, CAST(len(words) AS BIGINT) AS n_words, coalesce(covered.n, 0) AS n_repeat, n_lines, n_failed,
         CAST(n_lost AS BIGINT) AS n_lost,
         list_filter(lines, lambda l: trim(l, {_BLANKS}) <> '') AS full_lines
  FROM w LEFT JOIN covered ON w.r = covered.r JOIN lost ON w.r = lost.r)
SELECT doc_id, n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
       CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
       CAST(len(full_lines) - len(list_distinct(full_lines)) AS BIGINT) AS n_dup_lines,
       CAST(n_repeat AS BIGINT) AS n_repeat_words, n_words < 10 OR 100 * n_repeat > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat > 20 * n_words) AND 100 * n_lost <= 30 * n_words AS kept,
       n_lines, n_failed AS n_failed_lines, n_lost AS lost_words
FROM m
"""
OP9 = "\n".join(line for line in OP9.split("\n") if not line.startswith("windows AS"))


def _canonical(text: str) -> str:
    c = f"regexp_replace(lower({text}), '{COPYRIGHT_LINE}', '', 'g')"
    c = rf"' ' || regexp_replace({c}, '[^\p{{L}}\p{{N}}]+', ' ', 'g') || ' '"
    for old, new in EQUIVALENT:
        c = f"replace({c}, '{old}', '{new}')"
    return f"trim({c}, ' ')"


def _values(rows) -> str:
    return ", ".join("('%s', '%s')" % (a, b.replace("'", "''")) for a, b in rows)


OP10 = f"""
WITH whole AS (SELECT digest, min(license) AS license FROM (
    SELECT license, sha256({_canonical("text")}) AS digest FROM (VALUES {_values(TEXTS + NOTICES)}) t(license, text)) GROUP BY digest),
notice AS (SELECT digest, min(license) AS license FROM (
    SELECT license, sha256({_canonical("text")}) AS digest FROM (VALUES {_values(NOTICES)}) t(license, text)) GROUP BY digest),
lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
found AS (SELECT doc_id, count(*) AS n, string_agg(DISTINCT license, ',' ORDER BY license) AS notices
          FROM (SELECT doc_id, sha256({_canonical("line")}) AS digest FROM lines WHERE contains(lower(line), '{NOTICE_MARK}')) l
          JOIN notice USING (digest) GROUP BY doc_id)
SELECT d.doc_id, d.digest, whole.license, coalesce(n, 0) AS n_notices, coalesce(notices, '') AS notices
FROM (SELECT doc_id, sha256({_canonical("coalesce(text, '')")}) AS digest FROM documents) d
LEFT JOIN whole ON d.digest = whole.digest LEFT JOIN found ON d.doc_id = found.doc_id
"""

#: Strings of 100 bytes (as hex), all but the first of equal ones mark their bytes.
OP11 = """
WITH d AS (SELECT doc_id, hex(coalesce(text, '')) AS h, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n FROM documents),
places AS (SELECT doc_id, h, unnest(range(n - 99)) AS i FROM d WHERE n >= 100),
strings AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS s FROM places),
later AS (SELECT doc_id, i FROM (
  SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM strings) WHERE r > 1),
begun AS (SELECT *, CASE WHEN i <= 100 + lag(i) OVER (PARTITION BY doc_id ORDER BY i) THEN 0 ELSE 1 END AS fresh FROM later),
spans AS (
  SELECT doc_id, min(i) AS a, max(i) + 100 AS b
  FROM (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM begun) GROUP BY doc_id, g),
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS x, a AS y, b FROM spans),
rest AS (
  SELECT d.doc_id, CAST(sum(b - y) AS BIGINT) AS n_removed, count(*) AS n_spans,
         string_agg(substr(h, 2 * x + 1, 2 * (y - x)), '' ORDER BY y) || substr(any_value(h), 2 * max(b) + 1) AS kept
  FROM gaps JOIN d USING (doc_id) GROUP BY d.doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept, h))) AS kept_sha256
FROM d LEFT JOIN rest USING (doc_id)
"""

#: The checksum of an id bit by bit, then runs as islands of equal words q apart.
OP12 = f"""
WITH d AS (
  SELECT doc_id, {_WORDS % "coalesce(text, '')"} AS w,
         xor(list_reduce(flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
               lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
             lambda x, e: xor(xor(x, e) >> 1, 3988292384 * (xor(x, e) & 1)), CAST(4294967295 AS BIGINT)), 4294967295) AS h
  FROM documents),
g AS (SELECT doc_id, w, h % 10 = 0 AND len(w) > 0 AS planted, len(w) AS n, h // 10 AS g FROM d),
p AS (SELECT *, CASE WHEN planted THEN g % n END AS a,
             CASE WHEN planted THEN 1 + (n - g % n) // (3 + g % 8) END AS p FROM g),
words AS (
  SELECT doc_id, n, i, w[CASE WHEN planted AND i >= a THEN a + (i - a) % p ELSE i END + 1] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM p)),
equal AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y
  ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
islands AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS g FROM equal) GROUP BY doc_id, q, g),
runs AS (
  SELECT doc_id, start, length, min(q) AS period FROM islands
  WHERE length >= greatest(24, 3 * q) GROUP BY doc_id, start, length),
best AS (
  SELECT doc_id, count(*) AS n_runs,
         first({{'s': start, 'l': length, 'p': period}} ORDER BY length / period DESC, start, period) AS top,
         sha256(string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period)) AS digest
  FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS rest
         FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, top.s AS start, top.l AS length, top.p AS period,
       1000 * top.l // top.p AS exponent_milli, coalesce(digest, sha256('')) AS runs_sha256,
       sha256(coalesce(rest, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

_TERMS = r"regexp_extract_all(%s, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')" % (_LOWER % "coalesce(text, '')")

OP13 = f"""
WITH words AS (SELECT doc_id, unnest({_TERMS}) AS t FROM documents),
sizes AS (SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
norms AS (SELECT doc_id, 50 + (50 * n * docs) // terms AS m FROM sizes, totals),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS t FROM benchmark),
postings AS (SELECT t, doc_id, count(*) AS tf FROM words WHERE t IN (SELECT t FROM asked) GROUP BY t, doc_id),
weights AS (
  SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM postings GROUP BY t), totals),
impacts AS (
  SELECT t, doc_id, w * ((1000000000 * tf) // (1000 * tf + 20 * m)) AS impact
  FROM postings JOIN weights USING (t) JOIN norms USING (doc_id)),
scores AS (
  SELECT item_id, doc_id, CAST(sum(impact) AS BIGINT) AS score FROM asked JOIN impacts USING (t)
  GROUP BY item_id, doc_id HAVING sum(impact) > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores) WHERE rank <= 50
"""

QUERIES: dict[str, str] = {
    "op1_subspace_pigeonhole": OP1,
    "op2_line_dedup": OP2,
    "op3_ngram_jaccard": OP3,
    "op5_interleaved_shards": OP5,
    "op8_mix_sources": OP8,
    "op9_quality_rules": OP9,
    "op10_license_scan": OP10,
    "op11_suffix_dedup": OP11,
    "op12_periodic_runs": OP12,
    "op13_nra_search": OP13,
}
