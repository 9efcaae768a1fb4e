"""SQL (DuckDB dialect) for the queries of this subpackage that SQL can express.

Written from the contracts, by plain counting: no digest index, no signatures,
no suffix array.
"""

from __future__ import annotations

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
PLAIN = "coalesce(text, '')"
LOWER = f"translate({PLAIN}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT = f"""
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256({PLAIN}) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY {PLAIN})"""

# Every string of 200 bytes by its digest; runs of removed bytes; what is left.
REPEATS = f"""
WITH b AS (
  SELECT doc_id, hex(encode({PLAIN})) AS h, octet_length(encode({PLAIN}))::BIGINT AS n FROM documents
),
g AS (
  SELECT doc_id, p, md5(substr(h, (2 * p + 1)::BIGINT, 400)) AS m
  FROM (SELECT doc_id, h, unnest(range(0, n - 199)) AS p FROM b WHERE n >= 200)
),
r AS (
  SELECT doc_id, p, p - coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p), -1000) > 200 AS fresh
  FROM (SELECT doc_id, p FROM g QUALIFY count(*) OVER (PARTITION BY m) > 1)
),
spans AS (
  SELECT doc_id, min(p) AS start, max(p) + 200 AS stop
  FROM (SELECT *, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM r)
  GROUP BY doc_id, run
),
cut AS (
  SELECT doc_id, sum(stop - start)::BIGINT AS n_removed, count(*) AS n_spans, max(stop) AS last,
         string_agg(substr(h, (2 * before + 1)::BIGINT, (2 * (start - before))::BIGINT), '' ORDER BY start) AS kept
  FROM (
    SELECT s.*, h, coalesce(lag(stop) OVER (PARTITION BY doc_id ORDER BY start), 0) AS before
    FROM spans s JOIN b USING (doc_id)
  )
  GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN kept IS NULL THEN h ELSE kept || substr(h, (2 * last + 1)::BIGINT) END)) AS kept_sha256
FROM b LEFT JOIN cut USING (doc_id)"""

NEAR = f"""
WITH RECURSIVE w AS (SELECT doc_id, {WORDS.format(LOWER)} AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(range(1, greatest(1, len(words) - 4) + 1)) AS i FROM w WHERE len(words) > 0)
),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT x, y FROM pairs JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * shared >= 75 * (a.size + b.size - shared)
),
reach AS (
  SELECT doc_id AS node, doc_id AS other FROM documents
  UNION
  SELECT reach.node, links.y FROM reach JOIN links ON links.x = reach.other
)
SELECT node AS doc_id, coalesce(max(size), 0) AS n_shingles, min(other) AS component_id, min(other) = node AS kept
FROM reach LEFT JOIN n ON n.doc_id = node GROUP BY node"""

TERMS = f"regexp_extract_all({{}}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

RANKED = f"""
WITH d AS (SELECT doc_id, {TERMS.format(LOWER)} AS t FROM documents),
e AS (SELECT doc_id, t, len(t)::BIGINT AS n FROM d WHERE len(t) > 0),
c AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS every FROM e),
q AS (SELECT item_id, unnest(list_distinct({TERMS.format(LOWER)})) AS term FROM benchmark),
v AS (SELECT DISTINCT term FROM q),
p AS (
  SELECT doc_id, term, any_value(n) AS n, count(*)::BIGINT AS tf
  FROM (SELECT doc_id, n, unnest(t) AS term FROM e) SEMI JOIN v USING (term) GROUP BY doc_id, term
),
w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM p, c GROUP BY term, docs
),
s AS (
  SELECT item_id, doc_id,
         sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // every))))::BIGINT AS score
  FROM q JOIN p USING (term) JOIN w USING (term), c GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 50"""

PASSAGES = f"""
WITH d AS (SELECT doc_id, {WORDS.format(PLAIN)} AS w FROM documents),
g AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS m
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
),
r AS (SELECT doc_id, i FROM g QUALIFY doc_id > min(doc_id) OVER (PARTITION BY m)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM r),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS rest, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d) ANTI JOIN gone USING (doc_id, i)
  GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w)::BIGINT - coalesce(n, 0) AS n_removed,
       sha256(coalesce(rest, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


def quality(boilerplate: tuple[str, ...], furniture_words: int) -> str:
    phrases = " OR ".join(f"contains(lower(line), '{phrase}')" for phrase in boilerplate)
    bars = r"['|', '»', '«', '›', '‹', '·', '•', '>', '/', '\', '::', '->']"
    decorated = r"([#*$%&<>|~^=_]{2,}|!{2,}|\?{2,})[.,;:]?$"
    sentence = r"""[.!?…。！？؟।]["''”’»)\]]*([\x20\x09-\x0D]|$)"""  # a quote is doubled in SQL
    return f"""
WITH d AS (SELECT doc_id, {PLAIN} AS text, {WORDS.format(PLAIN)} AS words FROM documents),
t AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, words[i], words[i + 1], words[i + 2]) AS times
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM d WHERE len(words) > 2)
),
again AS (
  SELECT doc_id, count(DISTINCT place) AS n
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS place FROM t WHERE times > 1) GROUP BY doc_id
),
l AS (
  SELECT doc_id, line, {WORDS.format('line')} AS lw
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
),
f AS (
  SELECT doc_id, line, len(lw) AS size,
         (len(lw) <= {furniture_words} AND ({phrases})) OR (bars >= 3 AND len(lw) - bars <= 4 * (bars + 1))
         OR len(list_filter(lw, lambda x: regexp_matches(x, '{decorated}'))) > 0.5 * len(lw)
         OR (len(lw) >= 10 AND NOT regexp_matches(line, '{sentence}')) AS fails
  FROM (SELECT *, len(list_filter(lw, lambda x: list_contains({bars}, x))) AS bars FROM l WHERE len(lw) > 0)
),
lines AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS dups, coalesce(sum(size) FILTER (WHERE fails), 0) AS lost
  FROM f GROUP BY doc_id
),
c AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(dups, 0)::BIGINT AS n_dup_lines, coalesce(again.n, 0)::BIGINT AS n_repeat_words,
         coalesce(lost, 0)::BIGINT AS lost_words
  FROM d LEFT JOIN again USING (doc_id) LEFT JOIN lines USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND 100 * lost_words <= 50 * n_words AS kept
FROM c"""
