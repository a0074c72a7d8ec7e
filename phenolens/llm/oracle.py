"""DuckDB SQL of the queries that SQL can express; the others are tested against brute force, labels or round trips."""

from __future__ import annotations


def crc32(source: str) -> str:
    """CTEs that give ``crc`` (UBIGINT) of each distinct ``key`` (text) of the relation ``source``, by the table method."""
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END"
    return f"""
crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i::UBIGINT, range(8)::UBIGINT[]), lambda c, k: {step}) AS c FROM range(256) r(i))),
crcs AS (
  SELECT key, xor(list_reduce(list_prepend(4294967295::UBIGINT, bytes),
                              lambda c, b: xor(c >> 8, t[((xor(c, b) & 255) + 1)::BIGINT])), 4294967295::UBIGINT) AS crc
  FROM (SELECT key, list_transform(range(strlen(key)), lambda k:
                 ('0x' || substr(hex(encode(key)), 2 * k + 1, 2))::UBIGINT) AS bytes FROM (SELECT DISTINCT key FROM {source}))
  CROSS JOIN crc_table)"""


LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

RESAMPLING = f"""WITH
doc_words AS (
  SELECT doc_id, unnest(regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS key FROM documents),
goal_words AS (
  SELECT unnest(regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) AS key FROM benchmark),
every AS (SELECT key FROM doc_words UNION ALL SELECT key FROM goal_words), {crc32('every')},
raw AS (SELECT crc % 10000 AS bucket, count(*) AS s FROM doc_words JOIN crcs USING (key) GROUP BY 1),
goal AS (SELECT crc % 10000 AS bucket, count(*) AS t FROM goal_words JOIN crcs USING (key) GROUP BY 1),
sums AS (SELECT (SELECT coalesce(sum(s), 0) FROM raw)::DOUBLE AS s_all, (SELECT coalesce(sum(t), 0) FROM goal)::DOUBLE AS t_all),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * (s_all + 10000)
                                 / ((s + 1.0::DOUBLE) * (t_all + 10000))))::BIGINT AS gain
  FROM raw LEFT JOIN goal USING (bucket) CROSS JOIN sums),
per_doc AS (
  SELECT d.doc_id, count(w.key) AS n_features, coalesce(sum(g.gain), 0)::BIGINT AS weight
  FROM documents d LEFT JOIN doc_words w ON w.doc_id = d.doc_id LEFT JOIN crcs c ON c.key = w.key
  LEFT JOIN gains g ON g.bucket = c.crc % 10000 GROUP BY d.doc_id),
scored AS (
  SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
  FROM per_doc),
ranks AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranks USING (doc_id)"""


def shingle_components(percent: int) -> str:
    """CTEs up to ``parts`` (doc_id, component_id) and ``sets`` (doc_id, shingle) of the five-word shingle join."""
    return f"""
words AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))) END)
         AS shingle FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
both_in AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS held FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM both_in JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * held >= {percent} * (x.n + y.n - held)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
parts AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)"""


JACCARD = f"""WITH RECURSIVE {shingle_components(80)}
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM parts LEFT JOIN sizes USING (doc_id)"""

NEAR_DEDUP = f"""WITH RECURSIVE {shingle_components(75)}
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM parts LEFT JOIN sizes USING (doc_id)"""

#: One ASCII character for each letter that words may have besides a-z (U+00C0 to U+00FF), as levenshtein counts bytes.
BEYOND_ASCII = "".join(map(chr, range(0xC0, 0x100)))
STAND_INS = "".join(map(chr, range(0x30, 0x61)))[:49] + "".join(map(chr, (0x21, *range(0x23, 0x27), *range(0x28, 0x30), 0x7B, 0x7C)))

SPELLING = f"""WITH RECURSIVE
occurrences AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
runs AS (SELECT run, doc_id || ':' || run AS key, count(*) AS n FROM occurrences GROUP BY ALL), {crc32('runs')},
counted AS (
  SELECT CASE WHEN crc % 199 = 0 THEN substr(run, 1, (crc % length(run))::BIGINT) || substr(run, (crc % length(run))::BIGINT + 2)
         ELSE run END AS word, sum(n)::BIGINT AS n FROM runs JOIN crcs USING (key) GROUP BY 1),
words AS (
  SELECT word, n, length(word) AS size, translate(word, '{BEYOND_ASCII}', '{STAND_INS}') AS plain FROM counted
  WHERE length(word) >= 6 AND n >= 5),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM words a JOIN words b
  ON b.size BETWEEN a.size - 1 AND a.size + 1 AND a.word <> b.word AND levenshtein(a.plain, b.plain) = 1),
best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS form, max(other_n) AS form_n FROM near GROUP BY word),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form,
         CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n FROM words w LEFT JOIN best b ON b.word = w.word),
chain AS (
  SELECT word, word AS root, 0 AS step FROM formed
  UNION ALL SELECT c.word, f.form, c.step + 1 FROM chain c JOIN formed f ON f.word = c.root WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)"""

SQL = {
    "op11_importance_resampling": RESAMPLING,
    "op12_ngram_jaccard_join": JACCARD,
    "op13_spelling_variants": SPELLING,
    "op2_minhash_near_dedup": NEAR_DEDUP,
}
