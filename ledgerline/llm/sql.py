"""DuckDB SQL of the queries that SQL can express."""

#: Prefix-filtered Jaccard self-join, textbook form: rarity is the exact number
#: of lines of a word, and pairs are verified on the word lists.
OP10 = r"""
WITH lines AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS no
  FROM documents WHERE text IS NOT NULL),
sets AS (
  SELECT doc_id, no, list_distinct(list_filter(string_split(translate(lower(line), chr(9) || chr(13) || chr(11) || chr(12), '    '), ' '), lambda x: x <> '')) AS w
  FROM lines),
firsts AS (
  SELECT list_sort(w) AS w, min((doc_id, no)) AS pos, row_number() OVER () AS id FROM sets WHERE len(w) > 0 GROUP BY list_sort(w)),
words AS (SELECT id, pos, len(w) AS n, unnest(w) AS word FROM firsts),
rarity AS (SELECT word, count(*) AS df FROM words GROUP BY word),
ranked AS (
  SELECT id, pos, n, words.word, row_number() OVER (PARTITION BY id ORDER BY df, words.word) AS i
  FROM words JOIN rarity ON words.word = rarity.word),
prefix AS (SELECT * FROM ranked WHERE i <= n - CAST(ceil(n * 4 / 5.0) AS INT) + 1),
pairs AS (
  SELECT DISTINCT x.id AS x, y.id AS y FROM prefix x JOIN prefix y
  ON x.word = y.word AND x.pos < y.pos AND x.n * 4 <= y.n * 5 AND y.n * 4 <= x.n * 5),
gone AS (
  SELECT DISTINCT y FROM pairs JOIN firsts a ON a.id = x JOIN firsts b ON b.id = y
  WHERE len(list_intersect(a.w, b.w)) * 9 >= (len(a.w) + len(b.w)) * 4),
stays AS (SELECT pos FROM firsts WHERE id NOT IN (SELECT y FROM gone)),
marked AS (
  SELECT s.doc_id, s.no, l.line, (len(s.w) = 0 OR stays.pos IS NOT NULL) AS keep
  FROM sets s JOIN lines l ON s.doc_id = l.doc_id AND s.no = l.no LEFT JOIN stays ON stays.pos = (s.doc_id, s.no)),
rebuilt AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE keep), '') AS text,
         count(*) AS n_lines, count(*) FILTER (WHERE NOT keep) AS n_removed
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, r.text, coalesce(r.n_lines, 0) AS n_lines, coalesce(r.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN rebuilt r ON d.doc_id = r.doc_id
"""

#: Plain sums of gains by feature; the checksum byte by byte, from a table made by its rule.
OP11 = r"""
WITH tab AS (
  SELECT list(list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS tab
  FROM range(256) r(n)),
texts AS (
  SELECT 'd' AS side, row_number() OVER () AS row, doc_id, text FROM documents UNION ALL
  SELECT 'b', row_number() OVER (), NULL, text FROM benchmark),
words AS (
  SELECT side, row, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM texts),
runs AS (
  SELECT side, row, unnest(list_concat(w, list_concat(
    list_transform(range(1, greatest(1, len(w))), lambda i: w[i] || ' ' || w[i + 1]),
    list_transform(range(1, greatest(1, len(w) - 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])))) AS f
  FROM words),
hashed AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(regexp_extract_all(hex(encode(f)), '..'), lambda x: ('0x' || x)::BIGINT)),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT f FROM runs), tab),
hits AS (SELECT side, row, bucket, count(*) AS n FROM runs JOIN hashed USING (f) GROUP BY ALL),
per_bucket AS (
  SELECT b.bucket, coalesce(sum(n) FILTER (WHERE side = 'd'), 0) AS s, coalesce(sum(n) FILTER (WHERE side = 'b'), 0) AS t
  FROM range(10000) b(bucket) LEFT JOIN hits ON hits.bucket = b.bucket GROUP BY b.bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain
  FROM per_bucket),
weighed AS (
  SELECT row, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight FROM hits JOIN gains USING (bucket) WHERE side = 'd' GROUP BY row),
scored AS (
  SELECT row, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM words LEFT JOIN weighed USING (row) WHERE side = 'd'),
drawn AS (
  SELECT row, row_number() OVER (ORDER BY score DESC, doc_id, weight DESC, n_features DESC) AS rank, count(*) OVER () AS n
  FROM scored WHERE n_words >= 20 AND score IS NOT NULL)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 5 * n // 100 THEN rank END AS rank
FROM scored LEFT JOIN drawn USING (row)
"""

#: Every anchor against every row.
OP13 = r"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN pairs USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""

SQL: dict[str, str] = {"op10_line_dedup": OP10, "op11_bit_sliced_resampling": OP11, "op13_segment_negatives": OP13}
