"""DuckDB SQL with the same results as the queries of the same names, where SQL can express them."""

ORACLE: dict[str, str] = {}

#: Copies of each row of a table ``docs`` (doc_id, text, source) in the mix, as table ``mix``.
MIX = r"""
sized AS (
  SELECT docs.*, coalesce(source, '') AS source_key, source IS NULL AS no_source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM docs),
blocked AS (
  SELECT *, length(bin(size)) AS size_bits, size >> greatest(length(bin(size)) - 6, 0) AS size_head,
         substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, 2) AS salt
  FROM sized),
totals AS (
  SELECT source_key, no_source, sum(size)::BIGINT AS source_size FROM blocked GROUP BY ALL),
weighted AS (
  SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY no_source, source_key) - 1) % 3 + 1]::BIGINT AS weight,
         source_size * 3 AS bound FROM totals),
shared AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(bound) OVER (
              ORDER BY bound / weight, no_source, source_key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            )::DOUBLE / sum(weight) OVER (
              ORDER BY bound / weight, no_source, source_key ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS share
  FROM weighted),
targets AS (
  SELECT *, least(bound::DOUBLE,
                  coalesce(max(CASE WHEN share * weight <= bound THEN share END) OVER (), 0) * weight) AS target,
         ('0x' || substr(md5('17:' || source_key || CASE WHEN no_source THEN '/null' ELSE '/' END), 1, 4))::BIGINT
           / 65536.0::DOUBLE AS shift
  FROM shared),
placed AS (
  SELECT blocked.*, source_size, target, shift,
         CASE WHEN source_size = 0 THEN 0 ELSE target / source_size END AS step,
         row_number() OVER (PARTITION BY source_key, no_source ORDER BY size_bits, size_head, salt, size,
                            doc_id NULLS FIRST) AS place
  FROM blocked JOIN targets USING (source_key, no_source)),
mix AS (
  SELECT *, (floor(shift + step * place) - floor(shift + step * (place - 1)))::BIGINT AS copies FROM placed)
"""

ORACLE["op9_source_mix"] = f"""
WITH docs AS (SELECT doc_id, text, source FROM documents), {MIX}
SELECT doc_id, size, source_size, target, copies * size AS taken FROM mix
"""

#: Pairs of a row of ``docs`` and a benchmark item it contains.
LEAKS = r"""
shingled AS (
  SELECT 0 AS side, doc_id AS id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'),
         lambda w: w <> '') AS w FROM docs
  UNION ALL
  SELECT 1, item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda w: w <> '')
  FROM benchmark),
runs AS (
  SELECT DISTINCT side, id, unnest(CASE WHEN len(w) > 0 THEN list_transform(
    range(1, greatest(len(w) - 3, 2)), lambda i: list_aggregate(w[i:i + 4], 'string_agg', ' ')) ELSE [] END) AS shingle
  FROM shingled),
leaks AS (
  SELECT d.id AS doc_id, i.id AS item_id, any_value(n) AS item_size, count(*) AS shared
  FROM runs d JOIN (SELECT *, count(*) OVER (PARTITION BY id) AS n FROM runs WHERE side = 1) i USING (shingle)
  WHERE d.side = 0 GROUP BY d.id, i.id HAVING count(*) * 100 >= any_value(n) * 80)
"""

ORACLE["op1_decontaminate"] = f"""
WITH docs AS (SELECT doc_id, text FROM documents), {LEAKS}
SELECT doc_id, item_id, item_size, shared, shared / item_size AS containment FROM leaks
"""

ORACLE["op11_target_resampling"] = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
grams AS (
  SELECT 0 AS side, row, unnest(words) AS word FROM docs
  UNION ALL
  SELECT 1, 0, unnest(regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
distinct_words AS (SELECT word, hex(encode(word)) AS bytes FROM grams GROUP BY word),
crc_table AS (
  SELECT list(list_reduce(list_prepend(n, range(8)),
           lambda c, _: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) ORDER BY n) AS crcs
  FROM range(256) AS r(n)),
bucketed AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(bytes), 2),
           lambda i: ('0x' || bytes[i + 1:i + 2])::BIGINT)),
           lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM distinct_words, crc_table),
counted AS (
  SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t
  FROM grams JOIN bucketed USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln(((t + 1) * (sum(s) OVER () + 10000))::DOUBLE
           / ((s + 1) * (sum(t) OVER () + 10000))::DOUBLE))::BIGINT AS gain
  FROM counted),
weighed AS (
  SELECT row, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM grams JOIN bucketed USING (word) JOIN gains USING (bucket) WHERE side = 0 GROUP BY row),
scored AS (
  SELECT row, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))
           ::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM docs LEFT JOIN weighed USING (row)),
ranked AS (
  SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20
              ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) END AS place,
         count(*) FILTER (n_features >= 20) OVER () * 10 // 100 AS draws
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= draws THEN place END AS rank FROM ranked
"""
