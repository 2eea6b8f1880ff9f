"""DuckDB SQL for the registered queries that SQL can express."""

PREFERENCE = """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n FROM turns),
openings AS (
  SELECT conv_id, role, text, min(conv_id) OVER (PARTITION BY role, text) AS chosen_id FROM numbered WHERE n = 1),
answers AS (
  SELECT conv_id, max(n) AS last, arg_max(text, n) AS answer FROM numbered WHERE role = 'assistant' GROUP BY conv_id),
pairs AS (
  SELECT 'opening' AS kind, chosen_id, conv_id AS rejected_id FROM openings WHERE conv_id <> chosen_id
  UNION ALL
  SELECT 'answer', a.conv_id, b.conv_id FROM answers a JOIN answers b ON b.conv_id = a.conv_id + 1),
sides AS (
  SELECT kind, chosen_id, rejected_id, 'c' AS side, n, role, text FROM pairs JOIN numbered ON conv_id = chosen_id
  WHERE kind = 'opening'
  UNION ALL
  SELECT kind, chosen_id, rejected_id, 'r', n, role, text FROM pairs JOIN numbered ON conv_id = rejected_id
  WHERE kind = 'opening'
  UNION ALL
  SELECT kind, chosen_id, rejected_id, s.side, t.n, t.role,
         CASE WHEN s.side = 'r' AND t.n = a.last THEN b.answer ELSE t.text END
  FROM pairs p JOIN answers a ON a.conv_id = p.chosen_id JOIN answers b ON b.conv_id = p.rejected_id
  JOIN numbered t ON t.conv_id = p.chosen_id AND t.n <= a.last CROSS JOIN (VALUES ('c'), ('r')) s(side)
  WHERE kind = 'answer'),
equal AS (
  SELECT kind, chosen_id, rejected_id, c.n
  FROM sides c JOIN sides r USING (kind, chosen_id, rejected_id, n)
  WHERE c.side = 'c' AND r.side = 'r' AND c.role = r.role AND c.text = r.text),
runs AS (
  SELECT *, row_number() OVER (PARTITION BY kind, chosen_id, rejected_id ORDER BY n) AS k FROM equal),
prefix AS (
  SELECT p.kind, p.chosen_id, p.rejected_id, count(*) FILTER (r.n = r.k) AS m
  FROM pairs p LEFT JOIN runs r USING (kind, chosen_id, rejected_id) GROUP BY ALL),
rendered AS (
  SELECT s.*, p.m, '<|' || role || '|>' || chr(10) AS head, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS whole
  FROM sides s JOIN prefix p USING (kind, chosen_id, rejected_id)),
placed AS (
  SELECT *, sum(length(whole)) OVER (PARTITION BY kind, chosen_id, rejected_id, side ORDER BY n)
              - length(whole) + length(head) AS start
  FROM rendered WHERE n > m),
done AS (
  SELECT kind, chosen_id, rejected_id, side, string_agg(whole, '' ORDER BY n) AS completion,
         string_agg(CASE WHEN role = 'assistant' THEN start::BIGINT::VARCHAR || '-' || (start + length(text))::BIGINT::VARCHAR END, ','
                    ORDER BY n) AS mask
  FROM placed GROUP BY ALL),
prompts AS (
  SELECT kind, chosen_id, rejected_id, string_agg(whole, '' ORDER BY n) AS prompt
  FROM rendered WHERE side = 'c' AND n <= m GROUP BY ALL)
SELECT p.kind, p.chosen_id, p.rejected_id, p.m::INTEGER AS prompt_turns, coalesce(q.prompt, '') AS prompt,
       coalesce(c.completion, '') AS chosen_text, coalesce(r.completion, '') AS rejected_text,
       coalesce(c.mask, '') AS chosen_mask, coalesce(r.mask, '') AS rejected_mask
FROM prefix p LEFT JOIN prompts q USING (kind, chosen_id, rejected_id)
LEFT JOIN done c ON c.kind = p.kind AND c.chosen_id = p.chosen_id AND c.rejected_id = p.rejected_id AND c.side = 'c'
LEFT JOIN done r ON r.kind = p.kind AND r.chosen_id = p.chosen_id AND r.rejected_id = p.rejected_id AND r.side = 'r'
WHERE c.completion IS NOT NULL OR r.completion IS NOT NULL
"""

DECONTAMINATION = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS row,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id::VARCHAR AS item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL),
starts AS (
  SELECT item, w, least(len(w), 10) AS size, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS pos FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, size, array_to_string(w[pos : pos + size - 1], ' ') AS gram FROM starts),
grams AS (
  SELECT d.row, s.size, unnest(range(1, len(d.w) - s.size + 2)) AS pos, d.w
  FROM docs d CROSS JOIN (SELECT DISTINCT size FROM windows) s WHERE len(d.w) >= s.size),
hits AS (
  SELECT g.row, g.pos, g.size, v.item
  FROM (SELECT row, size, pos, array_to_string(w[pos : pos + size - 1], ' ') AS gram FROM grams) g
  JOIN windows v ON v.gram = g.gram AND v.size = g.size),
covered AS (SELECT row, count(DISTINCT p) AS n FROM (SELECT row, unnest(range(pos, pos + size)) AS p FROM hits) GROUP BY row),
named AS (SELECT row, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY row)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n, 0)::BIGINT AS n_hit, coalesce(n.n, 0)::BIGINT AS n_items,
       sha256(coalesce(n.items, '')) AS items_sha256, coalesce(c.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN covered c USING (row) LEFT JOIN named n USING (row)
"""

RANKED = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
texts AS (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
asked AS (
  SELECT item_id, term, count(*) AS c
  FROM (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM texts) GROUP BY ALL),
sums AS (SELECT count(*)::BIGINT AS docs, sum(len(w))::BIGINT AS words FROM docs WHERE len(w) > 0),
counts AS (
  SELECT row, doc_id, n, term, count(*)::BIGINT AS tf
  FROM (SELECT row, doc_id, len(w)::BIGINT AS n, unnest(w) AS term FROM docs) SEMI JOIN asked USING (term) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight
  FROM counts, sums GROUP BY term, docs),
scores AS (
  SELECT item_id, row, doc_id,
         sum(c * weight * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + ((25 * n * docs) // words)))))::BIGINT AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term), sums
  WHERE doc_id IS NOT NULL GROUP BY item_id, row, doc_id),
ranks AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank, doc_id, score
          FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranks WHERE rank <= 20
"""

SQL: dict[str, str] = {"op2_preference": PREFERENCE, "op8_decontamination": DECONTAMINATION, "op13_ranked_search": RANKED}
