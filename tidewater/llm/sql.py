"""DuckDB SQL for the queries that SQL can express."""

OP1 = r"""
WITH doc AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
spot AS (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM doc),
win AS (SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS s FROM spot),
owner AS (SELECT s, min(doc_id) AS head FROM win GROUP BY s),
gone AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 50)))) AS pos
         FROM win JOIN owner USING (s) WHERE head < doc_id GROUP BY doc_id),
cut AS (SELECT doc_id, len(words) AS n, coalesce(len(pos), 0) AS r,
               list_filter(words, lambda w, k: pos IS NULL OR NOT list_contains(pos, k)) AS kept
        FROM doc LEFT JOIN gone USING (doc_id))
SELECT doc_id, n::BIGINT AS n_words, r::BIGINT AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM cut
"""

OP2 = r"""
WITH good AS (SELECT doc_id, max(quality) AS best FROM labels GROUP BY doc_id),
doc AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
               -ln((('0x' || substr(md5(doc_id::VARCHAR || 'mix'), 1, 12))::BIGINT + 0.5) / 281474976710656.0)
               / (CASE best WHEN 1 THEN 2.0 WHEN 0 THEN 0.5 ELSE 1.0 END) AS k
        FROM documents LEFT JOIN good USING (doc_id)),
src AS (SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM doc GROUP BY source),
walk AS (SELECT *, 3.0 * source_size / w AS ratio FROM src),
lev AS (SELECT *, (sum(source_size) OVER () - coalesce(sum(3.0 * source_size) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
          / (sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level FROM walk),
top AS (SELECT min_by(level, ratio) AS level FROM lev WHERE level <= ratio),
goal AS (SELECT source, source_size, coalesce(least(3.0 * source_size, (SELECT level FROM top) * w), 0.0)::DOUBLE AS target FROM lev),
plan AS (SELECT doc_id, size, source_size, target, floor(target + 0.5)::BIGINT AS budget,
                coalesce(sum(size) OVER (PARTITION BY doc.source ORDER BY k, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
         FROM doc JOIN goal ON doc.source IS NOT DISTINCT FROM goal.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size + greatest(0, least(size, budget % source_size - start)) END::BIGINT AS taken
FROM plan
"""

OP12 = r"""
WITH doc AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                    min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS head FROM documents),
lab AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
fail AS (SELECT part, (len(words) < 100)::INT + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
                + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
                + 16 * coalesce(head < doc_id, false)::INT AS mask, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
         FROM doc LEFT JOIN lab USING (doc_id)),
cell AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fail GROUP BY part, mask),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS b),
perm AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
         FROM letter a JOIN letter b ON b.x <> a.x JOIN letter c ON c.x NOT IN (a.x, b.x) JOIN letter d ON d.x NOT IN (a.x, b.x, c.x)
         JOIN letter e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
step AS (SELECT filter_order, s AS step, bits[s] AS bit, coalesce(list_sum(bits[1:s - 1]), 0) AS before FROM perm, (SELECT unnest(range(1, 6)) AS s)),
audit AS (SELECT part, filter_order, step, bit,
                 sum(CASE WHEN mask::BIGINT & (before::BIGINT | bit) = 0 THEN n ELSE 0 END) AS kept,
                 sum(CASE WHEN mask::BIGINT & bit <> 0 AND mask::BIGINT & before::BIGINT = 0 THEN n ELSE 0 END) AS removed,
                 sum(CASE WHEN mask::BIGINT & bit <> 0 AND mask::BIGINT & before::BIGINT <> 0 THEN n ELSE 0 END) AS redundant,
                 sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
                 sum(CASE WHEN mask::BIGINT & bit <> 0 AND mask::BIGINT & before::BIGINT = 0 THEN good ELSE 0 END) AS good_lost,
                 sum(CASE WHEN mask::BIGINT & bit <> 0 AND mask::BIGINT & before::BIGINT = 0 THEN toxic ELSE 0 END) AS toxic_lost
          FROM cell, step GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
       good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM audit
"""

OP13 = r"""
WITH doc AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || doc_id::VARCHAR) AS h FROM documents),
num AS (SELECT *, len(u)::BIGINT AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM doc),
cut AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
               CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM num),
part AS (SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m, coalesce(array_to_string(u[b + 1:n], ''), '') AS s FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM part
"""

ORACLES = {"op1_substring_dedup": OP1, "op2_source_mixing": OP2, "op12_filter_audit": OP12, "op13_fill_middle": OP13}
