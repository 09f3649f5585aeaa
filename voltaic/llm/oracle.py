"""DuckDB SQL of the queries that SQL can express in full."""

WORDS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_LINE_KEY = "translate(trim(ls[k], ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_DISTANCE = "list_sum(list_transform(list_zip(parts.v, books{}.v), lambda x: (x[1] - x[2]) * (x[1] - x[2])))::BIGINT"


def _vector_round(k: int) -> str:
    """books{k+1}: every entry of books{k} at the floored mean of the parts nearest to it."""
    return f"""near{k} AS MATERIALIZED (SELECT r, part, min({_DISTANCE.format(k)} * 64 + entry) % 64 AS entry
          FROM parts JOIN books{k} USING (part) GROUP BY r, part),
mean{k} AS (SELECT part, entry, list(c ORDER BY place) AS v FROM (
          SELECT part, entry, place, floor(sum(v[place]) / count(*))::BIGINT AS c
          FROM parts JOIN near{k} USING (r, part), range(1, len(v) + 1) AS t(place) GROUP BY part, entry, place) GROUP BY part, entry),
books{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(mean{k}.v, books{k}.v) AS v FROM books{k} LEFT JOIN mean{k} USING (part, entry))"""


SQL = {
    "op1_decontamination": f"""
WITH item AS (SELECT item_id, {WORDS} AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n,
               array_to_string(w[k:k + least(len(w), 13) - 1], ' ') AS phrase
        FROM item, range(1, greatest(len(w) - 12, 1) + 1) AS t(k) WHERE len(w) > 0),
doc AS (SELECT doc_id, row_number() OVER () AS rid, coalesce({WORDS}, []) AS w FROM documents),
place AS (SELECT rid, k, size AS n, array_to_string(w[k:k + size - 1], ' ') AS phrase
          FROM doc, (SELECT DISTINCT n AS size FROM win) AS s, range(1, greatest(len(w) - size + 2, 1)) AS t(k)),
occ AS (SELECT p.rid, p.k, p.n, win.item_id FROM place AS p JOIN win ON p.phrase = win.phrase AND p.n = win.n),
hit AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM occ, range(k, k + n) AS t(pos) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
        FROM (SELECT DISTINCT rid, item_id::VARCHAR AS i FROM occ) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)""",
    "op2_chat": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
e AS (SELECT *, length(text) + length(role) + 26
             + len(regexp_extract_all(text, '[<\[]\\*(\||/?s>|/?INST\])'))
             + len(regexp_extract_all(role, '[<\[]\\*(\||/?s>|/?INST\])')) AS n FROM t),
c AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
             coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss, sum(n) AS n
      FROM e GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, n::BIGINT AS formatted_chars FROM c""",
    "op11_fim": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
                  sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
x AS (SELECT *, ('0x' || h[1:8])::UBIGINT % (n + 1) AS u, ('0x' || h[9:16])::UBIGINT % (n + 1) AS v,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR ('0x' || h[17:24])::UBIGINT % 100 >= 90
                  THEN 'plain' WHEN ('0x' || h[25:32])::UBIGINT % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
c AS (SELECT *, least(u, v)::BIGINT AS a, greatest(u, v)::BIGINT AS b FROM x),
p AS (SELECT *, substring(t, 1, a) AS pre, substring(t, a + 1, b - a) AS mid, substring(t, b + 1, n - b) AS suf FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM p""",
    "op12_vector_codes": f"""
WITH whole AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS q FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
numbered AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, q) AS r FROM whole),
parts AS MATERIALIZED (SELECT r, vec_id, label, part, q[part * len(q) // 16 + 1:(part + 1) * len(q) // 16] AS v
                       FROM numbered, range(16) AS s(part)),
books0 AS MATERIALIZED (SELECT part, r - 1 AS entry, v FROM parts WHERE r <= 64),
{_vector_round(0)},
{_vector_round(1)},
best AS MATERIALIZED (SELECT r, part, min({_DISTANCE.format(2)} * 64 + entry) AS m FROM parts JOIN books2 USING (part) GROUP BY r, part),
digest AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM books2),
coded AS (SELECT r, string_agg(lpad(lower(to_hex(m % 64)), 2, '0'), '' ORDER BY part) AS code, sum(m // 64) AS error FROM best GROUP BY r)
SELECT vec_id, code, error::BIGINT AS error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN numbered USING (r), digest""",
    "op13_lines": f"""
WITH doc AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
line AS (SELECT rid, k, ls[k] AS own, {_LINE_KEY} AS key FROM doc, range(1, len(ls) + 1) AS t(k)),
often AS (SELECT key FROM line WHERE key <> '' GROUP BY key HAVING count(DISTINCT rid) >= 10),
cut AS (SELECT rid, count(often.key) AS n_dropped,
               coalesce(string_agg(own, chr(10) ORDER BY k) FILTER (often.key IS NULL), '') AS kept
        FROM line LEFT JOIN often USING (key) GROUP BY rid)
SELECT doc_id, len(ls)::BIGINT AS n_lines, n_dropped::BIGINT AS n_dropped, sha256(kept) AS kept_sha256 FROM doc JOIN cut USING (rid)""",
}
