"""DuckDB twins of the operator queries that SQL can express."""

from __future__ import annotations

#: CRC-32 over the UTF-8 bytes, by the usual table of 256 words.
_CRC = """
    crc_words AS (
        SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
            lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS w
    )"""


def _crc(text: str) -> str:
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: ('0x' || h)::BIGINT)),
        lambda c, x: xor(c >> 8, w[(xor(c, x) & 255) + 1])), 4294967295)"""


_OP2 = f"""
WITH RECURSIVE {_CRC},
    facts AS (
        SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 1 AS size, {_crc("coalesce(text, '')")} AS text_crc32
        FROM documents, crc_words
    ),
    numbered AS (
        SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS row_no,
            count(*) OVER () AS n, ceil(sqrt(count(*) OVER ()))::BIGINT AS a
        FROM facts
    ),
    sized AS (SELECT *, (n + a - 1) // a AS b FROM numbered),
    walk AS (
        SELECT row_no, n, a, b, row_no % a AS l, row_no // a AS r, 0 AS k FROM sized
        UNION ALL
        SELECT row_no, n, a, b,
            CASE WHEN k % 2 = 0 THEN (l + ('0x' || left(md5('20:' || (k % 4) || ':' || r), 15))::BIGINT % a) % a ELSE l END,
            CASE WHEN k % 2 = 0 THEN r ELSE (r + ('0x' || left(md5('20:' || (k % 4) || ':' || l), 15))::BIGINT % b) % b END,
            k + 1
        FROM walk WHERE k = 0 OR k % 4 <> 0 OR r * a + l >= n
    ),
    placed AS (SELECT row_no, r * a + l AS place FROM walk WHERE k > 0 AND k % 4 = 0 AND r * a + l < n)
SELECT doc_id, size, text_crc32, 'rows' AS law, (place % 8)::INTEGER AS shard, place // 8 AS slot,
    NULL::INTEGER AS grown_shard, row_no
FROM sized JOIN placed USING (row_no)
"""

_OP1 = """
WITH RECURSIVE good AS (
        SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    ),
    links AS (
        SELECT a.vec_id AS x, b.vec_id AS y FROM good a JOIN good b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
        WHERE list_cosine_similarity(a.v, b.v) >= 0.98
    ),
    reach AS (
        SELECT vec_id AS x, vec_id AS y FROM embeddings
        UNION
        SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y
    ),
    part AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
    counted AS (SELECT x AS vec_id, count(*) AS n_links FROM links GROUP BY x)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN part USING (vec_id) LEFT JOIN counted USING (vec_id)
"""

_OP3 = """
WITH words AS (
        SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
        FROM (SELECT doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents)
    ),
    good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING bool_and(coalesce(quality = 1 AND toxic = 0, false))),
    flagged AS (SELECT words.*, good.doc_id IS NOT NULL AS t FROM words LEFT JOIN good USING (doc_id)),
    totals AS (SELECT coalesce(sum(strlen(text)) FILTER (good.doc_id IS NOT NULL), 0)::DOUBLE AS part, sum(strlen(text))::DOUBLE AS whole FROM documents LEFT JOIN good USING (doc_id)),
    sizes AS (SELECT CASE WHEN part > 0 THEN part / whole ELSE 1 END AS scale FROM totals),
    chains AS (SELECT doc_id, t, w, coalesce(lag(w) OVER (PARTITION BY doc_id ORDER BY i), ' ') AS u FROM flagged),
    contexts AS (SELECT u, count(*) * any_value(scale) AS b, count_if(t)::DOUBLE AS t FROM chains, sizes GROUP BY u),
    bigrams AS (SELECT u, w, count(*) * any_value(scale) AS b, count_if(t)::DOUBLE AS t FROM chains, sizes GROUP BY u, w),
    losses AS (
        SELECT doc_id, ln(0.75::DOUBLE * x.t + 0.25::DOUBLE * x.b + 5) - ln(0.75::DOUBLE * g.t + 0.25::DOUBLE * g.b) AS lt, ln(x.b + 5) - ln(g.b) AS lb
        FROM chains c JOIN bigrams g ON g.u = c.u AND g.w = c.w JOIN contexts x ON x.u = c.u
    ),
    means AS (SELECT doc_id, count(*) AS n, avg(lt) AS lt, avg(lb) AS lb FROM losses GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_tokens, round(lt, 6) AS target_loss, round(lb, 6) AS background_loss,
    round(lb - lt, 6) AS score, coalesce(lb - lt > 0, false) AS kept
FROM documents LEFT JOIN means USING (doc_id)
"""

ORACLES: dict[str, str] = {"op1_vector_dedup": _OP1, "op2_sharding": _OP2, "op3_lm_score": _OP3}
