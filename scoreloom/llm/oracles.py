"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_CHAT = r"""
WITH given AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, 'rows' AS layout FROM conversations
    UNION ALL
    SELECT -1, turn, role, '<|im_end|><|im_start|>assistant ok', 'messages'
    FROM (VALUES (0, 'user'), (1, 'assistant')) AS said(turn, role)
), turns AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
           length(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g')) + (length(role) - length(replace(role, chr(10), '')))
               + (length(role) - length(replace(role, '\', ''))) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))
               + length('<|im_start|>') + length('<|im_end|>') + 2 AS size
    FROM given
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(size)::BIGINT AS formatted_chars, min(layout) AS layout
FROM turns GROUP BY conv_id
"""

_PHRASES = r"""
WITH pieces AS (
    SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS cut
    FROM documents
), split AS (
    SELECT doc, lang, unnest(range(1, len(cut) + 1)) AS piece, unnest(cut) AS body FROM pieces
), listed AS (
    SELECT doc, lang, piece, list_filter(string_split_regex(body, '[\x20\x09]+'), lambda w: w <> '') AS words FROM split
), placed AS (
    SELECT doc, lang, piece, unnest(range(1, len(words) + 1)) AS place, unnest(words) AS w1 FROM listed
), followed AS MATERIALIZED (
    SELECT lang, w1, lead(w1, 1) OVER follow AS w2, lead(w1, 2) OVER follow AS w3, lead(w1, 3) OVER follow AS w4
    FROM placed WINDOW follow AS (PARTITION BY doc, piece ORDER BY place)
), sizes AS (
    SELECT lang, count(*) AS n FROM placed GROUP BY lang
), phrases AS (
    SELECT lang, [w1] AS w, count(*) AS f FROM followed GROUP BY lang, w1 HAVING count(*) >= 30
    UNION ALL SELECT lang, [w1, w2], count(*) FROM followed WHERE w2 IS NOT NULL GROUP BY lang, w1, w2 HAVING count(*) >= 30
    UNION ALL SELECT lang, [w1, w2, w3], count(*) FROM followed WHERE w3 IS NOT NULL
              GROUP BY lang, w1, w2, w3 HAVING count(*) >= 30
    UNION ALL SELECT lang, [w1, w2, w3, w4], count(*) FROM followed WHERE w4 IS NOT NULL
              GROUP BY lang, w1, w2, w3, w4 HAVING count(*) >= 30
), counted AS MATERIALIZED (
    SELECT lang, array_to_string(w, ' ') AS phrase, w, f FROM phrases
), parted AS MATERIALIZED (
    SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest
    FROM (SELECT *, unnest(range(1, len(w))) AS k FROM counted)
), cuts AS (
    SELECT p.lang, p.phrase, p.a, p.k, l.f AS l, r.f AS r, ((2000000::HUGEINT * p.a) // (l.f::HUGEINT + r.f))::BIGINT AS score
    FROM parted p JOIN counted l ON l.lang = p.lang AND l.phrase = p.head JOIN counted r ON r.lang = p.lang AND r.phrase = p.rest
), scored AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_phrases AS (
    SELECT lang, f, w, m, unnest(range(1, len(w) - m + 2)) AS i
    FROM (SELECT *, unnest(range(2, len(w))) AS m FROM counted WHERE len(w) > 2)
), inside AS (
    SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(f) AS longer FROM inner_phrases GROUP BY 1, 2
), kept AS (
    SELECT s.* FROM scored s LEFT JOIN inside i ON i.lang = s.lang AND i.phrase = s.phrase
    WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * s.a
)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept k JOIN sizes z ON z.lang = k.lang
QUALIFY rank <= 2000
"""

ORACLES: dict[str, str] = {"op11_chat_format": _CHAT, "op12_collocations": _PHRASES}
