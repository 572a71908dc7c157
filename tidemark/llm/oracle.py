"""DuckDB texts of those text operators that SQL can express."""

HOST_RULES = r"""
WITH texts AS (
    SELECT doc_id, source AS host, coalesce(text, '') AS t FROM documents
), split_up AS (
    SELECT doc_id, host, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
           list_filter(string_split(t, chr(10)),
                       lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines
    FROM texts
), places AS (
    SELECT doc_id, words, unnest(generate_series(1, len(words) - 2)) AS spot
    FROM split_up WHERE len(words) >= 3
), windows AS (
    SELECT doc_id, spot, count(*) OVER (
        PARTITION BY doc_id, words[spot], words[spot + 1], words[spot + 2]) AS times
    FROM places
), covered AS (
    SELECT doc_id, count(DISTINCT spot + k) AS n_repeat_words
    FROM windows, (VALUES (0), (1), (2)) AS offsets(k)
    WHERE times > 1 GROUP BY doc_id
), measures AS (
    SELECT doc_id, host, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
           len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) AS n_lines,
           len(lines) - len(list_distinct(lines)) AS n_dup_lines,
           coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM split_up LEFT JOIN covered USING (doc_id)
), tested AS (
    SELECT *, n_words < 50 AS f1, 100 * n_repeat_words > 50 * n_words AS f2,
           n_symbols > 0.1 * n_words AS f3, n_dup_lines > 0.3 * n_lines AS f4,
           n_words > 0 AND NOT (word_chars / n_words BETWEEN 2 AND 20) AS f5
    FROM measures
), failures AS (
    SELECT host, r.rule, r.most, count(*) AS n, count(*) FILTER (r.failed) AS f
    FROM tested, LATERAL (VALUES (1, 0.8, f1), (2, 0.5, f2), (3, 0.5, f3), (4, 0.5, f4),
                                 (5, 0.5, f5)) AS r(rule, most, failed)
    GROUP BY ALL
), moments AS (
    SELECT rule, most, sum(f) / sum(n) AS m, count(*) AS hosts, sum(n) AS docs,
           sum(f * f / n) - sum(n) * (sum(f) / sum(n)) ** 2 AS excess
    FROM failures GROUP BY rule, most
), variances AS (
    -- The share of the variance that lies between hosts, beyond the chance within them.
    SELECT *, CASE WHEN m * (1 - m) > 0 AND docs > hosts
                   THEN (excess / (m * (1 - m)) - (hosts - 1)) / (docs - hosts) ELSE 0 END AS share
    FROM moments
), priors AS (
    SELECT rule, m, greatest(CASE WHEN share > 0 THEN least(1 / share - 1, 1e6) ELSE 1e6 END, 2,
                             CASE WHEN m < most THEN (1 - most) / (most - m) ELSE 0 END) AS s
    FROM variances
), verdicts AS (
    SELECT host, bool_or((f + m * s) / (n + s) > most) AS host_failed
    FROM failures JOIN priors USING (rule) GROUP BY host
)
SELECT doc_id, tested.host AS host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       f1 OR f2 AS base_failed, host_failed, NOT (f1 OR f2 OR host_failed) AS kept
FROM tested JOIN verdicts ON tested.host IS NOT DISTINCT FROM verdicts.host
"""

CHAT = r"""
WITH told AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations
    UNION ALL
    VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'),
           (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
    SELECT *, length('<|im_start|>') + length(role) + 1 + length(text)
              + len(regexp_extract_all(text, '\\'))
              + len(regexp_extract_all(text, '<\|')) + len(regexp_extract_all(text, '</?s>'))
              + len(regexp_extract_all(text, '</?SYS>'))
              + len(regexp_extract_all(text, '<</?SYS>'))
              + len(regexp_extract_all(text, '\[/?INST\]'))
              + length('<|im_end|>') + 1 AS turn_chars
    FROM told
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
           AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(turn_chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

MANIFEST = r"""
WITH RECURSIVE parts AS (
    SELECT doc_id, lang, n_chars, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
               || coalesce(strlen(source) || ':' || source, '-')
               || coalesce(strlen(lang) || ':' || lang, '-') AS before,
           coalesce(strlen(text) || ':' || text, '-') AS after,
           -- CRC-32 of the id's digits, bit by bit.
           xor(list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(
                   string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
               lambda sum, byte: list_reduce(
                   list_prepend(xor(sum, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                   lambda x, _: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) AS crc
    FROM documents
), claims AS (
    SELECT *, coalesce(strlen(n::VARCHAR) || ':' || n, '-') AS told,
           coalesce(strlen(c::VARCHAR) || ':' || c, '-') AS claimed
    FROM (SELECT *, n_chars::HUGEINT AS n,
                 n_chars::HUGEINT + CASE WHEN crc % 7 = 0 THEN 1 ELSE 0 END AS c FROM parts)
), leaves AS (
    SELECT doc_id, lang, sha256(before || told || after) AS leaf,
           sha256(before || claimed || after) AS claim FROM claims
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place
    FROM leaves
), trees AS (
    SELECT lang, 0 AS level, place, leaf AS digest FROM placed
    UNION ALL
    SELECT lang, level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place))
    FROM (SELECT *, count(*) OVER (PARTITION BY lang) AS nodes FROM trees)
    WHERE nodes > 1 GROUP BY lang, level, place // 2
), subroots AS (
    SELECT lang, height, subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS rank
    FROM (SELECT lang, level AS height, digest AS subroot FROM trees
          QUALIFY level = max(level) OVER (PARTITION BY lang))
), tops AS (
    SELECT 0 AS level, rank AS place, subroot AS digest FROM subroots
    UNION ALL
    SELECT level + 1, place // 2, sha256(string_agg(digest, '' ORDER BY place))
    FROM (SELECT *, count(*) OVER () AS nodes FROM tops)
    WHERE nodes > 1 GROUP BY level, place // 2
), root AS (
    SELECT level AS height, digest AS root FROM tops ORDER BY level DESC LIMIT 1
), ways AS (
    -- The sibling of each leaf on each level, with the side it stands on.
    SELECT p.lang, p.place, l.level, 0 AS part,
           CASE WHEN t.digest IS NULL THEN '' WHEN t.place & 1 = 0 THEN 'L' || t.digest
                ELSE 'R' || t.digest END AS sibling
    FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang,
         LATERAL (SELECT unnest(range(s.height)) AS level) l
    LEFT JOIN trees t ON t.lang IS NOT DISTINCT FROM p.lang AND t.level = l.level
         AND t.place = xor(p.place >> l.level::INTEGER, 1)
    UNION ALL
    SELECT p.lang, p.place, l.level, 1,
           CASE WHEN t.digest IS NULL THEN '' WHEN t.place & 1 = 0 THEN 'L' || t.digest
                ELSE 'R' || t.digest END
    FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang, root r,
         LATERAL (SELECT unnest(range(r.height)) AS level) l
    LEFT JOIN tops t ON t.level = l.level AND t.place = xor(s.rank >> l.level::INTEGER, 1)
), proofs AS (
    SELECT lang, place, list(sibling ORDER BY part, level) AS siblings FROM ways GROUP BY ALL
), folded AS (
    SELECT p.doc_id, p.leaf, s.subroot, r.root,
           sha256(coalesce(list_aggregate(list_transform(
               w.siblings, lambda x: x[2:]), 'string_agg', ''), '')) AS proof_sha256,
           list_reduce(list_prepend(p.claim, coalesce(w.siblings, [])),
                       lambda h, x: sha256(CASE x[1] WHEN 'L' THEN x[2:] || h
                                           ELSE h || x[2:] END)) AS folded_root
    FROM placed p JOIN subroots s ON s.lang IS NOT DISTINCT FROM p.lang, root r
    LEFT JOIN proofs w ON w.lang IS NOT DISTINCT FROM p.lang AND w.place = p.place
)
SELECT *, folded_root = root AS verified FROM folded
"""

HARD_NEGATIVES = r"""
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
           list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2]))::BIGINT AS score
    FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INT
           AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

TEXTS = {"op1_host_rules": HOST_RULES, "op10_chat": CHAT, "op12_hard_negatives": HARD_NEGATIVES,
         "op13_manifest": MANIFEST}
