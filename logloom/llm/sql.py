"""The registered queries that SQL can express, for DuckDB."""

_WORDS = r"""
texts AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
split_words AS (
    SELECT doc_id, source, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM texts
)"""

OP1 = rf"""
WITH {_WORDS},
line_lists AS (
    SELECT *, list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM split_words
),
windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM split_words WHERE len(words) >= 5)
),
repeated AS (
    SELECT doc_id, count(DISTINCT p) AS n FROM (
        SELECT doc_id, unnest(range(i, i + 5)) AS p FROM (
            SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS times FROM windows
        ) WHERE times > 1
    ) GROUP BY doc_id
),
measured AS (
    SELECT l.doc_id, l.source,
        len(words)::BIGINT AS n_words,
        length(array_to_string(words, ''))::BIGINT AS word_chars,
        length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(r.n, 0)::BIGINT AS n_repeat_words,
        len(lines) AS n_lines
    FROM line_lists l LEFT JOIN repeated r ON l.doc_id = r.doc_id
),
failing AS (
    SELECT *, n_words < 10 AS short, n_repeat_words * 100 > n_words * 20 AS repeats,
        n_symbols * 100 > word_chars * 10 AS symbols, n_dup_lines * 100 > n_lines * 30 AS dup_lines
    FROM measured
),
hosts AS (
    SELECT source, rule, count(*) AS n, sum(failed::INT) AS k, sum(failed::INT) / count(*) AS rate FROM (
        SELECT source, 'short' AS rule, short AS failed FROM failing
        UNION ALL SELECT source, 'repeats', repeats FROM failing
        UNION ALL SELECT source, 'symbols', symbols FROM failing
        UNION ALL SELECT source, 'dup_lines', dup_lines FROM failing
    ) GROUP BY source, rule
),
priors AS (
    SELECT rule, m, CASE WHEN v > 0 THEN greatest(m * (1 - m) / v - 1, 1.0) ELSE 1.0 END AS weight
    FROM (SELECT rule, avg(rate) AS m, var_pop(rate) AS v FROM hosts GROUP BY rule)
),
verdicts AS (
    SELECT source, max((k + m * weight) / (n + weight)) > 0.5 AS host_failed
    FROM hosts JOIN priors ON hosts.rule = priors.rule GROUP BY source
)
SELECT f.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    short OR repeats AS base_failed,
    NOT (short OR repeats) AND NOT (
        host_failed AND (symbols OR dup_lines OR n_repeat_words * 100 > n_words * 10)) AS kept,
    host_failed
FROM failing f JOIN verdicts v ON f.source IS NOT DISTINCT FROM v.source
"""

OP2 = rf"""
WITH {_WORDS},
windows AS (
    SELECT doc_id, i, array_to_string(words[i:i + 19], ' ') AS w
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM split_words WHERE len(words) >= 20)
),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM (
        SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS place FROM windows
    ) WHERE place > 1
),
numbered AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS p FROM split_words
),
kept AS (
    SELECT n.doc_id, count(*) AS n, string_agg(n.word, ' ' ORDER BY n.p) AS body
    FROM numbered n LEFT JOIN gone g ON n.doc_id = g.doc_id AND n.p = g.p WHERE g.p IS NULL GROUP BY n.doc_id
)
SELECT s.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(k.n, 0))::BIGINT AS n_removed,
    sha256(coalesce(k.body, '')) AS kept_sha256
FROM split_words s LEFT JOIN kept k ON s.doc_id = k.doc_id
"""

OP13 = rf"""
WITH {_WORDS},
failing AS (
    SELECT coalesce(source, '') AS part, doc_id,
        (len(words) < 200)::INT
        + 2 * (100 * len(list_distinct(words)) < 50 * len(words))::INT
        + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
        + 8 * regexp_matches(t, '[#$%&*|]')::INT
        + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t),
                        doc_id IS NULL AND min(doc_id) OVER (PARTITION BY t) IS NOT NULL)::INT AS mask
    FROM split_words
),
counted AS (
    SELECT part, mask, count(*) AS n,
        count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)) AS n_good,
        count(*) FILTER (doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)) AS n_toxic
    FROM failing GROUP BY part, mask
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
),
steps AS (
    SELECT filter_order, step, l.x, l.bit,
        (SELECT coalesce(sum(p.bit), 0)::INT FROM letters p WHERE instr(filter_order[1:step - 1], p.x) > 0) AS before
    FROM (SELECT filter_order, unnest(range(1, 6)) AS step FROM orders) o JOIN letters l ON l.x = o.filter_order[step]
),
effects AS (
    SELECT part, filter_order, step, x,
        sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN mask & bit > 0 AND mask & before > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n_good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN mask & bit > 0 AND mask & before = 0 THEN n_toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM counted, steps GROUP BY part, filter_order, step, x
)
SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    sum(removed) OVER (PARTITION BY part, x)::BIGINT AS shapley
FROM effects
"""

OP12 = r"""
WITH cut AS (
    SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages
),
rules(rule_host, rule_path, rule_verdict) AS (VALUES
    ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
listed(host) AS (VALUES
    ('ads-track.example.com'), ('casino-win.example.net'), ('cheap-pills.example.net'), ('free-bets.example.net'),
    ('spam-farm.example.org'), ('adult-x.example.com')),
found AS (
    SELECT c.*, (
        SELECT max_by(struct_pack(rule := rule_host || rule_path, verdict := rule_verdict), length(rule_host || rule_path))
        FROM rules WHERE (c.host = rule_host OR ends_with(c.host, '.' || rule_host)) AND starts_with(c.path, rule_path)
    ) AS best, starts_with(path, '/') AND EXISTS (
        SELECT 1 FROM listed l WHERE c.host = l.host OR ends_with(c.host, '.' || l.host)) AS blocked
    FROM cut c
)
SELECT page_id, host, path, best.rule AS rule,
    coalesce(best.verdict, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM found
"""

ORACLES = {"op1_host_rules": OP1, "op2_block_anchors": OP2, "op12_url_filters": OP12, "op13_filter_audit": OP13}
