"""DuckDB SQL for those operators that SQL can express."""

from __future__ import annotations

# Every kind's matches with their places: what lies between matches and the matches alternate.
_ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+"""
_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)$"""


def _spans(name: str, kind: str, order: int, pattern: str, keep: str) -> str:
    return f"""
{name}_matches AS (
    SELECT row_id, regexp_extract_all(whole, '{pattern}') AS found, string_split_regex(whole, '{pattern}') AS gaps
    FROM docs WHERE regexp_matches(whole, '{pattern}')
),
{name} AS (
    SELECT row_id, '{kind}' AS kind, {order} AS kind_order, found,
        gap_before + found_before AS span_start, gap_before + found_before + length(found) AS span_end
    FROM (
        SELECT row_id, found[k] AS found,
            list_sum(list_transform(gaps[1:k], lambda g: length(g))) AS gap_before,
            coalesce(list_sum(list_transform(found[1:k - 1], lambda g: length(g))), 0) AS found_before
        FROM (SELECT row_id, found, gaps, unnest(range(1, len(found) + 1)) AS k FROM {name}_matches)
    )
    WHERE {keep}
)"""


_LISTED = "string_agg(kind || ':' || span_start || ':' || span_end, ',' ORDER BY span_start, kind_order)"

SECRETS = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS whole, row_number() OVER () AS row_id FROM documents),
{_spans("assigns", "assign", 0, _ASSIGN, f"length(regexp_extract(found, '{_VALUE}', 1)) >= 6")},
{_spans("access", "access", 1, "AKIA[A-Z0-9]+", "length(found) >= 20")},
{_spans("hexes", "hex", 2, "[0-9a-f]+", "length(found) >= 24")},
{_spans("runs", "entropy", 3, "[A-Za-z0-9+/_=-]+", "length(found) >= 20")},
base AS (
    SELECT row_id, kind, kind_order, span_start, span_end FROM assigns UNION ALL
    SELECT row_id, kind, kind_order, span_start, span_end FROM access UNION ALL
    SELECT row_id, kind, kind_order, span_start, span_end FROM hexes
),
scored AS (
    SELECT *, list_max(list_transform(range(1, length(found) - 18), lambda k:
        list_entropy(string_split(substring(CASE WHEN regexp_full_match(found, '[0-9a-fA-F]+') THEN lower(found) ELSE found END, k, 20), '')))) AS best
    FROM runs
    WHERE regexp_matches(found, '[0-9]') AND regexp_matches(found, '[A-Za-z]')
        AND NOT regexp_matches(found, '^[0-9a-fA-F]{{8}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{4}}-[0-9a-fA-F]{{12}}$')
        AND NOT regexp_matches(found, '(?i)^(sha(1|224|256|384|512)|md5)[-_=]')
        AND NOT regexp_matches(found, '(?i)example')
        AND NOT EXISTS (
            SELECT 1 FROM base b
            WHERE b.row_id = runs.row_id AND b.span_start <= runs.span_start AND b.span_end >= runs.span_end
        )
),
added AS (
    SELECT row_id, kind, kind_order, span_start, span_end FROM scored
    WHERE best > CASE WHEN regexp_full_match(found, '[0-9a-fA-F]+') THEN 2.99
        WHEN regexp_full_match(found, '[0-9A-Za-z]+') THEN 3.73 ELSE 3.83 END
),
base_of AS (
    SELECT row_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
        count(*) FILTER (kind = 'hex') AS n_hex, {_LISTED} AS listed
    FROM base GROUP BY row_id
),
all_of AS (
    SELECT row_id, {_LISTED} AS listed, count(*) FILTER (kind = 'entropy') AS n_entropy
    FROM (SELECT * FROM base UNION ALL SELECT * FROM added) GROUP BY row_id
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
    sha256(coalesce(b.listed, '')) AS base_sha256, coalesce(a.listed, '') AS spans, coalesce(n_entropy, 0) AS n_entropy
FROM docs LEFT JOIN base_of b USING (row_id) LEFT JOIN all_of a USING (row_id)
"""

URLS = r"""
WITH parsed AS (
    SELECT page_id,
        CASE WHEN contains(url, '://') THEN translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
        CASE WHEN contains(url, '://') THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
    FROM (SELECT page_id, url, substring(url, strpos(url, '://') + 3) AS rest FROM pages)
),
rules(rule_host, rule_path, verdict) AS (
    VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
)
SELECT page_id, host, path,
    (SELECT rule_host || rule_path FROM rules
     WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
     ORDER BY length(rule_host || rule_path) DESC LIMIT 1) AS rule,
    coalesce((SELECT verdict FROM rules
     WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
     ORDER BY length(rule_host || rule_path) DESC LIMIT 1), 'allow') AS verdict
FROM parsed
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LEAKS = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS words FROM benchmark),
windows AS (
    SELECT item, words[k:k + 9] AS phrase, len(words[k:k + 9]) AS size
    FROM (SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS k FROM items WHERE len(words) > 0)
),
docs AS (SELECT row_number() OVER () AS row_id, doc_id, {_WORDS} AS words FROM documents),
sizes AS (SELECT DISTINCT size FROM windows),
places AS (
    SELECT row_id, k, size, words[k:k + size - 1] AS phrase
    FROM (SELECT row_id, words, size, unnest(range(1, len(words) - size + 2)) AS k FROM docs, sizes WHERE len(words) >= size)
),
hits AS (SELECT row_id, k, p.size, item FROM places p JOIN windows w ON p.phrase = w.phrase),
hit_words AS (
    SELECT row_id, count(DISTINCT place) AS n_hit
    FROM (SELECT row_id, unnest(range(k, k + size)) AS place FROM (SELECT DISTINCT row_id, k, size FROM hits)) GROUP BY row_id
),
hit_items AS (SELECT row_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT row_id, item FROM hits) GROUP BY row_id)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (row_id) LEFT JOIN hit_items USING (row_id)
"""

# All words of a full window, each as often as there, among 12 words from one of them on that don't hold the window.
NEAR = f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS words FROM benchmark),
windows AS (
    SELECT row_number() OVER () AS wid, phrase FROM (
        SELECT DISTINCT words[k:k + 9] AS phrase FROM (SELECT words, unnest(range(1, len(words) - 8)) AS k FROM items WHERE len(words) >= 10)
    )
),
window_items AS (
    SELECT DISTINCT wid, item FROM windows JOIN (
        SELECT item, words[k:k + 9] AS phrase FROM (SELECT item, words, unnest(range(1, len(words) - 8)) AS k FROM items WHERE len(words) >= 10)
    ) USING (phrase)
),
docs AS (SELECT row_number() OVER () AS row_id, doc_id, {_WORDS} AS words FROM documents),
doc_words AS (SELECT row_id, k, words[k] AS word FROM (SELECT row_id, words, unnest(range(1, len(words) + 1)) AS k FROM docs)),
counts AS (SELECT word, count(*) AS n FROM doc_words GROUP BY word),
rarest AS (SELECT wid, arg_min(word, n) AS word FROM (SELECT wid, unnest(phrase) AS word FROM windows) JOIN counts USING (word) GROUP BY wid),
begins AS (
    SELECT DISTINCT row_id, wid, begin FROM (
        SELECT row_id, wid, unnest(range(greatest(k - 11, 1), k + 1)) AS begin FROM doc_words JOIN rarest USING (word)
    )
),
places AS (SELECT row_id, wid, begin AS k, phrase, words[begin:begin + 11] AS around FROM begins JOIN docs USING (row_id) JOIN windows USING (wid)),
near AS (
    SELECT row_id, k, wid FROM places
    WHERE list_contains(phrase, around[1]) AND list_has_all(around, phrase)
        AND len(list_filter(phrase, lambda w: len(list_filter(around, lambda a: a = w)) < len(list_filter(phrase, lambda p: p = w)))) = 0
        AND around[1:10] <> phrase AND around[2:11] <> phrase AND around[3:12] <> phrase
)
SELECT doc_id, coalesce(n_near, 0) AS n_near, coalesce(near_items, '') AS near_items
FROM docs LEFT JOIN (SELECT row_id, count(DISTINCT k) AS n_near FROM near GROUP BY row_id) USING (row_id)
LEFT JOIN (SELECT row_id, string_agg(DISTINCT item, ',' ORDER BY item) AS near_items FROM near JOIN window_items USING (wid) GROUP BY row_id) USING (row_id)
"""

# CRC-32 is folded over the bytes of each distinct word, with the table of its 256 remainders.
RESAMPLED = f"""
WITH docs AS (SELECT row_number() OVER () AS row_id, doc_id, {_WORDS} AS words FROM documents),
doc_words AS (SELECT row_id, word, count(*) AS n FROM (SELECT row_id, unnest(words) AS word FROM docs) GROUP BY ALL),
item_words AS (SELECT word, count(*) AS n FROM (SELECT unnest({_WORDS}) AS word FROM benchmark) GROUP BY ALL),
remainders AS (
    SELECT list(r ORDER BY k) AS rs FROM (
        SELECT k, list_reduce([k, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS r
        FROM range(256) t(k)
    )
),
spelled AS (
    SELECT word, list_transform(range(1, octet_length(encode(word)) + 1), lambda k:
        CAST('0x' || substring(hex(encode(word)), 2 * k - 1, 2) AS BIGINT)) AS bytes
    FROM (SELECT word FROM doc_words UNION SELECT word FROM item_words)
),
buckets AS (
    SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, bytes), lambda c, b: xor(rs[(xor(c, b) & 255) + 1], c >> 8))) % 10000 AS bucket
    FROM spelled, remainders
),
s AS (SELECT bucket, sum(n) AS s FROM doc_words JOIN buckets USING (word) GROUP BY bucket),
t AS (SELECT bucket, sum(n) AS t FROM item_words JOIN buckets USING (word) GROUP BY bucket),
gains AS (
    SELECT bucket, CAST(floor(1000 * ln(
        ((coalesce(t, 0) + 1) * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE)
        / ((coalesce(s, 0) + 1) * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE))) AS BIGINT) AS gain
    FROM s FULL JOIN t USING (bucket)
),
weights AS (SELECT row_id, CAST(sum(n * gain) AS BIGINT) AS weight FROM doc_words JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY row_id),
scored AS (
    SELECT row_id, doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
        (CAST('0x' || substring(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
    FROM docs LEFT JOIN weights USING (row_id)
),
ranked AS (SELECT row_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= (10 * n) // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (row_id)
"""

SQL = {"op6_near_passages": NEAR, "op11_importance_resampling": RESAMPLED, "op6_benchmark_decontamination": LEAKS, "op4_secret_scans": SECRETS, "op7_url_filters": URLS}
