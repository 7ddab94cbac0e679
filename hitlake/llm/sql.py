"""The same results in DuckDB SQL, where SQL can say them."""

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATE = rf"""
WITH item_words AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL
), item_windows AS (
    SELECT DISTINCT item, least(13, len(w)) AS n, unnest([array_to_string(w[i : i + least(13, len(w)) - 1], ' ')
        FOR i IN range(1, len(w) - least(13, len(w)) + 2)]) AS win
    FROM item_words WHERE len(w) > 0
), doc_words AS (
    SELECT doc_id, row_number() OVER () AS uid,
        coalesce(regexp_extract_all({LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
    FROM documents
), doc_windows AS (
    SELECT uid, n, unnest(range(1, len(w) - n + 2)) AS start,
        unnest([array_to_string(w[i : i + n - 1], ' ') FOR i IN range(1, len(w) - n + 2)]) AS win
    FROM doc_words, (SELECT DISTINCT n FROM item_windows)
), found AS (
    SELECT uid, start, doc_windows.n AS n, item FROM doc_windows JOIN item_windows USING (n, win)
), hit AS (
    SELECT uid, count(DISTINCT place) AS n_hit FROM (SELECT uid, unnest(range(start, start + n)) AS place FROM found) GROUP BY uid
), owners AS (
    SELECT uid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT uid, item FROM found) GROUP BY uid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc_words LEFT JOIN hit USING (uid) LEFT JOIN owners USING (uid)
"""

MIX_SOURCES = """
WITH sizes AS (
    SELECT source, CASE WHEN sum(coalesce(length(text), 0)) > 0 THEN sum(coalesce(length(text), 0)) ELSE count(*) END AS size
    FROM documents GROUP BY source
), rates AS (
    SELECT source, sqrt(size) / (SELECT sum(sqrt(size)) FROM sizes) * (SELECT sum(size) FROM sizes) / size AS rate FROM sizes
), terms AS (
    SELECT source, rate, unnest(range(CAST(ceil(rate + 12 * sqrt(rate) + 20) AS BIGINT) + 1)) AS k FROM rates
), cdf AS (
    SELECT source, sum(exp(k * ln(rate) - rate - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS p FROM terms
), draws AS (
    SELECT doc_id, source, text, '6:' || coalesce(CAST(doc_id AS VARCHAR), '-') AS key,
        CAST('0x' || substr(md5('6:' || coalesce(CAST(doc_id AS VARCHAR), '-')), 1, 13) AS BIGINT) / pow(2, 52) AS u
    FROM documents
), counts AS (
    SELECT *, (SELECT count(*) FROM cdf WHERE cdf.source IS NOT DISTINCT FROM draws.source AND p <= u) AS n FROM draws
), copies AS (
    SELECT *, unnest(range(n)) AS copy FROM counts
)
SELECT doc_id, source, text, copy, md5(key || ':' || copy) AS shuffle_key FROM copies
"""

QUALITY_RULES = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, source, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS l
    FROM documents
), windows AS (
    SELECT row, unnest(range(1, len(w) - 1)) AS place, unnest([array_to_string(w[i : i + 2], ' ') FOR i IN range(1, len(w) - 1)]) AS win
    FROM docs WHERE len(w) >= 3
), repeated AS (
    SELECT row, place FROM windows QUALIFY count(*) OVER (PARTITION BY row, win) > 1
), covered AS (
    SELECT row, count(DISTINCT word) AS n FROM (SELECT row, unnest(range(place, place + 3)) AS word FROM repeated) GROUP BY row
), lines AS (
    SELECT row, source, line, lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS form,
        len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words
    FROM (SELECT row, source, unnest(l) AS line FROM docs)
), frequent AS (
    SELECT source, form FROM lines GROUP BY source, form HAVING count(DISTINCT row) > 10
), lost AS (
    SELECT row, CAST(sum(words) AS BIGINT) AS words
    FROM lines JOIN frequent ON lines.form = frequent.form AND lines.source IS NOT DISTINCT FROM frequent.source GROUP BY row
), figures AS (
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
        CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
        coalesce(words, 0) AS lost_words
    FROM docs LEFT JOIN covered USING (row) LEFT JOIN lost USING (row)
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM figures
)
SELECT *, NOT base_failed AND 100 * lost_words <= 50 * n_words AS kept FROM judged
"""

WARC = """
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS bytes, sha256(coalesce(html, '')) AS digest FROM pages
), owned AS (
    SELECT *, CASE WHEN bytes >= 100 THEN min(page_id) OVER (PARTITION BY digest) END AS owner FROM payloads
)
SELECT page_id, bytes AS payload_bytes, digest AS payload_digest,
    CASE WHEN owner IS NULL OR page_id IS NOT DISTINCT FROM owner THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN owner IS NOT NULL AND page_id IS DISTINCT FROM owner THEN owner END AS refers_to
FROM owned
"""

# The length of the formatted text depends on the template; each control string found costs one backslash.
CHAT_FORMAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
    SELECT *, len(regexp_extract_all(role || chr(10) || text, '<\\*(?:\|(?:turn|text|end|im_start|im_end|endoftext)\|>|/?s>|</?SYS>>)|\[\\*/?INST\]')) AS n_escapes
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length(role) + length(text) + n_escapes + 23) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

# CRC-32 of the distinct strings s of the table ``keys`` as crcs(s, crc). It is linear: every byte, by its distance from
# the end, contributes a value of its own, and the string's length another one.
CRC32 = """
byte_values AS (SELECT unnest(range(256)) AS b),
crc_table AS (
    SELECT b, list_reduce([b] || range(8), lambda c, _: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS t FROM byte_values
),
crc_bytes AS (
    SELECT s, n, unnest(range(n)) AS place, unnest([CAST('0x' || h[2 * i + 1 : 2 * i + 2] AS INTEGER) FOR i IN range(n)]) AS b
    FROM (SELECT s, hex(encode(s)) AS h, octet_length(encode(s)) AS n FROM (SELECT DISTINCT s FROM keys))
),
crc_places(distance, b, t) AS (
    SELECT CAST(0 AS BIGINT), b, t FROM crc_table
    UNION ALL
    SELECT distance + 1, p.b, xor(p.t >> 8, c.t) FROM crc_places AS p JOIN crc_table AS c ON c.b = p.t & 255
    WHERE distance < (SELECT max(n) FROM crc_bytes)
),
crc_lengths(n, state) AS (
    SELECT CAST(0 AS BIGINT), CAST(4294967295 AS BIGINT)
    UNION ALL
    SELECT n + 1, xor(state >> 8, t) FROM crc_lengths JOIN crc_table ON b = state & 255 WHERE n < (SELECT max(n) FROM crc_bytes)
),
crcs AS (
    SELECT s, xor(bit_xor(p.t), any_value(xor(l.state, 4294967295))) AS crc
    FROM crc_bytes AS y JOIN crc_places AS p ON p.distance = y.n - 1 - y.place AND p.b = y.b JOIN crc_lengths AS l ON l.n = y.n
    GROUP BY s
)"""

VARIANTS = rf"""
WITH RECURSIVE runs AS (
    SELECT doc_id, unnest(regexp_extract_all({LOWER.format("text")}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents
), keys AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS s, run, count(*) AS times FROM runs WHERE length(run) >= 6 GROUP BY ALL
), {CRC32}, spelled AS (
    SELECT CASE WHEN crc % 199 = 0 THEN run[1 : crc % length(run)] || run[crc % length(run) + 2 :] ELSE run END AS word, times
    FROM keys JOIN crcs USING (s)
), vocabulary AS (
    SELECT word, CAST(sum(times) AS BIGINT) AS n FROM spelled WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5
), places AS (
    SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocabulary
), changed AS (
    SELECT word, n, i, word[1 : i - 1] || word[i + 1 :] AS rest FROM places
), near AS (
    SELECT a.word, b.word AS other, b.n AS other_n FROM changed AS a JOIN changed AS b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION SELECT a.word, b.word, b.n FROM changed AS a JOIN vocabulary AS b ON a.rest = b.word
    UNION SELECT b.word, a.word, a.n FROM changed AS a JOIN vocabulary AS b ON a.rest = b.word
), nearest AS (
    SELECT word, count(*) AS n_near, min((-other_n, other)) AS best FROM near GROUP BY word
), formed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 5 * n THEN best[2] END AS form,
        CASE WHEN -best[1] >= 5 * n THEN -best[1] END AS form_n
    FROM vocabulary LEFT JOIN nearest USING (word)
), chains(word, root) AS (
    SELECT word, word FROM formed
    UNION ALL
    SELECT c.word, f.form FROM chains AS c JOIN formed AS f ON c.root = f.word WHERE f.form IS NOT NULL
), ends AS (
    SELECT c.word, c.root FROM chains AS c JOIN formed AS f ON c.root = f.word WHERE f.form IS NULL
)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN ends USING (word)
"""

REPAIR = rf"""
WITH RECURSIVE given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS s
    FROM conversations
), keys AS (SELECT DISTINCT s FROM given), {CRC32}, damaged AS (
    SELECT conv_id, turn, CASE WHEN crc % 20 = 4 THEN 'user' ELSE role END AS role,
        CASE crc % 20 WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
        unnest(CASE WHEN crc % 20 = 3 THEN [0, 1] ELSE [0] END) AS time
    FROM given JOIN crcs USING (s) WHERE crc % 20 <> 0
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
), shown AS (
    SELECT *, left(role, 1) AS initial, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS last,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS time_said FROM placed
), rows AS (
    SELECT conv_id, i, turn, role, text, initial, lead(initial) OVER (PARTITION BY conv_id ORDER BY i) AS following,
        CASE WHEN last = '' THEN 'blank' WHEN time_said > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'sound' END AS fault
    FROM shown
), facts AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
        count(*) FILTER (following IS NOT NULL AND initial || following NOT IN ('su', 'ua', 'au')) AS illegal
    FROM rows GROUP BY conv_id
), said(initial, before, behind) AS (
    VALUES ('s', '0', 's'), ('u', '0', 'u'), ('u', 's', 'u'), ('u', 'a', 'u'), ('a', 'u', 'a')
), inserted(before, behind, cost, letters) AS (
    VALUES ('0', '0', 0, ''), ('s', 's', 0, ''), ('u', 'u', 0, ''), ('a', 'a', 0, ''), ('0', 'u', 3, 'I'), ('s', 'u', 3, 'I'), ('a', 'u', 3, 'I'),
        ('u', 'a', 3, 'I'), ('0', 'a', 6, 'II'), ('s', 'a', 6, 'II')
), edits AS (
    SELECT conv_id, i, before, behind, CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS cost, 'K' AS letter
    FROM rows JOIN said USING (initial) WHERE fault IN ('sound', 'truncated')
    UNION ALL
    SELECT conv_id, i, before, behind, CASE WHEN fault = 'truncated' THEN 6 ELSE 3 END, 'R'
    FROM rows, said WHERE fault IN ('sound', 'truncated') AND said.initial <> 's'
    UNION ALL
    SELECT conv_id, i, state, state, 4, 'D' FROM rows, (VALUES ('0'), ('s'), ('u'), ('a')) AS states(state)
), ways(conv_id, i, state, label) AS (
    SELECT conv_id, CAST(0 AS BIGINT), behind, (CAST(cost AS BIGINT), letters) FROM facts, inserted WHERE before = '0'
    UNION ALL
    SELECT w.conv_id, w.i + 1, s.behind, min((w.label[1] + e.cost + s.cost, w.label[2] || e.letter || s.letters))
    FROM ways AS w JOIN edits AS e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.i = w.i + 1 AND e.before = w.state
        JOIN inserted AS s ON s.before = e.behind
    GROUP BY w.conv_id, w.i, s.behind
), verdicts AS (
    SELECT w.conv_id, min(w.label)[1] AS cost, min(w.label)[2] AS audit
    FROM ways AS w JOIN facts AS f ON w.conv_id IS NOT DISTINCT FROM f.conv_id AND w.i = f.n WHERE w.state IN ('0', 'a') GROUP BY w.conv_id
), letters AS (
    SELECT conv_id, unnest(range(1, length(audit) + 1)) AS j, unnest(string_split(audit, '')) AS letter FROM verdicts WHERE audit <> ''
), read AS (
    SELECT *, count(*) FILTER (letter <> 'I') OVER upto AS i, count(*) FILTER (letter <> 'D') OVER upto AS place
    FROM letters WINDOW upto AS (PARTITION BY conv_id ORDER BY j)
), turns AS (
    SELECT read.conv_id, place, letter, rows.role, coalesce(rows.text, '') AS text,
        bool_or(place = 1 AND letter = 'K' AND rows.initial = 's') OVER (PARTITION BY read.conv_id) AS led
    FROM read LEFT JOIN rows ON rows.conv_id IS NOT DISTINCT FROM read.conv_id AND rows.i = read.i AND letter <> 'I'
    WHERE letter <> 'D'
), repaired AS (
    SELECT conv_id, string_agg(CASE WHEN letter = 'K' THEN role WHEN (place - CASE WHEN led THEN 1 ELSE 0 END) % 2 = 1 THEN 'user' ELSE 'assistant' END
        || ':' || text, chr(10) ORDER BY place) AS whole
    FROM turns GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS c LEFT JOIN facts AS f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
    LEFT JOIN verdicts AS v ON v.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN repaired AS r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""
