"""DuckDB SQL for the queries that SQL can express."""

from paperloom.llm.licenses import TEMPLATES

CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
placed AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
    length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) AS chars,
    length(regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(\\*)\|', '<\\\1|', 'g')) AS role_chars
  FROM turns),
merged AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS lines,
    coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS learned,
    sum(chars + CASE WHEN before = role THEN 11 ELSE 12 + role_chars + 1 + 11 END) AS formatted
  FROM placed GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(lines) AS turns_sha256, length(learned) AS loss_chars,
  sha256(learned) AS loss_sha256, CAST(formatted AS BIGINT) AS formatted_chars
FROM merged
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_TEMPLATES = ", ".join(f"({i}, '{t.label}', {t.phrase}, '{t.text}')" for i, t in enumerate(TEMPLATES))

LICENSES = f"""
WITH template(template, label, phrase, text) AS (VALUES {_TEMPLATES}),
template_words AS (SELECT template, label, phrase, {_WORDS} AS w FROM template),
template_grams AS (
  SELECT template, label, phrase, len(w) AS length, t_pos, w[t_pos + 1] AS a, w[t_pos + 2] AS b, w[t_pos + 3] AS c
  FROM template_words, unnest(range(0, len(w) - 2)) AS u(t_pos)),
texts AS (SELECT doc_id, {_WORDS} AS w FROM documents),
grams AS (
  SELECT doc_id, pos, w[pos + 1] AS a, w[pos + 2] AS b, w[pos + 3] AS c
  FROM texts, unnest(range(0, greatest(len(w) - 2, 0))) AS u(pos)),
votes AS (
  SELECT doc_id, template, label, phrase, length, pos - t_pos AS diagonal, count(*) AS votes, min(pos) AS lo, max(pos) AS hi
  FROM grams JOIN template_grams USING (a, b, c) GROUP BY ALL),
stepped AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER along <= 2 THEN 0 ELSE 1 END AS apart
  FROM votes WINDOW along AS (PARTITION BY doc_id, template ORDER BY diagonal)),
merged AS (SELECT *, sum(apart) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS cluster FROM stepped),
clusters AS (
  SELECT doc_id, template, label, phrase, length, cluster, sum(votes) AS votes, min(lo) AS lo, max(hi) AS hi,
    count(*) FILTER (phrase AND votes = length - 2) AS places,
    min(diagonal) FILTER (phrase AND votes = length - 2) AS first_word,
    max(diagonal) FILTER (phrase AND votes = length - 2) AS last_word
  FROM merged GROUP BY ALL),
covered AS (
  SELECT *, CASE WHEN hi - lo + 3 <= length + 2 OR places > 0
    THEN least(1.0::DOUBLE, votes::DOUBLE / (length - 2)) ELSE 0.0::DOUBLE END AS cover FROM clusters),
found AS (
  SELECT doc_id, sum(places) AS n_base, min(first_word) AS first_word, max(last_word) AS last_word, max(cover) AS score,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (places > 0) AS base_labels,
    string_agg(DISTINCT label, ',' ORDER BY label) FILTER (cover >= 0.8) AS labels
  FROM covered GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0::DOUBLE) AS score
FROM texts LEFT JOIN found USING (doc_id)
"""

WARC = """
WITH payload AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
first AS (SELECT payload_digest, min(page_id) AS first FROM payload WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > first THEN first END AS refers_to
FROM payload LEFT JOIN first USING (payload_digest)
"""

PHRASES = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
lines AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
words AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM lines GROUP BY lang),
grams AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM lines, unnest(range(1, 6)) AS u(m), unnest(range(1, greatest(len(w) - m + 2, 1))) AS v(i)),
counted AS (SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE m > 1),
held AS (
  SELECT DISTINCT c.lang, c.phrase FROM candidates c JOIN candidates o
    ON c.lang = o.lang AND o.m > c.m AND 100 * o.f >= 100 * c.f AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' ')),
cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
  FROM candidates, unnest(range(1, m)) AS u(k)
  WHERE (lang, phrase) NOT IN (SELECT (lang, phrase) FROM held)),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, k, x.f AS l, y.f AS r, n,
    CAST((1000::HUGEINT * a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts JOIN counted x ON x.lang = cuts.lang AND x.phrase = cuts.first
    JOIN counted y ON y.lang = cuts.lang AND y.phrase = cuts.rest JOIN words ON words.lang = cuts.lang),
best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""

ORACLES = {"op3_chat_formatting": CHAT, "op7_warc": WARC, "op8_license_scan": LICENSES, "op12_phrase_collocations": PHRASES}
