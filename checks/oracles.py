"""SQL for DuckDB that states what each registered query must return.

Written from the rules, over the same tables, without looking at how the Spark side
gets there: hits by joining papers with terms, merges by ranking, and so on.
"""

from __future__ import annotations

from checks.fixture import CONFIG, CONTEXT_GATES, OTHER_CONFIG, PAPERS_SQL
from paperloom.config import FilterConfig

# Matches every white space character the compaction rule names.
WS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]+"


def quoted(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def values(name: str, columns: str, rows: list[tuple]) -> str:
    body = ", ".join(
        "(" + ", ".join(quoted(v) if isinstance(v, str) else str(v) for v in row) + ")"
        for row in rows
    )
    return f"{name}({columns}) AS (VALUES {body})"


def in_list(names) -> str:
    return "(" + ", ".join(quoted(n) for n in names) + ")"


# Stated here, not taken from the library: which categories stand in for anchors, and the keywords.
ANCHORS = {CONFIG: ["src0", "src1", "src2", "src3"], OTHER_CONFIG: [f"src{i}" for i in range(8)]}
KEYWORDS = {
    CONFIG: ["of the", "in the", "heit", "ción", "edst", "on the", "with the", "ouer", "tiea"],
    OTHER_CONFIG: ["on the", "heit", "ouer", "of the", "in the", "heit"],
}


def score_ctes(config: FilterConfig, papers: str = "papers", tag: str = "") -> str:
    """CTEs ``hits``, ``gate`` and ``scored`` (with ``tag`` appended) for one config."""
    tiers = (
        [("core", i, t) for i, t in enumerate(config.core_terms)]
        + [("adjacent", i, t) for i, t in enumerate(config.adjacent_terms)]
        + [("exclude", i, t) for i, t in enumerate(config.exclude_terms)]
        + [("anchor", i, t) for i, t in enumerate(config.anchor_terms)]
    )
    return f"""
{values(f"terms{tag}", "tier, ordinal, term", tiers)},
hits{tag} AS (
  SELECT p.paper_id, t.tier, t.ordinal, t.term,
    CASE WHEN contains(lower(p.title), t.term) THEN 'title' ELSE 'summary' END AS place
  FROM {papers} p JOIN terms{tag} t
    ON contains(lower(p.title), t.term) OR contains(lower(p.summary), t.term)
),
points{tag} AS (
  SELECT paper_id, bool_or(tier = 'anchor') AS anchor_hit,
    sum(CASE WHEN tier = 'core' AND place = 'title' THEN 4
             WHEN tier = 'core' THEN 2
             WHEN tier = 'adjacent' AND place = 'title' THEN 2
             WHEN tier = 'adjacent' THEN 1
             WHEN tier = 'exclude' THEN -3 ELSE 0 END) AS pts
  FROM hits{tag} GROUP BY paper_id
),
gate{tag} AS (
  SELECT p.paper_id,
    p.primary_category IN {in_list(ANCHORS[config])} OR coalesce(h.anchor_hit, false) AS has_anchor,
    CAST(coalesce(h.pts, 0)
      + CASE WHEN p.primary_category IN {in_list(config.categories)} THEN 1 ELSE 0 END AS INT) AS raw_score
  FROM {papers} p LEFT JOIN points{tag} h ON p.paper_id = h.paper_id
),
scored{tag} AS (
  SELECT p.*, g.has_anchor, g.raw_score, s.score,
    CASE WHEN s.score >= 6 THEN 'core' WHEN s.score >= 3 THEN 'adjacent' ELSE 'unlikely' END AS label
  FROM {papers} p JOIN gate{tag} g ON p.paper_id = g.paper_id
  JOIN (SELECT paper_id,
          CAST(CASE WHEN has_anchor THEN raw_score ELSE least(raw_score, 2) END AS INT) AS score
        FROM gate{tag}) s ON p.paper_id = s.paper_id
)"""


REASONS = f"""
reasons AS (
  SELECT paper_id, string_agg(reason, '|' ORDER BY reason) AS reasons, string_agg(reason, ', ' ORDER BY reason) AS why
  FROM (
    SELECT DISTINCT paper_id, place || ':' || term AS reason FROM hits WHERE tier IN ('core', 'adjacent')
    UNION SELECT paper_id, 'exclude:' || term FROM hits WHERE tier = 'exclude'
    UNION SELECT paper_id, 'category:' || primary_category FROM papers
      WHERE primary_category IN {in_list(CONFIG.categories)}
    UNION SELECT paper_id, 'no-anchor' FROM gate WHERE NOT has_anchor
  ) GROUP BY paper_id
)"""

def candidate_ctes(window: str, config: FilterConfig = CONFIG, papers: str = "papers", tag: str = "") -> str:
    words = [(i // 6 + 1, i, term) for i, term in enumerate(KEYWORDS[config])]
    return f"""
{values(f"cats{tag}", "ordinal, category", list(enumerate(config.categories)))},
{values(f"words{tag}", "chunk, ordinal, term", words)},
inside{tag} AS (SELECT * FROM {papers} WHERE {window}),
by_category{tag} AS (
  SELECT p.paper_id, p.published, c.ordinal AS source_ordinal, 'category:' || c.category AS source_name
  FROM inside{tag} p JOIN cats{tag} c ON list_contains(p.categories, c.category)
),
by_keyword{tag} AS (
  SELECT DISTINCT p.paper_id, p.published, {len(config.categories)} - 1 + w.chunk AS source_ordinal,
    'keyword_chunk_' || w.chunk AS source_name
  FROM inside{tag} p JOIN words{tag} w
    ON contains(lower(p.title), lower(w.term)) OR contains(lower(p.summary), lower(w.term))
),
every{tag} AS (SELECT * FROM by_category{tag} UNION ALL SELECT * FROM by_keyword{tag}),
tagged{tag} AS (
  SELECT paper_id, min(source_ordinal) AS source_ordinal,
    string_agg(DISTINCT source_name, '|' ORDER BY source_name) AS sources
  FROM every{tag} GROUP BY paper_id
)"""


IN_WINDOW = "published >= '2024-01-01' AND published < '2024-04-01'"
SCORES = score_ctes(CONFIG)
TRIAGED = f"""{SCORES}, {candidate_ctes("true")},
triaged AS (SELECT s.*, t.sources FROM scored s JOIN tagged t ON s.paper_id = t.paper_id)"""
YEAR = f"""{SCORES}, {candidate_ctes("true")},
year AS (
  SELECT s.*, t.sources, CAST(left(published, 10) AS DATE) AS d
  FROM scored s JOIN tagged t ON s.paper_id = t.paper_id
)"""
MONTHS = "['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec']"


def week_sql(day: str) -> str:
    k = f"((day({day}) - 1) // 7)"
    start = f"CAST(date_trunc('month', {day}) AS DATE) + CAST({k} * 7 AS INT)"
    return (
        f"year({day}) || '_' || {MONTHS}[month({day})] || '_Wk' || ({k} + 1) AS window_slug, "
        f"{start} AS window_start, least({start} + 6, last_day({day})) AS window_end"
    )


WEEKS = f"""
weeks AS (
  SELECT DISTINCT {week_sql("d")}, (month(d) - 1) * 5 + (day(d) - 1) // 7 + 1 AS run_id
  FROM (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-12-31', INTERVAL 1 DAY)) AS DATE) AS d)
)"""

THREE_RUNS = f"""{score_ctes(CONFIG)}, {score_ctes(OTHER_CONFIG, tag="2")},
runs AS (
  SELECT 1::BIGINT AS run_id, paper_id, title, published, primary_category, score, label FROM scored
  UNION ALL
  SELECT 2, paper_id, title || ' (v2)', published, primary_category, score, label FROM scored2
    WHERE published >= '2024-02-01'
  UNION ALL
  SELECT 3, paper_id, title || ' (v3)', published, primary_category, score, label FROM scored2
    WHERE published >= '2024-03-01' AND published < '2024-04-01'
),
stored AS (
  SELECT paper_id, title, published, primary_category,
    '2024-12-0' || run_id || 'T00:00:00+00:00' AS latest_seen_at, run_id
  FROM (SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY run_id DESC) AS rn FROM runs WHERE score >= 3)
  WHERE rn = 1
)"""


def escape_sql(value: str) -> str:
    out = value
    for found, put in (("\\", "\\\\"), ("{", "\\{"), ("}", "\\}"), ('"', "``")):
        out = f"replace({out}, {quoted(found)}, {quoted(put)})"
    return f"trim(regexp_replace({out}, '{WS}', ' ', 'g'))"


def with_papers(body: str, *ctes: str) -> str:
    return "WITH " + ", ".join((PAPERS_SQL, *ctes)) + "\n" + body


FEED_CTE = """
feed_rows AS (
  SELECT *, CAST(substr(primary_category, 4) AS INT) AS source_ordinal,
    'category:' || primary_category AS source_name,
    CAST(paper_id AS BIGINT) // 200 * 200 AS page_start
  FROM papers
),
feed_pages AS (
  SELECT source_ordinal, source_name, page_start, count(*) AS n,
    (page_start // 200) % 3 = 1 OR (page_start // 200) % 4 = 2 AS corrupt
  FROM feed_rows GROUP BY ALL
)"""

_PDF = "CASE WHEN {0} LIKE 'http://%' THEN 'https://' || substr({0}, 8) ELSE {0} END"


def _confusion(condition: str) -> str:
    return f"count(*) FILTER ({condition})"


DIGEST_BODY = f"""
SELECT window_slug, CASE label WHEN 'core' THEN 1 ELSE 3 END AS section, 0 AS seq,
  '- [' || title || '](' || abs_url || ') | ' || paper_id AS line, published, paper_id
FROM (SELECT *, {week_sql("d")} FROM year) WHERE label <> 'unlikely'
UNION ALL
SELECT c.window_slug, x.section, x.seq,
  CASE x.seq
    WHEN 0 THEN '# Paper Digest (' || c.window_start || ' to ' || c.window_end || ')'
    WHEN 2 THEN '- Core papers: ' || c.core
    WHEN 3 THEN '- Adjacent papers: ' || c.adjacent
    WHEN 4 THEN '- Other candidates included in this digest only: ' || c.unlikely
    WHEN 6 THEN '## Core' WHEN 10 THEN '## Adjacent'
    WHEN 8 THEN '- None' WHEN 12 THEN '- None' ELSE '' END, '', ''
FROM (
  SELECT w.window_slug, w.window_start, w.window_end, count(*) FILTER (y.label = 'core') AS core,
    count(*) FILTER (y.label = 'adjacent') AS adjacent, count(*) FILTER (y.label = 'unlikely') AS unlikely
  FROM weeks w LEFT JOIN (SELECT label, {week_sql("d")} FROM year) y ON w.window_slug = y.window_slug
  GROUP BY ALL) c,
  (SELECT unnest(range(13))::INT AS seq, unnest([0,0,0,0,0,0,0,0,1,2,2,2,3])::INT AS section) x
WHERE (x.seq <> 8 OR c.core = 0) AND (x.seq <> 12 OR c.adjacent = 0)"""

ORACLES = {
    "feed_ingest": with_papers(
        """SELECT source_ordinal, page_start,
  CAST(row_number() OVER (PARTITION BY source_ordinal, page_start ORDER BY CAST(paper_id AS BIGINT)) - 1 AS INT) AS pos,
  paper_id, title, summary, published, updated, primary_category,
  array_to_string(categories, '|') AS categories, array_to_string(authors, '|') AS authors,
  abs_url, pdf_url, source_name AS sources
FROM feed_rows""",
        FEED_CTE,
    ),
    "feed_entries_streamed": with_papers(
        """SELECT source_ordinal, page_start,
  CAST(row_number() OVER (PARTITION BY source_ordinal, page_start ORDER BY CAST(paper_id AS BIGINT)) - 1 AS INT) AS pos,
  paper_id, title, summary, published, updated, primary_category,
  array_to_string(categories, '|') AS categories, array_to_string(authors, '|') AS authors,
  abs_url, pdf_url, source_name AS sources
FROM feed_rows""",
        FEED_CTE,
    ),
    "ingest_completeness": with_papers(
        """SELECT 'range:' || source AS source_name, source AS source_ordinal, total AS declared_total, landed_entries,
  landed_pages, corrupt_pages, expected AS expected_pages, missing > 0 AS has_gap, missing = 0 AS complete
FROM (
  SELECT source, any_value(total) AS total, any_value((total + 49) // 50) AS expected,
    CAST(coalesce(sum(n) FILTER (here), 0) AS BIGINT) AS landed_entries, count(*) FILTER (here) AS landed_pages,
    count(*) FILTER (start < total AND NOT here) AS missing,
    CAST(sum(CASE WHEN cut THEN copies ELSE 0 END) AS BIGINT) AS corrupt_pages
  FROM (
    SELECT *, copies > 0 AND NOT cut AND start < total AS here FROM (
      SELECT *, CASE WHEN b % 7 = 3 THEN 0 WHEN b % 5 = 1 THEN 2 ELSE 1 END AS copies, b % 11 = 5 AS cut FROM (
        SELECT p.source, p.start, p.n, t.total, p.source * 9 + p.start // 50 AS b
        FROM (SELECT CAST(doc_id // 400 AS INT) AS source, doc_id % 400 // 50 * 50 AS start, count(*) AS n
              FROM documents GROUP BY ALL
              UNION ALL SELECT DISTINCT CAST(doc_id // 400 AS INT), 400, 0 FROM documents WHERE doc_id // 400 % 2 = 0) p
        JOIN (SELECT doc_id // 400 AS source, count(*) AS total FROM documents GROUP BY 1) t ON p.source = t.source)))
  GROUP BY source HAVING sum(copies) > 0)"""
    ),
    "missing_page_ranges": with_papers(
        """SELECT 'range:' || source AS source_name, source AS source_ordinal, min(start) AS first_missing,
  max(start) AS last_missing, count(*) AS pages
FROM (
  SELECT source, start, start // 50 - row_number() OVER (PARTITION BY source ORDER BY start) AS island
  FROM (
    SELECT source, start, source * 9 + start // 50 AS b
    FROM (SELECT CAST(doc_id // 400 AS INT) AS source, count(*) AS total FROM documents GROUP BY 1),
      unnest(generate_series(0, total - 1, 50)) AS u(start))
  WHERE b % 7 = 3 OR b % 11 = 5)
WHERE source IN (
  SELECT CAST(doc_id // 400 AS INT) FROM documents GROUP BY doc_id // 400, doc_id % 400 // 50
  HAVING (doc_id // 400 * 9 + doc_id % 400 // 50) % 7 <> 3)
GROUP BY source, island"""
    ),
    "quarantined_pages": with_papers(
        "SELECT source_ordinal, source_name, page_start FROM feed_pages WHERE corrupt", FEED_CTE
    ),
    "quarantined_records": with_papers(
        """SELECT source_ordinal, source_name, page_start, NULL::INT AS pos, NULL::VARCHAR AS abs_url,
  'unreadable page' AS reason FROM feed_pages WHERE corrupt
UNION ALL
SELECT source_ordinal, source_name, page_start, pos, abs_url, 'no title' FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY source_ordinal, page_start ORDER BY CAST(paper_id AS BIGINT)) - 1 AS INT) AS pos
  FROM feed_rows)
WHERE NOT ((page_start // 200) % 3 = 1 OR (page_start // 200) % 4 = 2)
  AND length(replace(replace(replace(summary, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')) <= 40""",
        FEED_CTE,
    ),
    "config_terms": with_papers(
        """SELECT tier, CAST(ordinal AS INT) AS ordinal, term, (
  SELECT count(*) FROM papers p
  WHERE CASE WHEN d.tier LIKE '%categories' THEN list_contains(p.categories, d.term)
    ELSE contains(lower(p.title), lower(d.term)) OR contains(lower(p.summary), lower(d.term)) END
) AS papers FROM dimension d""",
        values(
            "dimension",
            "tier, ordinal, term",
            [
                (tier, i, term)
                for tier in ("categories", "anchor_categories", "query_terms", "anchor_terms", "core_terms", "adjacent_terms", "exclude_terms")
                for i, term in enumerate(getattr(CONFIG, tier))
            ],
        ),
    ),
    "config_chunks": with_papers(
        """SELECT CAST(w.chunk AS INT) AS chunk, CAST(w.ordinal AS INT) AS ordinal, w.term,
  (SELECT count(*) FROM by_keyword b WHERE b.source_name = 'keyword_chunk_' || w.chunk) AS candidates
FROM words w""",
        candidate_ctes("true"),
    ),
    "papers_scan": with_papers(
        """SELECT paper_id, title, summary, published, primary_category,
  array_to_string(authors, '|') AS authors, abs_url, pdf_url FROM papers"""
    ),
    "extract_id": with_papers(
        """SELECT abs_url, split_part(split_part(rtrim(abs_url, '/'), '/', -1), 'v', 1) AS paper_id
FROM (SELECT abs_url FROM papers
      UNION ALL SELECT url || CASE WHEN page_id % 2 = 0 THEN '//' ELSE '' END FROM pages)"""
    ),
    "compact_whitespace": f"""
SELECT origin, id, trim(regexp_replace(text, '{WS}', ' ', 'g')) AS compacted
FROM (SELECT 'documents' AS origin, doc_id AS id, text FROM documents
      UNION ALL SELECT 'pages', page_id, html FROM pages)""",
    "pdf_link": with_papers(
        """SELECT paper_id, CASE CAST(paper_id AS BIGINT) % 5
  WHEN 3 THEN 'https://y.example/PDF/https://' || paper_id
  WHEN 4 THEN NULL
  ELSE 'https://x.example/pdf/' || paper_id END AS pdf_url
FROM papers"""
    ),
    "json_lists": with_papers(
        """SELECT paper_id, CAST(to_json(authors) AS VARCHAR) AS authors_json,
  CASE WHEN CAST(paper_id AS BIGINT) % 7 = 0 THEN 0 ELSE len(authors) END AS n_authors,
  CASE WHEN CAST(paper_id AS BIGINT) % 7 = 0 THEN '' ELSE array_to_string(authors, '|') END AS authors
FROM papers"""
    ),
    "date_parts": with_papers(
        """SELECT paper_id, substr(cut, 1, 4) AS year,
  CASE WHEN length(cut) >= 7 THEN substr(cut, 6, 2) ELSE '' END AS month,
  CASE WHEN length(cut) >= 10 THEN substr(cut, 9, 2) ELSE '' END AS day
FROM (SELECT paper_id, substr(published, 1, CAST(CAST(paper_id AS BIGINT) % 20 AS INT)) AS cut FROM papers)"""
    ),
    "citation_key": with_papers(
        r"""SELECT paper_id, CASE WHEN CAST(paper_id AS BIGINT) % 6 = 0 OR word = '' THEN '' ELSE word || '_' END
  || 'math_AG_' || paper_id AS citation_key
FROM (SELECT paper_id, regexp_replace(split_part(title, ' ', 1), '[^\p{L}\p{N}_]', '', 'g') AS word FROM papers)"""
    ),
    "truncate_abstract": with_papers(
        """SELECT paper_id, CASE WHEN length(summary) > 1000 THEN substr(summary, 1, 1000) || '...'
  ELSE summary END AS abstract FROM papers"""
    ),
    "bibtex_escape": f"""
SELECT origin, id, {escape_sql("value")} AS escaped
FROM (SELECT 'documents' AS origin, doc_id AS id, text AS value FROM documents
      UNION ALL SELECT 'pages', page_id, html FROM pages
      UNION ALL SELECT 'events', event_id, props FROM events)""",
    "iso_dates": with_papers(
        """SELECT paper_id, CASE WHEN CAST(paper_id AS BIGINT) % 9 = 0 THEN NULL
  ELSE CAST(substr(published, 1, 10) AS DATE) END AS parsed FROM papers"""
    ),
    "invalid_records": """
SELECT * FROM (
  SELECT doc_id AS number, CASE WHEN doc_id % 11 = 0 THEN 'no id' WHEN doc_id % 7 = 0 THEN 'no title'
    WHEN doc_id % 5 = 0 THEN 'no published date' WHEN doc_id % 3 = 0 THEN 'no authors' END AS skip_reason
  FROM documents) WHERE skip_reason IS NOT NULL""",
    "window_filter": with_papers(
        """SELECT paper_id, published FROM papers
WHERE CAST(replace(published, 'Z', '') AS TIMESTAMP) BETWEEN TIMESTAMP '2024-01-01 00:00:00' AND TIMESTAMP '2024-03-31 23:59:59'"""
    ),
    "category_candidates": with_papers("SELECT * FROM by_category", candidate_ctes(IN_WINDOW)),
    "keyword_candidates": with_papers("SELECT * FROM by_keyword", candidate_ctes(IN_WINDOW)),
    "keyword_fallback": with_papers("SELECT * FROM by_keyword", candidate_ctes("true", OTHER_CONFIG)),
    "all_candidates": with_papers("SELECT * FROM every", candidate_ctes(IN_WINDOW)),
    "tagged_candidates": with_papers("SELECT * FROM tagged", candidate_ctes(IN_WINDOW)),
    "merge_papers": with_papers(
        """SELECT p.paper_id, p.title, p.published, p.abs_url || '.' || t.source_ordinal AS abs_url, t.sources,
  row_number() OVER (ORDER BY p.published DESC, p.paper_id DESC) AS position
FROM papers p JOIN tagged t ON p.paper_id = t.paper_id""",
        candidate_ctes("true"),
    ),
    "streamed_merge": with_papers(
        """SELECT p.paper_id, p.title, p.published, p.abs_url || '.' || e.source_ordinal AS abs_url, t.sources
FROM papers p JOIN tagged t ON p.paper_id = t.paper_id
JOIN (SELECT paper_id, source_ordinal, row_number() OVER (
    PARTITION BY paper_id ORDER BY source_ordinal % 4, source_ordinal) AS rn FROM every) e
  ON e.paper_id = p.paper_id AND e.rn = 1""",
        candidate_ctes("true"),
    ),
    "merge_table_copies": with_papers(
        """SELECT split_part(s.paper_id, '#', 1) AS paper_id, s.title, array_to_string(s.categories, '|') AS categories,
  s.score, s.label, u.sources
FROM (
  SELECT s.*, row_number() OVER (PARTITION BY split_part(s.paper_id, '#', 1)
    ORDER BY t.source_ordinal, s.title, s.categories) AS rn
  FROM scored s JOIN tagged t ON s.paper_id = t.paper_id) s
JOIN (
  SELECT split_part(paper_id, '#', 1) AS id, string_agg(DISTINCT source_name, '|' ORDER BY source_name) AS sources
  FROM every GROUP BY 1) u ON u.id = split_part(s.paper_id, '#', 1)
WHERE s.rn = 1""",
        """copies AS (
  SELECT * REPLACE (paper_id || '#0' AS paper_id) FROM papers
  UNION ALL SELECT * REPLACE (paper_id || '#1' AS paper_id, 'Zz ' || title AS title) FROM papers WHERE CAST(paper_id AS BIGINT) % 2 = 0
  UNION ALL SELECT * REPLACE (paper_id || '#2' AS paper_id, 'A in the ' || title AS title) FROM papers WHERE CAST(paper_id AS BIGINT) % 3 = 0
  UNION ALL SELECT * REPLACE (paper_id || '#3' AS paper_id, ['src0', primary_category] AS categories) FROM papers WHERE CAST(paper_id AS BIGINT) % 5 = 0)""",
        score_ctes(CONFIG, "copies"),
        candidate_ctes("true", papers="copies"),
    ),
    "score_papers": with_papers("SELECT paper_id, score, label FROM scored", SCORES),
    "score_reasons": with_papers(
        """SELECT p.paper_id, coalesce(r.reasons, '') AS reasons
FROM papers p LEFT JOIN reasons r ON p.paper_id = r.paper_id""",
        SCORES,
        REASONS,
    ),
    "anchor_gate": with_papers(
        "SELECT paper_id, has_anchor, raw_score, score FROM scored", SCORES
    ),
    "label_papers": with_papers(
        """SELECT paper_id, label,
  CAST(CASE label WHEN 'core' THEN 0 WHEN 'adjacent' THEN 1 ELSE 2 END AS INT) AS label_rank FROM scored""",
        SCORES,
    ),
    "label_counts": with_papers(
        """SELECT count(*) AS total_candidates, count(*) FILTER (label = 'core') AS core_count,
  count(*) FILTER (label = 'adjacent') AS adjacent_count, count(*) FILTER (label = 'unlikely') AS unlikely_count
FROM scored""",
        SCORES,
    ),
    "relevant_papers": with_papers(
        "SELECT paper_id, title, score, label FROM scored WHERE score >= 3", SCORES
    ),
    "term_matches": with_papers("SELECT DISTINCT paper_id, tier, term, place FROM hits", SCORES),
    "many_term_matches": with_papers(
        """SELECT p.paper_id, t.term, CASE WHEN contains(title, term) THEN 'title' ELSE 'summary' END AS place
FROM (SELECT paper_id, lower(title) AS title, lower(summary) AS summary FROM papers) p
JOIN (SELECT DISTINCT lower(substr(summary, 1 + (n * 7 + k * 61) % 400, 8 + (n + k) % 9)) AS term
      FROM (SELECT summary, CAST(paper_id AS BIGINT) AS n FROM papers), unnest(range(12)) AS u(k)) t
  ON term <> '' AND (contains(title, term) OR contains(summary, term))"""
    ),
    "score_indexed": with_papers(
        "SELECT s.paper_id, s.score, s.label, coalesce(r.reasons, '') AS reasons "
        "FROM scored s LEFT JOIN reasons r ON s.paper_id = r.paper_id",
        SCORES,
        REASONS,
    ),
    "rescore_delta": with_papers("SELECT paper_id, score, label FROM scored", score_ctes(OTHER_CONFIG)),
    "context_gated_terms": with_papers(
        """SELECT p.paper_id, g.term, string_agg(g.context, '|' ORDER BY g.ordinal) AS contexts
FROM (SELECT paper_id, lower(title) AS t, lower(summary) AS s FROM papers) p JOIN gates g
  ON (contains(p.t, g.term) OR contains(p.s, g.term)) AND (contains(p.t, g.context) OR contains(p.s, g.context))
GROUP BY p.paper_id, g.term""",
        values(
            "gates",
            "term, ordinal, context",
            [(t, i, c) for t, cs in CONTEXT_GATES.items() for i, c in enumerate(cs)],
        ),
    ),
    "trailing_window": with_papers(
        """SELECT paper_id, published, DATE '2024-03-18' AS window_start, DATE '2024-03-31' AS window_end
FROM papers WHERE CAST(substr(published, 1, 10) AS DATE) BETWEEN DATE '2024-03-31' - 13 AND DATE '2024-03-31'"""
    ),
    "month_weeks": f"""
SELECT window_slug, window_start, window_end, count(*) AS n FROM (
  SELECT {week_sql("d")} FROM (
    SELECT CAST(ts AS DATE) AS d FROM events UNION ALL SELECT CAST(o_orderdate AS DATE) FROM orders))
GROUP BY ALL""",
    "monthly_digest_counts": with_papers(
        f"""SELECT window_slug, window_start, window_end, count(*) AS total_candidates,
  count(*) FILTER (label = 'core') AS core_count, count(*) FILTER (label = 'adjacent') AS adjacent_count,
  count(*) FILTER (label = 'unlikely') AS unlikely_count
FROM (SELECT label, {week_sql("d")} FROM year) GROUP BY window_slug, window_start, window_end""",
        YEAR,
    ),
    "filter_category": with_papers(
        "SELECT paper_id, title, published, primary_category FROM papers WHERE primary_category IN ('src1', 'src7')"
    ),
    "filter_date": with_papers(
        """SELECT paper_id, title, published, primary_category FROM papers
WHERE CAST(substr(published, 1, 10) AS DATE) BETWEEN DATE '2024-02-10' AND DATE '2024-03-20'"""
    ),
    "filter_title": with_papers(
        "SELECT paper_id, title, published, primary_category FROM papers WHERE title ILIKE '%the%'"
    ),
    "filter_summary": with_papers(
        "SELECT paper_id, title, published, primary_category FROM papers WHERE contains(lower(summary), 'ción')"
    ),
    "filter_author": with_papers(
        """SELECT paper_id, title, published, primary_category FROM papers
WHERE CAST(to_json(authors) AS VARCHAR) ILIKE '%ada k1%'"""
    ),
    "filter_text": with_papers(
        """SELECT paper_id, title, published, primary_category FROM papers
WHERE title ILIKE '%src1%' OR summary ILIKE '%src1%' OR CAST(to_json(authors) AS VARCHAR) ILIKE '%src1%'"""
    ),
    "filter_ids": with_papers(
        """SELECT paper_id, title, published, primary_category FROM papers
WHERE CAST(paper_id AS BIGINT) IN (SELECT doc_id FROM labels)"""
    ),
    "filter_combined": with_papers(
        """SELECT paper_id, title, published, primary_category FROM papers
WHERE primary_category IN ('src0', 'src1', 'src2', 'src3', 'src4', 'src5', 'src6', 'src7', 'src8', 'src9')
  AND CAST(substr(published, 1, 10) AS DATE) BETWEEN DATE '2024-01-15' AND DATE '2024-11-30'
  AND title ILIKE '%e%' AND summary ILIKE '%the%' AND CAST(to_json(authors) AS VARCHAR) ILIKE '%ada%'
  AND (title ILIKE '%ing%' OR summary ILIKE '%ing%' OR CAST(to_json(authors) AS VARCHAR) ILIKE '%ing%')"""
    ),
    "export_rows": with_papers(
        """SELECT paper_id AS arxiv_id, title, summary, published, updated, primary_category,
  array_to_string(categories, '|') AS categories, array_to_string(authors, '|') AS authors, abs_url,
  coalesce(pdf_url, '') AS pdf_url, label, sources AS source_queries,
  row_number() OVER (ORDER BY CASE label WHEN 'core' THEN 0 WHEN 'adjacent' THEN 1 ELSE 2 END, published DESC, paper_id DESC) AS position
FROM triaged""",
        TRIAGED,
    ),
    "export_csv_rows": with_papers(
        """SELECT label, paper_id AS arxiv_id, coalesce(pdf_url, '') AS pdf_url, title, summary, published, updated,
  primary_category, array_to_string(categories, '; ') AS categories, array_to_string(authors, '; ') AS authors,
  replace(sources, '|', '; ') AS source_queries, abs_url
FROM triaged""",
        TRIAGED,
    ),
    "export_jsonl_rows": with_papers(
        """SELECT paper_id AS arxiv_id, CAST(to_json({'arxiv_id': paper_id, 'title': title, 'summary': summary,
  'published': published, 'updated': updated, 'primary_category': primary_category, 'categories': categories,
  'authors': authors, 'abs_url': abs_url, 'pdf_url': coalesce(pdf_url, ''), 'label': label,
  'source_queries': string_split(sources, '|')}) AS VARCHAR) AS line
FROM triaged""",
        TRIAGED,
    ),
    "csv_files": with_papers(
        f"""SELECT label, paper_id AS arxiv_id, coalesce(pdf_url, '') AS pdf_url, title, summary, published, updated,
  primary_category, array_to_string(categories, '; ') AS categories, array_to_string(authors, '; ') AS authors,
  replace(sources, '|', '; ') AS source_queries, abs_url, window_slug
FROM (SELECT *, {week_sql("d")} FROM year)""",
        YEAR,
    ),
    "jsonl_files": with_papers(
        f"""SELECT window_slug, paper_id AS arxiv_id, title, summary, sources AS source_queries, label
FROM (SELECT *, {week_sql("d")} FROM year)""",
        YEAR,
    ),
    "undated_records": with_papers(
        "SELECT abs_url, 'no full date' AS reason FROM papers WHERE CAST(paper_id AS BIGINT) % 14 < 10"
    ),
    "bibliography": with_papers(
        "SELECT paper_id, published, row_number() OVER (ORDER BY published DESC, paper_id DESC) AS position FROM papers"
    ),
    "digest_lines": with_papers(
        DIGEST_BODY,
        YEAR,
        WEEKS,
    ),
    "single_files": with_papers(
        f"""SELECT 'csv' AS kind, window_slug, 0::BIGINT AS position, 'arxiv_id' AS content FROM weeks
UNION ALL
SELECT kind, window_slug, row_number() OVER (
    PARTITION BY kind, window_slug ORDER BY score >= 6 DESC, score >= 3 DESC, published DESC, paper_id DESC) - first, paper_id
FROM (SELECT *, {week_sql("d")} FROM year), (VALUES ('csv', 0), ('jsonl', 1)) AS k(kind, first)
UNION ALL
SELECT 'digest', window_slug, row_number() OVER (
    PARTITION BY window_slug ORDER BY section, seq, published DESC, paper_id DESC) - 1, line
FROM ({DIGEST_BODY})""",
        YEAR,
        WEEKS,
    ),
    "bibtex_entries": with_papers(
        f"""
SELECT paper_id, '% arXiv:' || paper_id || chr(10) || '@article{{' || key || ',' || chr(10)
  || array_to_string(list_concat(
       list_transform(range(1, least(len(fields), 3) + 1),
         lambda i: fields[i] || CASE WHEN i < len(fields) THEN ',' ELSE '' END),
       ['  journal = {{arXiv:' || paper_id || '}},'],
       list_transform(range(4, len(fields) + 1),
         lambda i: fields[i] || CASE WHEN i < len(fields) THEN ',' ELSE '' END)), chr(10))
  || chr(10) || '}}' AS entry
FROM (
  SELECT paper_id, key, list_transform(list_filter(pairs, lambda f: f.v <> ''), lambda f: '  ' || f.k || ' = {{' || f.v || '}}') AS fields
  FROM (
    SELECT paper_id,
      CASE WHEN n % 3 = 0 THEN paper_id ELSE 'K' || n % 97 || '_' || paper_id END AS key,
      [{{'k': 'title', 'v': CASE WHEN n % 5 = 0 THEN '' ELSE {escape_sql("title || ' {\"x\"} ' || chr(92)")} END}},
       {{'k': 'author', 'v': CASE WHEN n % 3 = 0 THEN '' ELSE authors[1] || ' and ' || authors[2] END}},
       {{'k': 'year', 'v': substr(cut, 1, 4)}},
       {{'k': 'month', 'v': CASE WHEN length(cut) >= 7 THEN substr(cut, 6, 2) ELSE '' END}},
       {{'k': 'day', 'v': CASE WHEN length(cut) >= 10 THEN substr(cut, 9, 2) ELSE '' END}},
       {{'k': 'eprint', 'v': paper_id}},
       {{'k': 'archivePrefix', 'v': 'arXiv'}},
       {{'k': 'primaryClass', 'v': CASE WHEN n % 4 = 0 THEN '' ELSE primary_category END}},
       {{'k': 'url', 'v': abs_url}},
       {{'k': 'pdf', 'v': coalesce(pdf_url, '')}},
       {{'k': 'abstract', 'v': {escape_sql("CASE WHEN length(summary) > 1000 THEN substr(summary, 1, 1000) || '...' ELSE summary END")}}}] AS pairs
    FROM (SELECT *, CAST(paper_id AS BIGINT) AS n, substr(published, 1, CAST(CAST(paper_id AS BIGINT) % 12 AS INT)) AS cut FROM papers)
  )
)"""
    ),
    "run_log": with_papers(
        f"""SELECT '2024-12-31T00:00:00+00:00' AS collected_at,
  CAST(w.window_start AS VARCHAR) AS window_start, CAST(w.window_end AS VARCHAR) AS window_end,
  count(y.label) AS total_candidates, count(*) FILTER (y.label = 'core') AS core_count,
  count(*) FILTER (y.label = 'adjacent') AS adjacent_count, 'filters.json' AS config_path, w.run_id
FROM weeks w LEFT JOIN (SELECT label, {week_sql("d")} FROM year) y ON w.window_slug = y.window_slug
GROUP BY w.window_start, w.window_end, w.run_id""",
        YEAR,
        WEEKS,
    ),
    "run_papers": with_papers(
        "SELECT (month(d) - 1) * 5 + (day(d) - 1) // 7 + 1 AS run_id, paper_id, label, sources FROM year", YEAR
    ),
    "upsert_papers": with_papers("SELECT * FROM stored", THREE_RUNS),
    "upsert_onto_base": with_papers("SELECT * FROM stored", THREE_RUNS),
    "upsert_bucketed": with_papers("SELECT * FROM stored", THREE_RUNS),
    "ids_bucketed": with_papers("SELECT paper_id, title FROM papers WHERE CAST(paper_id AS BIGINT) % 50 = 0"),
    "label_intervals": with_papers(
        """SELECT paper_id, label, min(run_id) AS from_run,
  (SELECT min(n.run_id) FROM runs n WHERE n.paper_id = g.paper_id AND n.run_id > max(g.run_id)) AS to_run, count(*) AS runs
FROM (
  SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY run_id)
    - row_number() OVER (PARTITION BY paper_id, label ORDER BY run_id) AS island FROM runs) g
GROUP BY paper_id, label, island""",
        THREE_RUNS,
    ),
    "labels_as_of": with_papers(
        """SELECT p.paper_id, as_of, r.label, r.run_id
FROM (SELECT paper_id, '2024-12-0' || unnest([0, 1, 2, 9]) || 'T00:00:00+00:00' AS as_of FROM papers) p
LEFT JOIN (SELECT *, '2024-12-0' || run_id || 'T00:00:00+00:00' AS at FROM runs) r
  ON r.paper_id = p.paper_id AND r.at <= p.as_of
QUALIFY row_number() OVER (PARTITION BY p.paper_id, as_of ORDER BY run_id DESC) = 1""",
        THREE_RUNS,
    ),
    "run_history": with_papers(
        """SELECT r.paper_id, r.run_id, r.label, w.window_start, w.window_end, s.title
FROM runs r JOIN (
  SELECT run_id, left(min(published), 10) AS window_start, left(max(published), 10) AS window_end
  FROM runs GROUP BY run_id) w ON r.run_id = w.run_id
JOIN stored s ON r.paper_id = s.paper_id""",
        THREE_RUNS,
    ),
    "run_orphans": with_papers(
        """SELECT r.paper_id, r.run_id, r.label FROM runs r
WHERE r.paper_id NOT IN (SELECT paper_id FROM stored)""",
        THREE_RUNS,
    ),
    "store_roundtrip": with_papers(
        """SELECT 'paper' AS kind, run_id, paper_id, title, NULL::VARCHAR AS detail FROM latest
UNION ALL SELECT 'seen', s.run_id, s.paper_id, l.title, s.label FROM seen s JOIN latest l ON s.paper_id = l.paper_id
UNION ALL SELECT 'run', run_id, NULL, NULL, count(*) || '/' || count(*) FILTER (label = 'core') || '/'
    || count(*) FILTER (label = 'adjacent') || '/' || ['2024-01-01', '2024-02-01', '2024-03-01'][run_id]
  FROM seen GROUP BY run_id""",
        score_ctes(CONFIG),
        candidate_ctes("true"),
        """p2 AS (SELECT * REPLACE (title || ' (v2)' AS title) FROM papers WHERE published >= '2024-02-01'),
p3 AS (SELECT * REPLACE (title || ' (v3)' AS title) FROM papers WHERE published >= '2024-03-01' AND published < '2024-04-01')""",
        score_ctes(OTHER_CONFIG, "p2", "2"),
        candidate_ctes("true", OTHER_CONFIG, "p2", "2"),
        score_ctes(OTHER_CONFIG, "p3", "3"),
        candidate_ctes("true", OTHER_CONFIG, "p3", "3"),
        """seen AS (
  SELECT 1::BIGINT AS run_id, s.paper_id, s.title, s.score, s.label FROM scored s JOIN tagged t ON s.paper_id = t.paper_id
  UNION ALL SELECT 2, s.paper_id, s.title, s.score, s.label FROM scored2 s JOIN tagged2 t ON s.paper_id = t.paper_id
  UNION ALL SELECT 3, s.paper_id, s.title, s.score, s.label FROM scored3 s JOIN tagged3 t ON s.paper_id = t.paper_id),
latest AS (
  SELECT paper_id, run_id, title FROM (
    SELECT *, row_number() OVER (PARTITION BY paper_id ORDER BY run_id DESC) AS rn FROM seen WHERE score >= 3)
  WHERE rn = 1)""",
    ),
    "shortlist": with_papers(
        """SELECT s.paper_id, s.title, s.label, s.score, r.why
FROM scored s JOIN reasons r ON s.paper_id = r.paper_id WHERE s.label IN ('core', 'adjacent')""",
        SCORES,
        REASONS,
    ),
    "label_confusion": with_papers(
        f"""SELECT s.label, count(*) AS papers,
  {_confusion("s.score >= 3 AND l.quality = 1")} AS true_positives,
  {_confusion("s.score >= 3 AND l.quality <> 1")} AS false_positives,
  {_confusion("s.score < 3 AND l.quality = 1")} AS false_negatives,
  {_confusion("s.score < 3 AND l.quality <> 1")} AS true_negatives
FROM scored s JOIN labels l ON s.paper_id = CAST(l.doc_id AS VARCHAR) GROUP BY s.label""",
        SCORES,
    ),
    "threshold_curve": with_papers(
        """SELECT t.score AS threshold, CAST(sum(good) AS BIGINT) AS true_positives, CAST(sum(1 - good) AS BIGINT) AS false_positives,
  CAST(any_value(total) - sum(good) AS BIGINT) AS false_negatives, sum(good)::DOUBLE / count(*) AS precision,
  CASE WHEN any_value(total) > 0 THEN sum(good)::DOUBLE / any_value(total) END AS recall
FROM (SELECT DISTINCT score FROM judged) t JOIN judged j ON j.score >= t.score, (SELECT sum(good) AS total FROM judged)
GROUP BY t.score""",
        SCORES,
        """judged AS (
  SELECT s.score, CASE WHEN l.quality = 1 THEN 1 ELSE 0 END AS good
  FROM scored s JOIN labels l ON s.paper_id = CAST(l.doc_id AS VARCHAR))""",
    ),
    "config_diff": with_papers(
        """SELECT a.label AS old_label, b.label AS new_label, count(*) AS papers
FROM scored a JOIN scored2 b ON a.paper_id = b.paper_id GROUP BY ALL""",
        score_ctes(CONFIG),
        score_ctes(OTHER_CONFIG, tag="2"),
    ),
}
