"""The same results in plain SQL, written apart from the operators, for checking."""

from __future__ import annotations

from catalog.views import RULES

FEED = """
feed AS (
  SELECT 'DOC' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS story_id,
         split_part(text, chr(10), 1) AS headline, text AS body_text,
         'NS:' || upper(source) AS source_code,
         CASE WHEN contains(upper(source), 'RTRS') THEN 'Reuters' ELSE 'NS:' || upper(source) END AS source,
         TIMESTAMP '2024-01-01' + to_minutes(CAST(doc_id * 7 AS INT)) AS published_at,
         lang AS language, doc_id
  FROM documents)"""

OVERLAP = """
feed_overlap AS (
  SELECT *, 1 AS arrival FROM feed
  UNION ALL
  SELECT * REPLACE (published_at + INTERVAL 24 HOUR AS published_at), 2 AS arrival FROM feed WHERE doc_id % 10 = 0)"""


def with_(*ctes: str, body: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


# -- rule expressions ----------------------------------------------------------------------


def any_substring(text: str, terms: list[str]) -> str:
    return "(" + " OR ".join(f"contains({text}, '{t}')" for t in terms) + ")"


def any_word(text: str, words: list[str]) -> str:
    either = "|".join(words)
    return rf"regexp_matches({text}, '(^|[^\p{{L}}\p{{N}}_])({either})([^\p{{L}}\p{{N}}_]|$)')"


def tags_sql() -> str:
    cases = [f"CASE WHEN {any_word('t', w)} THEN '{c}' END" for c, w in RULES.category_words.items()]
    cases += [f"CASE WHEN {any_substring('lower(headline)', p)} THEN '{c}' END" for c, p in RULES.headline_phrases.items()]
    return f"[x FOR x IN [{', '.join(cases)}] IF x IS NOT NULL]"


def searched_sql() -> str:
    cases = [f"CASE WHEN {any_substring('t', w)} THEN '{c}' END" for c, w in RULES.search_terms.items()]
    return f"[x FOR x IN [{', '.join(cases)}] IF x IS NOT NULL]"


URGENCY = (
    f"CASE WHEN {any_substring('t', RULES.urgency_words[1])} THEN 1 "
    f"WHEN {any_substring('t', RULES.urgency_words[2])} THEN 2 ELSE 3 END"
)
PRIORITY = " + ".join(
    f"CASE WHEN contains(t, '{term}') THEN {rule['score']} ELSE 0 END"
    for rule in RULES.priority_terms.values()
    for term in rule["terms"]
)
REQUIRED = "greatest(0, " + ", ".join(
    f"CASE WHEN list_contains(categories, '{c}') THEN {m} ELSE 0 END" for c, m in RULES.category_minimum.items()
) + ")"


def tagged(source: str = "feed", name: str = "tagged") -> str:
    return f"""
{name} AS (
  SELECT * EXCLUDE (t), {tags_sql()} AS categories, {URGENCY} AS urgency_level, CAST({PRIORITY} AS INT) AS priority_score
  FROM (SELECT *, lower(headline || ' ' || coalesce(body_text, '')) AS t FROM {source}))"""


TAGGED = tagged()

BY_CATEGORY = f"""
matched AS (
  SELECT story_id, doc_id % 5 = 0 AS stored, {searched_sql()} AS c
  FROM (SELECT *, lower(headline || ' ' || body_text) AS t FROM feed)),
spread AS (SELECT story_id, stored, unnest(c) AS category, unnest(range(len(c))) AS pos FROM matched),
by_category AS (
  SELECT category, count(*) AS fetched,
         count(*) FILTER (pos = 0 AND NOT stored) AS stored,
         count(*) - count(*) FILTER (pos = 0 AND NOT stored) AS failed,
         count(*) FILTER (pos > 0 AND NOT stored) AS duplicate_of_category
  FROM spread GROUP BY category)"""

PAGES = """
paged AS (
  SELECT story_id, arrival, published_at,
         CAST(ceil(row_number() OVER (ORDER BY published_at DESC, story_id, arrival) / 100.0) AS BIGINT) AS page
  FROM feed_overlap)"""

PAGE_COUNTS = """
seen AS (SELECT page, min(page) OVER (PARTITION BY story_id) = page AS is_new FROM paged),
page_counts AS (
  SELECT page, count(*) AS n_rows, count(*) FILTER (is_new) AS new_rows, count(*) FILTER (NOT is_new) AS duplicates
  FROM seen GROUP BY page)"""

RUN_LOG = """
calls AS (
  SELECT strftime(ts, '%Y-%m-%d %H') AS run_id, *,
         row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d %H') ORDER BY ts DESC, event_id DESC) AS back
  FROM events),
runs AS (
  SELECT run_id, min(ts) AS fetch_start, max(ts) AS last_ts, count(*) AS n, count(*) FILTER (event_type <> 'error') AS ok,
         max(CASE WHEN back = 1 AND event_type = 'error' THEN props END) AS error_message
  FROM calls GROUP BY run_id),
fetch_log AS (
  SELECT run_id, fetch_start, CASE WHEN NOT open THEN last_ts END AS fetch_end, n AS articles_fetched,
         ok AS articles_inserted, n AS api_calls, error_message,
         CASE WHEN open THEN 'running' WHEN error_message <> '' THEN 'failed' ELSE 'completed' END AS status
  FROM (SELECT *, fetch_start >= (SELECT date_trunc('hour', max(ts)) FROM events) AS open FROM runs))"""

GAPS = """
gaps AS (
  SELECT * REPLACE (
    CASE WHEN doc_id % 17 = 0 THEN '  ' ELSE story_id END AS story_id,
    CASE WHEN doc_id % 19 = 0 THEN '　' ELSE headline END AS headline,
    CASE WHEN doc_id % 23 <> 0 THEN published_at END AS published_at)
  FROM {source})"""

BLANK = r"({c} IS NULL OR NOT regexp_matches({c}, '[^\s\p{{Z}}]'))"

# comments, scripts and styles, tags, then the entities that occur in the pages, `&amp;` last
_INSIDE = """(?:[^''">]|"[^"]*"|''[^'']*'')*"""
_MARKUP = "|".join(
    [r"(?is)<!--.*?(?:-->|\z)"]
    + [rf"<{tag}\b{_INSIDE}>.*?(?:</{tag}\s*>|\z)" for tag in ("script", "style")]
    + [rf"</?[a-z!?]{_INSIDE}>", "</?[a-z!?][^>]*>"]
)

PAGE_TEXT = rf"""
stripped AS (SELECT page_id, regexp_replace(html, '{_MARKUP}', '', 'g') AS t FROM pages),
page_text AS (
  SELECT page_id, trim(regexp_replace(
         replace(replace(replace(replace(replace(replace(replace(replace(t,
           '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&nbsp;', chr(160)), '&#39;', ''''),
           '&copy;', '©'), '&middot;', '·'), '&amp;', '&'), '[\s\p{{Z}}]+', ' ', 'g')) AS text
  FROM stripped)"""

WITH_PAGES = """
with_pages AS (
  SELECT f.* REPLACE (p.text AS body_text) FROM feed f LEFT JOIN page_text p ON f.doc_id = p.page_id)"""


# -- near duplicates -----------------------------------------------------------------------


def vectors(source: str) -> str:
    """Terms of the headlines of ``source``, and tf-idf weights as a day weighs its own articles and those of the day before."""
    return rf"""
word_lists AS (
  SELECT story_id, published_at, headline, regexp_extract_all(lower(headline), '[\p{{L}}\p{{N}}_]{{2,}}') AS w FROM {source}),
term_lists AS MATERIALIZED (
  SELECT story_id, published_at, CAST(published_at AS DATE) AS day, w || [w[i] || ' ' || w[i + 1] FOR i IN range(1, greatest(len(w), 1))] AS terms,
    CASE WHEN len(w) > 0 THEN array_to_string(w, ' ') WHEN trim(headline) <> '' THEN headline END AS key
  FROM word_lists),
counts AS MATERIALIZED (
  SELECT story_id, day, term, count(*) AS tf
  FROM (SELECT story_id, day, unnest(terms) AS term FROM term_lists) GROUP BY ALL),
judged AS MATERIALIZED (SELECT *, unnest([day, day + 1]) AS judge FROM counts),
frequencies AS (SELECT judge, term, count(*) AS df FROM judged GROUP BY ALL),
totals AS (SELECT judge, count(*) AS total FROM (SELECT unnest([day, day + 1]) AS judge FROM term_lists) GROUP BY ALL),
raw AS (
  SELECT judge, day, story_id, term, tf * (ln((1 + total) / (1.0 + df)) + 1) AS w
  FROM judged JOIN frequencies USING (judge, term) JOIN totals USING (judge)),
weights AS MATERIALIZED (
  SELECT judge, day, story_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY judge, story_id)) AS weight FROM raw)"""


EARLIER = """b.published_at >= a.published_at - INTERVAL 24 HOUR
       AND (b.published_at < a.published_at OR (b.published_at = a.published_at AND b.story_id < a.story_id))"""


def cosines(asking: str) -> str:
    """Cosine of the articles of ``asking`` with all earlier ones of their window, of other words."""
    return f"""
pairs AS (
  SELECT a.story_id, b.story_id AS other_id, b.published_at AS other_at, sum(x.weight * y.weight) AS exact
  FROM {asking} a JOIN term_lists b ON a.key <> b.key AND {EARLIER}
  JOIN weights x ON x.story_id = a.story_id AND x.judge = a.day
  JOIN weights y ON y.story_id = b.story_id AND y.judge = a.day AND y.term = x.term
  GROUP BY ALL)"""


def duplicates(source: str) -> str:
    """Best earlier match of each article, from all pairs of articles."""
    return f"""{vectors(source)}, {cosines("term_lists")},
matches AS (
  SELECT a.story_id, b.story_id AS other_id, b.published_at AS other_at, 1.0 AS similarity, TRUE AS same
  FROM term_lists a JOIN term_lists b ON a.key = b.key AND {EARLIER}
  UNION ALL SELECT story_id, other_id, other_at, round(exact, 6), FALSE FROM pairs WHERE exact >= 0.85 - 1e-12),
best AS (
  SELECT story_id, other_id, similarity,
         row_number() OVER (PARTITION BY story_id ORDER BY same DESC, similarity DESC, other_at DESC, other_id DESC) AS rn
  FROM matches),
duplicates AS (
  SELECT f.story_id, b.other_id AS best_match, CAST(b.similarity AS DOUBLE) AS similarity, b.other_id IS NOT NULL AS is_duplicate
  FROM {source} f LEFT JOIN best b ON b.story_id = f.story_id AND b.rn = 1)"""


def languages(source: str) -> str:
    return rf"""
words_by_lang AS (
  SELECT lang, word, count(*) AS n
  FROM (SELECT lang, unnest(regexp_extract_all(lower(text), '\p{{L}}+')) AS word FROM documents) GROUP BY ALL),
grams_by_lang AS (
  SELECT lang, gram, sum(n) AS n
  FROM (SELECT lang, n, unnest([substr('_' || word || '_', i, 3) FOR i IN range(1, length(word) + 1)]) AS gram
        FROM words_by_lang) GROUP BY ALL),
profile AS (
  SELECT lang, gram, 301 - rnk AS points
  FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, gram) AS rnk FROM grams_by_lang) WHERE rnk <= 300),
headline_words AS (
  SELECT story_id, unnest(regexp_extract_all(lower(headline), '\p{{L}}+')) AS word
  FROM {source} WHERE length(trim(headline)) >= 3),
headline_grams AS (
  SELECT story_id, unnest([substr('_' || word || '_', i, 3) FOR i IN range(1, length(word) + 1)]) AS gram
  FROM headline_words),
scores AS (SELECT story_id, lang, sum(points) AS points FROM headline_grams JOIN profile USING (gram) GROUP BY ALL),
ranked AS (SELECT story_id, lang, row_number() OVER (PARTITION BY story_id ORDER BY points DESC, lang) AS rn FROM scores),
detected AS (
  SELECT f.story_id, coalesce(r.lang, 'unknown') AS detected
  FROM {source} f LEFT JOIN ranked r ON r.story_id = f.story_id AND r.rn = 1)"""



SAMPLES = f"""
firsts AS (
  SELECT categories[1] AS category, story_id, headline,
         row_number() OVER (PARTITION BY categories[1] ORDER BY published_at, story_id) AS rn
  FROM {{source}} WHERE len(categories) > 0),
samples AS (
  SELECT category, CAST(rn AS INT) AS rn, story_id,
         CASE WHEN length(headline) > 60 THEN substr(headline, 1, 60) || '...' ELSE headline END AS preview
  FROM firsts WHERE rn <= 3)"""

RANGE_WHERE = "published_at BETWEEN TIMESTAMP '2024-01-01 06:04:00' AND TIMESTAMP '2024-01-03 17:27:00'"
RANGE_SQL = with_(
    FEED,
    OVERLAP,
    body=f"""
SELECT story_id, published_at FROM (
  SELECT *, row_number() OVER (PARTITION BY story_id ORDER BY arrival) AS rn FROM feed_overlap WHERE {RANGE_WHERE})
WHERE rn = 1""",
)

ORACLE: dict[str, str] = {
    "scan_latest": with_(
        FEED, body="SELECT story_id, headline, published_at FROM feed ORDER BY published_at DESC, story_id LIMIT 100"
    ),
    "backfill_range": RANGE_SQL,
    "load_range_forward": RANGE_SQL,
    "keyset_pages": """
SELECT page, count(*) AS n_rows, max(ts) AS newest, min(ts) AS oldest
FROM (SELECT ts, CAST(ceil(row_number() OVER (ORDER BY ts DESC, event_id) / 100.0) AS BIGINT) AS page FROM events)
GROUP BY page""",
    "incremental_since_hwm": """
SELECT event_id, ts FROM events
WHERE ts >= (SELECT coalesce(max(ts) + INTERVAL 1 SECOND, TIMESTAMP '2024-01-30') FROM events
             WHERE ts < TIMESTAMP '2024-01-20')""",
    "ingest_insert_only": with_(
        FEED,
        OVERLAP,
        body="""
SELECT count(*) AS total_processed,
       count(DISTINCT story_id) FILTER (doc_id % 3 <> 0) AS inserted_count,
       count(*) - count(DISTINCT story_id) FILTER (doc_id % 3 <> 0) AS failed_count
FROM feed_overlap""",
    ),
    "ingest_by_category": with_(FEED, BY_CATEGORY, body="SELECT * FROM by_category"),
    "fetch_log": with_(RUN_LOG, body="SELECT * FROM fetch_log"),
    "evolve_add_column": with_(
        FEED,
        TAGGED,
        body="""
SELECT story_id, CASE WHEN doc_id % 4 = 3 THEN priority_score ELSE 0 END AS priority_score FROM tagged""",
    ),
    "rules_from_json": with_(
        FEED,
        body="\nUNION ALL\n".join(
            f"SELECT '{level}' AS level, {rule['score']} AS score, '{term}' AS term, "
            f"count(*) FILTER (contains(lower(headline || ' ' || body_text), '{term}')) AS n_articles FROM feed"
            for level, rule in RULES.priority_terms.items()
            for term in rule["terms"]
        ),
    ),
    "normalize_articles": with_(
        FEED,
        body=f"""
SELECT story_id, headline, body_text, source, published_at, language FROM feed
WHERE NOT {BLANK.format(c='story_id')} AND NOT {BLANK.format(c='headline')} AND published_at IS NOT NULL""",
    ),
    "validate_required": with_(
        FEED,
        GAPS.format(source="feed"),
        body=f"""
SELECT CASE WHEN {BLANK.format(c='story_id')} THEN 'story_id' WHEN {BLANK.format(c='headline')} THEN 'headline'
            WHEN published_at IS NULL THEN 'published_at' ELSE 'valid' END AS reason, count(*) AS n
FROM gaps GROUP BY 1""",
    ),
    "truncate_headline": with_(FEED, body="SELECT story_id, substr(headline, 1, 500) AS headline FROM feed"),
    "standardize_timestamp": with_(
        FEED, body="SELECT story_id, published_at FROM feed WHERE doc_id % 13 <> 0"
    ),
    "filter_date_range": """
SELECT event_id, ts FROM events
WHERE ts BETWEEN (SELECT ts FROM events WHERE event_id = 100) AND (SELECT ts FROM events WHERE event_id = 700)""",
    "lookup_by_id": with_(
        FEED,
        body="""
SELECT story_id, headline, body_text, source, published_at, language FROM feed WHERE doc_id IN (3, 10, 42, 107, 199)""",
    ),
    "filter_sources": with_(
        FEED,
        body="""
SELECT story_id, source_code FROM feed WHERE NOT regexp_matches(split_part(source_code, ':', -1), '(?i)src1')""",
    ),
    "category_search": with_(
        FEED,
        body="\nUNION ALL\n".join(
            f"SELECT story_id, '{c}' AS category FROM feed "
            f"WHERE language = 'en' AND {any_substring('lower(headline || chr(32) || body_text)', w)}"
            for c, w in RULES.search_terms.items()
        ),
    ),
    "filter_min_score": with_(
        FEED,
        TAGGED,
        body=f"""
SELECT story_id, priority_score, CAST({REQUIRED} AS INT) AS required_score FROM tagged
WHERE priority_score >= {REQUIRED} AND priority_score >= {RULES.minimum_score}""",
    ),
    "check_constraints": with_(
        FEED,
        OVERLAP,
        GAPS.format(source="feed_overlap"),
        body=f"""
SELECT 'story_id_missing' AS check_name, count(*) AS violations FROM gaps WHERE {BLANK.format(c='story_id')}
UNION ALL SELECT 'headline_missing', count(*) FROM gaps WHERE {BLANK.format(c='headline')}
UNION ALL SELECT 'published_at_missing', count(*) FROM gaps WHERE published_at IS NULL
UNION ALL SELECT 'story_id_repeated', count(*) FROM (SELECT story_id FROM gaps GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'link_repeated', count(*) FROM (SELECT doc_id, quality FROM labels GROUP BY 1, 2 HAVING count(*) > 1)
UNION ALL SELECT 'link_without_article', count(*) FROM labels
  WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE doc_id % 11 <> 0)
UNION ALL SELECT 'status_outside_domain', count(*) FROM events
  WHERE event_type IS NULL OR event_type NOT IN ('click', 'view', 'purchase', 'signup')
UNION ALL SELECT 'value_outside_decimal_3_2', count(*) FROM events WHERE abs(round(value, 2)) >= 10""",
    ),
    "fill_defaults": """
SELECT d.doc_id, coalesce(l.quality, 3) AS quality, coalesce(l.toxic, 0) AS toxic,
       coalesce(CASE WHEN d.doc_id % 9 <> 0 THEN d.lang END, 'en') AS language
FROM documents d LEFT JOIN labels l USING (doc_id)""",
    "update_by_key": with_(
        FEED,
        body="""
SELECT story_id, CASE WHEN doc_id % 7 = 0 AND doc_id >= 8 THEN 'Updated: ' || headline ELSE headline END AS headline,
       CASE WHEN doc_id % 7 = 0 AND doc_id >= 8 THEN TIMESTAMP '2024-01-31' ELSE published_at END AS updated_at
FROM feed""",
    ),
    "delete_cascade": """
SELECT 'news_articles' AS table_name, count(*) FILTER (doc_id % 11 <> 0) AS remaining,
       count(*) FILTER (doc_id % 11 = 0) AS deleted FROM documents
UNION ALL
SELECT 'news_rics', count(*) - count(*) FILTER (doc_id % 11 = 0 AND doc_id IN (SELECT doc_id FROM documents)),
       count(*) FILTER (doc_id % 11 = 0 AND doc_id IN (SELECT doc_id FROM documents)) FROM labels""",
    "retention_cleanup": """
SELECT count(*) FILTER (ts >= TIMESTAMP '2024-01-17') AS kept, count(*) FILTER (ts < TIMESTAMP '2024-01-17') AS deleted,
       min(ts) FILTER (ts >= TIMESTAMP '2024-01-17') AS oldest_kept
FROM events""",
    "enrich_bodies": with_(
        FEED,
        PAGE_TEXT,
        WITH_PAGES,
        body="SELECT story_id, body_text IS NOT NULL AS has_body, body_text FROM with_pages",
    ),
    "exclude_seen": with_(
        FEED, OVERLAP, body="SELECT story_id, published_at FROM feed_overlap WHERE doc_id % 2 <> 0"
    ),
    "window_candidates": with_(
        FEED,
        body="""
SELECT story_id,
       count(*) OVER (ORDER BY published_at RANGE BETWEEN INTERVAL 24 HOUR PRECEDING AND CURRENT ROW) - 1 AS n_candidates,
       CASE WHEN published_at - lag(published_at) OVER w <= INTERVAL 24 HOUR
            THEN epoch(published_at - lag(published_at) OVER w) END AS nearest_gap_s
FROM feed WINDOW w AS (ORDER BY published_at, story_id)""",
    ),
    "article_links": with_(
        FEED, body="SELECT f.story_id, l.quality, l.toxic FROM feed f JOIN labels l ON f.doc_id = l.doc_id"
    ),
    "stats_global": with_(
        FEED,
        body="""
SELECT count(*) AS total_articles, count(DISTINCT source) AS sources_count, max(published_at) AS latest_article,
       min(published_at) AS earliest_article, round(avg(length(headline)), 6) AS avg_headline_length FROM feed""",
    ),
    "quality_daily": with_(
        FEED,
        body="""
SELECT CAST(CAST(published_at AS DATE) AS VARCHAR) AS date, count(*) AS total_articles,
       count(*) FILTER (doc_id % 19 = 0 OR headline = '') AS missing_headline,
       count(*) FILTER (published_at IS NULL) AS missing_published_at,
       count(*) FILTER (doc_id % 7 = 0 OR source IS NULL OR source = '') AS missing_source,
       round(avg(length(headline)) FILTER (doc_id % 19 <> 0), 6) AS avg_headline_length,
       round(avg(length(body_text)), 6) AS avg_body_length
FROM feed GROUP BY 1""",
    ),
    "stats_by_source_lang_cat": with_(
        FEED,
        TAGGED,
        body="""
SELECT source, language, array_to_string(categories, ',') AS category, count(*) AS article_count,
       min(published_at) AS earliest_article, max(published_at) AS latest_article,
       round(avg(length(body_text)), 6) AS avg_body_length
FROM tagged GROUP BY 1, 2, 3""",
    ),
    "latest_time": "SELECT max(ts) AS latest_time FROM events",
    "category_tag_counts": with_(
        FEED,
        TAGGED,
        body="SELECT category, count(*) AS n FROM (SELECT unnest(categories) AS category FROM tagged) GROUP BY 1",
    ),
    "primary_category_counts": with_(
        FEED,
        TAGGED,
        body="SELECT categories[1] AS category, count(*) AS n FROM tagged WHERE len(categories) > 0 GROUP BY 1",
    ),
    "language_counts": """
SELECT CASE WHEN doc_id % 8 IN (0, 1) OR lang IS NULL OR lang = '' THEN 'unknown' ELSE lang END AS language, count(*) AS n
FROM documents GROUP BY 1""",
    "body_coverage": with_(
        FEED,
        PAGE_TEXT,
        WITH_PAGES,
        body="""
SELECT count(*) FILTER (length(body_text) > 0) AS with_body,
       count(*) - count(*) FILTER (length(body_text) > 0) AS without_body,
       round(100.0 * count(*) FILTER (length(body_text) > 0) / count(*), 6) AS body_rate
FROM with_pages""",
    ),
    "top_sources": with_(
        FEED, body="SELECT source, count(*) AS n FROM feed GROUP BY 1 ORDER BY n DESC, source LIMIT 10"
    ),
    "api_call_stats": """
SELECT count(*) AS total_calls, count(*) FILTER (event_type = 'error') AS error_count,
       round((count(*) - count(*) FILTER (event_type = 'error')) / greatest(count(*), 1), 6) AS success_rate,
       round(epoch(max(ts) - min(ts)), 6) AS runtime_seconds,
       round(count(*) / greatest(epoch(max(ts) - min(ts)) / 60, 1), 6) AS calls_per_minute,
       round(avg(round(value * 1000, 2)), 6) AS avg_response_ms
FROM events""",
    "ingest_summary": with_(
        FEED,
        BY_CATEGORY,
        body="""
SELECT coalesce(category, 'ALL') AS category, CAST(sum(fetched) AS BIGINT) AS fetched,
       CAST(sum(stored) AS BIGINT) AS stored, CAST(sum(failed) AS BIGINT) AS failed, sum(fetched) > 0 AS success
FROM by_category GROUP BY GROUPING SETS ((category), ())""",
    ),
    "freshness_check": with_(
        RUN_LOG,
        body="""
SELECT TIMESTAMP '2024-01-31' AS as_of, max(fetch_end) AS last_success,
       round(epoch(TIMESTAMP '2024-01-31' - max(fetch_end)) / 3600, 6) AS hours_since,
       TIMESTAMP '2024-01-31' - max(fetch_end) > INTERVAL 2 HOUR AS is_stale,
       count(*) FILTER (gap > INTERVAL 2 HOUR) AS n_gaps
FROM (SELECT fetch_end, fetch_end - lag(fetch_end) OVER (ORDER BY fetch_end) AS gap FROM fetch_log
      WHERE status = 'completed')""",
    ),
    "op_log_rollup": """
SELECT event_type AS operation, 'table_' || CAST(user_id % 3 AS VARCHAR) AS table_name, count(*) AS query_count,
       CAST(sum(floor(value)) AS BIGINT) AS rows_affected
FROM events GROUP BY 1, 2""",
    "dedup_keep_first": with_(
        FEED,
        body="SELECT story_id, 1 AS arrival, published_at FROM feed",
    ),
    "sample_per_category": with_(FEED, TAGGED, SAMPLES.format(source="tagged"), body="SELECT * FROM samples"),
    "top_n_per_category": """
SELECT event_type, CAST(rn AS INT) AS rn, event_id, ts
FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) AS rn FROM events) WHERE rn <= 10""",
    "page_running_totals": with_(
        FEED,
        OVERLAP,
        PAGES,
        PAGE_COUNTS,
        body="""
SELECT page, n_rows, new_rows, duplicates, CAST(sum(n_rows) OVER w AS BIGINT) AS total_n_rows,
       CAST(sum(new_rows) OVER w AS BIGINT) AS total_new_rows, CAST(sum(duplicates) OVER w AS BIGINT) AS total_duplicates
FROM page_counts WINDOW w AS (ORDER BY page)""",
    ),
    "page_cursor": with_(
        FEED,
        OVERLAP,
        PAGES,
        body="""
SELECT page, n_rows, lag(next_end) OVER (ORDER BY page) AS upper_bound, next_end,
       next_end <= TIMESTAMP '2024-01-01 12:00:00' AS stop
FROM (SELECT page, count(*) AS n_rows, min(published_at) - INTERVAL 1 SECOND AS next_end FROM paged GROUP BY page)""",
    ),
    "page_duplicate_counts": with_(FEED, OVERLAP, PAGES, PAGE_COUNTS, body="SELECT * FROM page_counts"),
    "order_by_priority": with_(
        FEED,
        TAGGED,
        body="""
SELECT row_number() OVER (ORDER BY priority_score DESC, story_id) AS rank, story_id, priority_score FROM tagged""",
    ),
    "union_pages_distinct": with_(
        FEED, body="SELECT story_id, CASE WHEN doc_id % 3 = 0 THEN 2 ELSE 1 END AS first_slice FROM feed"
    ),
    "html_to_text": with_(PAGE_TEXT, body="SELECT * FROM page_text"),
    "detect_categories": with_(
        FEED, TAGGED, body="SELECT story_id, array_to_string(categories, ',') AS category FROM tagged"
    ),
    "detect_urgency": with_(FEED, TAGGED, body="SELECT story_id, urgency_level FROM tagged"),
    "priority_score": with_(FEED, TAGGED, body="SELECT story_id, priority_score FROM tagged"),
    "normalize_source": with_(
        FEED, body="SELECT story_id, CASE WHEN doc_id % 5 = 0 THEN 'Reuters' ELSE source END AS source FROM feed"
    ),
    "detect_language": with_(
        FEED,
        languages("feed"),
        body="SELECT f.story_id, f.language, d.detected FROM feed f JOIN detected d USING (story_id)",
    ),
    "mask_params": """
SELECT event_id, 'k=' || regexp_extract(props, '[0-9]+') || ',Api_Key_Id=********' AS params FROM events""",
    "previous_day": """
SELECT event_id, ts FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-15' AND TIMESTAMP '2024-01-15 23:59:59'""",
    "headline_ngrams": with_(
        FEED,
        vectors("feed"),
        body="""
SELECT story_id, len(terms) AS n_terms, coalesce(array_to_string(terms, '|'), '') AS terms FROM term_lists""",
    ),
    "top_ngrams": with_(
        FEED,
        vectors("feed"),
        body="SELECT term, CAST(sum(tf) AS BIGINT) AS freq, count(*) AS df FROM counts GROUP BY term ORDER BY freq DESC, term LIMIT 100",
    ),
    "tfidf_weights": with_(
        FEED, vectors("feed"), body="SELECT story_id, term, round(weight, 6) AS weight FROM weights WHERE judge = day"
    ),
    "headline_cosine": with_(
        FEED,
        vectors("feed"),
        """
firsts AS (
  SELECT * FROM term_lists WHERE key IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY day, key ORDER BY published_at, story_id) = 1)""",
        cosines("firsts"),
        body="""
SELECT story_id, other_id, round(exact, 6) AS similarity FROM pairs
WHERE exact >= 0.85 - 1e-12 AND exact < 1 - 1e-9
QUALIFY row_number() OVER (PARTITION BY story_id ORDER BY round(exact, 6) DESC, other_at DESC, other_id DESC) = 1""",
    ),
    "near_duplicate_filter": with_(FEED, duplicates("feed"), body="SELECT * FROM duplicates"),
    "stream_ingest": with_(
        FEED,
        """
kept AS (
  SELECT * REPLACE (substr(headline, 1, 500) AS headline) FROM feed
  WHERE NOT regexp_matches(split_part(source_code, ':', -1), '(?i)src1'))""",
        tagged("kept"),
        body=f"""
SELECT story_id, published_at, array_to_string(categories, ',') AS category, urgency_level, priority_score FROM tagged
WHERE priority_score >= {REQUIRED} AND priority_score >= {RULES.minimum_score}""",
    ),
    "stream_sliding_counts": """
SELECT window_start, count(*) AS n
FROM (SELECT unnest([time_bucket(INTERVAL 5 MINUTE, ts) - to_minutes(CAST(5 * i AS INT)) FOR i IN range(12)])
      AS window_start FROM events)
GROUP BY 1""",
    "stream_daily_counts": """
SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n FROM events
GROUP BY 1, 2""",
    "stream_dedup": "SELECT event_id, ts FROM events",
    "stream_late_data": """
WITH marked AS (
  SELECT date_trunc('hour', ts) AS window_start, ts < TIMESTAMP '2024-01-15 12:00:00' AS early, event_id % 10 = 0 AS tenth, ts
  FROM events),
closed AS (SELECT max(ts) - INTERVAL 1 HOUR AS at FROM marked WHERE early AND NOT tenth)
SELECT window_start, count(*) AS n FROM marked, closed
WHERE NOT (early AND tenth AND window_start + INTERVAL 1 HOUR <= closed.at)
GROUP BY 1""",
    "stream_exclude_stored": "SELECT event_id, ts FROM events WHERE event_id % 2 <> 0",
    "stream_category_totals": "SELECT event_type, count(*) AS n FROM events GROUP BY 1",
    "ingest_feed": with_(
        FEED,
        """
kept AS (
  SELECT * REPLACE (substr(headline, 1, 500) AS headline) FROM feed
  WHERE NOT regexp_matches(split_part(source_code, ':', -1), '(?i)src1'))""",
        tagged("kept"),
        f"""
passed AS (SELECT * FROM tagged WHERE priority_score >= {REQUIRED} AND priority_score >= {RULES.minimum_score}),
stored AS (SELECT story_id, substr(headline, 1, 500) AS headline, published_at FROM feed WHERE doc_id % 25 = 0),
unstored AS (SELECT * FROM passed WHERE story_id NOT IN (SELECT story_id FROM stored)),
compared AS MATERIALIZED (
  SELECT * FROM stored
  WHERE published_at BETWEEN (SELECT min(published_at) - INTERVAL 24 HOUR FROM unstored)
                         AND (SELECT max(published_at) FROM unstored)
  UNION ALL
  SELECT story_id, headline, published_at FROM unstored)""",
        duplicates("compared"),
        languages("unstored"),
        body="""
SELECT p.story_id, p.headline, p.body_text, p.source, p.published_at, d.detected AS language,
       array_to_string(p.categories, ',') AS category, p.urgency_level, p.priority_score
FROM unstored p JOIN detected d USING (story_id)
WHERE p.story_id NOT IN (SELECT story_id FROM duplicates WHERE is_duplicate)""",
    ),
    "pipeline_ingest": with_(
        FEED,
        PAGE_TEXT,
        """
kept AS (
  SELECT * REPLACE (substr(headline, 1, 500) AS headline, p.text AS body_text)
  FROM feed LEFT JOIN page_text p ON p.page_id = feed.doc_id
  WHERE NOT regexp_matches(split_part(source_code, ':', -1), '(?i)src1'))""",
        tagged("kept"),
        f"""
passed AS (SELECT * FROM tagged WHERE priority_score >= {REQUIRED} AND priority_score >= {RULES.minimum_score}),
stored AS (SELECT story_id, substr(headline, 1, 500) AS headline, published_at FROM feed WHERE doc_id % 25 = 0),
unstored AS (SELECT * FROM passed WHERE story_id NOT IN (SELECT story_id FROM stored)),
compared AS MATERIALIZED (
  SELECT * FROM stored
  WHERE published_at BETWEEN (SELECT min(published_at) - INTERVAL 24 HOUR FROM unstored)
                         AND (SELECT max(published_at) FROM unstored)
  UNION ALL
  SELECT story_id, headline, published_at FROM unstored)""",
        duplicates("compared"),
        languages("unstored"),
        """
loaded AS (
  SELECT p.*, d.detected FROM unstored p JOIN detected d USING (story_id)
  WHERE p.story_id NOT IN (SELECT story_id FROM duplicates WHERE is_duplicate)),
arrived AS (SELECT count(*) + count(*) FILTER (doc_id % 10 = 0) AS n FROM feed)""",
        body="""
SELECT 'article' AS kind, story_id AS id, detected AS language, array_to_string(categories, ',') AS category,
       CAST(length(body_text) AS BIGINT) AS size, CAST(priority_score AS BIGINT) AS score
FROM loaded WHERE body_text IS NOT NULL
UNION ALL SELECT 'article', story_id, language, NULL, CAST(length(body_text) AS BIGINT), 0 FROM feed WHERE doc_id % 25 = 0
UNION ALL SELECT 'run', 'first', 'completed', '', n, (SELECT count(*) FROM loaded) FROM arrived
UNION ALL SELECT 'run', 'second', 'completed', '', n, 0 FROM arrived""",
    ),
    "load_since_newest": with_(
        FEED,
        """
half AS (SELECT *, doc_id <= (SELECT floor(max(doc_id) / 2) FROM documents) AS old FROM feed)""",
        """
kept AS (
  SELECT * REPLACE (substr(headline, 1, 500) AS headline) FROM half
  WHERE NOT old AND NOT regexp_matches(split_part(source_code, ':', -1), '(?i)src1'))""",
        tagged("kept"),
        f"""
added AS (SELECT published_at FROM tagged WHERE priority_score >= {REQUIRED} AND priority_score >= {RULES.minimum_score})""",
        body="""
SELECT (SELECT count(*) FROM half WHERE old) AS before, (SELECT count(*) FROM half WHERE NOT old) AS fetched,
  (SELECT count(*) FROM half WHERE old) + (SELECT count(*) FROM added) AS stored,
  greatest((SELECT max(published_at) FROM half WHERE old), (SELECT max(published_at) FROM added)) AS newest""",
    ),
    "load_by_category": with_(
        FEED,
        f"""
searched AS (SELECT *, lower(headline || ' ' || coalesce(body_text, '')) AS t FROM feed),
hits AS (
  {" UNION ALL ".join(f"SELECT story_id, published_at, {i} AS place, '{c}' AS category FROM searched WHERE {any_substring('t', terms)}" for i, (c, terms) in enumerate(RULES.search_terms.items()))}),
wanted AS (SELECT * FROM hits QUALIFY row_number() OVER (PARTITION BY category ORDER BY published_at DESC, story_id) <= 50)""",
        """
kept AS (
  SELECT * REPLACE (substr(headline, 1, 500) AS headline) FROM feed
  WHERE story_id IN (SELECT story_id FROM wanted) AND doc_id % 25 <> 0
    AND NOT regexp_matches(split_part(source_code, ':', -1), '(?i)src1'))""",
        tagged("kept"),
        f"""
added AS (SELECT story_id FROM tagged WHERE priority_score >= {REQUIRED} AND priority_score >= {RULES.minimum_score}),
told AS (SELECT w.*, a.story_id IS NOT NULL AS new, row_number() OVER (PARTITION BY w.story_id ORDER BY place) AS nth FROM wanted w LEFT JOIN added a USING (story_id))""",
        body="""
SELECT category, count(*) AS fetched, count(*) FILTER (new AND nth = 1) AS stored,
  count(*) - count(*) FILTER (new AND nth = 1) AS failed, count(*) FILTER (new AND nth > 1) AS duplicate_of_category
FROM told GROUP BY category""",
    ),
    "backfill_pages": with_(
        FEED,
        """
ranged AS (SELECT * FROM feed WHERE published_at BETWEEN TIMESTAMP '2024-01-01 06:04:00' AND TIMESTAMP '2024-01-03 17:27:00'),
kept AS (
  SELECT * REPLACE (substr(headline, 1, 500) AS headline) FROM ranged
  WHERE NOT regexp_matches(split_part(source_code, ':', -1), '(?i)src1'))""",
        tagged("kept"),
        f"""
added AS (SELECT published_at FROM tagged WHERE priority_score >= {REQUIRED} AND priority_score >= {RULES.minimum_score})""",
        body="""
SELECT CAST(ceil(count(*) / 200) AS BIGINT) AS runs, count(*) AS fetched, (SELECT count(*) FROM added) AS inserted,
  (SELECT count(*) FROM added) AS stored, (SELECT min(published_at) FROM added) AS oldest, 0 AS pages_again
FROM ranged""",
    ),
    "stream_load": with_(
        FEED,
        PAGE_TEXT,
        """
kept AS (
  SELECT * REPLACE (substr(headline, 1, 500) AS headline, p.text AS body_text)
  FROM feed LEFT JOIN page_text p ON p.page_id = feed.doc_id
  WHERE NOT regexp_matches(split_part(source_code, ':', -1), '(?i)src1'))""",
        tagged("kept"),
        body=f"""
SELECT story_id, published_at, array_to_string(categories, ',') AS category, priority_score, coalesce(length(body_text), 0) AS body_length FROM tagged
WHERE priority_score >= {REQUIRED} AND priority_score >= {RULES.minimum_score}""",
    ),
    "category_report": with_(
        FEED,
        PAGE_TEXT,
        WITH_PAGES,
        tagged("with_pages"),
        SAMPLES.format(source="tagged"),
        """
sources AS (SELECT source, count(*) AS n FROM tagged GROUP BY 1 ORDER BY n DESC, source LIMIT 10)""",
        body="""
SELECT 'total' AS section, 'articles' AS key, CAST(count(*) AS VARCHAR) AS value FROM tagged
UNION ALL SELECT 'category_tag', c, CAST(count(*) AS VARCHAR) FROM (SELECT unnest(categories) AS c FROM tagged) GROUP BY c
UNION ALL SELECT 'primary_category', categories[1], CAST(count(*) AS VARCHAR) FROM tagged WHERE len(categories) > 0 GROUP BY 2
UNION ALL SELECT 'language', language, CAST(count(*) AS VARCHAR) FROM tagged GROUP BY 2
UNION ALL SELECT 'body', CASE WHEN length(body_text) > 0 THEN 'with_body' ELSE 'without_body' END,
                 CAST(count(*) AS VARCHAR) FROM tagged GROUP BY 2
UNION ALL SELECT 'source', source, CAST(n AS VARCHAR) FROM sources
UNION ALL SELECT 'body', 'body_rate',
                 CAST(round(100.0 * count(*) FILTER (length(body_text) > 0) / count(*), 1) AS VARCHAR) FROM tagged
UNION ALL SELECT 'sample', category || '#' || CAST(rn AS VARCHAR), preview FROM samples""",
    ),
    "weekly_maintenance": """
WITH kept AS (SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-17')
SELECT 'deleted' AS metric, (SELECT count(*) FROM events) - count(*) AS value FROM kept
UNION ALL SELECT 'kept', count(*) FROM kept
UNION ALL SELECT 'sources', count(DISTINCT event_type) FROM kept
UNION ALL SELECT 'earliest_epoch_s', CAST(floor(epoch(min(ts))) AS BIGINT) FROM kept
UNION ALL SELECT 'latest_epoch_s', CAST(floor(epoch(max(ts))) AS BIGINT) FROM kept""",
}
