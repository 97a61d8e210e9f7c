"""DuckDB text of the bindings, for the oracle side of the checked queries.

These mirror ``pressroom.plans.bindings`` over the same driver views; an
oracle is ``with_(["news", ...], "SELECT ...", extra_ctes)``.
"""

from __future__ import annotations

NEWS = """
SELECT doc_id AS id, split_part(text, chr(10), 1) AS title, text AS content,
  '' AS summary,
  TIMESTAMP '2024-06-01' + (doc_id % 2160) * INTERVAL 1 HOUR AS published_at,
  source, concat('https://', source, '.example.com/', CAST(doc_id AS VARCHAR)) AS url,
  CAST(NULL AS DOUBLE[]) AS vectorized_content,
  lang,
  doc_id % 6 = 0 AS is_vectorized,
  (lang <> 'en' AND doc_id % 3 = 0) AS is_translated,
  doc_id % 10 <> 0 AS is_public,
  doc_id % 4 IN (1, 2) AS is_requested_for_summarization,
  doc_id % 4 = 2 AS is_summarized,
  CASE WHEN doc_id % 4 IN (1, 2) THEN 's' || CAST(doc_id AS VARCHAR) ELSE '' END AS summarization_request_id,
  doc_id % 5 = 2 AS is_scored,
  doc_id % 5 IN (1, 2) AS is_requested_for_scoring,
  CASE WHEN doc_id % 5 IN (1, 2) THEN 'r' || CAST(doc_id AS VARCHAR) ELSE '' END AS score_request_id,
  CAST(0.0 AS DOUBLE) AS score
FROM documents"""

REPLIES = """
SELECT 'r' || CAST(doc_id AS VARCHAR) AS request_id, doc_id % 3 <> 0 AS done,
  CASE WHEN doc_id % 7 = 0 THEN 'none' ELSE 'theme ' || CAST(doc_id % 12 AS VARCHAR) || ' of 12' END AS text
FROM documents
UNION ALL
SELECT 's' || CAST(doc_id AS VARCHAR), doc_id % 3 <> 1, 'summary: ' || text
FROM documents"""

AUTHORITY = """
SELECT DISTINCT CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) + 1 AS rank, source AS name
FROM documents"""

DIGEST = """
SELECT k AS id, CAST(DATE '2024-06-01' + CAST(7 * k AS INTEGER) AS DATE) AS start_date,
  CAST(DATE '2024-06-01' + CAST(7 * k + 6 AS INTEGER) AS DATE) AS end_date, k % 4 <> 0 AS is_public
FROM (SELECT unnest(range(0, CAST(max(floor(date_diff('day', DATE '2024-06-01', CAST(published_at AS DATE)) / 7)) AS BIGINT) + 3)) AS k
      FROM news)"""

LISTING = """
SELECT *, CAST(floor(pos / 20) AS INTEGER) AS page FROM (
  SELECT n.*, row_number() OVER (PARTITION BY source
         ORDER BY CASE WHEN id % 97 = 0 THEN 0 ELSE 1 END, id DESC) - 1 AS pos FROM news n)"""

RUN_LOG = """
SELECT 'ingest' AS dag_id, event_type AS task_id,
  CASE WHEN value > 5 THEN 'SUCCESS' ELSE 'FAILED' END AS state, CAST(ts AS TIMESTAMP) AS end_date
FROM events"""

PROMPTS = """
SELECT conv_id * 1000 + turn AS id, text AS prompt, (conv_id * 1000 + turn) % 5 = 0 AS in_use
FROM conversations"""

EMAILS = """
SELECT doc_id * 1000 + k - 1 AS id, e[k] AS email FROM (
  SELECT doc_id, e, unnest(range(1, len(e) + 1)) AS k FROM (
    SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}') AS e
    FROM documents))"""

BINDINGS = {
    "news": NEWS, "replies": REPLIES, "authority": AUTHORITY, "digest": DIGEST,
    "listing": LISTING, "run_log": RUN_LOG, "prompts": PROMPTS, "emails": EMAILS,
}
# Bindings that read other bindings.
DEPENDS = {"digest": ["news"], "listing": ["news"]}


def with_(names: list[str], body: str, ctes: list[tuple[str, str]] | None = None) -> str:
    order: list[str] = []

    def add(n: str) -> None:
        for dep in DEPENDS.get(n, []):
            add(dep)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = [f"{n} AS ({BINDINGS[n]})" for n in order]
    parts += [f"{n} AS ({sql})" for n, sql in (ctes or [])]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


# Character references that occur in the driver's pages (&amp; last).
PAGE_ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\xa0"),
                 ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))


def unescape(expr: str) -> str:
    """Character references of the driver's pages, decoded one by one."""
    for ent, ch in PAGE_ENTITIES:
        lit = ch.replace("'", "''")
        expr = f"replace({expr}, '{ent}', '{lit}')"
    return expr


def strip_tags(expr: str) -> str:
    return unescape(f"regexp_replace({expr}, '<[^>]*>', '', 'g')")


def container(expr: str, tag: str = "article") -> str:
    return rf"regexp_extract({expr}, '(?s)<{tag}\b[^>]*>(.*?)</{tag}>', 1)"


def paragraphs(fragment: str) -> str:
    piece_text = strip_tags("split_part(piece, '</p>', 1)")
    return (rf"list_transform(regexp_split_to_array({fragment}, '<p\b[^>]*>')[2:], "
            f"lambda piece: {piece_text})")
