"""Inputs derived from the given tables, as SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_MS = 1_700_000_000_000
NOW_MS = BASE_MS + 10_000
AGENT = "mybot"
MAX_BYTES = 12_000

INPUTS = {
    # part -> next part of the same order: cyclic, a few self-links
    "part_edges": """
        SELECT src, dst FROM (
          SELECT 'p' || CAST(l_partkey AS STRING) AS src,
                 'p' || CAST(lead(l_partkey) OVER (
                     PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS STRING) AS dst
          FROM lineitem) chain
        WHERE dst IS NOT NULL""",
    # the same and part -> supplier: suppliers link nowhere
    "supply_edges": """
        SELECT src, dst FROM part_edges
        UNION ALL
        SELECT 'p' || CAST(l_partkey AS STRING) AS src, 's' || CAST(l_suppkey AS STRING) AS dst
        FROM lineitem""",
    # event type -> next type of the same user: five nodes, many parallel links and self-links
    "event_edges": """
        SELECT src, dst FROM (
          SELECT event_type AS src,
                 lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS dst
          FROM events) chain
        WHERE dst IS NOT NULL""",
    "page_hosts": "SELECT DISTINCT split_part(url, '/', 3) AS host FROM pages",
    "fetch_log": """
        SELECT url,
               CASE page_id % 7 WHEN 0 THEN 301 WHEN 1 THEN 404 ELSE 200 END AS status,
               CASE WHEN page_id % 5 = 0 THEN 'application/pdf'
                    ELSE 'text/html; charset=utf-8' END AS content_type,
               CAST(length(html) AS BIGINT) AS content_length,
               CASE WHEN page_id % 7 = 0 THEN
                    CASE WHEN page_id % 2 = 0 THEN '/rel' ELSE url || '/moved' END END AS location
        FROM pages""",
    "robots_bodies": """
        SELECT host,
               'User-agent: *' || chr(10) || 'Disallow: ' ||
               CASE WHEN substr(sha1(host), 1, 1) < '8' THEN '/de/' ELSE '/es/' END || chr(10) ||
               'Crawl-delay: 0.5' || chr(10) || chr(10) ||
               CASE WHEN substr(sha1(host), 1, 1) < 'c' THEN
                 'User-agent: mybot' || chr(10) || 'User-agent: other' || chr(10) ||
                 'Disallow: ' || CASE WHEN substr(sha1(host), 2, 1) < '8' THEN '/fr/' ELSE '/en/1' END ||
                 chr(10) || 'Disallow:' || chr(10) || 'Allow: /fr/1' || chr(10) ||
                 'Crawl-delay: 2' || chr(10) || 'Crawl-delay: 3' || chr(10) ||
                 'Sitemap: http://' || host || '/s.xml' || chr(10) || chr(10)
               ELSE '' END ||
               'User-agent: last' || chr(10) || 'Disallow:' AS body
        FROM page_hosts""",
    # hosts whose name has an even length are not known yet
    "host_state": f"""
        SELECT host, CAST(1 + (length(host) % 4) * 0.5 AS DOUBLE) AS crawl_delay,
               {BASE_MS} AS next_request_ms
        FROM page_hosts WHERE length(host) % 2 = 1""",
    "frontier": f"""
        SELECT url, split_part(url, '/', 3) AS host,
               CAST({BASE_MS} + page_id * 500 AS BIGINT) AS next_request_ms,
               CAST('text/html' AS STRING) AS content_type
        FROM pages""",
    "arrivals": """
        SELECT 'http://u' || CAST(user_id AS STRING) || '.example.org/' ||
               CAST(event_id % 50 AS STRING) AS url,
               'u' || CAST(user_id AS STRING) || '.example.org' AS host,
               event_id AS arrival
        FROM events""",
    "arrival_hosts": f"""
        SELECT host, CAST(1 + (length(host) % 4) * 0.3 AS DOUBLE) AS crawl_delay,
               {BASE_MS} AS next_request_ms
        FROM (SELECT DISTINCT host FROM arrivals) hosts WHERE length(host) % 2 = 1""",
    "manifest": f"""
        SELECT 'doc-' || CAST(doc_id AS STRING) AS key, doc_id % 50 = 0 AS is_dir,
               CAST({BASE_MS} - doc_id * 1000 AS BIGINT) AS modified_ms
        FROM documents""",
    "copied": "SELECT 'doc-' || CAST(doc_id AS STRING) AS key FROM documents WHERE doc_id % 3 = 0",
}

# Which inputs an input is built from.
NEEDS = {
    "supply_edges": ("part_edges",),
    "robots_bodies": ("page_hosts",),
    "host_state": ("page_hosts",),
    "arrival_hosts": ("arrivals",),
}
TABLES = ("lineitem", "events", "documents", "pages")


def ordered(names) -> list[str]:
    """``names`` with what they are built from, each after what it needs."""
    result: list[str] = []
    for name in names:
        for part in (*ordered(NEEDS.get(name, ())), name):
            if part not in result:
                result.append(part)
    return result


def with_inputs(sql: str, *names: str) -> str:
    """``sql`` with the named inputs as common table expressions in front."""
    parts = ",\n".join(f"{name} AS ({INPUTS[name]})" for name in ordered(names))
    return f"WITH {parts},\n{sql}" if names else f"WITH {sql}"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, or one of the inputs above."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    for table in TABLES:
        if table in INPUTS[name] or any(table in INPUTS[part] for part in ordered((name,))):
            load(spark, sf_dir, table).createOrReplaceTempView(table)
    return spark.sql(f"{with_inputs(f'result AS ({INPUTS[name]})', *NEEDS.get(name, ()))} SELECT * FROM result")
