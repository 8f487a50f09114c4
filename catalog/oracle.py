"""The SQL twin of every query, for DuckDB."""

from __future__ import annotations

from catalog.inputs import AGENT, MAX_BYTES, NOW_MS, with_inputs
from linkgraph.functions.urls import (
    BRACKET_BEFORE_QUERY, EMPTY_AUTHORITY, HOST, ILL_FORMED, IPV6_HOST, OPAQUE, PATH, SCHEME)

LINK_SCHEMES = ("http", "https", "ftp", "file", "mailto", "jar")
AUTHORITY = r"^[a-z]+://(?:[^/?#@]*@)?(?:\[[^\]]*\]|[^/?#:]*)(?::(?:-1|[0-9]{0,9}))?(?:[/?#]|$)"

ORACLE_SQL: dict[str, str] = {}


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def twin(name: str, sql: str, *inputs: str) -> None:
    """Register ``sql``, a chain of table expressions that ends in one named ``result``."""
    ORACLE_SQL[name] = f"{with_inputs(sql, *inputs)}\nSELECT * FROM result"


def host(url: str) -> str:
    return f"regexp_extract({url}, {quoted(HOST)}, 1)"


def legal(link: str) -> str:
    bracket = (
        f"(regexp_matches(regexp_replace({link}, {quoted(IPV6_HOST)}, '\\1'), {quoted(BRACKET_BEFORE_QUERY)})"
        f" AND NOT regexp_matches({link}, {quoted(OPAQUE)}))")
    return f"NOT (regexp_matches({link}, {quoted(ILL_FORMED)}) OR {bracket})"


def absolute(link: str, ok: str) -> str:
    scheme = f"lower(regexp_extract({link}, {quoted(SCHEME)}, 1))"
    low = f"({scheme} || substr({link}, length({scheme}) + 1))"
    schemes = ", ".join(quoted(s) for s in LINK_SCHEMES)
    canonical = f"regexp_replace({low}, {quoted(EMPTY_AUTHORITY)}, '\\1:\\2')"
    return (
        f"CASE WHEN {ok} AND {scheme} IN ({schemes}) AND ({scheme} <> 'jar' OR contains({link}, '!/'))"
        f" AND (NOT regexp_matches({low}, '^[a-z]+://') OR regexp_matches({low}, {quoted(AUTHORITY)}))"
        f" THEN {canonical} END")


# what the test pages hold: anchors with a double-quoted href, and the hrefs only "&amp;" for a reference
SILENT = "(?s)<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<title>.*?</title>"
ANCHORS = f"""
lists AS (
  SELECT page_id, url, regexp_extract_all(
    regexp_replace(html, {quoted(SILENT)}, '', 'g'), '<a [^>]*?href="([^"]*)"', 1) AS hs
  FROM pages),
anchors AS (
  SELECT page_id, url, CAST(generate_subscripts(hs, 1) - 1 AS INTEGER) AS ord,
         replace(unnest(hs), '&amp;', '&') AS href
  FROM lists)"""


def resolved(source: str) -> str:
    """``page_id, url, ord, link`` of the hrefs in ``source``."""
    return f"""
based AS (
  SELECT page_id, url, ord, href, lower(regexp_extract(url, {quoted(SCHEME)}, 1)) AS proto,
         {host('url')} AS host, regexp_extract(url, {quoted(PATH)}, 1) AS path
  FROM {source}),
cut AS (
  SELECT *, CASE WHEN trim(path) = '' THEN '/'
                 WHEN contains(split_part(path, '/', -1), '.') THEN regexp_replace(path, '/[^/]*$', '')
                 ELSE path END AS dir
  FROM based),
full_links AS (
  SELECT *, CASE WHEN starts_with(href, '//') THEN proto || ':' || href
                 WHEN regexp_matches(href, {quoted(SCHEME)}) THEN href
                 WHEN starts_with(href, '/') THEN proto || '://' || host || href
                 ELSE proto || '://' || host || dir ||
                      CASE WHEN ends_with(dir, '/') THEN '' ELSE '/' END || href END AS f
  FROM cut),
links AS (
  SELECT page_id, url, ord, {absolute('f', legal('href'))} AS link FROM full_links),
good_links AS (SELECT * FROM links WHERE link IS NOT NULL)"""


PAGE_LINKS = ANCHORS + "," + resolved("anchors")
TARGETS = """
target_lists AS (
  SELECT page_id, string_agg(link, '|' ORDER BY ord) AS targets FROM good_links GROUP BY page_id)"""
BODY = r"""regexp_replace(regexp_replace(regexp_replace({0}, '\r\n|\r', chr(10), 'g'),
    '^[\x00-\x20]+', ''), '[\x00-\x20]+\z', '')"""


def rank_steps(steps: int, edges: str, distinct: bool = False) -> str:
    """Tables ``r0`` to ``r<steps>`` over the edge table ``edges``."""
    unique = "DISTINCT" if distinct else ""
    parts = [f"""
e AS (SELECT {unique} src, dst FROM {edges} WHERE src <> dst),
d AS (SELECT src, count(*) AS out_degree FROM e GROUP BY src),
n AS (SELECT src AS node FROM e UNION SELECT dst FROM e),
r0 AS (SELECT src AS node, out_degree, CAST(1 AS DOUBLE) AS rank FROM d)"""]
    for i in range(steps):
        parts.append(f"""
c{i + 1} AS (
  SELECT e.dst AS node, sum(r.rank / r.out_degree) AS received
  FROM e JOIN r{i} r ON r.node = e.src GROUP BY e.dst),
r{i + 1} AS (
  SELECT n.node, d.out_degree, 0.15 + 0.85 * coalesce(c.received, 0) AS rank
  FROM n LEFT JOIN d ON d.src = n.node LEFT JOIN c{i + 1} c ON c.node = n.node)""")
    return ",".join(parts)


def rank_delta(before: int, after: int) -> str:
    return f"""
delta AS (
  SELECT coalesce(a.node, b.node) AS node, abs(coalesce(a.rank, 1) - coalesce(b.rank, 1)) AS delta
  FROM r{before} a FULL JOIN r{after} b ON a.node = b.node)"""


# Pages, links and URLs

twin("extract_links", f"{ANCHORS}, result AS (SELECT * FROM anchors)")
twin("extract_links_hostile", f"""{ANCHORS},
numbers AS (SELECT page_id, url, CAST(len(hs) AS INTEGER) AS n FROM lists),
result AS (
  SELECT page_id, url, CAST(ord + 1 AS INTEGER) AS ord, href FROM anchors
  UNION ALL SELECT page_id, url, 0, '/crowded?' || page_id FROM numbers
  UNION ALL SELECT page_id, url, CAST(n + 1 AS INTEGER), '/single' FROM numbers)""")
twin("decode_references_pages", """
result AS (
  SELECT page_id, url || '?a&lt;A' || chr(233) || '&lt;&copy=1' || chr(8770) || chr(824) || chr(8364)
         || '&nope;&#128;' || page_id AS href
  FROM pages)""".replace("&#128;", "' || chr(8364) || '"))
twin("resolve_links", f"{PAGE_LINKS}, result AS (SELECT * FROM good_links)")
twin("resolve_link_shapes", ANCHORS + """,
shapes AS (
  SELECT page_id, url, ord, substr(href, 2) AS bare, href FROM anchors),
shape_lists AS (
  SELECT page_id, url, ord, [href, bare, '//k.org' || href, 'HTTPS://K.org' || href, '?q=' || bare,
         '#' || bare, 'mailto:' || bare || '@y.z', 'javascript:' || bare, bare || ' x',
         href || '%zz', '../' || bare, 'http://h:80x' || href, 'http://u@h:81' || href, '',
         href || '?a[]=1', href || '[0]'] AS forms
  FROM shapes),
shaped AS (
  SELECT page_id, url, CAST(ord * 100 + generate_subscripts(forms, 1) - 1 AS INTEGER) AS ord,
         unnest(forms) AS href
  FROM shape_lists),""" + resolved("shaped") + ", result AS (SELECT * FROM good_links)")
twin("url_parts_of_pages", f"""
result AS (
  SELECT page_id, lower(regexp_extract(url, {quoted(SCHEME)}, 1)) AS protocol,
         split_part(split_part(url, '/', 3), ':', 1) AS host,
         '/' || regexp_replace(regexp_replace(url, '^[a-z]+://[^/]*/', ''), '[?#].*$', '') AS path
  FROM pages)""")
twin("drop_trap_urls", """
trapped AS (
  SELECT page_id, url || repeat('/..', CAST(page_id % 5 AS INTEGER)) AS url FROM pages),
result AS (SELECT * FROM trapped WHERE len(string_split(url, '..')) - 1 < 3)""")
twin("normalise_bodies", r"""
messy AS (
  SELECT page_id, ' ' || chr(13) || chr(10) || replace(html, '><', '>' || chr(13) || chr(10) || chr(9) || '<')
         || chr(13) || ' ' || chr(1) || chr(10) AS html
  FROM pages),
result AS (SELECT page_id, """ + BODY.format("html") + " AS body FROM messy)")
twin("crawl_outputs", PAGE_LINKS + "," + TARGETS + """,
result AS (
  SELECT p.page_id, p.url, """ + BODY.format("p.html") + """ AS body, coalesce(t.targets, '') AS targets
  FROM pages p LEFT JOIN target_lists t ON t.page_id = p.page_id)""")
twin("seed_urls", """
result AS (SELECT unnest([url, url || '/a', url || '/b']) AS url FROM pages)""")
twin("distinct_url_batch", "result AS (SELECT DISTINCT url FROM arrivals)", "arrivals")

twin("url_batch_candidates", """
result AS (
  SELECT url, split_part(url, '/', 3) AS host FROM pages
  UNION ALL SELECT replace(url, '://', '://u@'), split_part(url, '/', 3) FROM pages
  UNION ALL SELECT 'HTTP://H.org:8080/' || page_id, 'H.org' FROM pages)""")

# Edges and ranks

twin("page_edges", f"{PAGE_LINKS}, result AS (SELECT url AS src, link AS dst FROM good_links WHERE url <> link)")
twin("link_list_round_trip", PAGE_LINKS + """,
pieces AS (
  SELECT page_id, url, ord, generate_subscripts(string_split(link, ','), 1) AS i,
         trim(unnest(string_split(link, ','))) AS piece
  FROM good_links),
result AS (
  SELECT url AS source, string_agg(piece, '|' ORDER BY ord, i) AS targets
  FROM pieces WHERE piece <> '' GROUP BY page_id, url)""")
twin("pair_counts", """
result AS (SELECT src, dst, count(*) AS m FROM event_edges WHERE src <> dst GROUP BY src, dst)""",
     "event_edges")
twin("edge_weights", """
e AS (SELECT src, dst FROM event_edges WHERE src <> dst),
result AS (
  SELECT src, dst, round(count(*) * 1.0 / (SELECT count(*) FROM e x WHERE x.src = e.src), 6) AS w
  FROM e GROUP BY src, dst)""", "event_edges")
twin("pagerank_init_parts", rank_steps(0, "part_edges") + ", result AS (SELECT * FROM r0)", "part_edges")
twin("flagship_page_ranks", PAGE_LINKS + """,
page_edges AS (SELECT url AS src, link AS dst FROM good_links),""" + rank_steps(1, "page_edges") + """,
result AS (SELECT node, round(rank, 6) AS rank FROM r1 ORDER BY rank DESC, node)""")
twin("pagerank_contributions_events", rank_steps(1, "event_edges") + """,
result AS (SELECT node, round(received, 6) AS received FROM c1)""", "event_edges")

RANKED = "result AS (SELECT node, out_degree, round(rank, 6) AS rank FROM r{0})"
twin("pagerank_step_supply", rank_steps(1, "supply_edges") + "," + RANKED.format(1), "supply_edges")
twin("pagerank_3_iterations_parts", rank_steps(3, "part_edges") + "," + RANKED.format(3), "part_edges")
twin("pagerank_3_iterations_supply", rank_steps(3, "supply_edges") + "," + RANKED.format(3), "supply_edges")
twin("pagerank_resumed_parts", rank_steps(3, "part_edges") + "," + RANKED.format(3), "part_edges")
twin("pagerank_3_iterations_events", rank_steps(3, "event_edges") + "," + RANKED.format(3), "event_edges")
twin("pagerank_distinct_edges_parts", rank_steps(2, "part_edges", True) + "," + RANKED.format(2), "part_edges")
twin("rank_states_union", rank_steps(1, "supply_edges") + """,
result AS (
  SELECT node, round(rank, 6) AS rank FROM r0 UNION ALL SELECT node, round(rank, 6) FROM r1)""",
     "supply_edges")
twin("read_rank_state_files", rank_steps(1, "supply_edges") + """,
result AS (
  SELECT 0 AS step, node, out_degree, round(rank, 6) AS rank FROM r0
  UNION ALL SELECT 1, node, out_degree, round(rank, 6) FROM r1)""", "supply_edges")
twin("rank_files_round_trip", rank_steps(2, "part_edges") + """,
result AS (SELECT node, round(rank, 6) AS rank FROM r2)""", "part_edges")
twin("rank_delta_supply", rank_steps(1, "supply_edges") + "," + rank_delta(0, 1) + """,
result AS (SELECT node, round(delta, 6) AS delta FROM delta)""", "supply_edges")
twin("max_delta_supply", rank_steps(2, "supply_edges") + "," + rank_delta(1, 2) + """,
result AS (SELECT round(max(delta), 6) AS max_delta FROM delta)""", "supply_edges")
twin("pagerank_finish_parts", rank_steps(2, "part_edges") + """,
result AS (SELECT node, round(rank, 6) AS rank FROM r2 ORDER BY r2.rank DESC, node)""", "part_edges")
twin("pagerank_top_parts", rank_steps(2, "part_edges") + """,
result AS (SELECT node, round(rank, 6) AS rank FROM r2 ORDER BY r2.rank DESC, node LIMIT 10)""", "part_edges")
twin("pagerank_until_converged_parts", rank_steps(6, "part_edges") + "," + ",".join(f"""
m{i} AS (
  SELECT max(abs(coalesce(a.rank, 1) - coalesce(b.rank, 1))) AS delta
  FROM r{i - 1} a FULL JOIN r{i} b ON a.node = b.node)""" for i in range(1, 7)) + """,
last_step AS (
  SELECT CASE WHEN (SELECT delta FROM m1) <= 0.05 THEN 1 WHEN (SELECT delta FROM m2) <= 0.05 THEN 2
              WHEN (SELECT delta FROM m3) <= 0.05 THEN 3 WHEN (SELECT delta FROM m4) <= 0.05 THEN 4
              WHEN (SELECT delta FROM m5) <= 0.05 THEN 5 ELSE 6 END AS k),
every_step AS (""" + " UNION ALL ".join(f"SELECT {i} AS k, node, rank FROM r{i}" for i in range(1, 7)) + """),
result AS (
  SELECT node, round(rank, 6) AS rank FROM every_step WHERE k = (SELECT k FROM last_step))""", "part_edges")

twin("pagerank_stored_until_converged_supply", rank_steps(4, "supply_edges") + "," + ",".join(f"""
m{i} AS (
  SELECT max(abs(coalesce(a.rank, 1) - coalesce(b.rank, 1))) AS delta
  FROM r{i - 1} a FULL JOIN r{i} b ON a.node = b.node)""" for i in range(1, 5)) + """,
last_step AS (
  SELECT CASE WHEN (SELECT delta FROM m1) <= 0.3 THEN 1 WHEN (SELECT delta FROM m2) <= 0.3 THEN 2
              WHEN (SELECT delta FROM m3) <= 0.3 THEN 3 ELSE 4 END AS k),
every_step AS (""" + " UNION ALL ".join(f"SELECT {i} AS k, * FROM r{i}" for i in range(1, 5)) + """),
result AS (
  SELECT node, out_degree, round(rank, 6) AS rank FROM every_step
  WHERE k = (SELECT k FROM last_step))""", "supply_edges")

# Frontier

FIRST = """
first_arrivals AS (
  SELECT url, any_value(host) AS host, min(arrival) AS arrival FROM arrivals GROUP BY url)"""
twin("admit_unseen", FIRST + """,
result AS (
  SELECT * FROM first_arrivals
  WHERE NOT ends_with(url, '7') AND url NOT IN (SELECT url FROM frontier))""", "arrivals", "frontier")
twin("seen_after_admission", """
result AS (SELECT url FROM frontier UNION SELECT url FROM arrivals)""", "arrivals", "frontier")
twin("first_occurrence", FIRST + ", result AS (SELECT * FROM first_arrivals)", "arrivals")
twin("host_lookup", """
result AS (
  SELECT f.url, f.host, coalesce(h.next_request_ms, 0) AS next_request_ms, h.host IS NULL AS needs_robots
  FROM frontier f LEFT JOIN host_state h ON h.host = f.host)""", "frontier", "host_state")
SCHEDULED = FIRST + """,
result AS (
  SELECT a.url, a.host, a.arrival, CAST(coalesce(h.next_request_ms
         + row_number() OVER (PARTITION BY a.host ORDER BY a.arrival, a.url)
         * CAST(floor(h.crawl_delay * 1000) AS BIGINT), 0) AS BIGINT) AS next_request_ms
  FROM first_arrivals a LEFT JOIN arrival_hosts h ON h.host = a.host)"""
twin("politeness_schedule", SCHEDULED, "arrivals", "arrival_hosts")
twin("stream_schedule", SCHEDULED, "arrivals", "arrival_hosts")
twin("stream_schedule_new_hosts", SCHEDULED, "arrivals", "arrival_hosts")
twin("politeness_host_times", """
totals AS (SELECT host, count(DISTINCT url) AS n FROM arrivals GROUP BY host),
result AS (
  SELECT h.host, h.crawl_delay, CAST(h.next_request_ms
         + coalesce(t.n, 0) * CAST(floor(h.crawl_delay * 1000) AS BIGINT) AS BIGINT) AS next_request_ms
  FROM arrival_hosts h LEFT JOIN totals t ON t.host = h.host)""", "arrivals", "arrival_hosts")
ROUTED = f"""
actions AS (
  SELECT url, split_part(url, '/', 3) AS host, content_type, location,
         CASE WHEN status IN (301, 302, 307) AND location LIKE 'http%' THEN 'redirect'
              WHEN status = 200 AND starts_with(content_type, 'text/html')
                   AND coalesce(content_length, 0) <= {MAX_BYTES} THEN 'fetch'
              ELSE 'drop' END AS action
  FROM fetch_log),
routed AS (
  SELECT a.url, a.action,
         CASE a.action WHEN 'redirect' THEN a.location WHEN 'fetch' THEN a.url END AS target,
         a.content_type,
         CASE WHEN a.action <> 'drop' THEN coalesce(h.next_request_ms, 0) END AS next_request_ms
  FROM actions a LEFT JOIN host_state h ON h.host = a.host)"""
twin("route_fetches", ROUTED + ", result AS (SELECT * FROM routed)", "fetch_log", "host_state")

PAIRS = r"""
blocks AS (
  SELECT host, generate_subscripts(string_split(body, chr(10) || chr(10)), 1) - 1 AS block_no,
         unnest(string_split(body, chr(10) || chr(10))) AS block
  FROM robots_bodies),
token_lists AS (
  SELECT host, block_no, string_split_regex(regexp_replace(block, '[\n:]+\z', ''), '[\n:]') AS tokens
  FROM blocks),
positions AS (
  SELECT host, block_no, tokens, unnest(generate_series(1, len(tokens) - 1)) AS i FROM token_lists),
pairs AS (
  SELECT host, block_no, i - 1 AS pos, lower(trim(tokens[i])) AS key, trim(tokens[i + 1]) AS value
  FROM positions),
block_agents AS (SELECT host, block_no, value AS agent FROM pairs WHERE key = 'user-agent'),
block_rules AS (
  SELECT host, block_no, pos, key, value FROM pairs WHERE key IN ('disallow', 'allow', 'sitemap')
  UNION ALL
  SELECT host, block_no, max(pos), 'crawl-delay',
         CAST(greatest(CAST(arg_max(value, pos) AS DOUBLE), 1.0) AS VARCHAR)
  FROM pairs WHERE key = 'crawl-delay' GROUP BY host, block_no),
rules AS (
  SELECT a.host, a.agent, r.key AS directive, r.value,
         CAST(r.block_no AS BIGINT) * 4294967296 + r.pos AS ord
  FROM block_agents a JOIN block_rules r ON r.host = a.host AND r.block_no = a.block_no)"""
DELAYS = f"""
delays AS (
  SELECT host, coalesce(
    arg_max(CAST(value AS DOUBLE), ord) FILTER (WHERE directive = 'crawl-delay' AND agent = '{AGENT}'),
    arg_max(CAST(value AS DOUBLE), ord) FILTER (WHERE directive = 'crawl-delay' AND agent = '*'),
    1.0) AS crawl_delay
  FROM (SELECT host, agent, directive, CASE WHEN directive = 'crawl-delay' THEN value END AS value, ord
        FROM rules) r
  GROUP BY host)"""
twin("parse_robots", PAIRS + ", result AS (SELECT * FROM rules)", "robots_bodies")
AGENTS = """
agents AS (
  SELECT host, unnest(['*', 'last']) AS agent FROM robots_bodies
  UNION ALL SELECT host, unnest(['mybot', 'other']) FROM robots_bodies WHERE substr(sha1(host), 1, 1) < 'c')"""
twin("known_agents", AGENTS + ", result AS (SELECT * FROM agents)", "robots_bodies")
twin("host_rules", PAIRS + "," + AGENTS + """,
result AS (
  SELECT host, agent,
         coalesce(string_agg(value, '|' ORDER BY ord) FILTER (WHERE directive = 'disallow'), '') AS disallow,
         coalesce(string_agg(value, '|' ORDER BY ord) FILTER (WHERE directive = 'allow'), '') AS allow,
         coalesce(string_agg(value, '|' ORDER BY ord) FILTER (WHERE directive = 'sitemap'), '') AS sitemaps,
         CAST(arg_max(value, ord) FILTER (WHERE directive = 'crawl-delay') AS DOUBLE) AS crawl_delay
  FROM (SELECT host, agent, directive, value, ord FROM rules
        UNION ALL SELECT host, agent, NULL, NULL, NULL FROM agents) named
  GROUP BY host, agent)""", "robots_bodies")
twin("effective_delay", PAIRS + "," + DELAYS + ", result AS (SELECT * FROM delays)", "robots_bodies")


def excluded(agent: str) -> str:
    return f"""
own AS (SELECT DISTINCT host FROM rules WHERE directive = 'disallow' AND agent = '{agent}'),
disallows AS (
  SELECT DISTINCT host, value FROM rules
  WHERE directive = 'disallow' AND agent = CASE WHEN host IN (SELECT host FROM own)
        THEN '{agent}' ELSE '*' END)"""


def open_urls(agent: str, target: str, extra: str = "") -> str:
    return PAIRS + "," + excluded(agent) + f""",
result AS (
  SELECT f.url, f.host FROM frontier f
  WHERE NOT EXISTS (SELECT 1 FROM disallows d WHERE d.host = f.host {extra}
                    AND starts_with({target} || '/', d.value)))"""


PAGE_PATH = "regexp_extract(f.url, '^[a-z]+://[^/?#]*([^?#]*)', 1)"
twin("robots_allowed", open_urls(AGENT, PAGE_PATH, "AND d.value <> ''"), "robots_bodies", "frontier")
twin("robots_allowed_any_agent", open_urls("nobody", PAGE_PATH, "AND d.value <> ''"), "robots_bodies", "frontier")
twin("robots_allowed_literal_url", open_urls(AGENT, "f.url"), "robots_bodies", "frontier")

twin("register_hosts_urls", PAIRS + "," + DELAYS + f""",
result AS (
  SELECT f.url, f.host,
         CAST({NOW_MS} + floor(coalesce(d.crawl_delay, 1.0) * 1000) AS BIGINT) AS next_request_ms
  FROM frontier f LEFT JOIN delays d ON d.host = f.host
  WHERE f.host NOT IN (SELECT host FROM host_state))""", "robots_bodies", "frontier", "host_state")
twin("register_hosts_rows", PAIRS + "," + DELAYS + f""",
all_hosts AS (SELECT host FROM frontier UNION SELECT host FROM arrivals),
result AS (
  SELECT a.host, coalesce(d.crawl_delay, 1.0) AS crawl_delay,
         CAST({NOW_MS} + floor(coalesce(d.crawl_delay, 1.0) * 1000) AS BIGINT) AS next_request_ms
  FROM all_hosts a LEFT JOIN delays d ON d.host = a.host)""", "robots_bodies", "frontier", "arrivals")
twin("due_urls", f"result AS (SELECT * FROM frontier WHERE next_request_ms - {NOW_MS} < 2000)", "frontier")
twin("pop_earliest", "result AS (SELECT * FROM frontier ORDER BY next_request_ms, url LIMIT 20)", "frontier")
twin("pop_earliest_rest", """
result AS (SELECT * FROM frontier ORDER BY next_request_ms, url LIMIT ALL OFFSET 20)""", "frontier")
twin("pop_due", f"""
result AS (
  SELECT * FROM frontier WHERE next_request_ms - {NOW_MS} < 2000
  ORDER BY next_request_ms, url LIMIT 15)""", "frontier")
twin("pop_due_rest", f"""
popped AS (
  SELECT url FROM frontier WHERE next_request_ms - {NOW_MS} < 2000
  ORDER BY next_request_ms, url LIMIT 15),
result AS (SELECT * FROM frontier WHERE url NOT IN (SELECT url FROM popped))""", "frontier")
twin("pull_batch", "result AS (SELECT * FROM frontier ORDER BY url LIMIT 25)", "frontier")
twin("pull_batch_rest", "result AS (SELECT * FROM frontier ORDER BY url LIMIT ALL OFFSET 25)", "frontier")
twin("pop_stored_earliest", "result AS (SELECT * FROM frontier ORDER BY next_request_ms, url LIMIT 20)", "frontier")
twin("pop_stored_earliest_rest", """
result AS (SELECT * FROM frontier ORDER BY next_request_ms, url LIMIT ALL OFFSET 20)""", "frontier")
twin("pop_stored_due", f"""
result AS (
  SELECT * FROM frontier WHERE next_request_ms - {NOW_MS} < 2000
  ORDER BY next_request_ms, url LIMIT 15)""", "frontier")
twin("pop_stored_due_rest", f"result AS (SELECT * FROM frontier WHERE next_request_ms - {NOW_MS} >= 2000)", "frontier")
twin("pull_stored_batch", "result AS (SELECT * FROM frontier ORDER BY url LIMIT 25)", "frontier")
twin("pull_stored_batch_rest", "result AS (SELECT * FROM frontier ORDER BY url LIMIT ALL OFFSET 25)", "frontier")
twin("frontier_in_time_order", "result AS (SELECT * FROM frontier ORDER BY next_request_ms, url)", "frontier")
twin("upsert_frontier", """
result AS (
  SELECT url || '/kept' AS url, host, next_request_ms, content_type FROM frontier
  UNION ALL
  SELECT url, host, (next_request_ms + 7) * 2, content_type FROM frontier
  UNION ALL
  SELECT url || '/again', host, (next_request_ms + 7) * 2, content_type FROM frontier)""", "frontier")
twin("upsert_stored_frontier", """
result AS (
  SELECT url || '/kept' AS url, host, next_request_ms, content_type FROM frontier
  UNION ALL
  SELECT url, host, (next_request_ms + 7) * 2, content_type FROM frontier
  UNION ALL
  SELECT url || '/again', host, (next_request_ms + 7) * 2, content_type FROM frontier)""", "frontier")
twin("clear_frontier", """
result AS (
  SELECT url, 'kept' AS state FROM frontier
  UNION ALL SELECT url || '/page', 'kept' FROM frontier WHERE next_request_ms % 1500 = 0
  UNION ALL SELECT host, 'kept' FROM host_state)""", "frontier", "host_state")
twin("delete_from_stored_frontier", ROUTED + """,
result AS (
  SELECT * FROM frontier WHERE url NOT IN (SELECT url FROM routed WHERE action = 'drop'))""",
     "fetch_log", "host_state", "frontier")
twin("delete_from_frontier", ROUTED + """,
result AS (
  SELECT * FROM frontier WHERE url NOT IN (SELECT url FROM routed WHERE action = 'drop'))""",
     "fetch_log", "host_state", "frontier")
twin("files_to_copy_documents", f"""
result AS (
  SELECT * FROM manifest
  WHERE NOT is_dir AND {NOW_MS} - modified_ms >= 60000 AND key NOT IN (SELECT key FROM copied))""",
     "manifest", "copied")


twin("list_and_copy", """
result AS (
  SELECT 'part=' || CAST(doc_id % 12 AS VARCHAR) AS folder,
         CAST(CASE WHEN doc_id % 12 < 5 THEN 1 ELSE 2 END AS BIGINT) AS taken, 'd' || CAST(doc_id AS VARCHAR) AS line
  FROM documents)""")


def bucket(name: str, n: int) -> str:
    """The bucket by comparing with every bound."""
    width = (1 << 160) // n
    bounds = ", ".join(f"'{width * i:040x}'" for i in range(1, n))
    return f"CAST(len(list_filter([{bounds}], lambda b: b <= sha1({name}))) AS INTEGER)"


twin("host_bucket_3", f"result AS (SELECT host, {bucket('host', 3)} AS bucket FROM page_hosts)", "page_hosts")
twin("host_bucket_16_arrivals", f"""
result AS (SELECT {bucket('host', 16)} AS bucket, count(*) AS n FROM arrivals GROUP BY 1)""", "arrivals")
twin("urls_per_node", PAGE_LINKS + f""",
numbered AS (
  SELECT page_id, ord, link, row_number() OVER (PARTITION BY page_id ORDER BY ord) - 1 AS i FROM good_links),
moved AS (
  SELECT page_id, ord, CASE WHEN i % 2 = 0 THEN link ELSE replace(link, '://', '://m') END AS link
  FROM numbered),
routed AS (SELECT page_id, ord, link, {bucket("split_part(link, '/', 3)", 3)} AS node FROM moved),
result AS (
  SELECT page_id, node, string_agg(link, '|' ORDER BY ord) AS urls FROM routed GROUP BY page_id, node)""")

ROUND = PAGE_LINKS + "," + ROUTED + "," + PAIRS + "," + DELAYS + "," + excluded(AGENT) + f""",
candidates AS (
  SELECT target AS url, split_part(target, '/', 3) AS host, 0 AS kind, 0 AS page_id, 0 AS ord, next_request_ms
  FROM routed WHERE action = 'redirect'
  UNION ALL
  SELECT link, {host('link')}, 1, page_id, ord, NULL FROM good_links
  WHERE starts_with(link, 'http://') OR starts_with(link, 'https://')),
once AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY url ORDER BY kind, page_id, ord, next_request_ms) AS nth
    FROM candidates WHERE len(string_split(url, '..')) - 1 < 3) c
  WHERE nth = 1 AND url NOT IN (SELECT url FROM frontier)),
timed AS (
  SELECT o.url, o.host, h.next_request_ms
         + row_number() OVER (PARTITION BY o.host ORDER BY o.page_id, o.ord, o.url)
         * CAST(floor(h.crawl_delay * 1000) AS BIGINT) AS t
  FROM once o LEFT JOIN host_state h ON h.host = o.host WHERE o.kind = 1),
waiting AS (
  SELECT url, host, next_request_ms FROM frontier
  UNION ALL SELECT url, host, next_request_ms FROM once WHERE kind = 0
  UNION ALL SELECT url, host, coalesce(t, 0) FROM timed),
ready AS (SELECT * FROM waiting WHERE next_request_ms - {NOW_MS} < 2000),
late AS (SELECT * FROM waiting WHERE next_request_ms - {NOW_MS} >= 2000),
entered AS (
  SELECT r.url, r.host, coalesce(d.crawl_delay, 1.0) AS crawl_delay,
         CAST({NOW_MS} + floor(coalesce(d.crawl_delay, 1.0) * 1000) AS BIGINT) AS next_request_ms
  FROM ready r LEFT JOIN delays d ON d.host = r.host
  WHERE r.host NOT IN (SELECT host FROM host_state)),
open_now AS (
  SELECT f.url, f.next_request_ms FROM ready f
  WHERE f.host IN (SELECT host FROM host_state)
    AND NOT EXISTS (SELECT 1 FROM disallows d WHERE d.host = f.host AND d.value <> ''
                    AND starts_with({PAGE_PATH} || '/', d.value)))"""
ROUND_INPUTS = ("fetch_log", "host_state", "robots_bodies", "frontier")
twin("frontier_round", ROUND + """,
result AS (
  SELECT url, CAST(next_request_ms AS BIGINT) AS next_request_ms, 'fetch' AS state FROM routed WHERE action = 'fetch'
  UNION ALL SELECT url, CAST(next_request_ms AS BIGINT), 'due' FROM open_now
  UNION ALL SELECT url, CAST(next_request_ms AS BIGINT), 'queued' FROM late
  UNION ALL SELECT url, CAST(next_request_ms AS BIGINT), 'queued' FROM entered)""", *ROUND_INPUTS)
twin("frontier_round_hosts", ROUND + """,
totals AS (SELECT host, count(*) AS n FROM timed GROUP BY host),
result AS (
  SELECT h.host, h.crawl_delay, CAST(h.next_request_ms
         + coalesce(t.n, 0) * CAST(floor(h.crawl_delay * 1000) AS BIGINT) AS BIGINT) AS next_request_ms
  FROM host_state h LEFT JOIN totals t ON t.host = h.host
  UNION ALL SELECT DISTINCT host, crawl_delay, next_request_ms FROM entered)""", *ROUND_INPUTS)

twin("frontier_round_get_queue", ROUND + f""",
pages_waiting AS (
  SELECT url || '/page' AS url, next_request_ms FROM frontier WHERE next_request_ms % 1500 = 0
  UNION ALL SELECT url, next_request_ms FROM routed WHERE action = 'fetch'),
result AS (
  SELECT url, CAST(next_request_ms AS BIGINT) AS next_request_ms,
         CASE WHEN next_request_ms - {NOW_MS} < 2000 THEN 'fetch' ELSE 'get' END AS state FROM pages_waiting
  UNION ALL SELECT url, CAST(next_request_ms AS BIGINT), 'due' FROM open_now
  UNION ALL SELECT url, CAST(next_request_ms AS BIGINT), 'head' FROM late
  UNION ALL SELECT url, CAST(next_request_ms AS BIGINT), 'head' FROM entered)""", *ROUND_INPUTS)
twin("frontier_round_deltas", ROUND + """,
totals AS (SELECT host, count(*) AS n FROM timed GROUP BY host),
result AS (
  SELECT url, CAST(next_request_ms AS BIGINT) AS next_request_ms, 'new' AS state FROM once WHERE kind = 0
  UNION ALL SELECT url, CAST(coalesce(t, 0) AS BIGINT), 'new' FROM timed
  UNION ALL SELECT r.url, CAST(r.next_request_ms AS BIGINT),
                   CASE WHEN r.url IN (SELECT url FROM open_now) THEN 'removed, due' ELSE 'removed, excluded' END
            FROM ready r WHERE r.host IN (SELECT host FROM host_state)
  UNION ALL SELECT h.host, CAST(h.next_request_ms + t.n * CAST(floor(h.crawl_delay * 1000) AS BIGINT) AS BIGINT), 'moved'
            FROM host_state h JOIN totals t ON t.host = h.host
  UNION ALL SELECT DISTINCT host, next_request_ms, 'moved' FROM entered)""", *ROUND_INPUTS)
twin("frontier_round_seen", ROUND + """,
result AS (
  SELECT url FROM frontier
  UNION ALL SELECT url || '/page' FROM frontier WHERE next_request_ms % 1500 = 0
  UNION ALL SELECT url FROM once)""", *ROUND_INPUTS)

# Files and streams

twin("document_files_round_trip", """
result AS (SELECT 'doc-' || doc_id AS url, text AS body FROM documents)""")
twin("link_files_round_trip", f"{PAGE_LINKS}, result AS (SELECT url AS src, link AS dst FROM good_links)")
twin("stream_admit", """
result AS (SELECT DISTINCT url FROM arrivals WHERE NOT ends_with(url, '7'))""", "arrivals")
twin("stream_rolling_files", "result AS (SELECT event_id, event_type FROM events)")
twin("rolled_windows", """
result AS (
  SELECT event_id, strftime(time_bucket(INTERVAL 30 SECOND, ts), '%Y-%m-%d %H:%M:%S') AS window_start
  FROM events)""")
twin("arrivals_per_window", """
result AS (
  SELECT strftime(time_bucket(INTERVAL 30 SECOND, ts), '%Y-%m-%d %H:%M:%S') AS window_start,
         strftime(time_bucket(INTERVAL 30 SECOND, ts) + INTERVAL 30 SECOND, '%Y-%m-%d %H:%M:%S') AS window_end,
         count(*) AS n
  FROM events GROUP BY 1, 2)""")
twin("stream_crawl_links", PAGE_LINKS + "," + TARGETS + """,
result AS (
  SELECT p.url AS source, coalesce(t.targets, '') AS targets
  FROM pages p LEFT JOIN target_lists t ON t.page_id = p.page_id)""")
twin("stream_crawl_documents", "result AS (SELECT url, " + BODY.format("html") + " AS body FROM pages)")
# Three batches with arrivals and one without: the clock of the last decides.
twin("stream_due", f"""
result AS (
  SELECT url, next_request_ms FROM frontier
  WHERE next_request_ms < {NOW_MS} + 3 * 40000 + 2000)""", "frontier")
