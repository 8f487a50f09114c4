"""Web-crawl data preparation and link ranking as Spark jobs."""

from linkgraph.operators.edges import drop_self_links, to_edges, weighted_edges
from linkgraph.operators.exchange import urls_per_node, write_exchange
from linkgraph.operators.frontier import (
    admit, drop_trap_urls, due, first_occurrence, pop_due, pop_earliest, pull_batch, register_hosts,
    route_fetches, schedule, url_candidates, with_host_state)
from linkgraph.operators.pages import (
    candidate_urls, crawl_outputs, extract_links, page_links, resolve_links)
from linkgraph.operators.ranking import (
    has_converged, initial_state, link_graph, max_delta, pagerank_finish, pagerank_init,
    pagerank_step, rank_delta)
from linkgraph.operators.robots import (
    allowed, effective_delay, effective_disallow, host_rules, known_agents, parse_robots)
from linkgraph.operators.tables import clear, delete_keys, upsert
from linkgraph.plans.frontier import frontier_round
from linkgraph.plans.pagerank import pagerank, rank_edges, rank_states
from linkgraph.plans.stored_frontier import StoredFrontier, StoredRound
from linkgraph.plans.stored_ranking import StoredRanking
from linkgraph.session import build_session
from linkgraph.sources.documents import read_documents, write_documents
from linkgraph.sources.files import FileArchive, list_files
from linkgraph.sources.links import read_links, write_links
from linkgraph.sources.ranks import (
    read_rank_state, read_rank_states, write_rank_state, write_ranks)
from linkgraph.sources.urls import (
    append_seen, files_to_copy, read_settled, read_url_batch, seeds, stream_url_batches)
from linkgraph.stored.keyed import KeyedTable
from linkgraph.stored.ordered import OrderedTable, SlotTable, prefix_part
from linkgraph.stored.seen import SeenTable
from linkgraph.streaming.admission import start_admission
from linkgraph.streaming.admit import arrivals_per_window, stream_admit
from linkgraph.streaming.due import start_due
from linkgraph.streaming.schedule import start_schedule
from linkgraph.streaming.sinks import start_crawl_outputs, start_rolling_sink, write_rolled
