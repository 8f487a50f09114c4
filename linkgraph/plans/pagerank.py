"""The whole ranking: prepare, iterate with a stop rule, order."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import closing

from pyspark.sql import DataFrame, Observation, functions as F

from linkgraph.operators.edges import to_edges
from linkgraph.operators.ranking import (
    DAMPING, initial_state, link_graph, measured_step, pagerank_finish, pagerank_step, single_step, start_state,
    whole_state)
from linkgraph.session import checkpointed, drop_path, scratch_path, written


def rank_states(edges: DataFrame, damping: float = DAMPING, checkpoint_every: int = 5,
                distinct_edges: bool = False, keep: bool = True) -> Iterator[DataFrame]:
    """States 0, 1, 2 and so on over one graph, for as long as they are asked for.

    A state can be used until two states later. States are written to the checkpoint folder every few steps, so
    neither the plan nor the work lost with an executor grows with the number of steps; with ``keep``, or next
    to hub edges, the others are cached in their layout. The graph is given up when the iterator is closed.
    """
    with closing(_states(edges, damping, checkpoint_every, distinct_edges, keep, False)) as states:
        for state, _ in states:
            yield state


def _states(edges: DataFrame, damping: float, checkpoint_every: int, distinct_edges: bool, keep: bool,
            measure: bool) -> Iterator[tuple[DataFrame, float | None]]:
    """States, each with the most that a rank moved by if that is to be measured.

    The movement is a metric of the job that computes the state, so there is one job a step. Such a state is read
    twice by the next step and therefore always written.
    """
    graph = link_graph(edges, distinct_edges)
    held: list[tuple[int, DataFrame]] = []
    try:
        state, step = initial_state(graph), 0
        yield state, None
        if measure:
            state = whole_state(graph)
        while True:
            step += 1
            moved = Observation()
            if measure:
                following = measured_step(state, graph, damping).observe(
                    moved, F.max("delta").alias("delta")).drop("delta")
            else:
                following = pagerank_step(state, graph, damping)
            if measure or step % checkpoint_every == 0:
                following = checkpointed(following)
            elif keep or graph.hub_edges is not None:
                held.append((step, following.persist()))
                following.count()
            state = following
            yield state, (moved.get["delta"] or 0.0) if measure else None
            # what lies before the checkpoint before is read no more
            reached = step // checkpoint_every * checkpoint_every
            while held and held[0][0] < reached and held[0][0] < step - 1:
                held.pop(0)[1].unpersist()
    finally:
        release([frame for _, frame in held])
        graph.release()


def rank_edges(edges: DataFrame, max_iter: int = 1, tol: float | None = None,
               damping: float = DAMPING, check_every: int = 1, checkpoint_every: int = 5,
               distinct_edges: bool = False) -> DataFrame:
    """The state after ``max_iter`` steps, or fewer once no rank moves by more than ``tol``.

    No step, and a single one without a test, need no graph laid out for more.
    """
    if max_iter == 0:
        return checkpointed(start_state(edges, distinct_edges))
    if max_iter == 1 and tol is None:
        pairs = scratch_path(edges.sparkSession, "pairs")
        state = checkpointed(single_step(written(edges.select("src", "dst"), pairs), damping, distinct_edges))
        drop_path(edges.sparkSession, pairs)
        return state
    with closing(_states(edges, damping, checkpoint_every, distinct_edges, False, tol is not None)) as states:
        state, _ = next(states)
        for i in range(1, max_iter + 1):
            state, moved = next(states)
            if tol is not None and i % check_every == 0 and moved <= tol:
                break
        return checkpointed(state)


def release(cached: list[DataFrame]) -> None:
    while cached:
        cached.pop().unpersist()


def pagerank(links: DataFrame, max_iter: int = 1, tol: float | None = None,
             damping: float = DAMPING, check_every: int = 1, checkpoint_every: int = 5,
             limit: int | None = None, distinct_edges: bool = False) -> DataFrame:
    """Rank a link table (``source, targets``): ``node, rank`` in rank order."""
    state = rank_edges(to_edges(links), max_iter, tol, damping, check_every, checkpoint_every,
                       distinct_edges)
    return pagerank_finish(state, limit)
