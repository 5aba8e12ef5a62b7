"""X11: one multiplexed log read by several concurrent streams, one per route.

Every route is a query of its own: own checkpoint, own output, own progress. They are started together and awaited together;
a query that fails stops the others or is reported when all are done. A route that is started again goes on where its own
checkpoint stands, whatever the others did.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from .runner import run_stream


class RoutesFailed(RuntimeError):
    """Some routes failed; ``errors``: route -> exception."""

    def __init__(self, errors: Mapping[str, BaseException]):
        super().__init__("; ".join(f"{k}: {str(e)[:200]}" for k, e in errors.items()))
        self.errors = dict(errors)


@dataclass
class Routes:
    """Running queries by route."""

    queries: dict[str, StreamingQuery] = field(default_factory=dict)

    def wait(self, stop_on_failure: bool = True) -> dict[str, int]:
        """Wait for all queries; returns the rows each has read. If one fails, stop the rest at once (or let them finish), then raise
        ``RoutesFailed`` with all failures."""
        open_, errors = dict(self.queries), {}
        while open_:
            for name, q in list(open_.items()):
                try:
                    done = q.awaitTermination(0.2)
                except Exception as e:  # the query's own failure, kept for the report
                    errors[name], done = e, True
                if done:
                    del open_[name]
                    if name in errors and stop_on_failure:
                        for other in open_.values():
                            other.stop()
        if errors:
            raise RoutesFailed(errors)
        return {n: sum(int(p["numInputRows"]) for p in q.recentProgress) for n, q in self.queries.items()}


def start_routes(read_route: Callable[[str], DataFrame], routes: Mapping[str, str], root: str,
                 transform: Callable[[DataFrame, str], DataFrame] = lambda df, name: df,
                 writers: Mapping[str, Callable[[DataFrame, int], None]] | None = None, **options) -> Routes:
    """Start a query per route: ``read_route(literal)`` is its stream (each route reads the log by itself), written to
    ``root/<route>`` with the checkpoint ``root/_checkpoints/<route>``, or handed to its ``foreachBatch`` function in ``writers``."""
    out = Routes()
    for name, literal in routes.items():
        df = transform(read_route(literal), name)
        sink = {"foreach_batch": writers[name]} if writers and name in writers else {"path": f"{root}/{name}"}
        out.queries[name] = run_stream(df, f"{root}/_checkpoints/{name}", wait=False, **sink, **options)
    return out
