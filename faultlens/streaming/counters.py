"""Counters observed by streams, added up over their batches."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener


class Counters:
    """Sums of observed metrics by name; a batch reported again counts once, as does one that ran again."""

    def __init__(self):
        self.seen: dict[tuple[str, int], dict] = {}

    def add(self, query_id: str, batch_id: int, observed: dict) -> None:
        if observed:
            self.seen[str(query_id), int(batch_id)] = {name: row.asDict() for name, row in observed.items()}

    def take(self, query: StreamingQuery) -> None:
        """What a query's recent batches observed; to be called while it runs and once it has ended."""
        for progress in query.recentProgress:
            self.add(progress.id, progress.batchId, progress.observedMetrics)

    def total(self, name: str) -> dict[str, int]:
        out: dict[str, int] = defaultdict(int)
        for metrics in self.seen.values():
            for key, value in metrics.get(name, {}).items():
                out[key] += value or 0
        return dict(out)

    def latest(self, name: str) -> dict[str, int]:
        """The values of the newest batch that had any rows, for gauges."""
        rows = [(k[1], m[name]) for k, m in self.seen.items() if any(m.get(name, {}).values())]
        return max(rows, key=lambda r: r[0])[1] if rows else {}


class CounterListener(StreamingQueryListener):
    """Feeds ``Counters`` from all queries of a session."""

    def __init__(self, counters: Counters):
        self.counters = counters

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.counters.add(p.id, p.batchId, p.observedMetrics)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass
