"""Status of running queries: totals from their progress, logged at a level by what is behind."""

from __future__ import annotations

import logging

from pyspark.sql.streaming import StreamingQueryListener

from logloom.operators.metrics import INFO_BEHIND, WARN_BEHIND


class Status(StreamingQueryListener):
    """Sums rows by query; `behind` may be set to a function of the query's name that returns
    the bytes it hasn't read yet."""

    def __init__(self, behind=None, logger: str = "logloom.status"):
        self.behind, self.log, self.totals = behind, logging.getLogger(logger), {}

    def onQueryStarted(self, event) -> None:
        self.totals.setdefault(str(event.id), {"batches": 0, "rows": 0})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        t = self.totals.setdefault(str(p.id), {"batches": 0, "rows": 0})
        t["batches"] += 1
        t["rows"] += p.numInputRows
        left = self.behind(p.name) if self.behind else 0
        level = logging.WARNING if left >= WARN_BEHIND else logging.INFO if left >= INFO_BEHIND else logging.DEBUG
        self.log.log(level, "%s: batch %d, %d rows in all, %d bytes behind", p.name or p.id, p.batchId, t["rows"], left)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.totals.pop(str(event.id), None)
