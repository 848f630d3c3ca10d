"""Counters of a running pipeline, in a form that monitors scrape, and its health.

What comes in is counted where it passes (metrics observed in the stream's plan, which a
listener hears of after each micro-batch), what goes out where the sink has taken it.
``/metrics`` gives both in the usual text form, ``/health/live`` and ``/health/ready``
answer probes: live while the query has not failed, ready once it has started.
"""

from __future__ import annotations

import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

from pyspark.sql.streaming import StreamingQueryListener

PORT = 9090
COUNTERS = ("chunks_received", "bytes_received", "records_parsed", "parse_errors", "batches_sent", "messages_sent", "send_errors")
TABLE_COUNTERS = ("insert_count", "update_count", "delete_count")
#: Microseconds from 1970 to 2000, where the server's commit times begin.
EPOCH_2000_US = 946_684_800_000_000


class Monitor(StreamingQueryListener):
    """Totals of one pipeline; safe to read while it runs."""

    def __init__(self, commit_epoch_us: int = EPOCH_2000_US) -> None:
        self.lock, self.values = threading.Lock(), dict.fromkeys(COUNTERS, 0)
        self.tables: dict[tuple[str, str], dict[str, int]] = {}
        self.last_lsn: int | None = None
        self.state, self.error, self.query_name, self.query_id = "starting", None, None, None
        self.seen: set[int] = set()
        self.commit_epoch_us = commit_epoch_us

    def add(self, **found: int) -> None:
        with self.lock:
            for name, n in found.items():
                self.values[name] += n

    def add_table(self, schema: str, table: str, last_commit: int, **found: int) -> None:
        with self.lock:
            about = self.tables.setdefault((schema, table), dict.fromkeys(TABLE_COUNTERS, 0) | {"last_commit": last_commit})
            for name, n in found.items():
                about[name] += n
            about["last_commit"] = max(about["last_commit"], last_commit)

    def lag_ms(self, schema: str, table: str, now_ms: int | None = None) -> int:
        """Milliseconds since the last commit of a table."""
        now = int(time.time() * 1000) if now_ms is None else now_ms
        return now - (self.tables[schema, table]["last_commit"] + self.commit_epoch_us) // 1000

    def observed(self, batch_id: int, metrics) -> None:
        """What passed in one micro-batch; each counts once."""
        with self.lock:
            if batch_id in self.seen:
                return
            self.seen = {b for b in self.seen if b > batch_id - 100} | {batch_id}
        for name in ("chunks", "parsed"):
            if row := metrics.get(name):
                self.add(**{k: v for k, v in row.asDict().items() if k in COUNTERS and v})

    def onQueryStarted(self, event) -> None:
        if event.name is not None and event.name == self.query_name:
            self.state, self.error, self.query_id = "running", None, str(event.id)

    def onQueryProgress(self, event) -> None:
        if event.progress.name is not None and event.progress.name == self.query_name:
            self.observed(event.progress.batchId, event.progress.observedMetrics)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.query_id:
            self.state, self.error = ("failed", event.exception) if event.exception else ("stopped", None)

    def exposition(self, now_ms: int | None = None) -> str:
        """All counters as text."""
        with self.lock:
            values, tables, last = dict(self.values), {k: dict(v) for k, v in self.tables.items()}, self.last_lsn
        out = []
        for name, n in values.items():
            out += [f"# TYPE tidelog_{name}_total counter", f"tidelog_{name}_total {n}"]
        if last is not None:
            out += ["# TYPE tidelog_last_lsn gauge", f"tidelog_last_lsn {last}"]
        quote = lambda x: x.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n")
        labels = {k: f'{{schema="{quote(k[0])}",table="{quote(k[1])}"}}' for k in sorted(tables)}
        for name in TABLE_COUNTERS:
            out += [f"# TYPE tidelog_table_{name}_total counter", *[f"tidelog_table_{name}_total{labels[k]} {tables[k][name]}" for k in labels]]
        out += ["# TYPE tidelog_table_lag_ms gauge", *[f"tidelog_table_lag_ms{labels[k]} {self.lag_ms(*k, now_ms)}" for k in labels]]
        return "\n".join(out) + "\n"

    def serve(self, port: int = PORT, host: str = "") -> ThreadingHTTPServer:
        """Answer scrapes and probes from a thread; ``shutdown()`` ends it. Port 0 takes a free one."""
        monitor = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self) -> None:
                answers = {
                    "/metrics": lambda: (200, monitor.exposition()),
                    "/health/live": lambda: (503 if monitor.state == "failed" else 200, monitor.state + "\n"),
                    "/health/ready": lambda: (200 if monitor.state == "running" else 503, monitor.state + "\n"),
                }
                status, text = answers.get(self.path.partition("?")[0], lambda: (404, "not found\n"))()
                body = text.encode()
                self.send_response(status)
                self.send_header("Content-Type", "text/plain; version=0.0.4; charset=utf-8")
                self.send_header("Content-Length", str(len(body)))
                self.end_headers()
                self.wfile.write(body)

            def log_message(self, *_) -> None:
                pass

        server = ThreadingHTTPServer((host, port), Handler)
        threading.Thread(target=server.serve_forever, daemon=True).start()
        return server
