"""A sign of life from streams, whatever they process."""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql.streaming import StreamingQueryListener


class Heartbeat(StreamingQueryListener):
    """Calls sink(event, fields) when a query starts, progresses, is idle or ends. A failing sink never fails the query."""

    def __init__(self, sink: Callable[[str, dict], None]):
        self.sink = sink

    def _say(self, event: str, **fields) -> None:
        try:
            self.sink(event, fields)
        except Exception:  # telling must not stop the work
            pass

    def onQueryStarted(self, event):
        self._say("started", id=str(event.id))

    def onQueryProgress(self, event):
        p = event.progress
        self._say("progress", id=str(p.id), batch=p.batchId, rows=p.numInputRows)

    def onQueryIdle(self, event):
        self._say("idle", id=str(event.id))

    def onQueryTerminated(self, event):
        self._say("ended", id=str(event.id), error=event.exception)


class Ticker:
    """Calls sink("progress", fields of status()) every so many seconds while its block runs, whether or not a batch ends meanwhile; where status() fails it says so, and a failing sink stops nothing.

    status is often streams(spark)."""

    def __init__(self, sink: Callable[[str, dict], None], seconds: float, status: Callable[[], dict]):
        self.sink, self.seconds, self.status = sink, seconds, status
        self._stop = threading.Event()
        self._thread = threading.Thread(target=self._run, name="ticker", daemon=True)

    def _run(self) -> None:
        while not self._stop.wait(self.seconds):
            try:
                event, fields = "progress", self.status()
            except Exception as e:  # noqa: BLE001  whatever it is, the work goes on
                event, fields = "progress_unavailable", {"error_type": type(e).__name__}
            try:
                self.sink(event, fields)
            except Exception:  # noqa: BLE001
                pass

    def __enter__(self):
        self._thread.start()
        return self

    def __exit__(self, *_):
        self._stop.set()
        self._thread.join()


def streams(spark) -> Callable[[], dict]:
    """A status of the session's active streams: what each is doing, and its last batch."""

    def status() -> dict:
        out = {}
        for q in spark.streams.active:
            last = q.lastProgress
            out[q.name or str(q.id)] = {"doing": q.status["message"], "batch": last["batchId"] if last else None}
        return {"streams": out}

    return status
