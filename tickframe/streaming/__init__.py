from tickframe.streaming.analyze import start_analyze
from tickframe.streaming.ingest import start_ingest, start_quarantine
from tickframe.streaming.latest import latest_per_minute_stream, start_latest

__all__ = [
    "latest_per_minute_stream",
    "start_analyze",
    "start_ingest",
    "start_latest",
    "start_quarantine",
]
