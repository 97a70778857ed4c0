"""Arriving files: each once, upsert by key (as a log or as state), scoring."""

from tabulon.streaming.ingest import file_stream, ingest_new_files, score_stream
from tabulon.streaming.keyed_state import last_rows, upsert_stream, upserted
from tabulon.streaming.merge_log import compact, latest_versions, merge_stream

__all__ = [
    "compact", "file_stream", "ingest_new_files", "last_rows", "latest_versions", "merge_stream", "score_stream", "upsert_stream", "upserted",
]
