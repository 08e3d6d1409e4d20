"""Structured Streaming jobs."""

from adsift.streaming.hourly import for_each_batch, hourly_stream, hours_of, ingest_hours  # noqa: F401
from adsift.streaming.state import (  # noqa: F401
    first_seen_stream, read_first_seen, read_running_totals, running_totals_stream,
)
from adsift.streaming.wordcount import (  # noqa: F401
    file_line_stream, read_batches, run_to_end, socket_line_stream, word_count_stream, words,
)
