"""Structured Streaming: event-file source, stateless enrichment, sliding-window stats and
anomalies, and sinks whose results stay distributed (parquet in the shared folder)."""
from airnet.streaming.core import (  # noqa: F401
    append_sink, compact_sink, event_stream, latest_state, live_folders, open_state, run_until_done, scratch_path, to_event_time, to_wall_clock, upsert_sink,
)
from airnet.streaming.jobs import (  # noqa: F401
    stream_anomalies, stream_round_robin, stream_watermarked_counts, stream_window_stats,
)
