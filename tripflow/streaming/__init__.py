"""Structured Streaming: decoding, windowed counts, replay and sinks."""

from tripflow.streaming.batches import (
    fold_updates,
    read_sorted,
    read_updated,
    start_sorted,
    start_table,
    start_update,
)
from tripflow.streaming.counts import stream_zone_pair_counts, with_watermark
from tripflow.streaming.decode import decode_messages, with_event_time
from tripflow.streaming.replay import replay_files
from tripflow.streaming.sinks import (
    read_complete,
    start_append,
    start_complete,
    start_console,
)

__all__ = [
    "decode_messages",
    "fold_updates",
    "read_complete",
    "read_sorted",
    "read_updated",
    "replay_files",
    "start_append",
    "start_complete",
    "start_console",
    "start_sorted",
    "start_table",
    "start_update",
    "stream_zone_pair_counts",
    "with_event_time",
    "with_watermark",
]
