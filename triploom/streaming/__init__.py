"""Incremental ingest and live weekly counts with Structured Streaming."""

from triploom.streaming.ingest import stream_ingest  # noqa: F401
from triploom.streaming.weekly_live import (  # noqa: F401
    current_weekly_bbox, current_weekly_counts, register_boxes, start_weekly_boxes,
    start_weekly_counts, weekly_boxes_stream, weekly_counts_stream,
)
