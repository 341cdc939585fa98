"""Incremental snapshots on Structured Streaming (see ``snapshots``)."""

from cohortkit.streaming.snapshots import merged_snapshots, start_snapshot_stream

__all__ = ["merged_snapshots", "start_snapshot_stream"]
