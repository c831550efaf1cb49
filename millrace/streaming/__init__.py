"""Structured Streaming: draining a bounded stream to its end, stateful processors, streaming jobs."""
