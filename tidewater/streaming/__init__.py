"""Structured Streaming: runner (batch/stream with one transform), watermarked
aggregates, stream joins, de-duplication and per-batch upserts."""
