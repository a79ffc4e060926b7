"""Structured Streaming: event stream, windowed aggregates, fan-out."""
