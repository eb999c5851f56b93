"""Structured Streaming: a watched folder and a polled source."""
