"""Structured Streaming twins of the log, routing and vote operators."""
