"""Structured Streaming: sources, settlement, window metrics, per-batch writers."""
