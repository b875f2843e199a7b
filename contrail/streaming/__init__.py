"""Structured Streaming: the hops between layers, and control of queries."""
