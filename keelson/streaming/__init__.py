"""Structured Streaming sources, bars and the incremental forecast cycle."""
