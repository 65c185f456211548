"""Structured Streaming form of the incremental (DELTA) loads."""
