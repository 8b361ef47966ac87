"""Structured Streaming forms of the digest job (ST1-ST5)."""
