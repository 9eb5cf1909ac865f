"""Structured Streaming intake and the per-batch outbox."""
