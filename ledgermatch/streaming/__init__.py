"""Structured Streaming reconciliation."""
