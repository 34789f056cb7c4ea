"""Structured Streaming jobs: file ingest, merge into current state, and
event-time minute bars."""
