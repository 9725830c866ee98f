"""Structured Streaming jobs: ingest-featurize-store, land, dedupe, replay, score (OP-60..66)."""
