"""Sinks: envelope publish, keyed upsert store, per-batch landing, manifests, models (OP-08..12)."""
