"""Relational operators: ranking, splitting, sampling, pooling, joins, upsert, training."""
