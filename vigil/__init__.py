"""vigil: Spark-native moderation analytics (curate, decode, featurize, store, train, score, report)."""

__version__ = "0.1.0"
