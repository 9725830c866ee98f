"""Operators of a large-scale training-data pipeline.

Nothing outside this folder imports it. Each module holds one operator with a general
interface; ``vigil.llm.queries`` registers the thin ``opN_<name>`` queries.
"""
