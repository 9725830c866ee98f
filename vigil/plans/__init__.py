"""Query plans: one builder ``(spark, sf_dir) -> DataFrame`` per operator, plus the
equivalent DuckDB SQL used as the correctness oracle where one exists."""

from vigil.plans.catalog import ORACLES, QUERIES, load_all

__all__ = ["ORACLES", "QUERIES", "load_all"]
