"""Sources: input tables, message streams, manifests, directories, stores (OP-01..07, 13..16)."""

from vigil.sources.tables import TABLES, table

__all__ = ["TABLES", "table"]
