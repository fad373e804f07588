"""Registered queries over the driver tables, each with a DuckDB oracle.

Importing this package registers every query; ``registry.QUERIES`` maps a
name to ``(callable(spark, sf_dir) -> DataFrame, oracle SQL or None)``.
"""

from duelframe.plans import registry  # noqa: F401
from duelframe.plans import (  # noqa: F401  (import = registration)
    careers, keys_text, projections, joins, aggregates, ordering, reshaping, sources, prep,
    metrics, models, pages, names,
)
