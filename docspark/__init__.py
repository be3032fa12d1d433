"""docspark: document collections as Spark tables.

Declare a collection once (:mod:`docspark.schema`), conform JSON or typed rows to it (:mod:`docspark.operators.conform`),
write by id (:mod:`docspark.operators.writes`, :mod:`docspark.sources.store`), search and page
(:mod:`docspark.operators.search`), aggregate (:mod:`docspark.operators.aggs`), score text
(:mod:`docspark.operators.text`), report drift and evolve (:mod:`docspark.operators.drift`), and scan in batches
(:mod:`docspark.operators.scan`). Every operator is a DataFrame transformation.
"""

from .schema import Collection, DynamicTemplate, Field  # noqa: F401

__version__ = "0.1.0"
