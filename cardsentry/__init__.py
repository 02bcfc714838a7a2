"""cardsentry: card-payment fraud analytics as Spark DataFrame plans.

Every operator is a function ``DataFrame -> DataFrame`` (or a small
composition of them) built from native Spark SQL expressions, so Catalyst
sees one plan per query and can prune, push down and re-plan it with AQE.
"""

__all__ = ["__version__"]

__version__ = "0.1.0"
