"""dragoman: intent classification, routing and label-data refinery on Spark.

Import the sub-packages directly, e.g. ``from dragoman.operators import gate``.
"""

__all__ = ["dims", "session", "functions", "operators", "sources", "streaming", "plans"]
