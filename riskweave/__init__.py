"""riskweave — supply-network risk and resilience analytics on Spark.

Every operator is a pure function ``DataFrame(s) -> DataFrame``: no session
creation, no ``collect`` and no writes inside operators. The only driver-side
scalars are the convergence checks of the two iterative graph operators.
"""

__version__ = "0.1.0"
