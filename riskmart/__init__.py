"""Risk-data aggregation and data-quality scoring on Spark.

Layers: landing (all-string, append-only) -> conformed (typed, one row per key)
-> marts (risk-weighted assets, quality scorecard) -> reports.
"""

__version__ = "0.1.0"
