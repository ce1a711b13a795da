"""keepwise — Spark-native subscriber churn and retention analytics.

Every operator is a DataFrame -> DataFrame function (or a fitted Spark ML
stage) that runs as a lazy Catalyst plan.  See README.md for the map from
capabilities to modules.
"""

__version__ = "0.1.0"
