"""daybook: daily demand analytics on Spark.

Raw transactions → one row per transaction → daily demand per product and
city → gap-filled daily series with lag, rolling and calendar features →
a distributed gradient-boosted model, its metrics and the champion /
challenger decision. Every step is a function from DataFrame to DataFrame.
"""

__version__ = "0.1.0"
