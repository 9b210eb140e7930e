"""airshed: a Spark-native medallion pipeline for air-quality, weather and traffic feeds.

Layers: ``sources`` (bronze readers, driver-table adapters, dimensions), ``operators``
(cleaning, dedup, marts, joins, serving aggregates, payload normalisers), ``functions``
(Column-expression classifiers and numerics), ``plans`` (composed jobs, views, the query
catalog), ``streaming`` (Structured Streaming landing) and ``ml`` (MLlib forecast).
"""

__all__ = ["session"]
