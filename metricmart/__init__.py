"""metricmart: a Spark-native dimensional warehouse and metric engine for usage-billed API platforms."""

__version__ = "0.1.0"
