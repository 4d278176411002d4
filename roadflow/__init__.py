"""roadflow: a Spark-native road-traffic count warehouse and report engine."""

__version__ = "0.1.0"
